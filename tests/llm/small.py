"""Small tables and plain Python versions for the tests of this folder."""

import re

SF001, SF01, SF1 = (f"/root/testdata/sf{x}" for x in ("0.001", "0.01", "0.1"))
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
LONG = " ".join(f"word{i % 977}" for i in range(20000))

#: Nulls in any column, empty and very long texts, ties, repeated rows.
ODD_ROWS = [
    (1, "a b c d e f g h", "en", "s1", 15), (1, "a b c d e f g h", "en", "s1", 15), (2, "a b c d e f g h", None, None, None),
    (3, None, "en", "s1", 0), (4, "", "en", "s2", 0), (5, " \t\n ", "en", "s2", 4), (None, "a b c d e f g h", "en", "s1", 15),
    (6, LONG, "en", "s3", len(LONG)), (7, LONG + " tail", "en", "s3", None), (8, "x", "", "", 1), (9, "x", "de", "s1", 1),
    (10, "<|endoftext|> <turn x> </turn> \\ é漢😀", "de", "s1", -1), (None, None, None, None, None),
]
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def odd(spark):
    """The odd rows, with further columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD_ROWS, DOCUMENTS)
    for c in ("node", "cluster", "row", "class", "blob", "kept", "n_words", "score", "_text", "_id", "_label", "position"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def shingles(text, size):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) or frozenset([tuple(w)])


def duplicate_components(rows, size=4, percent=80):
    """{id: smallest id reachable} by comparing all pairs."""
    sets = {i: shingles(t, size) for i, t in rows}
    top = {i: i for i in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    ra, rb = root(a), root(b)
                    top[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in sets}
