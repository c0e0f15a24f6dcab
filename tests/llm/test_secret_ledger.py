import hashlib
import random
import re

from layerkit.llm import secret_ledger as sl

from .small import ODD_ROWS, SF001, empty, odd

KINDS = [
    ("assign", re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))"""
                          r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]


def base(text):
    out = []
    for place, (kind, rx, group, least) in enumerate(KINDS):
        out += [(m.start(), place, kind, m.end()) for m in rx.finditer(text or "") if len(m.group(group)) >= least]
    return sorted(out)


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{z}" for a, _, k, z in spans).encode()).hexdigest()


def test_spans_match_plain_python(spark):
    rng = random.Random(4)
    bits = ["password", "Secret", "token", "api_key", "APIKEY", "passwd", "=", ": ", '"', "'", " ", "\n", "é漢😀", "AKIA", "AB12" * 4, "0a" * 12, "deadbeef", "abc", "x.y-z/", "==", "A", "\\"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(400)] + [None, "", "secret: token: abcdefgh", "token=token=abcdefgh"]
    df = spark.createDataFrame(list(enumerate(texts)), "path long, text string")
    got = sl.scan(df, sl.new_ledger(spark), ["path"], {"base": sl.RULES["base"]}).collect()
    want = {i: base(t) for i, t in enumerate(texts)}
    assert sum(map(len, want.values())) > 200
    assert {r["path"]: [tuple(s) for s in r["spans"]] for r in got} == want


def test_query(spark):
    got = {r["doc_id"]: r for r in sl.op6_secret_ledger(spark, SF001).collect()}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        want, r = base(d["text"]), got[d["doc_id"]]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[2] == k for s in want) for k, *_ in KINDS]
        assert r["base_sha256"] == digest(want)


def test_further_formats(spark):
    pem = "-----BEGIN RSA PRIVATE KEY-----\nMIIabc+/=\n-----END RSA PRIVATE KEY-----"
    jwt = "eyJ" + "a" * 12 + ".eyJ" + "b" * 12 + "." + "c" * 12
    texts = [f"x {pem} y", jwt, "ghp_" + "Z9" * 18, "see https://user:hunter22@host/ and https://host/", "eyJ gh_ :// clean"]
    df = spark.createDataFrame(list(enumerate(texts)), "path long, text string")
    got = {r["path"]: [s["kind"] for s in r["spans"]] for r in sl.scan(df, sl.new_ledger(spark), ["path"]).collect()}
    assert got == {0: ["private_key"], 1: ["jwt"], 2: ["host_token"], 3: ["url_password"], 4: []}
    clean = {r["path"]: r["text"] for r in sl.without_secrets(df).collect()}
    assert clean[0] == "x [SECRET] y" and clean[3] == "see [SECRET]host/ and https://host/" and clean[4] == texts[4]


def test_only_unseen_pairs_are_scanned(spark):
    ledger = sl.new_ledger(spark)
    first = spark.createDataFrame([("a", 1, "token=abcdef1"), ("b", 1, "clean"), ("c", 1, "token=abcdef1")], "path string, version long, text string")
    later = first.union(spark.createDataFrame([("b", 2, "secret=zzzzzz"), ("d", 1, "clean")], first.schema))
    one = {"base": sl.RULES["base"]}
    assert sl.unseen(first, spark.read.schema(sl.LEDGER).parquet(ledger), one).count() == 2
    sl.scan_unseen(first, ledger, one)
    left = sl.unseen(later, spark.read.schema(sl.LEDGER).parquet(ledger), one).collect()
    assert [r["text"] for r in left] == ["secret=zzzzzz"]
    assert all(r["versions"] == ["formats"] for r in sl.unseen(first, spark.read.schema(sl.LEDGER).parquet(ledger), sl.RULES).collect())
    got = {(r["path"], r["version"]): len(r["spans"]) for r in sl.scan(later, ledger, ["path", "version"]).collect()}
    assert got == {("a", 1): 1, ("b", 1): 0, ("c", 1): 1, ("b", 2): 1, ("d", 1): 0}
    pairs = [tuple(r) for r in spark.read.schema(sl.LEDGER).parquet(ledger).select("blob", "rule_version").collect()]
    assert len(pairs) == len(set(pairs)) == 6


def test_odd_rows_and_redaction(spark):
    assert sl.scan(odd(spark), sl.new_ledger(spark), ["doc_id"]).count() == len(ODD_ROWS)
    assert sl.scan(empty(spark), sl.new_ledger(spark), ["doc_id"]).count() == 0
    out = sl.without_secrets(odd(spark))
    assert out.columns == odd(spark).columns
    key = lambda r: tuple(str(x)[:50] for x in r)
    assert sorted(map(key, out.collect())) == sorted(map(key, odd(spark).collect()))
    hidden = "token=" + "0a" * 14 + " and AKIA" + "A1" * 9 + " end"
    df = spark.createDataFrame([(1, hidden), (2, hidden), (3, None)], "doc_id long, text string")
    assert {r["text"] for r in sl.without_secrets(df).collect()} == {"[SECRET] and [SECRET] end", None}
    kept = sl.new_ledger(spark)
    for _ in range(2):
        assert {r["text"] for r in sl.without_secrets(df, ledger_path=kept).collect()} == {"[SECRET] and [SECRET] end", None}
    assert spark.read.parquet(kept).count() == 2 * len(sl.RULES)


def plain_redaction(text, spans, mark="[SECRET]"):
    out, at = "", 0
    for a, z in sorted(spans):
        if a >= at:
            out += text[at:a] + mark
        at = max(at, z)
    return out + text[at:]


def test_many_matches_in_one_text(spark):
    rng = random.Random(2)
    text = "é ".join("".join(rng.choice("0123456789abcdef") for _ in range(24 + i % 9)) for i in range(100_000)) + " token=" + "q" * 9000
    df = spark.createDataFrame([(1, text), (2, text[5:]), (3, "clean")], "path long, text string").repartition(2)
    got = {r["path"]: r["spans"] for r in sl.scan(df, sl.new_ledger(spark), ["path"], {"base": sl.RULES["base"]}).collect()}
    for path, t in ((1, text), (2, text[5:])):
        assert [tuple(s) for s in got[path]] == base(t)
        assert len(got[path]) > 99_000
    clean = {r["path"]: r["text"] for r in sl.without_secrets(df).collect()}
    assert clean[1] == plain_redaction(text, [(a, z) for a, _, _, z in base(text)])
    assert clean[2] == plain_redaction(text[5:], [(a, z) for a, _, _, z in base(text[5:])]) and clean[3] == "clean"


def test_redaction_in_small_parts(spark, monkeypatch):
    rng = random.Random(12)
    bits = ["token=abcdef", "secret: ", "0a" * 12, "AKIA" + "B2" * 8, " ", "é😀", "\n", "x"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    for size in (1, 7, 64):
        monkeypatch.setattr(sl, "CUT_CHARS", size)
        got = {r["path"]: r["text"] for r in sl.without_secrets(spark.createDataFrame(list(enumerate(texts)), "path long, text string")).collect()}
        assert got == {i: plain_redaction(t, [(a, z) for a, _, _, z in base(t)]) for i, t in enumerate(texts)}
