from pyspark.sql import functions as F

from layerkit.operators import (
    exclusive_label, has_marker, keyword_label, label_with_fallback, list_pii, name_dictionary,
    pandas_classifier, pii_scan, redact, review_sheet, stratified_sample, tag,
)
from layerkit.operators.privacy import NRIC_PATTERN, redact_by_table


def test_pii_scan_full_vs_contains(spark):
    df = spark.createDataFrame([("S1234567A", "my id is S1234567A"), ("S1234567A\n", "none")], "a string, b string")
    full = {(r.column_name): r.hits for r in pii_scan({"t": df}, {"nric": NRIC_PATTERN}).collect()}
    assert full == {"a": 1, "b": 0}          # value with a trailing newline is not a whole match
    cont = {(r.column_name): r.hits for r in pii_scan({"t": df}, {"nric": NRIC_PATTERN}, mode="contains").collect()}
    assert cont == {"a": 2, "b": 1}


def test_name_dictionary_and_redaction(spark):
    students = spark.createDataFrame([("Wen Jie Tan",), ("Wei Ling",), ("Al Bo",), (None,)], "full_name string")
    names = [r.name for r in name_dictionary(students, "full_name").collect()]
    assert names[0] == "Wen Jie Tan" and "Wen" in names and "Wei" in names and "Al" not in names
    df = spark.createDataFrame([("wen jie tan went home; call +65 8000 0123 or a.b@x.com S1234567A",)], "t string")
    out = df.select(redact("t", names).alias("r")).first().r
    # Substring matching: "went" is hit by "Wen" (the documented behaviour).
    assert out == "[NAME] [NAME]t home; call [PHONE] or [EMAIL] [NRIC]"
    ww = df.select(redact("t", names, whole_word=True).alias("r")).first().r
    assert ww.startswith("[NAME] went home")


def test_keyword_label_reference_lists(spark):
    df = spark.createDataFrame([
        ("I enjoyed it, the pace was too fast and confusing",),   # 1 pos vs confusing + phrase = 2
        ("Great and useful, loved it",),
        ("",),
        ("good but hard",),
    ], "t string")
    got = [r.l for r in df.select(keyword_label("t").alias("l")).collect()]
    assert got == ["negative", "positive", "neutral", "neutral"]
    only = [r.l for r in df.select(keyword_label("t", labels=["positive", "negative"]).alias("l")).collect()]
    assert only == ["negative", "positive", "positive", "positive"]


def test_fallback_path(spark):
    df = spark.createDataFrame([(1, "good stuff"), (2, "hard and good"), (3, "boring")], "id int, t string")

    def down(texts):
        raise RuntimeError("provider down")

    out = label_with_fallback(df, "t", pandas_classifier(down), exclusive_label)
    got = {r.id: (r.label, r.label_source, r.needs_review) for r in out.collect()}
    assert got == {1: ("positive", "rules-v1", True), 2: ("neutral", "rules-v1", True), 3: ("negative", "rules-v1", True)}
    ok = label_with_fallback(df, "t", keyword_label)
    assert {r.label_source for r in ok.collect()} == {"offline-stub-v1"}


def test_marker_and_stratified_sample(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"),
                                   F.when(F.col("id") % 40 == 0, F.lit("so shiok lah")).otherwise(F.lit("fine")).alias("t"))
    flag = has_marker("t")
    s1 = stratified_sample(docs, "doc_id", flag, 4, 20, 7)
    s2 = stratified_sample(docs.repartition(5), "doc_id", flag, 4, 20, 7)
    a = sorted(r.doc_id for r in s1.collect())
    assert a == sorted(r.doc_id for r in s2.collect()) and len(a) == 20
    assert s1.where("sample_flag").count() == 4
    few = docs.where((F.col("doc_id") < 40) | (F.col("doc_id") == 80))   # two flagged rows only
    s3 = stratified_sample(few, "doc_id", has_marker("t"), 4, 20, 7)
    assert s3.where("sample_flag").count() == 2 and s3.count() == 20
    sheet = review_sheet(spark.createDataFrame([(1, "a|b", "x")], "id int, c string, label string"), "id", "c")
    assert sheet.first().c == "a\\|b"


def test_tags(spark):
    df = tag(spark.createDataFrame([("h", "n")], "nric_hash string, full_name string"),
             {"nric_hash": {"classification": "restricted", "pii": True}})
    assert [(r.column_name, r.classification, r.pii) for r in list_pii(spark, df).collect()] == [
        ("nric_hash", "restricted", True)]


def test_pii_scan_namespaces_skips_missing(spark):
    import uuid

    from layerkit.operators import leak_found, pii_scan_namespaces

    ns = "silver_" + uuid.uuid4().hex[:6]
    spark.sql(f"CREATE DATABASE {ns}")
    spark.createDataFrame([("S1234567A", 1), ("ok", 2)], "nric string, n int").write.saveAsTable(f"{ns}.students")
    spark.createDataFrame([(1,)], "n int").write.saveAsTable(f"{ns}.numbers")
    hits, skipped = pii_scan_namespaces(spark, [ns, "gold_missing_xyz"], {"nric": NRIC_PATTERN})
    assert skipped == ["gold_missing_xyz"] and leak_found(hits)
    assert [(r.table_name, r.column_name, r.hits) for r in hits.collect()] == [(f"{ns}.students", "nric", 1)]
    none, _ = pii_scan_namespaces(spark, ["gold_missing_xyz"], {"nric": NRIC_PATTERN})
    assert none is None and not leak_found(none)


def test_redact_quotes_special_and_accented_names(spark):
    df = spark.createDataFrame([("josé (jo) met O'Neil, a.b and axb; José-Luis",)], "t string")
    out = df.select(redact("t", ["José", "(jo)", "O'Neil", "a.b"], patterns=()).alias("r")).first().r
    assert out == "[NAME] [NAME] met [NAME], [NAME] and axb; [NAME]-Luis"
    ww = df.select(redact("t", ["José"], patterns=(), whole_word=True).alias("r")).first().r
    assert ww == "[NAME] (jo) met O'Neil, a.b and axb; [NAME]-Luis"
    weird = df.select(redact("t", ["a\\Eb", "met"], patterns=()).alias("r")).first().r
    assert "[NAME]" in weird


def test_csv_timestamp_ntz_column(spark):
    from pyspark.sql import types as T

    from layerkit.sources import parse_csv_lines

    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("at", T.TimestampNTZType()),
                           T.StructField("n", T.IntegerType())])
    lines = spark.createDataFrame([("f", 1, "id,at,n"), ("f", 2, "a,2026-09-10 08:00:05,3"),
                                   ("f", 3, "b,yesterday,4"), ("f", 4, "c,2026-09-10T09:00:00,x")],
                                  "_source_file string, _line long, value string")
    good, rej = parse_csv_lines(lines, schema)
    import datetime as dt

    assert [(r.id, r.at, r.n) for r in good.collect()] == [("a", dt.datetime(2026, 9, 10, 8, 0, 5), 3)]
    assert sorted((r._line, r.column_name) for r in rej.collect()) == [(3, "at"), (4, "n")]


def one_at_a_time(text, names):
    """Names replaced one after the other over the whole text, longest first."""
    import re

    for n in sorted(set(names), key=lambda n: (-len(n), n)):
        text = re.compile(re.escape(n), re.IGNORECASE).sub("[NAME]", text)
    return text


def test_overlapping_names_leave_nothing(spark):
    names = ["Lee Ann Wong", "Ann Lee", "Lee", "Ann"]
    df = spark.createDataFrame([(1, "Ann Lee Ann Wong spoke")], "id int, t string")
    assert df.select(redact("t", names, patterns=()).alias("r")).first().r == "[NAME] [NAME] spoke"
    table = spark.createDataFrame([(n,) for n in names], "n string")
    assert redact_by_table(df, "t", table, "n", "r", patterns=()).first().r == "[NAME] [NAME] spoke"


def test_redaction_by_table_equals_one_at_a_time(spark):
    import random

    rng = random.Random(7)
    letters = "abAB ._kNamé"
    names = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 9))).strip() or "a" for _ in range(60)} | {"am", "Nam", "ß", "a\\Eb"})
    texts = ["".join(rng.choice(letters + "xy") for _ in range(rng.randint(0, 60))) for _ in range(120)] + ["", "NAME", "a\\Eb am"]
    df = spark.createDataFrame([(i % 100, t) for i, t in enumerate(texts)] + [(None, "Nam b"), (5, None)], "id int, t string")
    table = spark.createDataFrame([(n,) for n in names] * 2 + [(None,), ("",)], "n string")
    want = sorted((str(r.id), str(r.t), "None" if r.t is None else one_at_a_time(r.t, names)) for r in df.collect())
    for limit in (1 << 30, 60):  # one automaton; several
        out = redact_by_table(df, "t", table, "n", "r", patterns=(), part_bytes=limit)
        assert out.columns == ["id", "t", "r"]
        assert sorted((str(r.id), str(r.t), str(r.r)) for r in out.collect()) == want


def test_patterns_use_unicode_white_space_and_digits(spark):
    df = spark.createDataFrame([("+65\u00a09123\u00a04567 and +65\u0669\u0661\u0662\u06634567",)], "t string")
    assert df.select(redact("t").alias("r")).first().r == "[PHONE] and [PHONE]"
    names = spark.createDataFrame([("Wen\u00a0Jie",), ("\u2003Mei\x1cLing",)], "n string")
    assert {"Wen", "Mei"} <= {r.name for r in name_dictionary(names, "n").collect()}


def test_one_bad_text_fails_alone(spark):
    df = spark.createDataFrame([(i, "poison" if i == 42 else "good") for i in range(100)], "id int, t string").coalesce(1)

    def provider(texts):
        if "poison" in texts:
            raise RuntimeError("refused")
        return ["positive"] * len(texts)

    got = {r.id: r.label_source for r in label_with_fallback(df, "t", pandas_classifier(provider), exclusive_label).collect()}
    assert [i for i, s in got.items() if s == "rules-v1"] == [42]


def test_empty_dictionary(spark):
    df = spark.createDataFrame([(1, "abc")], "id int, t string")
    assert df.select(redact("t", ["", ""], patterns=()).alias("r")).first().r == "abc"
    none = spark.createDataFrame([], "n string")
    assert redact_by_table(df, "t", none, "n", "r", patterns=()).first().r == "abc"


def test_name_dictionary_is_ordered_longest_first(spark):
    df = spark.createDataFrame([(n,) for n in ("Bo Li", "Anna Maria Lo", "Cy Lu", "Anna Po")], "n string")
    got = [r.name for r in name_dictionary(df.repartition(5), "n").collect()]
    assert got == sorted(got, key=lambda n: (-len(n), n)) and "Anna" in got and "Bo" not in got
