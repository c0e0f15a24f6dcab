"""Secret scans over an incremental ledger of content-addressed texts.

Every version of every path is addressed by the SHA-256 of its text (its blob).
The ledger, a Parquet table in the shared folder, holds one row for each blob
and rule version that has been scanned, with the spans found. A scan takes the
blobs whose pair with a rule version isn't in the ledger yet, each text once
however many paths hold it, appends what it finds, and joins the ledger's
findings back to all paths. New rules are a new rule version: old pairs stay.

All work is Spark SQL functions. Spans are code points, end exclusive: a text is
split at a rule's matches, each piece and match becomes a row of counts, and
running sums over them give the positions. Texts that a rule can't match are
passed over by a plain test first. Redaction cuts a text into parts of
``CUT_CHARS`` and cuts each part's share of the spans out of it.

Defined results: a null text is the empty text and has no spans; repeated rows
and repeated paths give one result each; a null path keeps its row; very long
texts, with any number of matches, are scanned and redacted whole in about linear
time, the spans of one text being one row; an empty table scans nothing and gives an empty result. Other columns are passed through
untouched by ``scan`` if asked for in ``keep``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerkit.llm.tables import free_name, read_table, text_or_empty
from layerkit.session import scratch_path

SPAN = "struct<start:int,place:int,kind:string,end:int>"
LEDGER = f"blob binary, rule_version string, spans array<{SPAN}>"


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds leftmost matches; of these the ones stay whose ``group``
    has at least ``least`` characters. ``test`` holds for every text in which a
    match can stay, and is cheaper."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    test: str | None = None


_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""

#: Rule versions in the order in which spans that start together are listed.
RULES: dict[str, list[Rule]] = {
    "base": [
        Rule("assign", _ASSIGN + r"([A-Za-z0-9+/_.=-]+)", 2, 6, _ASSIGN + r"[A-Za-z0-9+/_.=-]{6}"),
        # A run of 20 is the same as a match of 20 or more: what a shorter
        # match takes in holds no longer one.
        Rule("access", r"AKIA[A-Z0-9]{16,}"),
        Rule("hex", r"[0-9a-f]{24,}"),
    ],
    "formats": [
        Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----"),
        Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
        Rule("host_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
        Rule("url_password", r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,100}:[^\s:/@]{3,100}@"),
    ],
}

#: Plain strings without which a rule can't match.
_NEEDS = {"access": "AKIA", "private_key": "PRIVATE KEY-----", "jwt": "eyJ", "host_token": "gh", "url_password": "://"}


#: Code points of a text that are redacted at a time.
CUT_CHARS = 4096


def _found(text: Column, rule: Rule) -> Column:
    """The matches of one rule as code point counts: of the text between the
    match before and this one, of the match, and of what it must have enough of."""
    rows = F.arrays_zip(F.split(text, rule.pattern, -1), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)),
                        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)))
    rows = rows.cast("array<struct<before:string,match:string,held:string>>")  # no match after the last piece
    return F.transform(rows, lambda r: F.struct(F.length(r["before"]).alias("before"), F.coalesce(F.length(r["match"]), F.lit(0)).alias("size"),
                                                F.coalesce(F.length(r["held"]) >= rule.least, F.lit(False)).alias("kept")))


def _matches(text: Column, rules: list[Rule], first_place: int) -> Column:
    """The matches of each rule that may have some."""
    parts = []
    for i, rule in enumerate(rules):
        test = text.rlike(rule.test or rule.pattern)
        if rule.kind in _NEEDS:
            test = F.contains(text, F.lit(_NEEDS[rule.kind])) & test
        parts.append(F.when(test, F.struct(F.lit(first_place + i).alias("place"), F.lit(rule.kind).alias("kind"), _found(text, rule).alias("matches"))))
    return F.array_compact(F.array(*parts))


def blob(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _places(rules: dict[str, list[Rule]]) -> dict[str, int]:
    places, n = {}, 0
    for version, listed in rules.items():
        places[version] = n
        n += len(listed)
    return places


def unseen(paths: DataFrame, ledger: DataFrame, rules: dict[str, list[Rule]], text: str = "text") -> DataFrame:
    """``blob``, ``text``, ``versions``: each distinct text with the rule
    versions that the ledger doesn't hold for it."""
    t = text_or_empty(text)
    blobs = paths.select(blob(t).alias("blob"), t.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    done = ledger.select("blob", "rule_version").distinct().groupBy("blob").agg(F.collect_list("rule_version").alias("done"))
    every = F.array(*(F.lit(v) for v in rules))
    left = blobs.join(done, "blob", "left")
    left = left.withColumn("versions", F.array_except(every, F.coalesce("done", F.array().cast("array<string>"))))
    return left.where(F.size("versions") > 0).select("blob", "text", "versions")


def scan_unseen(paths: DataFrame, ledger_path: str, rules: dict[str, list[Rule]] = RULES, text: str = "text") -> DataFrame:
    """Scan what the ledger lacks, append it, and return the whole ledger."""
    spark = paths.sparkSession
    ledger = spark.read.schema(LEDGER).parquet(ledger_path)
    rows = unseen(paths, ledger, rules, text)
    places = _places(rules)
    entries = F.array(*(
        F.when(F.array_contains("versions", v), F.struct(F.lit(v).alias("rule_version"), _matches(F.col("text"), listed, places[v]).alias("rules")))
        for v, listed in rules.items()))
    each = rows.select("blob", F.explode(F.array_compact(entries)).alias("e")).select("blob", "e.rule_version", F.explode_outer("e.rules").alias("r"))
    each = each.select("blob", "rule_version", "r.place", "r.kind", F.posexplode_outer("r.matches").alias("i", "m"))
    # The blobs lie together since they were made distinct, so that neither the
    # running sum of a rule's pieces nor the list of a blob's spans moves a row.
    end = F.sum(F.col("m.before") + F.col("m.size")).over(Window.partitionBy("blob", "place").orderBy("i")).cast("int")
    each = each.withColumn("end", end)
    span = F.struct((F.col("end") - F.col("m.size")).alias("start"), "place", "kind", "end").cast(SPAN)
    found = each.groupBy("blob", "rule_version").agg(F.array_sort(F.collect_list(F.when(F.col("m.kept"), span))).alias("spans"))
    found.write.mode("append").parquet(ledger_path)
    return spark.read.schema(LEDGER).parquet(ledger_path)


def _shown(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _entries(ledger: DataFrame, rules: dict[str, list[Rule]]) -> DataFrame:
    """The entries with spans, one for each pair of ``rules``, whatever number of
    them the rerun of a lost job has written."""
    hits = ledger.where(F.col("rule_version").isin(*rules) & (F.size("spans") > 0))
    return hits.groupBy("blob", "rule_version").agg(F.first("spans").alias("spans"))


def scan(paths: DataFrame, ledger_path: str, keep: list[str], rules: dict[str, list[Rule]] = RULES, text: str = "text") -> DataFrame:
    """``keep`` columns and ``spans`` (array, of all rule versions in ``rules``)
    for every row of ``paths``."""
    ledger = scan_unseen(paths, ledger_path, rules, text)
    # Clean blobs have no row here: most paths meet nothing.
    hits = _entries(ledger, rules).groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("_spans"))
    named = paths.select(F.struct(*keep).alias("kept"), blob(text_or_empty(text)).alias("blob"))
    out = named.join(hits, "blob", "left")
    return out.select("kept.*", F.coalesce("_spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def new_ledger(spark: SparkSession) -> str:
    """An empty ledger under the shared folder; keep its path for later scans."""
    path = scratch_path(spark, "secret-ledger")
    empty = spark.range(0).select(F.lit(None).cast("binary").alias("blob"), F.lit("").alias("rule_version"),
                                  F.array().cast(f"array<{SPAN}>").alias("spans"))
    empty.write.parquet(path)
    return path


def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read_table(spark, sf_dir, "documents"), new_ledger(spark), ["doc_id"])
    base = F.filter("spans", lambda s: s["place"] < len(RULES["base"]))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                        F.sha2(_shown(base), 256).alias("base_sha256"), _shown(F.col("spans")).alias("spans"))


def _cuts(ledger: DataFrame, rules: dict[str, list[Rule]], key: str, found: str) -> DataFrame:
    """For each blob with spans, the places to cut out of each ``CUT_CHARS`` of it:
    (begin, end, whether the span begins here). Overlapping spans are one."""
    each = _entries(ledger, rules).select("blob", F.explode("spans").alias("s")).select("blob", "s.start", "s.end").distinct()
    in_order = Window.partitionBy("blob").orderBy("start", "end")
    reach = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    each = each.withColumn("fresh", F.coalesce((F.col("start") >= reach).cast("int"), F.lit(1)))
    each = each.withColumn("n", F.sum("fresh").over(in_order))
    merged = each.groupBy("blob", "n").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    first, last = (F.floor(c / CUT_CHARS).cast("int") for c in (F.col("start"), F.col("end") - 1))
    touched = merged.select("blob", "start", "end", F.explode(F.sequence(first, last)).alias("k"))
    begin = F.col("k") * CUT_CHARS
    cut = F.struct((F.greatest("start", begin) - begin).alias("begin"), (F.least("end", begin + CUT_CHARS) - begin).alias("end"), (F.col("start") >= begin).alias("fresh"))
    by_part = touched.groupBy("blob", "k").agg(F.array_sort(F.collect_list(cut)).alias("cuts"))
    return by_part.groupBy(F.col("blob").alias(key)).agg(F.map_from_entries(F.collect_list(F.struct("k", "cuts"))).alias(found))


def _redacted(part: Column, cuts: Column, mark: str) -> Column:
    """A part of a text without its cuts, in which marks stand where spans begin."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, c: Column) -> Column:
        left = F.substring(part, acc["at"] + 1, c["begin"] - acc["at"])
        return F.struct(c["end"].alias("at"), F.concat(acc["out"], left, F.when(c["fresh"], F.lit(mark)).otherwise(F.lit(""))).alias("out"))

    return F.aggregate(cuts, start, step, lambda acc: F.concat(acc["out"], F.substring(part, acc["at"] + 1, F.lit(CUT_CHARS))))


def without_secrets(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", ledger_path: str | None = None) -> DataFrame:
    """``docs`` with every span of its text replaced by ``mark`` (overlapping
    spans by one); all other columns and all rows stay as they are. With the
    path of a kept ledger only texts that are new to it are scanned."""
    ledger = scan_unseen(docs, ledger_path or new_ledger(docs.sparkSession), RULES, text)
    key, found = free_name(docs, "_blob"), free_name(docs, "_spans")
    hits = _cuts(ledger, RULES, key, found)
    t = F.col(text)
    parts = F.regexp_extract_all(t, F.lit(f"(?s).{{1,{CUT_CHARS}}}"), F.lit(0))

    def one(part: Column, k: Column) -> Column:
        cuts = F.try_element_at(F.col(found), k)
        return F.when(cuts.isNull(), part).otherwise(_redacted(part, cuts, mark))

    joined = docs.withColumn(key, blob(text_or_empty(text))).join(hits, key, "left")
    changed = F.when(F.col(found).isNotNull() & t.isNotNull(), F.array_join(F.transform(parts, one), "")).otherwise(t)
    return joined.withColumn(text, changed).select(*docs.columns)


def _oracle() -> str:
    """DuckDB SQL of the query, from the same rule texts."""
    rules = [r for listed in RULES.values() for r in listed]
    parts = []
    for place, r in enumerate(rules):
        rx = r.pattern.replace("'", "''")
        parts.append(f"""select doc_id, {place} as place, '{r.kind}' as kind, {r.least} as least, regexp_split_to_array(text, '{rx}') as pieces,
          regexp_extract_all(text, '{rx}') as whole, regexp_extract_all(text, '{rx}', {r.group}) as held from docs where regexp_matches(text, '{rx}')""")
    return f"""
    with docs as (select doc_id, coalesce(text, '') as text from documents),
    found as ({" union all ".join(parts)}),
    each as (select *, unnest(range(1, len(whole) + 1)) as i from found),
    spans as (
      select doc_id, place, kind, cast(list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:i-1], lambda x: length(x))), 0) as bigint) as a,
        length(whole[i]) as size from each where length(held[i]) >= least),
    sums as (
      select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
        string_agg(kind || ':' || a || ':' || (a + size), ',' order by a, place) filter (place < {len(RULES["base"])}) as base,
        string_agg(kind || ':' || a || ':' || (a + size), ',' order by a, place) as spans
      from spans group by doc_id)
    select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
      sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
    from docs d left join sums s on d.doc_id = s.doc_id
    """


ORACLE = _oracle()
