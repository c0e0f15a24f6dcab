"""Licence scans by sentence rules.

A text is cut into sentences, each sentence is normalised and mapped to the id of
the licence sentence it is (an SPDX line to the ids of its identifiers, looked up
by name), and the sequence of ids is matched against ordered rules, each naming a
licence. A rule takes the ids it matches out of the
sequence, so that what is part of a longer notice isn't reported again; ids that
no rule takes are counted, as are sentences that speak of licences but are
unknown.

Only Spark SQL functions are used, in one narrow pass; texts without any word of
licences are passed over by a plain test.

Defined results: null and empty texts have no sentences and no licences; repeated
rows give one result each; a licence that is found twice is named once; very long
texts are scanned whole, line by line; an empty table gives an empty result. Other
columns are never read.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.llm.tables import read_table, text_or_empty

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A normalised sentence with one of these that no pattern knows is "unknown".
SPEAKS = r"license|copyright|all rights reserved|public domain"

#: SPDX identifiers.
SPDX = """
    0BSD AFL-3.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSD-3-Clause-Clear
    BSD-4-Clause BSL-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0
    CDDL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.2 GFDL-1.3-only GFDL-1.3-or-later GPL-2.0 GPL-2.0+ GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0+
    GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1 LGPL-2.1+ LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0+
    LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.1 OSL-3.0 PostgreSQL PSF-2.0
    Python-2.0 Ruby UPL-1.0 Unicode-3.0 Unlicense Vim W3C WTFPL X11 Zlib ZPL-2.1
""".split()
#: How a normalised sentence names them, longer names first.
SPDX_NAMES = {re.sub("[^a-z0-9.+]+", " ", name.lower()): name for name in sorted(SPDX, key=lambda n: (-len(n), n))}
SPDX_MARK = "spdx license identifier"
SPDX_EACH = "(?:^| )(" + "|".join(re.sub(r"([.+])", r"[\1]", n) for n in SPDX_NAMES) + ")(?: |$)"

#: Licence sentences as patterns over normalised sentences, in the
#: order in which they are tried (the first that fits names the sentence).
SENTENCES: list[tuple[str, str]] = [
    ("apache-2", r"licensed under the apache license version 2|apache license (version )?2\.0|apache 2\.0 license"),
    ("apache-compliance", r"you may not use this file except in compliance with the license"),
    ("apache-obtain", r"you may obtain a copy of the license at"),
    ("apache-as-is", r"unless required by applicable law or agreed to in writing"),
    ("apache-see", r"see the license for the specific language governing permissions"),
    ("lgpl-3", r"gnu lesser general public license.*(version|v) ?3|(^| )lgpl ?v?3"),
    ("lgpl-2", r"gnu (lesser|library) general public license.*(version|v) ?2|(^| )lgpl ?v?2"),
    ("agpl-3", r"gnu affero general public license|(^| )agpl ?v?3"),
    ("gpl-3-or-later", r"gnu general public license.*(version|v) ?3.*or at your option any later version"),
    ("gpl-2-or-later", r"gnu general public license.*(version|v) ?2.*or at your option any later version"),
    ("gpl-3", r"gnu general public license.*(version|v) ?3|(^| )gpl ?v?3"),
    ("gpl-2", r"gnu general public license.*(version|v) ?2|(^| )gpl ?v?2"),
    ("gpl-hope", r"distributed in the hope that it will be useful"),
    ("gpl-received", r"you should have received a copy of the gnu"),
    ("gpl-see", r"see the gnu (lesser |affero )?general public license for more details"),
    ("cc-by-nc-sa-4", r"(cc by nc sa|attribution noncommercial sharealike) 4"),
    ("cc-by-nc-nd-4", r"(cc by nc nd|attribution noncommercial noderiv[a-z]*) 4"),
    ("cc-by-nc-4", r"(cc by nc|attribution noncommercial) 4"),
    ("cc-by-nd-4", r"(cc by nd|attribution noderiv[a-z]*) 4"),
    ("cc-by-sa-4", r"(cc by sa|attribution sharealike) 4"),
    ("cc-by-sa-3", r"(cc by sa|attribution sharealike) 3"),
    ("cc-by-4", r"(cc by|creative commons attribution) 4"),
    ("cc0", r"(^| )cc0( |[.]|$)|creative commons zero"),
    ("mit", r"(released|licensed|distributed|available) under (the )?(terms of the )?mit license"),
    ("mit-grant", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit-notice", r"above copyright notice and this permission notice shall be included"),
    ("as-is", r"software is provided (by the copyright holders and contributors )?as is"),
    ("no-liability", r"in no event shall the (authors|copyright)"),
    ("isc-grant", r"permission to use copy modify and.?or distribute this software for any purpose"),
    ("isc", r"under (the )?(terms of the )?isc license"),
    ("bsd-grant", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-source", r"redistributions of source code must retain the above copyright notice"),
    ("bsd-binary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-endorse", r"neither the name of .* may be used to endorse or promote"),
    ("bsd-3", r"bsd 3 clause|3 clause bsd|(new|modified|revised) bsd license"),
    ("bsd-2", r"bsd 2 clause|2 clause bsd|simplified bsd license|freebsd license"),
    ("mpl-2", r"mozilla public license (version |v ?)?2"),
    ("epl-2", r"eclipse public license (version |v ?)?2"),
    ("bsl-1", r"boost software license"),
    ("zlib", r"zlib (libpng )?license"),
    ("artistic-2", r"artistic license (version |v ?)?2"),
    ("unlicense", r"free and unencumbered software released into the public domain|under the unlicense"),
    ("copyright", r"^(c )?copyright( |$)"),
    ("all-rights", r"all rights reserved"),
]

#: A text or a sentence without any of these holds no licence sentence: every
#: pattern above, ``SPEAKS`` and ``SPDX_MARK`` needs one of them. Tried first.
MAY_HOLD = ("licen[cs]e|copyright|permission|redistribut|spdx|public[^a-z0-9.+]+domain|reserved|cc0|cc[^a-z0-9.+]+by|creative|attribution|gnu|gpl|"
            "applicable|hope[^a-z0-9.+]+that|is[^a-z0-9.+]+provided|no[^a-z0-9.+]+event|endorse|bsd")

#: Ordered rules. Longer notices come before what they contain.
RULES: list[tuple[str, list[str]]] = [
    ("Apache-2.0", ["apache-2", "apache-compliance", "apache-obtain", "apache-as-is", "apache-see"]),
    ("Apache-2.0", ["apache-2", "apache-compliance", "apache-obtain", "apache-as-is"]),
    ("LGPL-3.0", ["lgpl-3", "gpl-hope", "gpl-see", "gpl-received"]),
    ("LGPL-2.1", ["lgpl-2", "gpl-hope", "gpl-see", "gpl-received"]),
    ("AGPL-3.0", ["agpl-3", "gpl-hope", "gpl-see", "gpl-received"]),
    ("GPL-3.0-or-later", ["gpl-3-or-later", "gpl-hope", "gpl-see", "gpl-received"]),
    ("GPL-2.0-or-later", ["gpl-2-or-later", "gpl-hope", "gpl-see", "gpl-received"]),
    ("GPL-3.0", ["gpl-3", "gpl-hope", "gpl-see", "gpl-received"]),
    ("GPL-2.0", ["gpl-2", "gpl-hope", "gpl-see", "gpl-received"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "as-is", "no-liability"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "as-is", "no-liability"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("MIT", ["mit-grant", "mit-notice", "as-is", "no-liability"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("ISC", ["isc-grant", "as-is", "no-liability"]),
    ("ISC", ["isc-grant"]),
    ("Apache-2.0", ["apache-2"]),
    ("LGPL-3.0", ["lgpl-3"]), ("LGPL-2.1", ["lgpl-2"]), ("AGPL-3.0", ["agpl-3"]),
    ("GPL-3.0-or-later", ["gpl-3-or-later"]), ("GPL-2.0-or-later", ["gpl-2-or-later"]),
    ("GPL-3.0", ["gpl-3"]), ("GPL-2.0", ["gpl-2"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa-4"]), ("CC-BY-NC-ND-4.0", ["cc-by-nc-nd-4"]), ("CC-BY-NC-4.0", ["cc-by-nc-4"]), ("CC-BY-ND-4.0", ["cc-by-nd-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]), ("CC-BY-SA-3.0", ["cc-by-sa-3"]), ("CC-BY-4.0", ["cc-by-4"]), ("CC0-1.0", ["cc0"]),
    ("MIT", ["mit"]), ("ISC", ["isc"]), ("BSD-3-Clause", ["bsd-3"]), ("BSD-2-Clause", ["bsd-2"]),
    ("MPL-2.0", ["mpl-2"]), ("EPL-2.0", ["epl-2"]), ("BSL-1.0", ["bsl-1"]), ("Zlib", ["zlib"]), ("Artistic-2.0", ["artistic-2"]), ("Unlicense", ["unlicense"]),
    *((name, [f"spdx:{name}"]) for name in SPDX),
    ("Proprietary", ["copyright", "all-rights"]),
]

# Normalisation. Each step is one that Spark's and DuckDB's regular expressions
# read alike: no look-ahead, no word boundaries, no letters beyond ASCII.

#: What stands before a line of a comment or quotation. Stars only count where a
#: comment with stars has been opened, as they also mark the items of lists.
STARS = r"^[ \t]*[*]*[ \t]*"
PREFIX = r"^[ \t]*((#+|//+[!/]?|--+|;+|%+|!+|>+|(dnl|REM|rem)[ \t])[ \t]*)?"
#: A line goes on the one before it if both fit one of these (end of the line
#: before, beginning of this one); the second two are tried in lower case.
_ANY = r"^"
GOES_ON = [
    (_ANY, r"^[a-z(]"),
    (r"[A-Z][A-Z]+ [A-Z][A-Z]+,?[ \t]*\z", r"^[\"'(]*[A-Z][A-Z]+[\"')]* [A-Z][A-Z]+"),
]
GOES_ON_LOWER = [
    (r"(^|[^a-z0-9_])(the|of|by|an|and|or|to|under|with|for|see)[ \t]*\z", r"^[a-z\"'(]"),
    (r"(^|[^a-z0-9_])(gnu|lesser|library|affero|general|public|apache|mozilla|mit)[ \t]*\z", r"^(lesser|library|affero|general|public|licen[cs]e)"),
    (r"(^|[^a-z0-9_])licen[cs]e,?[ \t]*\z", r"^version"),
    (r"(^|[^a-z0-9_])version[ \t]*\z", r"^[0-9]"),
]
#: A semicolon before the version of a licence ends no sentence.
KEEP_ON = (r";([ \t\r]+((either|only|under|using|the|terms|of)[ \t]+)*(version|v[.]?[ \t]?[0-9]))", r",{1}")
CUT = (r"([.!?;])[ \t\r]+", "{1}\n")
KEPT = r"[^a-z0-9.+]+"
TRIM = r"^[. ]+|[. ]+\z"


def _lower(s: Column) -> Column:
    return F.translate(s, _UPPER, _LOWER)


def lines(text: Column) -> Column:
    """The lines of a text without what marks them as comments."""
    each = F.split(text, "\r?\n", -1)
    bare = F.transform(each, lambda x: F.regexp_replace(x, PREFIX, ""))
    starless = F.transform(each, lambda x: F.regexp_replace(F.regexp_replace(x, STARS, ""), PREFIX, ""))
    return F.when(F.contains(text, F.lit("/*")), starless).otherwise(bare)


def _goes_on(before: Column, line: Column) -> Column:
    same = [before.rlike(a) & line.rlike(b) if a != _ANY else line.rlike(b) for a, b in GOES_ON]
    lower = [_lower(before).rlike(a) & _lower(line).rlike(b) for a, b in GOES_ON_LOWER]
    return reduce(Column.__or__, same + lower)


def sentences(lines: Column) -> Column:
    """Normalised sentences, in order, empty ones left out. ``lines`` is a column
    of its own, as each line looks at the one before it."""
    def placed(x: Column, i: Column) -> Column:
        return F.concat(F.when((i > 0) & _goes_on(F.get(lines, i - 1), x), F.lit(" ")).otherwise(F.lit("\n")), x)

    joined = F.array_join(F.transform(lines, placed), "")
    for pattern, by in (KEEP_ON, CUT):
        joined = F.regexp_replace(joined, pattern, by.format(None, "$1"))

    def normal(s: Column) -> Column:
        return F.regexp_replace(F.replace(F.regexp_replace(_lower(s), KEPT, " "), F.lit("licence"), F.lit("license")), TRIM, "")

    return F.filter(F.transform(F.filter(F.split(joined, "\n", -1), lambda s: _lower(s).rlike(MAY_HOLD)), normal), lambda s: s != "")


def sentence_ids(s: Column) -> Column:
    """Ids of a normalised sentence: the identifiers of an SPDX line, else one;
    ``unknown`` if it only speaks of licences."""
    names = F.create_map(*(F.lit(x) for pair in SPDX_NAMES.items() for x in pair))
    listed = F.transform(F.regexp_extract_all(s, F.lit(SPDX_EACH), F.lit(1)), lambda n: F.concat(F.lit("spdx:"), F.element_at(names, n)))
    unknown = F.array(F.lit("unknown"))
    out = F.when(F.contains(s, F.lit(SPDX_MARK)), F.when(F.size(listed) > 0, listed).otherwise(unknown))
    for name, pattern in SENTENCES:
        out = out.when(s.rlike(pattern), F.array(F.lit(name)))
    return out.when(s.rlike(SPEAKS), unknown).otherwise(F.array().cast("array<string>"))


def match_rules(ids: Column) -> Column:
    """Licences by the ordered rules, and what is left of the id sequence."""
    listed = F.array(*(F.struct(F.lit(name).alias("name"), F.lit("".join(f"<{i}>" for i in ids)).alias("ids")) for name, ids in RULES))
    start = F.struct(F.array_join(F.transform(ids, lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "").alias("left"),
                     F.array().cast("array<string>").alias("found"))

    def step(acc: Column, rule: Column) -> Column:
        hit = F.struct(F.replace(acc["left"], rule["ids"], F.lit("")).alias("left"), F.array_append(acc["found"], rule["name"]).alias("found"))
        return F.when(F.contains(acc["left"], rule["ids"]), hit).otherwise(acc)

    return F.aggregate(listed, start, step)


def scan(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, ``sentence_ids`` (array), ``licenses`` (array, in rule
    order), ``n_unmatched`` ids that no rule took, ``n_unknown`` sentences."""
    t = text_or_empty(text)
    rows = docs.select(F.struct(*keep).alias("kept"), F.when(_lower(t).rlike(MAY_HOLD), lines(t)).otherwise(F.array().cast("array<string>")).alias("lines"))
    rows = rows.select("kept", F.flatten(F.transform(sentences(F.col("lines")), sentence_ids)).alias("named"))
    rows = rows.select("kept", F.filter("named", lambda i: i != "unknown").alias("sentence_ids"),
                       F.size(F.filter("named", lambda i: i == "unknown")).cast("bigint").alias("n_unknown"))
    rows = rows.withColumn("match", match_rules(F.col("sentence_ids")))
    return rows.select("kept.*", "sentence_ids", F.array_distinct("match.found").alias("licenses"),
                       F.regexp_count("match.left", F.lit("<")).cast("bigint").alias("n_unmatched"), "n_unknown")


def op5_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read_table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", F.size("sentence_ids").cast("bigint").alias("n_sentences"), F.array_join("sentence_ids", ",").alias("sentence_ids"),
                        F.array_join("licenses", ",").alias("licenses"), "n_unmatched", "n_unknown")


def _oracle() -> str:
    """DuckDB SQL of the query, from the same patterns, without the pre-tests."""
    def q(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    def replaced(text: str, step: tuple[str, str]) -> str:
        return f"regexp_replace({text}, {q(step[0])}, {q(step[1].format(None, chr(92) + '1'))}, 'g')"

    def lower(text: str) -> str:
        return f"translate({text}, '{_UPPER}', '{_LOWER}')"

    same = [f"(regexp_matches(before, {q(a)}) and regexp_matches(line, {q(b)}))" for a, b in GOES_ON]
    low = [f"(regexp_matches({lower('before')}, {q(a)}) and regexp_matches({lower('line')}, {q(b)}))" for a, b in GOES_ON_LOWER]
    case = " ".join(f"when regexp_matches(s, {q(p)}) then ['{name}']" for name, p in SENTENCES)
    names = ", ".join(f"'{k}': '{v}'" for k, v in SPDX_NAMES.items())
    steps, now = [], "seq0"
    for k, (name, ids) in enumerate(RULES, 1):
        want = "".join(f"<{i}>" for i in ids)
        steps.append(f"r{k} as materialized (select d, replace(rest, '{want}', '') as rest, "
                     f"case when contains(rest, '{want}') and not list_contains(found, '{name}') then list_append(found, '{name}') else found end as found from {now})")
        now = f"r{k}"
    return rf"""
    with docs as (select row_number() over () as d, doc_id, coalesce(text, '') as text from documents),
    cut as (select d, contains(text, '/*') as starred, string_split_regex(text, '\r?\n') as parts from docs),
    each as (select d, starred, generate_subscripts(parts, 1) as i, unnest(parts) as part from cut),
    bare as (select d, i, regexp_replace(case when starred then regexp_replace(part, {q(STARS)}, '') else part end, {q(PREFIX)}, '') as line from each),
    pairs as (select d, i, line, lag(line) over (partition by d order by i) as before from bare),
    joined as (select d, string_agg(case when before is not null and ({" or ".join(same + low)}) then ' ' else chr(10) end || line, '' order by i) as text from pairs group by d),
    cuts as (select d, string_split({replaced(replaced("text", KEEP_ON), CUT)}, chr(10)) as parts from joined),
    sentence as (select d, generate_subscripts(parts, 1) as i, unnest(parts) as part from cuts),
    normal as (select d, i, regexp_replace(replace(regexp_replace({lower("part")}, '{KEPT}', ' ', 'g'), 'licence', 'license'), {q(TRIM)}, '', 'g') as s from sentence),
    named as (select d, i, case when contains(s, '{SPDX_MARK}') then list_transform(regexp_extract_all(s, {q(SPDX_EACH)}, 1), lambda n: 'spdx:' || map {{{names}}}[n])
      {case} when regexp_matches(s, '{SPEAKS}') then ['unknown'] end as ids, contains(s, '{SPDX_MARK}') as spdx from normal where s <> ''),
    listed as (select d, i, unnest(case when spdx and len(ids) = 0 then ['unknown'] else ids end) as id, generate_subscripts(case when spdx and len(ids) = 0 then ['unknown'] else ids end, 1) as j from named where ids is not null),
    sums as (select d, count(*) filter (id <> 'unknown') as n_sentences, count(*) filter (id = 'unknown') as n_unknown,
      string_agg(id, ',' order by i, j) filter (id <> 'unknown') as sentence_ids, string_agg('<' || id || '>', '' order by i, j) filter (id <> 'unknown') as rest
      from listed group by d),
    seq0 as (select d, coalesce(rest, '') as rest, cast([] as varchar[]) as found from sums),
    {", ".join(steps)}
    select doc_id, coalesce(n_sentences, 0) as n_sentences, coalesce(sentence_ids, '') as sentence_ids, coalesce(array_to_string(found, ','), '') as licenses,
      cast(length(coalesce(r.rest, '')) - length(replace(coalesce(r.rest, ''), '<', '')) as bigint) as n_unmatched, coalesce(n_unknown, 0) as n_unknown
    from docs left join sums s on docs.d = s.d left join {now} r on docs.d = r.d
    """


ORACLE = _oracle()
