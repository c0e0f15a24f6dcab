"""Ranked lexical search: term-at-a-time for short lists, document-at-a-time for long ones.

A term is a run of ASCII letters, digits and characters beyond ASCII, with A-Z
lower-cased. The documents are read once: each keeps its number of terms and its
counts of the terms that the queries ask for. From these come the corpus
statistics, over all documents, and the postings. The postings are searched where
they lie, in blocks of a bounded number of postings; in a block every query

* adds up the scores of its short lists term by term; the sums are one list, with
  its largest sum as its bound,
* goes through the documents with this list and the long lists, window by window
  in the order of ids. A list whose bound, together with those of weaker ones,
  can't lift a document over the lowest kept score isn't essential: it is only
  looked up for documents that the essential ones bring up and that can still get
  there. Windows whose bounds fall short are passed over.

Each task keeps every query's best ``k`` from block to block, and a window with a
group limit merges the tasks' results. Scores are whole numbers, so that bounds
are exact and nothing is lost by skipping.

Queries are a stated set. They are dealt into groups of about ``QUERY_BYTES`` of
text; for each group the documents are read once, and its terms are broadcast.

Defined results: null and empty texts have no terms and aren't found; documents
without an id count in the statistics and aren't found; repeated documents are
found one by one, under equal ids; equal query rows are one query, while texts that
share a query id are ranked apart; queries without terms find nothing; ties go to
the smaller id; a very long text is one row and its terms are counted in pieces of
bounded size; empty tables give an empty result. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerkit.llm.tables import read_table, ship, stored
from layerkit.llm.words import slices

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
TERM_ANY_CASE = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
QUERY_BYTES = 4 << 20
#: Postings that a block holds before it is searched (16 bytes each, and as much for its lists).
BLOCK_POSTINGS = 1_000_000
WINDOW = 2048
#: A list is short if it has at most this share of a block's documents.
SHORT_SHARE = 1 / 16
PIECE = 1 << 20
POSTINGS = "doc_id bigint, n bigint, term array<int>, tf array<bigint>"
FOUND = "query int, doc_id bigint, score bigint"


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in pieces cut between terms."""
    at = 0
    while at < len(text):
        part = text[at:at + PIECE].lower()  # of bytes: A-Z alone
        found = TERM.findall(part)
        at += PIECE
        if at < len(text) and found and part.endswith(found[-1]):  # may go on
            cut = len(found.pop())
            if cut == len(part):  # one term fills the piece
                end = TERM_ANY_CASE.match(text, at - cut).end()
                found = [text[at - cut:end].lower()]
                at = end
            else:
                at -= cut
        yield found


def weight(df: np.ndarray, n: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64)


def damping(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """What a document's length ``n`` adds below the fraction of its scores."""
    return 100 - 25 + (25 * n * docs) // total


def saturated(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Best:
    """The best ``k`` (score, id) seen, and the score that a document must beat."""

    def __init__(self, k: int):
        self.k = k
        self.ids = np.zeros(0, np.int64)
        self.scores = np.zeros(0, np.int64)

    @property
    def floor(self) -> int:
        """Scores below this can't get in any more."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        order = np.lexsort((ids, -scores))[: self.k]
        self.ids, self.scores = ids[order], scores[order]


class Block:
    """Inverted lists over documents in the order of their ids."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, counts: np.ndarray, term: np.ndarray, tf: np.ndarray,
                 weights: np.ndarray, docs: int, total: int):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        doc = np.repeat(place, counts)
        m = np.repeat(damping(lengths, docs, total), counts)
        score = weights[term] * saturated(tf, m)
        order = np.lexsort((doc, term))
        self.doc, self.score = doc[order], score[order]
        self.first = np.searchsorted(term[order], np.arange(len(weights) + 1))
        full = np.diff(self.first) > 0
        self.bound = np.zeros(len(weights), np.int64)
        if full.any():
            self.bound[full] = np.maximum.reduceat(self.score, self.first[:-1][full])

    def of(self, t: int) -> slice:
        return slice(self.first[t], self.first[t + 1])


def search(block: Block, query: list[tuple[int, int]], best: Best, short_share: float = SHORT_SHARE, window: int = WINDOW) -> None:
    """Bring ``best`` up to date with a block. ``query``: terms and how often each is asked for."""
    n = len(block.ids)
    asked = [(t, q) for t, q in query if block.bound[t] > 0]
    few = {t for t, _ in asked if block.first[t + 1] - block.first[t] <= short_share * n}
    short = [(t, q) for t, q in asked if t in few]
    lists = [(block.doc[s], block.score[s] * q, int(block.bound[t]) * q) for t, q in asked if t not in few for s in [block.of(t)]]
    if short:  # term at a time
        docs, place = np.unique(np.concatenate([block.doc[block.of(t)] for t, _ in short]), return_inverse=True)
        sums = np.zeros(len(docs), np.int64)
        np.add.at(sums, place, np.concatenate([block.score[block.of(t)] * q for t, q in short]))
        lists.append((docs, sums, int(sums.max())))
    if not lists:
        return
    lists.sort(key=lambda x: x[2])
    reach = np.cumsum([b for _, _, b in lists])  # of a document that only the lists so far hold
    for begin in range(0, n, window):
        floor = best.floor
        essential = int(np.searchsorted(reach, floor))  # lists before it can't bring up a document
        if essential == len(lists):
            return
        end = min(begin + window, n)
        score = np.zeros(end - begin, np.int64)
        there = [np.searchsorted(docs, (begin, end)) for docs, _, _ in lists]
        most = 0
        for (docs, scores, _), (a, z) in zip(lists[essential:], there[essential:]):
            if a < z:
                score[docs[a:z] - begin] += scores[a:z]
                most += int(scores[a:z].max())
        rest = sum(int(scores[a:z].max()) if a < z else 0 for (_, scores, _), (a, z) in zip(lists[:essential], there))
        if most + rest < floor:
            continue
        alive = np.flatnonzero((score > 0) & (score + rest >= floor))
        sums = score[alive]
        for x in range(essential - 1, -1, -1):  # strongest of the others first
            docs, scores, _ = lists[x]
            a, z = there[x]
            if a == z or not len(alive):
                continue
            at = a + np.searchsorted(docs[a:z], alive + begin)
            hit = at < z
            hit[hit] = docs[at[hit]] == alive[hit] + begin
            sums[hit] += scores[at[hit]]
            rest -= int(scores[a:z].max())
            keep = sums + rest >= floor
            alive, sums = alive[keep], sums[keep]
        best.add(block.ids[alive + begin], sums)


def _postings(docs: DataFrame, vocabulary, id_col: str, text_col: str) -> DataFrame:
    """Each document's number of terms, and its counts of the vocabulary's terms."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text <> ''")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for b in slices(batches, "text"):
            size, term, tf = [], [], []
            for text in b.column(1).cast(pa.binary()).to_pylist():
                n, counts = 0, Counter()
                for found in terms(text):
                    n += len(found)
                    counts.update(t for x in found if (t := known.get(x)) is not None)
                size.append(n)
                term.append(list(counts))
                tf.append(list(counts.values()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(term, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int64()))],
                                             names=["doc_id", "n", "term", "tf"])

    return stored(rows.mapInArrow(run, POSTINGS).where("n > 0"), "postings")


def _search_group(docs: DataFrame, texts: list[str], k: int, id_col: str, text_col: str) -> DataFrame:
    """``query`` (place in ``texts``), ``doc_id`` and ``score`` of each task's best."""
    spark = docs.sparkSession
    asked = [Counter(x for found in terms(t.encode()) for x in found) for t in texts]
    names = {t: i for i, t in enumerate(dict.fromkeys(t for c in asked for t in c))}
    wanted = [[(names[t], q) for t, q in c.items()] for c in asked]
    postings = _postings(docs, spark.sparkContext.broadcast(names), id_col, text_col)
    corpus = postings.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("total")).first()
    held = postings.select(F.explode("term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()
    df = np.zeros(len(names), np.int64)
    for r in held:
        df[r["term"]] = r["df"]
    plan = spark.sparkContext.broadcast((wanted, weight(df, corpus["docs"]), corpus["docs"], corpus["total"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, weights, docs, total = plan.value
        best = [Best(k) for _ in wanted]
        held, size = [], 0

        def look() -> None:
            t = pa.Table.from_batches(held).combine_chunks()
            term, tf = (t.column(c).combine_chunks() for c in ("term", "tf"))
            block = Block(t.column("doc_id").to_numpy(), t.column("n").to_numpy(), term.value_lengths().to_numpy(),
                          term.flatten().to_numpy(), tf.flatten().to_numpy(), weights, docs, total)
            for query, b in zip(wanted, best):
                search(block, query, b)

        for b in batches:
            held.append(b)
            size += len(b.column("term").flatten())
            if size >= BLOCK_POSTINGS:
                look()
                held, size = [], 0
        if held:
            look()
        for q, b in enumerate(best):
            if len(b.ids):
                yield pa.RecordBatch.from_arrays([pa.array([q] * len(b.ids), pa.int32()), pa.array(b.ids), pa.array(b.scores)], names=["query", "doc_id", "score"])

    return postings.where("doc_id is not null and size(term) > 0").mapInArrow(run, FOUND)


def ranked(docs: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           query_col: str = "item_id", query_text: str = "text", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``query_col``, ``rank`` (from 1), ``doc_id`` and ``score``: the ``k``
    highest-scoring documents for each query, those with a score above 0."""
    spark = docs.sparkSession
    ship(spark)
    asked = queries.select(F.col(query_col), F.col(query_text).cast("string").alias("_text")).where("_text <> ''").distinct()
    size = asked.agg(F.sum(F.octet_length("_text")).alias("bytes")).first()["bytes"] or 0
    groups = size // query_bytes + 1
    kind = StructType([asked.schema[0], *StructType.fromDDL("rank int, doc_id bigint, score bigint")])
    out = []
    for g in range(groups):
        mine = asked.where(F.pmod(F.xxhash64(query_col, "_text"), F.lit(groups)) == g).collect()
        if not mine:
            continue
        found = _search_group(docs, [r["_text"] for r in mine], k, id_col, text_col)
        # Tasks' results meet in two steps, so that a query's second one doesn't grow with the tasks.
        order = [F.desc("score"), F.asc("doc_id")]
        part = Window.partitionBy("query", "part").orderBy(*order)
        some = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(64))).withColumn("place", F.row_number().over(part)).where(F.col("place") <= k)
        top = some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)
        names = spark.createDataFrame([(q, r[0]) for q, r in enumerate(mine)], StructType([*StructType.fromDDL("query int"), asked.schema[0]]))
        out.append(top.join(names, "query").select(F.col(query_col), "rank", "doc_id", "score"))
    if not out:
        return spark.createDataFrame([], kind)
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE = f"""
with words as (
  select row_number() over () as d, doc_id, {_TERMS.format("text")} as ws from documents where text is not null
), sizes as (
  select d, doc_id, ws, len(ws)::bigint as n from words where len(ws) > 0
), corpus as (
  select count(*)::bigint as docs, sum(n)::bigint as total from sizes
), asked as (
  select q, item_id, t, count(*)::bigint as times
  from (select q, item_id, unnest({_TERMS.format("text")}) as t
        from (select row_number() over () as q, item_id, text from (select distinct item_id, text from benchmark where text is not null)))
  group by all
), counts as (
  select d, t, count(*)::bigint as tf from (select d, unnest(ws) as t from sizes) where t in (select t from asked) group by all
), weights as (
  select t, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from counts, corpus group by t, docs
), scored as (
  select q, item_id, d, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::bigint as score
  from asked join counts using (t) join weights using (t) join sizes using (d), corpus
  where doc_id is not null
  group by q, item_id, d, doc_id
)
select item_id, place::int as rank, doc_id, score
from (select *, row_number() over (partition by q order by score desc, doc_id) as place from scored where score > 0)
where place <= 20
"""
