"""Paged JSON records (A19), re-aimed at landed page files.

A page is ``{"page_no": int, "cursor": str|null, "data": [record, ...],
"next_cursor": str|null}``: ``cursor`` is the cursor the page was fetched
with (NULL for the first), ``next_cursor`` NULL on the last page. The HTTP
client that lands them is not part of the library.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def page_schema(record_schema: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("page_no", T.LongType()),
        T.StructField("cursor", T.StringType()),
        T.StructField("data", T.ArrayType(record_schema)),
        T.StructField("next_cursor", T.StringType()),
    ])


def records_from_pages(pages: DataFrame) -> DataFrame:
    """Flatten ``data[]`` of every page into typed rows with ``page_no`` and the
    position on the page (``posexplode``: narrow, no shuffle)."""
    return (pages.select("page_no", F.posexplode("data").alias("pos_in_page", "r"))
                 .select("r.*", "page_no", "pos_in_page"))


def pages_from_json(df: DataFrame, json_col: str, record_schema: T.StructType) -> DataFrame:
    """Parse page documents held as JSON text in a column."""
    return df.select(F.from_json(F.col(json_col), page_schema(record_schema)).alias("p")).select("p.*")


def read_pages(spark: SparkSession, path: str, record_schema: T.StructType) -> DataFrame:
    """Landed page files (one JSON page per line or file) → typed records."""
    pages = spark.read.schema(page_schema(record_schema)).json(path)
    return records_from_pages(pages)


def _problem(name: str, side: str) -> Column:
    return F.struct(F.lit(name).alias("problem"), F.col(f"{side}.page_no").alias("page_no"), F.col(f"{side}.cursor").alias("cursor"))


def chain_problems(pages: DataFrame) -> DataFrame:
    """Pages that break the cursor chain: ``(problem, page_no, cursor)``.

    Exactly one first page (no cursor) and one last page (no next cursor); every
    ``next_cursor`` must be the ``cursor`` of some page; every page but the first
    must be the next one of another page; no cursor may fetch two pages, and no
    two pages may name the same next one. Empty result = complete chain.

    The pages' data aren't read: one pass takes the three small columns, and one
    aggregate by cursor brings together the page that a cursor fetched and the
    page that named it.
    """
    small = pages.select("page_no", "cursor", "next_cursor")
    fetched = small.select(F.col("cursor").alias("key"), F.lit(1).alias("is_page"), "page_no", "cursor", F.col("next_cursor").eqNullSafe(F.col("cursor")).alias("self"))
    named = small.select(F.col("next_cursor").alias("key"), F.lit(0).alias("is_page"), "page_no", "cursor", F.lit(False).alias("self"))
    page, link = F.col("is_page") == 1, (F.col("is_page") == 0)
    by_key = fetched.unionByName(named).groupBy("key").agg(
        F.count_if(page).alias("pages"), F.count_if(link).alias("links"), F.count_if(page & F.col("self") & F.col("key").isNotNull()).alias("selves"),
        F.min(F.when(page, F.struct("page_no", "cursor"))).alias("page"), F.min(F.when(link, F.struct("page_no", "cursor"))).alias("link"))
    key, n, m = F.col("key"), F.col("pages"), F.col("links")
    others = m - F.col("selves")
    found = F.array_compact(F.array(
        F.when(key.isNull() & (n > 1), _problem("first page not unique", "page")),
        F.when(key.isNull() & (n == 0), _problem("no first page", "link")),
        F.when(key.isNull() & (m > 1), _problem("last page not unique", "link")),
        F.when(key.isNull() & (m == 0), _problem("no last page", "page")),
        F.when(key.isNotNull() & (n == 0), _problem("next cursor has no page", "link")),
        F.when(key.isNotNull() & (n > 1), _problem("cursor fetched twice", "page")),
        F.when(key.isNotNull() & (n > 0) & (others == 0), _problem("no page leads here", "page")),
        F.when(key.isNotNull() & (m > 1), _problem("named by two pages", "link"))))
    return by_key.select(F.inline(found))
