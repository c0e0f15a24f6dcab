"""The order of landed pages from their cursors alone.

A response holds ``data`` and ``next_cursor``; the cursor that it was fetched with
is in its request or in the name it was landed under. Pages are ranked by pointer
doubling: each page points at the one that names it and knows how many steps away
that is; in each round it takes over the pointer of the page it points at and adds
up the steps, so that a chain of n pages takes log2(n) rounds. Each round is one
join of small rows by unique keys, and pages that have reached the head of their
chain stay out of it, so that no key grows hot. The pages' data aren't moved until
the ranks are known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.session import cut_lineage

_RANK = "_rank"


def response_schema(record_schema: T.StructType) -> T.StructType:
    """A page as the API returns it."""
    return T.StructType([T.StructField("data", T.ArrayType(record_schema)), T.StructField("next_cursor", T.StringType())])


def cursor_of_request(request: Column, parameter: str = "cursor") -> Column:
    """The cursor in a request line or URL; NULL for the first page, whose request
    has none or an empty one."""
    value = F.url_decode(F.regexp_extract(request, rf"[?&]{parameter}=([^&\s#]*)", 1))
    return F.when(value != "", value)


def cursor_of_name(path: Column, pattern: str = r"cursor=([^/]*?)(?:\.json)?(?:/|$)") -> Column:
    """The cursor in a landed file's name or folder, URL-encoded; NULL if it has none."""
    value = F.url_decode(F.regexp_extract(path, pattern, 1))
    return F.when(~value.isin("", "__HIVE_DEFAULT_PARTITION__"), value)


def pages_from_responses(df: DataFrame, cursor: Column, body_col: str, record_schema: T.StructType) -> DataFrame:
    """Landed responses as pages ``(cursor, data, next_cursor)``; a body that is no
    page has null data and no next cursor."""
    body = F.from_json(F.col(body_col), response_schema(record_schema))
    return df.select(cursor.alias("cursor"), body.alias("p")).select("cursor", "p.data", "p.next_cursor")


def _key(cursor: Column) -> Column:
    """The first page has a key too."""
    return F.coalesce(F.concat(F.lit("c"), cursor), F.lit("first"))


def rank_pages(pages: DataFrame) -> DataFrame:
    """``(cursor, page_rank, problem)`` for each cursor that fetched a page.

    ``page_rank`` counts from 0 at the first page along ``next_cursor``. It is
    NULL, with a ``problem``, for a page whose chain doesn't begin at the first
    page (``detached``: ``chain_head`` is the cursor it begins at) and for pages on
    or behind a ring of pages that lead to one another, of any length (``cycle``).
    A cursor that two pages name is taken to follow the one with the smaller
    cursor; ``chain_problems`` reports it."""
    links = pages.select("cursor", "next_cursor").distinct()
    named = links.where("next_cursor is not null").groupBy(_key(F.col("next_cursor")).alias("key")).agg(F.min(_key(F.col("cursor"))).alias("ptr"))
    nodes = links.select("cursor", _key(F.col("cursor")).alias("key")).distinct()
    first = F.col("key") == "first"
    state = nodes.join(named, "key", "left").select(
        "key", "cursor", F.when(~first, F.col("ptr")).alias("ptr"), F.when(first | F.col("ptr").isNull(), 0).otherwise(1).cast("bigint").alias("steps"))
    state = cut_lineage(state.select("key", "cursor", F.coalesce("ptr", "key").alias("ptr"), "steps", F.col("ptr").isNull().alias("done")))
    n = state.count()
    for _ in range(max(n - 1, 0).bit_length() + 1):
        open_ = state.where(~F.col("done"))
        if open_.isEmpty():
            break
        target = state.select(F.col("key").alias("ptr"), F.col("ptr").alias("far"), F.col("steps").alias("more"), F.col("done").alias("reached"))
        # A page is done when the page it points at heads a chain or is done itself.
        moved = open_.join(target, "ptr").select("key", "cursor", F.col("far").alias("ptr"), (F.col("steps") + F.col("more")).alias("steps"), F.col("reached").alias("done"))
        state = cut_lineage(state.where("done").unionByName(moved))
    ranked = F.col("done") & (F.col("ptr") == "first")
    return state.select("cursor", F.when(ranked, F.col("steps")).alias("page_rank"),
                        F.when(~F.col("done"), F.lit("cycle")).when(~ranked, F.lit("detached")).alias("problem"),
                        F.when(F.col("done") & ~ranked, F.expr("substring(ptr, 2)")).alias("chain_head"))


def records_in_page_order(pages: DataFrame, ranks: DataFrame) -> DataFrame:
    """``data[]`` of every page as typed rows, with ``page_rank`` (NULL: the page
    has a problem) and ``pos_in_page``: the order of the rows, without sorting them."""
    placed = pages.withColumn("key", _key(F.col("cursor"))).join(ranks.select(_key(F.col("cursor")).alias("key"), "page_rank"), "key")
    return placed.select("page_rank", F.posexplode("data").alias("pos_in_page", "r")).select("r.*", "page_rank", "pos_in_page")


def ring_problems(ranks: DataFrame) -> DataFrame:
    """``(problem, cursor)`` of pages that aren't in the first page's chain; of a
    detached chain only its head."""
    head = F.col("cursor").eqNullSafe(F.col("chain_head"))
    return ranks.where(F.col("problem").isNotNull() & ((F.col("problem") == "cycle") | head)).select("problem", "cursor")
