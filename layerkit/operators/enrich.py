"""Text enrichment: keyword labels, fallback, markers, review sample.

All labelling is column expressions (token sets and array functions), so it
runs inside whole-stage codegen with no Python in the hot path. A real
provider can be plugged in through ``pandas_classifier`` (Arrow batches).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.functions._util import as_col
from layerkit.functions.text import contains_any, hits, overlaps, phrase_hits, token_set
from layerkit.operators.incremental import path_exists
from layerkit.session import batches_within, free_name, ship_package

# The keyword classifier's word lists, phrases and labels.
POSITIVE_WORDS = (
    "enjoyed", "enjoy", "great", "best", "love", "loved", "excellent",
    "understand", "useful", "helpful", "helpfull", "engaging", "appreciated",
    "relevant", "interesting", "fair", "rewarding", "good", "thanks",
    "motivated", "learned", "fun", "well",
)
NEGATIVE_WORDS = (
    "stress", "stressed", "stressful", "confusing", "confused", "confuse",
    "frustrating", "boring", "unclear", "hard", "difficult", "exhausting",
    "lost", "unfair", "terrible", "wasted", "waste", "overwhelmed",
    "struggling", "dread", "chaotic", "hate", "cannot", "damn", "dragged",
    "bad",
)
NEGATIVE_PHRASES = ("too tight", "too fast", "too much", "give up", "no life")
LABELS = ("positive", "neutral", "negative")

# The fallback rule's word lists.
FALLBACK_POSITIVE = ("good", "great", "excellent", "best", "love", "loved", "clear")
FALLBACK_NEGATIVE = ("hard", "confused", "boring", "waste", "terrible", "stressed")

# The dialect markers, matched in the lower-cased text padded
# with one space on each side.
MARKERS = (
    "shiok", "sian", "atas", "sibei", "jialat", "chao ta", "buay tahan",
    "aiyoh", "wah lao", "aiya", "song ah", "steady bom", "song", "lor ",
    " lah", " lah.", " lah,", " liao", " sia", " ah ", " ah,", " ah.",
)

# Label-source names and the sample's quota, size and seed.
PRIMARY_SOURCE = "offline-stub-v1"
FALLBACK_SOURCE = "rules-v1"
SAMPLE_QUOTA = 4
SAMPLE_SIZE = 20
SAMPLE_SEED = 20260918


def keyword_scores(text, pos: Iterable[str] = POSITIVE_WORDS, neg: Iterable[str] = NEGATIVE_WORDS,
                   phrases: Iterable[str] = NEGATIVE_PHRASES, tokens: Column | None = None,
                   lowered: bool = False) -> tuple[Column, Column]:
    """(positive, negative): distinct word hits; each phrase found adds one negative.

    ``tokens`` may pass a precomputed ``token_set`` column and ``lowered=True``
    says ``text`` is already lower case, so several classifiers over one text
    lower-case and tokenize it once."""
    tokens = token_set(text, lowered=lowered) if tokens is None else tokens
    return hits(tokens, pos), hits(tokens, neg) + phrase_hits(text, phrases, lowered=lowered)


def keyword_label(text, pos: Iterable[str] = POSITIVE_WORDS, neg: Iterable[str] = NEGATIVE_WORDS,
                  phrases: Iterable[str] = NEGATIVE_PHRASES, labels: Sequence[str] = LABELS,
                  tokens: Column | None = None, lowered: bool = False) -> Column:
    """More positive hits → positive, more negative → negative, else
    neutral. Labels the caller did not ask for fall through to ``neutral`` or,
    without it, the first requested label."""
    p, n = keyword_scores(text, pos, neg, phrases, tokens, lowered)
    default = "neutral" if "neutral" in labels else labels[0]
    out = F.lit(default)
    if "negative" in labels:
        out = F.when(n > p, "negative").otherwise(out)
    if "positive" in labels:
        out = F.when(p > n, "positive").otherwise(out)
    return out


def exclusive_label(text, pos: Iterable[str] = FALLBACK_POSITIVE, neg: Iterable[str] = FALLBACK_NEGATIVE,
                    tokens: Column | None = None) -> Column:
    """A label only when the text hits exactly one side's word list."""
    tokens = token_set(text) if tokens is None else tokens
    hp, hn = overlaps(tokens, pos), overlaps(tokens, neg)
    return F.when(hp & ~hn, "positive").when(hn & ~hp, "negative").otherwise("neutral")


def label_with_fallback(df: DataFrame, text: str, primary: Callable[[Column], Column],
                        fallback: Callable[[Column], Column] = exclusive_label,
                        primary_id: str = PRIMARY_SOURCE, fallback_id: str = FALLBACK_SOURCE,
                        out: str = "label") -> DataFrame:
    """The primary classifier's label, or — where it yields NULL (failed)
    — the fallback's; adds ``label_source`` and ``needs_review``."""
    p = primary(F.col(text))
    return (df.withColumn("__primary", p)
              .withColumn(out, F.coalesce(F.col("__primary"), fallback(F.col(text))))
              .withColumn("label_source", F.when(F.col("__primary").isNotNull(), F.lit(primary_id))
                          .otherwise(F.lit(fallback_id)))
              .withColumn("needs_review", F.col("__primary").isNull())
              .drop("__primary"))


def pandas_classifier(fn: Callable[[list[str]], list[str | None]]) -> Callable[[Column], Column]:
    """T4: wrap a provider call ``fn(texts) -> labels`` as an Arrow-batched
    pandas UDF. When a batch's call raises, its texts are sent one by one: a text
    whose own call raises gets a NULL label, so that the fallback of
    ``label_with_fallback`` takes over for it and for no other."""
    import pandas as pd

    def _one(text):
        try:
            return fn([text])[0]
        except Exception:  # whatever the provider raises: this text failed
            return None

    def _classify(s):
        try:
            labels = list(fn(s.tolist()))
            if len(labels) != len(s):
                raise ValueError(f"{len(labels)} labels for {len(s)} texts")
        except Exception:
            labels = [_one(text) for text in s]
        return pd.Series(labels, dtype="object")

    # Real (not string) annotations: Spark infers the UDF kind from them.
    _classify.__annotations__ = {"s": pd.Series, "return": pd.Series}
    udf = F.pandas_udf(_classify, T.StringType())
    return lambda c: udf(c)


#: Rows and bytes of the texts of one call of a provider, about: a Python worker
#: holds a batch several times over, as Arrow, as text and as the call's list.
CALL_ROWS, CALL_BYTES = 1000, 1 << 22
LABEL_TABLE = "digest string, provider string, label string"


def provider_labels(df: DataFrame, text: str, fn: Callable[[list[str]], list[str | None]], provider: str, path: str,
                    fallback: Callable[[Column], Column] = exclusive_label, fallback_id: str = FALLBACK_SOURCE) -> DataFrame:
    """T4 with memory: ``label``, ``label_source`` and ``needs_review`` of every
    row, from a provider that is asked once for each distinct text.

    The label table at ``path`` holds what the provider has said, by the digest of
    the (redacted) text and the provider's name and version. Texts that it lacks
    are sent, each once however many rows hold it, in Arrow batches of at most about
    ``CALL_ROWS`` texts and ``CALL_BYTES``, however long the texts are; texts whose
    own call fails get the fallback's label and are sent again by the next run, as
    no failure is kept. A null text isn't sent and has the fallback's label."""
    spark = df.sparkSession
    ship_package(spark)
    digest = free_name(df, "__digest")
    if not path_exists(spark, path):
        spark.createDataFrame([], LABEL_TABLE).write.mode("ignore").parquet(path)
    known = spark.read.schema(LABEL_TABLE).parquet(path).where(F.col("provider") == provider).groupBy("digest").agg(F.first("label").alias("__label"))
    rows = df.withColumn(digest, F.sha2(F.col(text), 256))
    texts = rows.where(F.col(text).isNotNull()).groupBy(F.col(digest).alias("digest")).agg(F.first(text).alias("text"))
    asked = texts.join(known, "digest", "left_anti").withColumn("label", pandas_classifier(fn)(F.col("text")))
    # A filter on the label would be run before its column is made, and so call twice.
    said = asked.select(F.explode(F.array_compact(F.array(F.when(F.col("label").isNotNull(), F.struct("digest", F.lit(provider).alias("provider"), "label"))))).alias("r"))
    with batches_within(spark, CALL_ROWS, CALL_BYTES):
        said.select("r.*").write.mode("append").parquet(path)
    known = spark.read.schema(LABEL_TABLE).parquet(path).where(F.col("provider") == provider).groupBy(F.col("digest").alias(digest)).agg(F.first("label").alias("__label"))
    got = rows.join(known, digest, "left")
    return label_with_fallback(got, text, lambda _: F.col("__label"), fallback, provider, fallback_id).drop(digest, "__label")


def has_marker(text, markers: Iterable[str] = MARKERS) -> Column:
    """T5: the padded, lower-cased text contains any marker."""
    padded = F.concat(F.lit(" "), F.lower(as_col(text)), F.lit(" "))
    return contains_any(padded, markers)


def sample_rank(id_col: str, seed: int) -> Column:
    """Reproducible pseudo-random order: ``md5(id || seed)``."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(str(seed))))


def stratified_sample(df: DataFrame, id_col: str, flag: Column, quota: int = SAMPLE_QUOTA,
                      total: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED) -> DataFrame:
    """``min(quota, n_flagged)`` rows of the flagged stratum, the rest of
    ``total`` from the other stratum, each chosen by ``md5(id || seed)``.

    One pass: ``row_number() <= total`` per stratum becomes a partial
    ``WindowGroupLimit``, so every task forwards at most ``total`` rows per
    stratum and no stratum is gathered into one task. The quota split is then
    decided on those ≤ 2 × ``total`` rows. A stratum smaller than its share
    yields what exists. Adds ``sample_flag``.
    """
    d = (df.withColumn("sample_flag", F.coalesce(flag.cast("boolean"), F.lit(False)))
           .withColumn("__h", sample_rank(id_col, seed)))
    w = Window.partitionBy("sample_flag").orderBy("__h", id_col)
    top = d.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= total)
    # ≤ 2 × total rows from here on (bounded): one small partition is fine.
    n_flag = F.max(F.when(F.col("sample_flag"), F.col("__rn"))).over(Window.partitionBy(F.lit(0)))
    top = top.withColumn("__k", F.least(F.lit(quota), F.coalesce(n_flag, F.lit(0))))
    keep = ((F.col("sample_flag") & (F.col("__rn") <= F.col("__k")))
            | (~F.col("sample_flag") & (F.col("__rn") <= F.lit(total) - F.col("__k"))))
    return top.where(keep).drop("__h", "__rn", "__k")


def review_sheet(sample: DataFrame, id_col: str, text_col: str, label_col: str = "label",
                 keep: Sequence[str] = ()) -> DataFrame:
    """``(id, text with '|' escaped, label, keep...)`` for a Markdown review table."""
    return sample.select(F.col(id_col), F.replace(F.col(text_col), F.lit("|"), F.lit("\\|")).alias(text_col),
                         F.col(label_col), *[F.col(c) for c in keep])


def enrich_summary(df: DataFrame) -> DataFrame:
    """Rows per ``label_source`` and how many need review."""
    return df.groupBy("label_source").agg(F.count(F.lit(1)).alias("n"),
                                          F.count_if("needs_review").alias("n_needs_review"))
