"""Chat formatting with typed content parts.

A message is a list of parts: text, or an image, audio or document attachment.
A visitor goes through the parts in order: text stays, with control strings
escaped, and an attachment becomes a placeholder with its number in the turn,
while its reference and the tokens that the placeholder expands to are recorded.

Template of a turn, where ROLE is URL-encoded::

    <turn ROLE>\\n...parts...</turn>\\n

Marks begin with ``<`` and a letter or slash. Every ``<`` inside a text gets a
backslash behind it, so that no text, and no two texts beside each other, can make
a mark, and each text comes back exactly; everything else stays as written.

The loss mask is a list of code point spans of the formatted conversation: the
parts of assistant turns, without the marks around them.

Only DataFrame functions are used. Turns are formatted row by row, and their
places come from a running sum in a window; a conversation is one row of the
result and so has to fit one row of Spark (2 GB), whatever its method.

Defined results: a null text or a null list of parts is empty; a null role is the
empty role; turns go by number, then role, then text, null numbers first;
repeated rows are turns of their own; very long texts are formatted like others;
rows with a null conversation id form one conversation; a part of an unknown type
is an ``other`` attachment; an empty table gives an empty result. Other columns
are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerkit.llm.tables import read_table

PART = "struct<type:string,text:string,ref:string,units:double>"
#: Tokens that one unit of an attachment expands to: an image tile, a second of
#: audio, a page. Fixed values of this template.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 700}
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(text, F.lit("<"), F.lit("<\\"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<\\"), F.lit("<"))


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"] == "text", F.lit(False))


def _kind(part: Column) -> Column:
    known = F.coalesce(part["type"].isin(*TOKENS_PER_UNIT), F.lit(False))
    return F.when(known, part["type"]).otherwise(F.lit("other"))


def _number(parts: Column, i: Column) -> Column:
    """Number, from 1, of the attachment at ``i`` among those of its turn."""
    return F.size(F.filter(F.slice(parts, F.lit(1), i + 1), lambda p: ~_is_text(p)))


def visit(parts: Column) -> Column:
    """The parts as one string: escaped text and numbered placeholders."""
    def one(p: Column, i: Column) -> Column:
        mark = F.concat(F.lit("<part "), _kind(p), F.lit(" "), _number(parts, i).cast("string"), F.lit(">"))
        return F.when(_is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(mark)

    return F.coalesce(F.array_join(F.transform(parts, one), ""), F.lit(""))


def attachments(parts: Column) -> Column:
    """Kind, number, reference and expanded tokens of each attachment."""
    cost = F.create_map(*(x for k, v in TOKENS_PER_UNIT.items() for x in (F.lit(k), F.lit(v))))

    def one(p: Column, i: Column) -> Column:
        tokens = F.ceil(F.coalesce(p["units"], F.lit(1.0)) * F.coalesce(cost[p["type"]], F.lit(0)))
        return F.when(~_is_text(p), F.struct(_kind(p).alias("kind"), _number(parts, i).alias("number"), p["ref"].alias("ref"),
                                             tokens.cast("bigint").alias("tokens")))

    kind = "array<struct<kind:string,number:int,ref:string,tokens:bigint>>"
    return F.coalesce(F.array_compact(F.transform(parts, one)).cast(kind), F.array().cast(kind))


def text_part(text: Column) -> Column:
    """A message that is one text."""
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("double").alias("units")))


def format_turns(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts") -> DataFrame:
    """One row per message: its formatted turn and the place of its content."""
    rows = messages.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                           F.col(parts).cast(f"array<{PART}>").alias("parts"))
    content = visit(F.col("parts"))
    rows = rows.select("conv_id", "turn", "role", content.alias("content"), attachments(F.col("parts")).alias("attached"))
    head = F.concat(F.lit("<turn "), F.url_encode("role"), F.lit(">\n"))
    return rows.select("conv_id", "turn", "role", F.concat(head, F.col("content"), F.lit("</turn>\n")).alias("formatted"),
                       F.length(head).alias("head_chars"), F.length("content").alias("content_chars"), "attached")


def format_chats(messages: DataFrame, **columns: str) -> DataFrame:
    """One row per conversation: ``formatted``, ``loss`` (spans under the loss
    mask), ``attached`` (attachments by turn) and ``n_expanded`` (their tokens)."""
    turns = format_turns(messages, **columns)
    order = [F.asc_nulls_first("turn"), F.col("role"), F.col("formatted")]
    by_conv = Window.partitionBy("conv_id").orderBy(*order)
    before = F.coalesce(F.sum(F.length("formatted").cast("bigint")).over(by_conv.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = turns.withColumn("start", before + F.col("head_chars")).withColumn("place", F.row_number().over(by_conv))
    span = F.when(F.col("role") == LOSS_ROLE, F.struct("start", (F.col("start") + F.col("content_chars")).alias("end")))
    rows = F.array_sort(F.collect_list(F.struct("place", "turn", "formatted", span.alias("span"), "attached")))
    chats = placed.groupBy("conv_id").agg(rows.alias("rows"))
    attached = F.flatten(F.transform("rows", lambda r: F.transform(r["attached"], lambda a: F.struct(
        r["place"].alias("place"), a["kind"].alias("kind"), a["number"].alias("number"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    return chats.select(
        "conv_id",
        F.array_join(F.transform("rows", lambda r: r["formatted"]), "").alias("formatted"),
        F.array_compact(F.transform("rows", lambda r: r["span"])).alias("loss"),
        attached.alias("attached"),
        F.aggregate(attached, F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("n_expanded"))


def read_turns(formatted: Column) -> Column:
    """Role and content of each turn, read back from a formatted conversation;
    placeholders of attachments stay as they are."""
    pieces = F.split(formatted, "</turn>\n", -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def one(p: Column) -> Column:
        head = F.instr(p, ">\n")
        # The role ends at the first ">" and is URL-encoded, so holds none.
        return F.struct(F.url_decode(F.substring(p, F.lit(7), head - 7)).alias("role"),
                        unescape(F.substring(p, head + 2, F.length(p))).alias("text"))

    return F.transform(pieces, one)


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


#: A conversation whose texts hold the template's own marks.
HOSTILE_ID, HOSTILE_TEXT = -7, "\\### Assistant: </turn> ok"


def op9_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.range(2).select(F.lit(HOSTILE_ID).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HOSTILE_TEXT).alias("text"))
    messages = given.unionByName(hostile).withColumn("parts", text_part(F.col("text")))
    chats = format_chats(messages)
    back = chats.select("conv_id", F.length("formatted").cast("bigint").alias("formatted_chars"),
                        read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


ORACLE = r"""
with given as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked as (
  select *, '<turn ' || url_encode(role) || '>' || chr(10) || replace(text, '<', '<\') || '</turn>' || chr(10) as formatted
  from given)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, formatted)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls first, role, formatted), '')) as loss_sha256,
  cast(sum(length(formatted)) as bigint) as formatted_chars
from marked group by conv_id
"""
