"""Chat formatting by prefix-target expansion, with DataFrame functions only.

A conversation becomes one formatted *stream*, a marked turn after the other::

    <|im_start|>ROLE<|im_sep|>TEXT<|im_end|>

Every assistant turn becomes an example of its own: all preceding turns are its
context and only that reply is trainable.  As an example's text is the stream up
to its reply's end mark, examples are kept as ``(end, loss_start, loss_end)``
spans of the stream (code points, end exclusive), one row per assistant turn;
:func:`example_texts` writes them out where a trainer wants whole texts.  The
expansion as spans grows with the turns, not with their square.

*Escaping*: in roles and texts every ``<``, ``[`` and ``\\`` is followed by an
inserted ``\\``.  No mark, nor any other control string that begins with one of
the brackets (``</s>``, ``[INST]``, ``<|im_end|>``), can then occur in a body,
and removing the inserted backslashes from left to right gives the text back.

Defined cases: null role or text counts as empty; turns are ordered by
``turn`` (nulls first), then role and text, repeated rows one after the other; null
``conv_id`` is a conversation of its own; a conversation without an assistant
has a stream but no example; only the role ``assistant`` is trainable.
Input columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import table, written

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"[<\[\\]", r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``stream`` and ``turn_ends``
    (role, end of the header, end of the body, end of the turn, in turns'
    order; lengths are added up per turn, so offsets are code points)."""
    body = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    rows = body.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    parts = F.transform("turns", lambda t: F.struct(
        t["role"].alias("role"), F.concat(F.lit(START), escape(t["role"]), F.lit(SEP)).alias("head"),
        escape(t["text"]).alias("body")))
    rows = rows.select("conv_id", parts.alias("parts"))
    stream = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    sizes = F.transform("parts", lambda p: F.struct(
        (p["role"] == "assistant").alias("trainable"), F.char_length(p["head"]).alias("head"),
        F.char_length(p["body"]).alias("body")))
    return rows.select("conv_id", stream.alias("stream"), sizes.alias("sizes"))


def example_spans(conversations: DataFrame) -> DataFrame:
    """Prefix-target expansion: ``conv_id``, ``example`` (number of its turn),
    ``end`` (its text is ``stream[0:end]``), ``loss_start`` and ``loss_end``."""
    return conversations.select("conv_id", F.inline(_spans(F.col("sizes"))))


def example_replies(conversations: DataFrame, key: str) -> DataFrame:
    """Prefix-target expansion with the replies: a row per assistant turn, with the
    column ``key``, its ``example_spans`` columns and ``reply``, the text under its
    loss mask, unescaped.  Replies are cut before the turns become rows, so a row
    carries its own reply and not the stream."""
    cut = F.transform(_spans(F.col("sizes")), lambda s: F.struct(
        s["example"].alias("example"), s["end"].alias("end"), s["loss_start"].alias("loss_start"),
        s["loss_end"].alias("loss_end"), unescape(F.substring(
            F.col("stream"), s["loss_start"] + 1, s["loss_end"] - s["loss_start"])).alias("reply")))
    return conversations.select(key, F.inline(cut))


def _spans(sizes: Column) -> Column:
    """Spans of every assistant turn, from the turns' lengths."""
    step = F.aggregate(
        sizes,
        F.struct(F.lit(0).alias("at"), F.lit(0).alias("turn"), F.expr(
            "cast(array() as array<struct<example:int,loss_start:int,loss_end:int,end:int>>)").alias("found")),
        lambda a, s: F.struct(
            (a["at"] + s["head"] + s["body"] + F.lit(len(END))).alias("at"), (a["turn"] + 1).alias("turn"),
            F.when(s["trainable"], F.concat(a["found"], F.array(F.struct(
                a["turn"].alias("example"), (a["at"] + s["head"]).alias("loss_start"),
                (a["at"] + s["head"] + s["body"]).alias("loss_end"),
                (a["at"] + s["head"] + s["body"] + F.lit(len(END))).alias("end")))))
            .otherwise(a["found"]).alias("found")))
    return step["found"]


def example_texts(turns: DataFrame) -> DataFrame:
    """Every example written out: conv_id, example, text (context and reply),
    loss_start, loss_end.  Grows with the square of a conversation's turns."""
    conv = format_conversations(turns)
    return conv.select("conv_id", "stream", F.inline(_spans(F.col("sizes")))) \
        .select("conv_id", "example", F.substring("stream", F.lit(1), F.col("end")).alias("text"),
                "loss_start", "loss_end")


def read_turns(stream: Column) -> Column:
    """The turns of a stream, as an array of (role, text), unescaped."""
    marked = F.filter(F.split(stream, r"<\|im_start\|>", -1), lambda p, i: i > 0)

    def turn(p: Column) -> Column:
        return F.struct(unescape(F.substring_index(p, SEP, 1)).alias("role"),
                        unescape(F.regexp_replace(p, r"(?s)^.*?<\|im_sep\|>|<\|im_end\|>$", "")).alias("text"))
    return F.transform(marked, turn)


CONTROL = "</s>[INST] ok [/INST]"


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all ``conversations`` and of conversation -7, read back from
    the streams and the loss spans of their examples."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)],
                                  "conv_id bigint, turn bigint, role string, text string")
    conv = written(format_conversations(given.union(extra)).withColumn("row", F.monotonically_increasing_id()),
                   "chat-streams")
    # every assistant turn is a row of its own here; what the query tells about the loss comes from these rows
    replies = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "reply"))), lambda r: r["reply"]), "")
    examples = example_replies(conv, "row").groupBy("row").agg(
        replies.alias("loss"), F.count("*").alias("n_examples"), F.sum("end").cast("bigint").alias("example_chars"))
    back = conv.select("row", "conv_id", F.char_length("stream").alias("stream_chars"),
                       read_turns(F.col("stream")).alias("turns")).join(examples, "row", "left")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.coalesce("loss", F.lit(""))
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.col("stream_chars").cast("bigint").alias("formatted_chars"),
        F.coalesce("n_examples", F.lit(0)).alias("n_examples"), F.coalesce("example_chars", F.lit(0)).alias("example_chars"))


OP3_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), n AS (
  SELECT *, length(role) + length(regexp_replace(role, '[^<\[\\]', '', 'g')) AS role_n,
         length(text) + length(regexp_replace(text, '[^<\[\\]', '', 'g')) AS text_n FROM t
), p AS (
  SELECT *, CAST(sum(32 + role_n + text_n) OVER (PARTITION BY conv_id ORDER BY turn, role, text
                                                 ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM n
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       max(upto) AS formatted_chars, count(*) FILTER (role = 'assistant') AS n_examples,
       CAST(coalesce(sum(upto) FILTER (role = 'assistant'), 0) AS BIGINT) AS example_chars
FROM p GROUP BY conv_id
"""
