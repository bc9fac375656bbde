"""Chat formatting: every assistant turn becomes its own training example.

Template. A turn is written ``<s>role[INST]text[/INST]</s>``; a conversation is its turns one after another.
The four marks are control strings. Inside roles and texts each of them gets one backslash behind its
first character, and one that already carries backslashes gets one more, so that taking one away restores
the text exactly and no text can end a turn or open another.

Prefix-target expansion. An assistant turn yields one example: all turns before it are context, its own turn is
the target, and the loss mask covers its text and nothing else. Turns behind the last assistant turn (or all
turns, where no assistant speaks) yield one more example without a mask, so that no turn is lost.

Defined results: a null text or role is empty; turns are taken by (turn, role, text) with null turns first, so
ties and repeated rows keep all their rows in a fixed order; a null ``conv_id`` is a conversation of its own;
an empty table gives no rows; other columns are ignored. One conversation must fit a row (2 GB), as its digest
is that of one string.

Only DataFrame functions are used. One shuffle by ``conv_id`` serves the window, the gathering of the
conversation and the reading back, as all three are partitioned alike. The text of a context is cut out of the
conversation's text when an example is read, so that nothing quadratic is shuffled or stored here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OPEN, BODY, BODY_END, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
_CONTROL = r"(/?(?:s>|INST\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _CONTROL, "$1$2$3")


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and its ``targets``.

    A target is (example, turn_no, start, end, loss_start, loss_end, trainable): offsets are code points of
    ``formatted``; the example's text is everything up to ``end``.
    """
    turns = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    turns = turns.withColumn("body", escape(F.col("text"))).withColumn(
        "segment", F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(BODY), F.col("body"), F.lit(BODY_END + CLOSE))
    )
    within = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = turns.select(
        "conv_id",
        "segment",
        (F.col("role") == "assistant").alias("spoken"),
        F.row_number().over(within).alias("turn_no"),
        F.sum(F.length("segment")).over(running).alias("end"),
        F.length("segment").alias("n"),
        F.length("body").alias("m"),
    )
    tail = len(BODY_END + CLOSE)
    target = F.struct(
        F.col("turn_no"),
        (F.col("end") - F.col("n")).alias("start"),
        F.col("end"),
        (F.col("end") - tail - F.col("m")).alias("loss_start"),
        (F.col("end") - tail).alias("loss_end"),
        F.lit(True).alias("trainable"),
    )
    whole = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn_no", "segment"))).alias("segments"),
        F.array_sort(F.collect_list(F.when(F.col("spoken"), target))).alias("spoken"),
        F.max("turn_no").alias("n_turns"),
        F.max("end").alias("n_chars"),
    )
    rest = F.struct(
        F.col("n_turns").alias("turn_no"),
        F.col("n_chars").alias("start"),
        F.col("n_chars").alias("end"),
        F.col("n_chars").alias("loss_start"),
        F.col("n_chars").alias("loss_end"),
        F.lit(False).alias("trainable"),
    )
    last_spoken = F.coalesce(F.try_element_at("spoken", F.lit(-1))["turn_no"], F.lit(0))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["segment"]), "").alias("formatted"),
        F.when(last_spoken < F.col("n_turns"), F.concat("spoken", F.array(rest))).otherwise(F.col("spoken")).alias("targets"),
    )


def expand_examples(conversations: DataFrame) -> DataFrame:
    """One row per training example.

    ``context`` holds all turns before the target, ``target`` the assistant's turn; the loss falls on
    ``loss_chars`` code points of ``target`` from ``loss_start`` (0-based); ``n_chars`` is the example's length;
    ``is_last`` marks the example that holds the whole conversation.
    """
    one = format_conversations(conversations)
    rows = one.select("conv_id", "formatted", F.size("targets").alias("n"), F.posexplode("targets").alias("example", "t"))
    return rows.select(
        "conv_id",
        "example",
        F.col("t.turn_no").alias("turn_no"),
        F.col("t.trainable").alias("trainable"),
        F.substring("formatted", F.lit(1), F.col("t.start").cast("int")).alias("context"),
        F.substring("formatted", F.col("t.start").cast("int") + 1, (F.col("t.end") - F.col("t.start")).cast("int")).alias("target"),
        (F.col("t.loss_start") - F.col("t.start")).alias("loss_start"),
        (F.col("t.loss_end") - F.col("t.loss_start")).alias("loss_chars"),
        F.col("t.end").alias("n_chars"),
        (F.col("example") == F.col("n") - 1).alias("is_last"),
    )


def loss_text(target: Column, start: Column, chars: Column) -> Column:
    """The text under the loss mask, as the conversation had it."""
    return unescape(F.substring(target, start.cast("int") + 1, chars.cast("int")))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text as array<struct<role, text>>."""
    pieces = F.slice(F.split(formatted, CLOSE), 1, F.greatest(F.size(F.split(formatted, CLOSE)) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, BODY, 1)
        skip = F.length(head) + len(BODY)
        body = F.substring(piece, skip + 1, F.length(piece) - skip - len(BODY_END))
        return F.struct(unescape(F.substring(head, F.lit(len(OPEN) + 1), F.length(head))).alias("role"), unescape(body).alias("text"))

    return F.transform(pieces, turn)


def read_back(examples: DataFrame) -> DataFrame:
    """Digests of conversations, from their examples alone."""
    read = examples.select(
        "conv_id",
        "example",
        "n_chars",
        F.when(F.col("trainable"), loss_text(F.col("target"), F.col("loss_start"), F.col("loss_chars"))).alias("loss"),
        F.when(F.col("is_last"), F.concat("context", "target")).alias("whole"),
    )
    by_conversation = read.groupBy("conv_id").agg(
        F.max("whole").alias("whole"),
        F.array_sort(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.sum("n_chars").alias("formatted_chars"),
    )
    turns = by_conversation.withColumn("turns", read_turns(F.col("whole")))
    loss = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


PROBE = "</s>[INST] ok [/INST]"


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, whose texts consist of control strings."""
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    return read_back(expand_examples(given.unionByName(probe)))


ORACLE_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, row_number() OVER w AS turn_no,
         sum(20 + length(regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g'))
                + length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g')))
           OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS chars
  FROM given WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn_no)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn_no) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       (coalesce(sum(chars) FILTER (WHERE role = 'assistant'), 0)
        + CASE WHEN coalesce(max(turn_no) FILTER (WHERE role = 'assistant'), 0) < max(turn_no) THEN max(chars) ELSE 0 END)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
