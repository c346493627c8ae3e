"""Chat formatting with Spark expressions only.

A conversation becomes one string of blocks ``<|role|>text<+>text</turn>``:
adjacent turns of one role share a block and are parted by ``<+>``. Inside
texts and roles a backslash becomes ``\\s`` and ``<`` becomes ``\\l`` (in roles
also ``|`` becomes ``\\p``), so ``<`` in the output is always a mark, whatever
the texts hold, and the steps undo exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR, END = "<+>", "</turn>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\s"), F.lit("\\"))


def _mark(role: Column) -> Column:
    return F.concat(F.lit("<|"), F.replace(escape(role), F.lit("|"), F.lit("\\p")), F.lit("|>"))


def format_conversations(df: DataFrame, loss_role: str = "assistant", id_col: str = "conv_id", order_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: (conv_id, formatted, segments).

    ``segments`` is an array of (text, loss) whose texts concatenate to
    ``formatted``; loss is true exactly on the texts of ``loss_role`` turns,
    never on marks or separators.

    Turns are ordered by turn, then role, then text, nulls first, so ties and
    repeated rows have a fixed place and are all kept. A null text or role is
    the empty string. Rows with a null conversation id form one conversation.
    Other columns are ignored; an empty table gives no rows. The turns of one
    conversation meet in one row because the output is that row.
    """
    turns = (
        df.select(
            F.col(id_col).alias("conv_id"), F.col(order_col).alias("turn"),
            F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        )
        .groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    )
    t, s = F.col("t"), F.col("s")
    starts = F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: (i == 0) | (F.get(t, i)["role"] != F.get(t, i - 1)["role"]))
    blocks = F.transform(s, lambda at, k: F.slice(t, at + 1, F.coalesce(F.get(s, k + 1), F.size(t)) - at))
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    flat = F.flatten(
        F.transform(
            F.col("b"),
            lambda block: F.concat(
                F.array(piece(_mark(F.get(block, F.lit(0))["role"]), F.lit(False))),
                F.flatten(
                    F.transform(
                        block,
                        lambda x, i: F.when(i == 0, F.array(piece(escape(x["text"]), x["role"] == loss_role))).otherwise(
                            F.array(piece(F.lit(SEPARATOR), F.lit(False)), piece(escape(x["text"]), x["role"] == loss_role))
                        ),
                    )
                ),
                F.array(piece(F.lit(END), F.lit(False))),
            ),
        )
    )
    return (
        turns.withColumn("s", starts).withColumn("b", blocks).select("conv_id", flat.alias("segments"))
        .select("conv_id", F.array_join(F.transform("segments", lambda x: x["text"]), "").alias("formatted"), "segments")
    )


def parse_formatted(df: DataFrame) -> DataFrame:
    """Read conversations back from ``formatted``: adds turns array<(role, text)>."""
    blocks = F.filter(F.split("formatted", END), lambda x: x != "")
    turns = F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(F.substring(b, F.instr(b, "|>") + F.lit(2), F.length(b)), r"<\+>"),
                lambda x: F.struct(
                    unescape(F.replace(F.substring(b, F.lit(3), F.instr(b, "|>") - F.lit(3)), F.lit("\\p"), F.lit("|"))).alias("role"),
                    unescape(x).alias("text"),
                ),
            ),
        )
    )
    return df.withColumn("turns", turns)


def digest(df: DataFrame) -> DataFrame:
    """The figures of ``op4``: counts and digests read back from the output."""
    loss = F.array_join(F.transform(F.filter("segments", lambda x: x["loss"]), lambda x: unescape(x["text"])), "")
    return parse_formatted(df).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
placed AS (
  SELECT *, row_number() OVER w AS k, lag(role) OVER w AS before FROM rows
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
sized AS (
  SELECT *, length(replace(replace(text, '\', '\s'), '<', '\l')) + CASE WHEN before = role THEN 3
    ELSE 4 + 7 + length(replace(replace(replace(role, '\', '\s'), '<', '\l'), '|', '\p')) END AS chars FROM placed)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
