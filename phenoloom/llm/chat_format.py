"""Rendering of logged conversations, snapshots collapsed. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phenoloom.llm.common import col
from phenoloom.session import stage

TURN_OPEN, ROLE_CLOSE, TURN_CLOSE = "<|start|>", "\n", "<|end|>\n"


def format_chats(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per maximal conversation: its id, number of turns, number of logs
    with just these turns, and the rendered text.

    Chats are often logged again after every turn. A conversation whose turns
    are the first turns of a longer one is dropped; of equal conversations the
    one with the smallest id stays. Turn i of a conversation adds a hash of
    (i, role, text) to the hash of the turns before it, so equal prefixes have
    equal pairs of 64-bit hashes.

    Turns are ordered by ``turn``, nulls first, then by a hash of their content;
    repeated rows are turns like others. Null roles and texts read as empty.
    Rows with a null conversation id form one conversation. Extra columns are
    ignored, an empty table gives no rows. One conversation is one output record
    and so is held by one task when it is rendered; content shared by many
    conversations, such as a first turn, is merged before it is shuffled.
    """
    role, text = F.coalesce(col(role_col), F.lit("")), F.coalesce(col(text_col), F.lit(""))
    whole = turns.select(
        # In a struct, null ids are equal to each other in joins and groups alike.
        F.struct(col(conv_col).alias("id")).alias("_conv"), col(turn_col).alias("_turn"),
        F.xxhash64(role, text).alias("_h1"), F.xxhash64(F.lit(1), role, text).alias("_h2"),
        role.alias("_role"), text.alias("_text"),
    )
    order = ["_turn", "_h1", "_h2"]
    within = Window.partitionBy("_conv").orderBy(*order)
    rolling = within.rowsBetween(Window.unboundedPreceding, 0)
    placed = whole.drop("_role", "_text").withColumns(
        {"_at": F.row_number().over(within), "_last": F.lead(F.lit(False), 1, True).over(within)}
    )
    prefixes = placed.select(
        "_conv", "_at", "_last",
        F.bit_xor(F.xxhash64("_at", "_h1")).over(rolling).alias("_p1"),
        F.bit_xor(F.xxhash64("_h2", "_at")).over(rolling).alias("_p2"),
    )
    prefixes = stage(prefixes)
    same = ["_at", "_p1", "_p2"]
    logged = prefixes.filter("_last").groupBy(*same).agg(
        F.min("_conv").alias("_kept"),
        F.count("*").alias("_logs"),
    )
    continued = prefixes.filter("NOT _last").select(*same).distinct()
    maximal = logged.join(continued, same, "left_anti").select("_kept", "_logs")
    turn_text = F.concat(F.lit(TURN_OPEN), "_role", F.lit(ROLE_CLOSE), "_text", F.lit(TURN_CLOSE))
    rendered = (
        whole.join(maximal, F.col("_conv") == F.col("_kept"))
        .groupBy("_conv")
        .agg(F.first("_logs").alias("_logs"), F.sort_array(F.collect_list(F.struct(*order, turn_text.alias("_out")))).alias("_turns"))
    )
    return rendered.select(
        F.col("_conv.id").alias(conv_col),
        F.size("_turns").cast("long").alias("n_turns"),
        F.col("_logs").alias("n_logs"),
        F.array_join(F.col("_turns._out"), "").alias("rendered"),
    )


def op4_chat_format(conversations: DataFrame) -> DataFrame:
    return format_chats(conversations)


OP4_SQL = """
WITH turns AS (
  SELECT conv_id, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n_turns,
         '<|start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS part
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST)
), prefixes AS (
  SELECT conv_id, place, n_turns,
         string_agg(part, '') OVER (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS rendered
  FROM turns
), logged AS (
  SELECT min(conv_id) AS conv_id, n_turns, count(*) AS n_logs, rendered
  FROM prefixes WHERE place = n_turns GROUP BY n_turns, rendered
)
SELECT conv_id, n_turns::BIGINT AS n_turns, n_logs::BIGINT AS n_logs, rendered FROM logged l
WHERE NOT EXISTS (SELECT 1 FROM prefixes p WHERE p.place < p.n_turns AND p.place = l.n_turns AND p.rendered = l.rendered)
"""
