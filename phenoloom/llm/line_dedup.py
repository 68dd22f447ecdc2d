"""Removal of lines that many documents share. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenoloom.llm.common import BLANKS, ascii_lower, col
from phenoloom.session import stage


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    counts: tuple[str, str] = ("n_lines", "n_dropped"),
) -> DataFrame:
    """All rows of ``docs`` with shared lines dropped from the text, plus the
    number of lines before and of lines dropped.

    The key of a line is the line without blanks at both ends, A-Z in lower
    case. A key of at least ``min_chars`` code points found in at least
    ``min_docs`` documents keeps its lines only in the largest id holding it.

    A null text is one empty line, so it comes back empty. Rows of the same id
    are one document when documents are counted, and each row keeps or loses
    lines by that id; null ids are one document that comes before all others.
    Long texts are cut into lines like any other. Columns of ``docs`` with the
    names of the counts are replaced; an empty table stays empty.

    Lines travel as two 64-bit hashes and a position. The distinct documents of
    a key are counted in two steps, first per (key, document), so a line that a
    third of all documents hold never meets in one task.
    """
    # The row's text is named by hashes beside the id, since ids may repeat.
    rows = docs.select(
        col(id_col).alias("_id"),
        F.xxhash64(F.coalesce(col(text_col), F.lit(""))).alias("_t1"),
        F.xxhash64(F.lit(1), F.coalesce(col(text_col), F.lit(""))).alias("_t2"),
        F.posexplode(F.split(F.coalesce(col(text_col), F.lit("")), "\n", -1)).alias("_at", "_line"),
    )
    key = ascii_lower(F.btrim("_line", F.lit(BLANKS)))
    lines = (
        rows.withColumn("_key", key)
        .filter(F.char_length("_key") >= min_chars)
        .select("_id", "_t1", "_t2", "_at", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), F.col("_key")).alias("_h2"))
    )
    lines = stage(lines)
    in_documents = lines.groupBy("_h1", "_h2", "_id").agg(F.lit(1).alias("_one"))
    shared = (
        in_documents.groupBy("_h1", "_h2")
        .agg(F.count("*").alias("_docs"), F.max("_id").alias("_keeper"))
        .filter(F.col("_docs") >= min_docs)
        .drop("_docs")
    )
    # Staged, so that the join below reads two plain sides: the keys are sent
    # whole if they are few, and a hot key is split between tasks if not.
    shared = stage(shared)
    dropped = (
        lines.join(shared, ["_h1", "_h2"])
        .filter(~F.col("_id").eqNullSafe(F.col("_keeper")))
        .groupBy("_id", "_t1", "_t2")
        .agg(F.sort_array(F.collect_set("_at")).alias("_drop"))  # at most the lines of one document
    )
    names = [c for c in docs.columns if c not in counts]
    keyed = docs.select(
        F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(names)]).alias("_row"),
        F.coalesce(col(text_col), F.lit("")).alias("_text"),
        col(id_col).alias("_id"),
    ).withColumns({"_t1": F.xxhash64("_text"), "_t2": F.xxhash64(F.lit(1), F.col("_text"))})
    right = dropped.select(F.col("_id").alias("_rid"), F.col("_t1").alias("_r1"), F.col("_t2").alias("_r2"), "_drop")
    same = F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_t1") == F.col("_r1")) & (F.col("_t2") == F.col("_r2"))
    joined = keyed.join(right, same, "left").select(
        "_row",
        F.split("_text", "\n", -1).alias("_lines"),
        F.coalesce("_drop", F.array().cast("array<int>")).alias("_drop"),
    )
    # The kept lines are the runs between dropped positions: linear in the lines.
    begin = lambda i: F.when(i == 0, 0).otherwise(F.get("_drop", i - 1) + 1)
    end = lambda i: F.coalesce(F.get("_drop", i), F.size("_lines"))
    runs = F.transform(
        F.sequence(F.lit(0), F.size("_drop")), lambda i: F.slice("_lines", begin(i) + 1, end(i) - begin(i))
    )
    text = F.when(F.size("_drop") == 0, F.array_join("_lines", "\n")).otherwise(F.array_join(F.flatten(runs), "\n"))
    fields = [text.alias(c) if c == text_col else F.col(f"_row.c{i}").alias(c) for i, c in enumerate(names)]
    return joined.select(
        *fields, F.size("_lines").cast("long").alias(counts[0]), F.size("_drop").cast("long").alias(counts[1])
    )


def op2_line_dedup(documents: DataFrame) -> DataFrame:
    """Contract of the query: doc_id, n_lines, n_dropped, kept_sha256."""
    kept = dedup_lines(documents.select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone FROM keyed k LEFT JOIN shared s USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
