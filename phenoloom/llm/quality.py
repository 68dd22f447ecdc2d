"""Quality rules per document and per host."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoloom.llm.common import BLANKS, col
from phenoloom.session import stage

SYMBOLS = "#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    """The values of ``MEASURES`` for one whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()  # bytes: the six ASCII blanks only
    letters = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    repeated_lines, seen = 0, set()
    for line in text.split("\n"):
        if line.strip(BLANKS):
            repeated_lines += line in seen
            seen.add(line)
    in_repeats = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        twice = np.fromiter((times[w] > 1 for w in windows), dtype=bool, count=len(windows))
        covered = np.zeros(len(words), dtype=bool)
        for k in range(3):
            covered[k : k + len(windows)] |= twice
        in_repeats = int(covered.sum())
    return len(words), letters, symbols, repeated_lines, in_repeats


def add_measures(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    plain = docs.select(col(id_col).alias("_id"), col(host_col).alias("_host"), col(text_col).alias("_text"))
    schema = T.StructType([plain.schema["_id"], plain.schema["_host"], *[T.StructField(m, T.LongType()) for m in MEASURES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([measure(t.as_py()) for t in batch.column("_text")], dtype=np.int64).reshape(-1, len(MEASURES))
            columns = [pa.array(np.ascontiguousarray(v)) for v in values.T]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_host"), *columns], ["_id", "_host", *MEASURES])

    return plain.mapInArrow(run, schema)


def judge_hosts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    min_words: int = 50, most_repeated: int = 50, symbols_per_word: float = 0.1, most_failures: float = 0.5,
    salts: int = 32,
) -> DataFrame:
    """One row per row of ``docs``: id, measures, ``base_failed``, the host's
    shrunk rate of failures and ``kept``.

    A document fails if it is short, repetitive or full of symbols. The rate of
    failures of a host is shrunk towards the rate of all documents: a beta prior
    is fitted to the hosts by moments, so a host with few documents says little
    by itself. Documents of hosts with a shrunk rate above ``most_failures`` go,
    and so do those that are short or repetitive themselves.

    Null and empty texts have no words and fail. Documents with a null host
    share one host. Repeated rows count as documents; extra columns are ignored;
    an empty table gives no rows.

    Failures are summed before they are shuffled, and the verdicts are joined on
    (host, salt), so a host with a third of all documents is spread.
    """
    short = F.col("n_words") < min_words
    repeats = 100 * F.col("n_repeat_words") > most_repeated * F.col("n_words")
    symbols = F.col("n_symbols") > symbols_per_word * F.col("n_words")
    measured = add_measures(docs, id_col, text_col, host_col).withColumns(
        {"base_failed": short | repeats, "_failed": (short | repeats | symbols).cast("int")}
    )
    measured = stage(measured)
    hosts = measured.groupBy("_host").agg(F.count("*").alias("_n"), F.sum("_failed").alias("_f"))
    prior = hosts.agg(
        F.sum("_n").alias("_all"), (F.sum("_f") / F.sum("_n")).alias("_mean"), F.count("*").alias("_hosts"),
        F.sum(F.col("_f") / F.col("_n") * F.col("_f")).alias("_square"),
    )
    within = F.col("_mean") * (1 - F.col("_mean"))
    between = F.col("_square") / F.col("_all") - F.col("_mean") * F.col("_mean") - within * F.col("_hosts") / F.col("_all")
    strength = F.when((between > 0) & (within > 0), F.least(F.greatest(within / between - 1, F.lit(1.0)), F.lit(10000.0))).otherwise(10000.0)
    mean, weight = prior.select("_mean", strength).first() or (None, None)  # two numbers
    mean, weight = F.lit(mean).cast("double"), F.lit(weight).cast("double")
    rate = (F.col("_f") + mean * weight) / (F.col("_n") + weight)
    verdicts = hosts.select("_host", rate.alias("host_failures"))
    verdicts = verdicts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = measured.withColumn("_salt", F.pmod(F.xxhash64("_id", *MEASURES), F.lit(salts)).cast("int"))
    right = stage(verdicts.select(F.col("_host").alias("_vhost"), F.col("_salt").alias("_vsalt"), "host_failures"))
    same = F.col("_host").eqNullSafe(F.col("_vhost")) & (F.col("_salt") == F.col("_vsalt"))
    kept = ~F.col("base_failed") & (F.col("host_failures") <= most_failures)
    return salted.join(right, same, "left").select(
        F.col("_id").alias(id_col), *MEASURES, "base_failed", "host_failures", kept.alias("kept")
    )


def op7_quality_hosts(documents: DataFrame) -> DataFrame:
    """Contract of the query: doc_id, the measures, base_failed, kept."""
    return judge_hosts(documents.select("doc_id", "source", "text")).drop("host_failures")


OP7_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT row, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts
), windows AS (
  SELECT row, i, (w[i], w[i + 1], w[i + 2]) AS three
  FROM (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)
), twice AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, three) AS times FROM windows) WHERE times > 1
), repeats AS (
  SELECT row, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) offsets(k) GROUP BY row
), lines AS (
  SELECT row, count(*) - count(DISTINCT line) AS n
  FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row
), measured AS (
  SELECT t.doc_id, t.source, len(w.w)::BIGINT AS n_words,
         length(regexp_replace(t.text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM texts t JOIN words w USING (row) LEFT JOIN lines l USING (row) LEFT JOIN repeats r USING (row)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_symbols > 0.1 * n_words AS failed
  FROM measured
), hosts AS (
  SELECT source, count(*)::DOUBLE AS n, count(*) FILTER (WHERE failed)::DOUBLE AS f FROM judged GROUP BY source
), spread AS (
  SELECT sum(f) / sum(n) AS mean, sum(f / n * f) / sum(n) AS square, sum(n) AS total, count(*) AS hosts FROM hosts
), between_hosts AS (
  SELECT mean, mean * (1 - mean) AS within,
         square - mean * mean - mean * (1 - mean) * hosts / total AS between_them FROM spread
), prior AS (
  SELECT mean, CASE WHEN between_them > 0 AND within > 0
                    THEN least(greatest(within / between_them - 1, 1.0), 10000.0) ELSE 10000.0 END AS strength
  FROM between_hosts
), verdicts AS (
  SELECT source, (f + mean * strength) / (n + strength) AS rate FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rate <= 0.5 AS kept
FROM judged j JOIN verdicts v ON j.source IS NOT DISTINCT FROM v.source
"""
