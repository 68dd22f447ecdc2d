"""Facts from tool logs, for all phenotypes' logs in one job.

The line tables have ``file`` and ``value`` plus ``block`` and ``line``, which
order the lines of a file. A file may span many blocks, read by different tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phenoloom.operators.logscan import Marker, lines_below

# Wording of the log lines.
USED_SAMPLES = [
    "samples were used in fitting the NULL glmm model and are found in sample file",
    "samples have been used to fit the glmm null model",
]
ANALYZING = "Analyzing"
FINAL = "Final"
PACKAGES = "other attached packages:"
PACKAGE_NAME = "SAIGE"
NORMALIZE = "$invNormalize"
TIMING = "Analysis took"
MODEL_TIMING = "t_end - t_begin"

ORDER = ["block", "line"]


def words(line: Column) -> Column:
    """Whitespace-separated words, none for a blank line."""
    return F.filter(F.split(line, r"\s+"), lambda w: w != "")


def word(line: Column, i: int) -> Column:
    return F.get(words(line), F.lit(i))


def with_next_lines(lines: DataFrame, n: int = 1, where: Column | None = None) -> DataFrame:
    """The lines matching ``where``, with the following ones as ``next1..nextn``.

    ``line`` counts without gaps within a block. The following lines are fetched
    by their place, which exchanges all lines; :func:`facts_from_logs` does not.
    """
    blocks = Window.partitionBy("file").orderBy("block")
    extent = (
        lines.groupBy("file", "block")
        .agg(F.min("line").alias("_first"), F.max("line").alias("_last"))
        .select(
            "file",
            F.col("block").alias("_b"),
            "_last",
            F.lead("block").over(blocks).alias("_next_block"),
            F.lead("_first").over(blocks).alias("_next_first"),
        )
    )
    marked = lines if where is None else lines.filter(where)
    current = marked.withColumns({"_b": F.col("block"), "_l": F.col("line")})
    for i in range(1, n + 1):
        inside = F.col("_l") < F.col("_last")
        step = {
            "_b": F.when(inside, F.col("_b")).otherwise(F.col("_next_block")),
            "_l": F.when(inside, F.col("_l") + 1).otherwise(F.col("_next_first")),
        }
        moved = current.join(extent, ["file", "_b"], "left").withColumns(step).drop("_last", "_next_block", "_next_first")
        fetched = lines.select(
            "file", F.col("block").alias("_b"), F.col("line").alias("_l"), F.col("value").alias(f"next{i}")
        )
        current = moved.join(fetched, ["file", "_b", "_l"], "left")
    return current.select(*lines.columns, *[f"next{i}" for i in range(1, n + 1)])


def _position() -> Column:
    return F.struct(*ORDER)


def case_counts_from_logs(lines: DataFrame, key: list[str], chrom: str = "chrom") -> DataFrame:
    """Cases and controls per phenotype from its first chromosome log of 10..22.

    The first line ``Analyzing <n> ... <m> ...`` of six words with two whole
    numbers decides; without one the last count of samples used, or of a
    half-readable line, gives the cases. -1 where nothing is found.
    """
    scanned = lines.filter(F.col(chrom).between(10, 22))
    text = F.trim("value")
    six = text.startswith(ANALYZING) & (F.size(words(text)) == 6)
    used = ~text.startswith(ANALYZING) & (text.endswith(USED_SAMPLES[0]) | text.endswith(USED_SAMPLES[1]))
    cases = F.when(six, word(text, 1)).when(used, word(text, 0)).try_cast("int")
    controls = F.when(six, word(text, 4)).try_cast("int")
    parsed = scanned.select(
        *key,
        chrom,
        _position().alias("at"),
        cases.alias("cases"),
        controls.alias("controls"),
    )
    per_file = parsed.groupBy(*key, chrom).agg(
        F.min(
            F.when(F.col("cases").isNotNull() & F.col("controls").isNotNull(), F.struct("at", "cases", "controls"))
        ).alias("both"),
        F.max(F.when(F.col("cases").isNotNull(), F.struct("at", "cases"))).alias("last"),
    )
    first = per_file.groupBy(*key).agg(F.min_by(F.struct("both", "last"), chrom).alias("_f"))
    return first.select(
        *key,
        F.coalesce("_f.both.cases", "_f.last.cases", F.lit(-1)).alias("n_cases"),
        F.coalesce("_f.both.controls", F.lit(-1)).alias("n_controls"),
    )


VERSION, NORMALIZED, MODEL_TIME, HERITABILITY = range(4)
MARKERS = [Marker(PACKAGES, 1), Marker(NORMALIZE, 1), Marker(MODEL_TIMING, 2), Marker(FINAL, 0)]


def facts_from_logs(lines: DataFrame, wanted: Sequence[int] | None = None) -> DataFrame:
    """All facts of the model logs by one pass over their lines, a row per file.

    ``saige_version``, ``inv_normalized``, ``cpu`` and ``wall`` come from the last
    marker line with a readable line below it, the heritabilities from the first
    readable ``Final`` line of four words: t2 / (t1 + t2) for a quantitative
    trait, t2 / (t2 + pi^2 / 3) for a binary one. Facts not found are 'NA',
    'Unknown' or -1. Lines are as :func:`logscan.lines_below` wants them.

    ``wanted`` names the facts to look for (``VERSION`` and so on; all by
    default); lines of others stay in the scan and their columns are left out.
    """
    wanted = list(range(len(MARKERS))) if wanted is None else list(wanted)
    found, files = lines_below(lines, [MARKERS[fact] for fact in wanted])
    text = F.col("text")
    parts = words(text)
    named = F.get(F.filter(parts, lambda w: F.contains(w, F.lit(PACKAGE_NAME))), F.lit(0))
    times = F.when(F.size(parts) == 3, F.struct(parts[0].alias("cpu"), parts[2].alias("wall")))
    t1, t2 = (F.when(F.size(parts) == 4, word(text, i)).try_cast("double") for i in (1, 2))

    def share(total: Column) -> Column:
        return F.when(total != 0, t2 / total)

    def pick(fact: int, value: Column, choose) -> Column:
        at = F.when((F.col("fact") == wanted.index(fact)) & value.isNotNull(), F.struct("at", value.alias("value")))
        return choose(at).getField("value")

    columns = {
        VERSION: {"saige_version": (named, F.max)},
        NORMALIZED: {"inv_normalized": (F.initcap(word(text, 1)), F.max)},
        MODEL_TIME: {"_times": (times, F.max)},
        HERITABILITY: {
            "heritability_binary": (share(t2 + F.lit(math.pi**2 / 3)), F.min),
            "heritability_quantitative": (share(t1 + t2), F.min),
        },
    }
    picks = [pick(fact, *how).alias(name) for fact in wanted for name, how in columns[fact].items()]
    default = {
        VERSION: {"saige_version": F.lit("NA")}, NORMALIZED: {"inv_normalized": F.lit("Unknown")},
        MODEL_TIME: {"cpu": F.lit("NA"), "wall": F.lit("NA")},
        HERITABILITY: {"heritability_binary": F.lit(-1.0), "heritability_quantitative": F.lit(-1.0)},
    }
    # Files without any line found are there too, so all are grouped by file once.
    nothing = [F.lit(None).cast(found.schema[n].dataType).alias(n) for n in ("at", "fact", "text")]
    facts = found.unionByName(files.select("file", *nothing)).groupBy("file").agg(*picks)
    if MODEL_TIME in wanted:
        facts = facts.select("*", "_times.cpu", "_times.wall")
    return facts.select("file", *[F.coalesce(n, d).alias(n) for fact in sorted(wanted) for n, d in default[fact].items()])


def heritability_from_logs(lines: DataFrame, quantitative: Column | None = None) -> DataFrame:
    """Heritability per file from its first readable ``Final`` line of four words.

    t2 / (t1 + t2) for quantitative traits, t2 / (t2 + pi^2 / 3) for binary ones;
    -1 if there is none. ``quantitative`` is evaluated on the line table.
    """
    quantitative = F.lit(False) if quantitative is None else quantitative
    final = F.col("value").startswith(FINAL) & (F.size(words(F.col("value"))) == 4)
    t1, t2 = (word(F.col("value"), i).try_cast("double") for i in (1, 2))
    total = F.when(quantitative, t1 + t2).otherwise(t2 + F.lit(math.pi**2 / 3))
    share = F.when(final & (total != 0), t2 / total)
    parsed = lines.select("file", _position().alias("at"), share.alias("share"))
    best = parsed.groupBy("file").agg(
        F.min(F.when(F.col("share").isNotNull(), F.struct("at", "share"))).alias("_b")
    )
    return best.select("file", F.coalesce("_b.share", F.lit(-1.0)).alias("heritability"))


def version_from_logs(lines: DataFrame) -> DataFrame:
    """Tool version per file: the first matching package on the line below the
    package header; 'NA' if none."""
    return facts_from_logs(lines, [VERSION])


def normalization_from_logs(lines: DataFrame) -> DataFrame:
    """Inverse-normal flag per file, capitalised; 'Unknown' if none."""
    return facts_from_logs(lines, [NORMALIZED])


def model_timing_from_logs(lines: DataFrame) -> DataFrame:
    """CPU and wall time per file, two lines below the timing marker; 'NA' if none."""
    return facts_from_logs(lines, [MODEL_TIME])


def timing_from_logs(lines: DataFrame) -> DataFrame:
    """Run time per file from its first timing line; chromosome and position come
    from the file name ``..._<chrom>_<pos>.<x>.<y>``. Unreadable times are left out."""
    hits = lines.filter(F.col("value").contains(TIMING)).groupBy("file").agg(
        F.min(F.struct(*ORDER, "value")).alias("_first")
    )
    stem = F.regexp_replace("file", r"(\.[^.]*){1,2}$", "")
    place = F.regexp_extract(stem, r"_([^_]*)_([^_]*)$", 1), F.regexp_extract(stem, r"_([^_]*)_([^_]*)$", 2)
    return hits.select(
        F.concat(place[0], F.lit(":"), place[1]).alias("locus"),
        word(F.col("_first.value"), 2).try_cast("double").alias("seconds"),
    ).filter("seconds IS NOT NULL")


def problem_lines(lines: DataFrame) -> DataFrame:
    """Lines that mention an error or a warning."""
    lower = F.lower("value")
    return lines.filter(lower.contains("error") | lower.contains("warning"))


def count_problem_files(lines: DataFrame) -> DataFrame:
    return problem_lines(lines).agg(F.count_distinct("file").alias("n_files"))
