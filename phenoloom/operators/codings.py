"""Data codings: lookups of code meanings, reassignments and hierarchies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenoloom.scale import lookup, one_per_key
from phenoloom.session import stage


def reassignments(summary: DataFrame) -> DataFrame:
    """(pheno, coding, reassign_from, reassign_to) from a summary table.

    The second word of ``PHESANT.reassignments`` lists ``from=to`` items; items
    set to NA and those not about the field's own coding are left out.
    """
    items = F.split(F.get(F.split(F.col("`PHESANT.reassignments`"), " "), F.lit(1)), r"\|")
    field = F.split("FieldID", "_")
    parsed = (
        summary.select("FieldID", F.explode(items).alias("item"))
        .select(
            F.get(field, F.lit(0)).alias("pheno"),
            F.get(field, F.lit(1)).alias("coding"),
            F.get(F.split("item", "="), F.lit(0)).alias("reassign_from"),
            F.get(F.split("item", "="), F.lit(1)).alias("reassign_to"),
        )
    )
    return parsed.filter((F.col("reassign_to") != "NA") & (F.col("reassign_to") == F.col("coding")))


def add_meanings(cols: DataFrame, codings: DataFrame, summary: DataFrame) -> DataFrame:
    """Column table with the fields of ``codings`` (keyed coding_id, coding).

    A code without a meaning is looked up again under the code it was
    reassigned from.
    """
    keyed = one_per_key(codings.withColumn("coding", F.col("coding").cast("string")), ["coding_id", "coding"])
    fields = [c for c in keyed.columns if c not in ("coding_id", "coding")]
    direct = lookup(cols, keyed, ["coding_id", "coding"], unique=True)
    moved = reassignments(summary).select(F.col("pheno").alias("phenocode"), "coding", "reassign_from")
    recoded = lookup(direct, moved, ["phenocode", "coding"]).withColumn(
        "recoding", F.when(F.col("meaning").isNull(), F.col("reassign_from"))
    )
    second = keyed.select(
        "coding_id", F.col("coding").alias("recoding"), *[F.col(f).alias(f"_{f}") for f in fields]
    )
    found = F.col("meaning").isNotNull()
    return lookup(recoded.drop("reassign_from"), second, ["coding_id", "recoding"], unique=True).select(
        *cols.columns,
        "recoding",
        *[F.when(found, F.col(f)).otherwise(F.col(f"_{f}")).alias(f) for f in fields],
    )


def missing_codings(cols: DataFrame) -> DataFrame:
    """Coding ids that still lack a meaning somewhere."""
    return cols.filter("meaning IS NULL AND coding_id IS NOT NULL").select("coding_id").distinct()


def full_meanings(codings: DataFrame, separator: str = " | ") -> DataFrame:
    """Code hierarchy with every meaning prefixed by its ancestors' meanings.

    A node's pointer jumps to its ancestor's own pointer each round, so depth d
    takes log2(d) joins. A chain that ends at a missing parent, or at one outside
    the table, gives NULL meanings. A chain is no longer than the table, so nodes
    still unresolved after as many doublings as that takes form a cycle.
    """
    state = codings.select(
        "*",
        F.col("meaning").alias("short_meaning"),
        F.col("parent_id").alias("_up"),
        F.col("meaning").alias("_path"),
    )
    state = stage(state)
    for _ in range(state.count().bit_length() + 2):
        waiting = state.filter("_up != 0")
        if waiting.isEmpty():
            # Settled once, here: a chain counts only if it reached a root.
            return state.withColumn("meaning", F.when(F.col("_up") == 0, F.col("_path"))).drop("_up", "_path")
        target = one_per_key(
            state.select(F.col("node_id").alias("_up"), F.col("_path").alias("_prefix"), F.col("_up").alias("_next")),
            ["_up"],
        )
        climbed = (
            waiting.join(target, "_up", "left")
            .withColumns({"_path": F.concat("_prefix", F.lit(separator), "_path"), "_up": F.col("_next")})
            .select(state.columns)
        )
        settled = state.filter("_up = 0 OR _up IS NULL")
        state = stage(settled.unionByName(climbed))
    raise ValueError("code hierarchy has a cycle")
