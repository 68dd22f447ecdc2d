"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phenoloom.session import stage

#: The white space of the contracts, `[\x20\x09-\x0D]`.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(base: str, df: DataFrame) -> str:
    """``base``, lengthened until no column of ``df`` has the name in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case, all else untouched; texts of ASCII take the short way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def held_out(id_col: Column) -> Column:
    """Fold of a row: crc32 of the id as text, modulo 5, is 0. A null id counts
    as empty text, so it is held out."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def worker_memo(name: str, make: Callable[[], object]):
    """An object made once per Python worker and kept between its tasks.

    A worker serves the stages of several operators one after another; it keeps
    the object asked for last and lets the one before go, so its memory is that of
    one operator.
    """
    holder = sys.modules.setdefault("_phenoloom_worker", types.ModuleType("_phenoloom_worker"))
    if getattr(holder, "name", None) != name:
        holder.name = holder.value = None
        holder.value, holder.name = make(), name
    return holder.value


def sample_per_class(
    ids: DataFrame, classes: Sequence[str], id_col: str, per_class: int, salts: int = 16
) -> DataFrame:
    """At most ``per_class`` rows of ``ids`` per class, in order of a hash of the id.

    Only ids and classes are ranked: first within salted parts of a class, then
    what is left of them, at most ``salts * per_class`` rows of a class. So a hot
    class does not gather.
    """
    hashed = F.xxhash64(col(id_col))
    named = [col(c) for c in classes]
    for part in ([F.pmod(hashed, F.lit(salts))], []):
        order = Window.partitionBy(*named, *part).orderBy(hashed, col(id_col))
        ids = ids.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= per_class).drop("_rank")
    return ids


def fetch_sample(docs: DataFrame, ids: DataFrame, id_col: str, most: int) -> DataFrame:
    """The rows of ``docs`` named by the bounded sample ``ids``.

    The ids are broadcast after their number is checked to be within ``most``.
    """
    ids = stage(ids)
    n = ids.count()
    return docs.join(F.broadcast(ids) if n <= most else ids, id_col)
