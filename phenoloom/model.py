"""The long-form matrix: row table, column table and one record per cell."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Field names of the phenotype data model.
PHENO_KEY = ["trait_type", "phenocode", "pheno_sex", "coding", "modifier"]
PHENO_DESCRIPTION = ["description", "description_more", "coding_description", "category"]
PHENO_GWAS = ["n_cases", "n_controls", "heritability", "saige_version", "inv_normalized"]
SEXES = ["both_sexes", "females", "males"]


@dataclass(frozen=True)
class MatrixFrame:
    """``rows`` x ``cols`` with ``entries`` in long form.

    An absent entry is a cell that does not exist; an entry holding NULL is a
    cell whose value is missing. Both states are kept apart. A column may give
    absent cells a value, see ``operators.defaults``.
    """

    rows: DataFrame
    cols: DataFrame
    entries: DataFrame
    row_key: Sequence[str]
    col_key: Sequence[str]

    def with_(self, **parts) -> "MatrixFrame":
        return replace(self, **parts)

    @property
    def entry_fields(self) -> list[str]:
        keys = {*self.row_key, *self.col_key}
        return [c for c in self.entries.columns if c not in keys]

    def filter_cols(self, condition: Column | str) -> "MatrixFrame":
        """Keep matching columns, and only their entries."""
        cols = self.cols.filter(condition)
        entries = self.entries.join(cols.select(*self.col_key), list(self.col_key), "left_semi")
        return self.with_(cols=cols, entries=entries)

    def filter_rows(self, condition: Column | str) -> "MatrixFrame":
        """Keep matching rows, and only their entries."""
        rows = self.rows.filter(condition)
        entries = self.entries.join(rows.select(*self.row_key), list(self.row_key), "left_semi")
        return self.with_(rows=rows, entries=entries)


def pheno_key(trait_type, phenocode, pheno_sex="both_sexes", coding="", modifier="") -> list[Column]:
    """The five key columns; plain strings become literals, NULL becomes ``''``."""
    parts = dict(zip(PHENO_KEY, (trait_type, phenocode, pheno_sex, coding, modifier)))
    return [
        F.coalesce(value if isinstance(value, Column) else F.lit(value), F.lit("")).alias(name)
        for name, value in parts.items()
    ]
