"""Association results: loading shapes, merging, hits and λ quality control."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoloom.functions.genome import split_locus_alleles
from phenoloom.functions.normal import lambda_gc
from phenoloom.model import PHENO_GWAS, PHENO_KEY, MatrixFrame
from phenoloom.scale import level_code, level_histogram, lookup, nested_middles, one_per_key, sets_of

# Cutoffs and thresholds of the quality control.
AC_CUTOFFS = [0, 1, 2, 3, 4, 5, 10, 20, 50, 100]
AF_CUTOFFS = [0, 0.0001, 0.0002, 0.0005, 0.001, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.5, 0.99]
SIGNIFICANT = 5e-8
EXPORT_THRESHOLD = 1e-6

VARIANT = ["contig", "pos", "alleles"]


def with_metadata(df: DataFrame, metadata: DataFrame | dict, key: Sequence[str] = tuple(PHENO_KEY)) -> DataFrame:
    """Attach per-phenotype metadata; -1, -1.0 and 'NA' stand for missing.

    ``metadata`` is a table keyed by ``key`` or constants for a single phenotype.
    """
    missing = {"n_cases": -1, "n_controls": -1, "heritability": -1.0, "saige_version": "NA", "inv_normalized": "NA"}
    if isinstance(metadata, dict):
        df = df.withColumns({name: F.lit(value) for name, value in metadata.items()})
        names = list(metadata)
    else:
        df = lookup(df, metadata, key)
        names = [c for c in metadata.columns if c not in key]
    return df.withColumns({n: F.nullif(F.col(n), F.lit(missing[n])) for n in names if n in missing})


def load_variant_results(
    scan: DataFrame,
    key: dict[str, str] | None,
    metadata: DataFrame | dict,
    annotation: DataFrame,
    log_pvalue: bool = False,
) -> DataFrame:
    """Single-variant test output keyed by contig, pos, alleles and phenotype.

    The id column is ``markerID`` or ``SNPID``. ``key`` gives the phenotype key
    of a scan that holds one phenotype; without it the scan has key columns, so
    one job loads all phenotypes. ``annotation`` holds gene and annotation per
    variant.
    """
    id_column = "markerID" if "markerID" in scan.columns else "SNPID"
    if key:
        scan = scan.withColumns({k: F.lit(v) for k, v in key.items()})
    spent = ["p.value", "N", "Tstat"]
    if id_column == "SNPID":
        spent += ["CHR", "POS", "SNPID", "Allele1", "Allele2"]
    kept_fields = [scan[f"`{c}`"] for c in scan.columns if c not in spent]
    parts = F.split(scan[id_column], "_")
    locus = F.split(F.get(parts, F.lit(0)), ":")
    keyed = scan.select(
        F.get(locus, F.lit(0)).alias("contig"),
        F.get(locus, F.lit(1)).try_cast("int").alias("pos"),
        F.split(F.get(parts, F.lit(1)), "/").alias("alleles"),
        *kept_fields,
        scan["`p.value`"].alias("Pvalue"),
    )
    # One exchange by variant serves the deduplication and the annotation; the
    # metadata is attached after it.
    single = one_per_key(keyed.repartition(*VARIANT), [*VARIANT, *PHENO_KEY])
    described = with_metadata(single, metadata).withColumn("log_pvalue", F.lit(log_pvalue))
    return lookup(described, annotation, VARIANT, unique=True)


def load_gene_results(
    scan: DataFrame, key: dict[str, str] | None, metadata: DataFrame | dict, intervals: DataFrame
) -> DataFrame:
    """Gene test output keyed by gene, annotation and phenotype.

    Only ids of the form gene_symbol_annotation are kept. ``intervals`` is keyed
    by gene_id.
    """
    if key:
        scan = scan.withColumns({k: F.lit(v) for k, v in key.items()})
    parts = F.split("Gene", "_")
    counts = [F.coalesce(scan[f"`{c}`"].cast("int"), F.lit(0)) for c in scan.columns if "Nmarker" in c]
    total = reduce(Column.__add__, counts, F.lit(0))
    kept = (
        scan.filter(F.size(parts) == 3)
        .withColumns(
            {
                "gene_id": parts[0],
                "gene_symbol": parts[1],
                "annotation": parts[2],
                "total_variants": total,
            }
        )
        .drop("Gene")
    )
    return lookup(with_metadata(kept, metadata), intervals, ["gene_id"])


def _aligned(df: DataFrame, fields: dict[str, str], defaults: dict[str, Column] | None = None) -> DataFrame:
    """``fields`` (name to type) in order; absent ones become typed NULLs."""
    key = [c for c in (*VARIANT, "gene_id", "gene_symbol", *PHENO_KEY) if c in df.columns and c not in fields]
    columns = []
    for name, kind in fields.items():
        value = df[f"`{name}`"].try_cast(kind) if name in df.columns else F.lit(None).cast(kind)
        columns.append((defaults or {}).get(name, value).alias(name))
    return df.select(*key, *columns)


def unify_imputed(df: DataFrame, patch: DataFrame | None = None) -> DataFrame:
    """One schema for results on imputed variants.

    ``patch`` (phenotype key, n_cases, n_controls) fills in case counts that are
    missing or zero. Results that already carry an annotation are refused by
    ``already_annotated``.
    """
    text = {n: F.coalesce(F.col(n), F.lit("")) for n in ("gene", "annotation")}
    fields = {
        "AC_Allele2": "double", "AF_Allele2": "double", "imputationInfo": "double", "BETA": "double", "SE": "double",
        "p.value.NA": "double", "Is.SPA.converge": "int", "AF.Cases": "double", "AF.Controls": "double",
        "Pvalue": "double", "gene": "string", "annotation": "string",
        "n_cases": "int", "n_controls": "int", "heritability": "double", "saige_version": "string",
        "inv_normalized": "string", "log_pvalue": "boolean",
    }
    log_flag = F.coalesce(F.col("log_pvalue"), F.lit(False)) if "log_pvalue" in df.columns else F.lit(False)
    unified = _aligned(df, fields, {**text, "log_pvalue": log_flag})
    if patch is None:
        return unified
    found = patch.select(*PHENO_KEY, F.nullif("n_cases", F.lit(-1)).alias("_cases"),
                         F.nullif("n_controls", F.lit(-1)).alias("_controls"))
    patched = lookup(unified, found, PHENO_KEY)
    lacking = F.col("n_cases").isNull() | (F.col("n_cases") == 0)
    return patched.withColumns(
        {
            "n_controls": F.when(lacking, F.col("_controls")).otherwise(F.col("n_controls")).cast("int"),
            "n_cases": F.when(lacking, F.col("_cases")).otherwise(F.col("n_cases")).cast("int"),
        }
    ).drop("_cases", "_controls")


def already_annotated(df: DataFrame) -> DataFrame:
    """Phenotypes of imputed results that carry an annotation, where none is due."""
    return df.filter(F.col("annotation").isNotNull()).select(*PHENO_KEY).distinct()


def unify_exome(df: DataFrame) -> DataFrame:
    """One schema for exome variant results; both input shapes map onto it."""
    doubles = ("BETA", "SE", "Tstat", "varT", "varTstar", "AF.Cases", "AF.Controls")
    fields = {"markerID": "string", "AC": "int", "AF": "double", "N": "int"}
    fields |= {n: "double" for n in doubles}
    fields |= {"N.Cases": "int", "N.Controls": "int", "Pvalue": "double", "gene": "string", "annotation": "string"}
    if "N" not in df.columns:
        for name in ("N", "Tstat", "varT", "varTstar"):
            del fields[name]
    return _aligned(df, fields)


def unify_burden(df: DataFrame) -> DataFrame:
    """One schema for gene results; standard errors become numbers."""
    fields = {"annotation": "string", "Pvalue": "double"}
    fields |= {f"Nmarker_MACCate_{i}": "int" for i in range(1, 9)}
    fields |= {"markerIDs": "string", "markerAFs": "string"}
    names = ("Pvalue_Burden", "Pvalue_SKAT", "BETA_Burden", "SE_Burden", "Pvalue.NA", "Pvalue_Burden.NA",
             "Pvalue_SKAT.NA", "BETA_Burden.NA", "SE_Burden.NA")
    fields |= {n: "double" for n in names}
    unified = _aligned(df, fields | {"total_variants": "int"})
    rest = [c for c in ("interval", *PHENO_GWAS) if c in df.columns]
    if not rest:
        return unified
    key = [c for c in unified.columns if c not in fields and c != "total_variants"]
    ordered = _aligned(df, fields | {"total_variants": "int"} | {c: df.schema[c].dataType for c in rest})
    return ordered.select(*key, *[f"`{c}`" for c in fields], "total_variants", *rest)


def _wider(left: T.DataType, right: T.DataType) -> T.DataType:
    ranks = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.StringType]
    if left == right or isinstance(right, T.NullType):
        return left
    if isinstance(left, T.NullType):
        return right
    kinds = [next((i for i, r in enumerate(ranks) if isinstance(t, r)), None) for t in (left, right)]
    if None in kinds:
        raise ValueError(f"cannot unify {left} with {right}")
    return (left, right)[kinds.index(max(kinds))]


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Union of tables whose schemas differ by missing fields or by int against
    double; each field takes the widest type seen.

    The plan has a leaf for each table. Folders of results, however many, are
    best read by ``sources.catalogue.read_and_union``, with a leaf per schema.
    """
    types: dict[str, T.DataType] = {}
    for table in tables:
        for field in table.schema:
            types[field.name] = _wider(types.get(field.name, field.dataType), field.dataType)
    cast = [t.select(*[t[f"`{c}`"].cast(types[c]).alias(c) for c in t.columns]) for t in tables]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def _as_one(tables: DataFrame | Sequence[DataFrame]) -> DataFrame:
    return tables if isinstance(tables, DataFrame) else union_tables(tables)


def union_with_phenotypes(
    tables: DataFrame | Sequence[DataFrame], phenotypes: DataFrame, fields: Sequence[str], strict: bool = False
) -> DataFrame:
    """Union (or a union already made), then annotate each record from the
    phenotype table by ``fields``. ``strict`` fails at a record that the table lacks."""
    if not strict:
        return lookup(_as_one(tables), phenotypes, fields)
    marked = lookup(_as_one(tables), phenotypes.withColumn("_known", F.lit(True)), fields)
    lacking = F.raise_error(F.concat_ws(" ", F.lit("no phenotype for"), *[F.col(f).cast("string") for f in fields]))
    first = marked.columns[0]
    checked = F.when(F.col("_known").isNull(), lacking.cast(marked.schema[first].dataType)).otherwise(F.col(f"`{first}`"))
    return marked.withColumn(first, checked).drop("_known")


def unknown_phenotypes(results: DataFrame, phenotypes: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Phenotypes in the results that the phenotype table lacks."""
    return results.select(*fields).distinct().join(phenotypes, list(fields), "left_anti")


def results_matrix(
    tables: DataFrame | Sequence[DataFrame],
    row_key: Sequence[str] = tuple(VARIANT),
    col_key: Sequence[str] = tuple(PHENO_KEY),
    col_fields: Sequence[str] = (),
) -> MatrixFrame:
    """Variant x phenotype matrix of per-phenotype tables.

    In long form the phenotype key is a column already: the outer zip of the
    tables is their union, which may be given; cells a table lacks are absent.
    """
    long = _as_one(tables)
    cols = one_per_key(long.select(*col_key, *col_fields), list(col_key))
    entries = long.drop(*col_fields)
    return MatrixFrame(entries.select(*row_key).distinct(), cols, entries, list(row_key), list(col_key))


def top_hit(
    entries: DataFrame, row_key: Sequence[str], score: Column, rows: DataFrame | None = None
) -> DataFrame:
    """Per row the entry with the smallest score; missing scores never win.

    Ties go to the first entry by its values. With ``rows`` every row is kept,
    with NULLs where it has no scored entry.
    """
    fields = [c for c in entries.columns if c not in row_key]
    scored = entries.withColumn("_score", score.cast("double"))
    scored = scored.filter(F.col("_score").isNotNull() & ~F.isnan("_score"))
    best = scored.groupBy(*row_key).agg(F.min(F.struct("_score", *fields)).alias("_best"))
    best = best.select(*row_key, *[F.col("_best").getField(f).alias(f) for f in fields])
    return best if rows is None else rows.join(best, list(row_key), "left")


def significant(entries: DataFrame, threshold: float = EXPORT_THRESHOLD) -> DataFrame:
    """Confident entries at or below the threshold; a NULL in either test drops."""
    return entries.filter((F.col("pval") <= threshold) & ~F.col("low_confidence_variant"))


def significant_by_sex(tables: dict[str, DataFrame], threshold: float = EXPORT_THRESHOLD) -> DataFrame:
    """Significant entries of all sexes as one flat table for export."""
    kept = [significant(t, threshold).withColumn("sex", F.lit(sex)) for sex, t in tables.items()]
    flat = split_locus_alleles(union_tables(kept), drop_and_prefix=True)
    lead = ["chrom", "pos", "ref", "alt", "rsid", "sex", "AF", "consequence", "info"]
    return flat.select(*lead, *[c for c in flat.columns if c not in lead])


def top_by_sex(tables: dict[str, DataFrame], row_key: Sequence[str]) -> DataFrame:
    """Per variant and sex the confident entry with the largest |t|, where it
    has a p-value."""
    best = []
    for sex, table in tables.items():
        confident = table.filter(~F.col("low_confidence_variant"))
        best.append(top_hit(confident, row_key, -F.abs("tstat")).filter("pval IS NOT NULL").withColumn("sex", F.lit(sex)))
    return union_tables(best)


def top_summary(top: DataFrame, threshold: float = SIGNIFICANT) -> DataFrame:
    """Significant both-sex top hits, and the number of variants (rows / 3)."""
    return top.agg(
        F.count_if((F.col("pval") < threshold) & (F.col("sex") == "both_sexes")).alias("n_significant"),
        F.expr("count(*) div 3").alias("n_variants"),
    )


def hit_summary(hits: DataFrame, threshold: float = SIGNIFICANT) -> DataFrame:
    return hits.filter(F.col("pval") < threshold).agg(
        F.count("*").alias("total_associations"), F.count_distinct("phenotype").alias("unique_phenos")
    )


def hits_per_phenotype(hits: DataFrame, threshold: float = SIGNIFICANT) -> DataFrame:
    """Hits of each phenotype, most first."""
    counts = hits.filter(F.col("pval") < threshold).groupBy("phenotype").agg(F.count("*").alias("n_sig"))
    return counts.orderBy(F.desc("n_sig"), "phenotype")


def lambda_by_cutoffs(
    entries: DataFrame, pheno_key: Sequence[str], pvalue: str, measures: dict[str, Sequence[float]], threshold: float = SIGNIFICANT
) -> DataFrame:
    """λ, number of variants and of significant ones among the entries that reach
    each cutoff of each of the ``measures``; one record per phenotype, ``measure``
    and ``cutoff``.

    Counts include entries without a p-value; λ does not. Two passes over the
    entries for all measures: one joint histogram of their levels gives the
    counts and the bins of the middles, the second ranks the values of those
    bins.
    """
    bounds = {name: [float(c) for c in sorted(cutoffs)] for name, cutoffs in measures.items()}
    sizes = [len(b) for b in bounds.values()]
    levels = []
    for name, cutoffs in bounds.items():
        x = F.col(name)
        # Spark orders NaN above all numbers; a NaN measure reaches no cutoff.
        levels.append(reduce(Column.__add__, [F.when((x >= c) & ~F.isnan(x), 1).otherwise(0) for c in cutoffs]) - 1)
    narrow = entries.select(*pheno_key, F.col(pvalue).alias("_p"), level_code(levels, sizes).alias("_code"))
    hit = (F.col("_p") < threshold) & ~F.isnan("_p")
    histogram = level_histogram(narrow, pheno_key, "_p", F.col("_code"), F.count_if(hit).alias("_s"))
    # Small records, spread over the cutoffs only here; every cutoff has a record.
    names = [(name, c) for name, cutoffs in bounds.items() for c in cutoffs]
    cutoff = F.posexplode(F.array(*[F.struct(F.lit(n).alias("measure"), F.lit(c).alias("cutoff")) for n, c in names])).alias("j", "_at")
    within = F.array_contains(sets_of(F.col("_level"), sizes), F.col("j"))
    counts = (
        histogram.groupBy("_group", "_level")
        .agg(F.sum("_c").alias("_n"), F.sum("_s").alias("_s"))
        .select("_group", "_level", "_n", "_s", cutoff)
        .groupBy("_group", "j", "_at")
        .agg(
            F.sum(F.when(within, F.col("_n")).otherwise(0)).alias("n_variants"),
            F.sum(F.when(within, F.col("_s")).otherwise(0)).alias("n_sig"),
        )
        .select(*[F.col("_group").getField(k).alias(k) for k in pheno_key], "j", "_at.measure", "_at.cutoff", "n_variants", "n_sig")
    )
    middles = nested_middles(narrow, pheno_key, "_p", F.col("_code"), sizes, histogram).select(
        *pheno_key, "j", lambda_gc(F.col("lower"), F.col("upper")).alias("lambda_gc")
    )
    # In a struct, missing keys are equal to each other.
    group = F.struct(*pheno_key)
    middles = middles.select(group.alias("_g"), "j", "lambda_gc")
    return counts.withColumn("_g", group).join(middles, ["_g", "j"], "left").select(
        *pheno_key, "measure", "cutoff", "lambda_gc", "n_variants", "n_sig"
    )


def lambda_by_cutoff(
    entries: DataFrame,
    pheno_key: Sequence[str],
    pvalue: str,
    measure: str,
    cutoffs: Sequence[float],
    threshold: float = SIGNIFICANT,
) -> DataFrame:
    """:func:`lambda_by_cutoffs` of one measure."""
    return lambda_by_cutoffs(entries, pheno_key, pvalue, {measure: cutoffs}, threshold).drop("measure")


FREQUENCIES = {"ac": ("ac_cases", AC_CUTOFFS, "by_case_ac"), "af": ("af_total", AF_CUTOFFS, "by_af")}


def lambda_by_frequencies(
    entries: DataFrame, pheno_cols: DataFrame, by: Sequence[str] = ("ac", "af"), pheno_key: Sequence[str] = tuple(PHENO_KEY)
) -> DataFrame:
    """λ by expected case allele count (``ac``) and overall frequency (``af``),
    all in the same two passes.

    ``log_pvalue`` on the phenotypes (default false) says that p-values are
    stored as logarithms. One record per phenotype, ``measure`` and ``cutoff``.
    """
    key = list(pheno_key)
    fields = [c for c in ("n_cases", "log_pvalue") if c in pheno_cols.columns and c not in entries.columns]
    joined = lookup(entries, pheno_cols.select(*key, *fields), key) if fields else entries
    logged = F.coalesce(F.col("log_pvalue"), F.lit(False)) if "log_pvalue" in joined.columns else F.lit(False)
    values = {"ac_cases": F.col("`AF.Cases`") * F.col("n_cases") * 2, "af_total": F.col("AF_Allele2")}
    used = [FREQUENCIES[b] for b in by]
    prepared = joined.select(
        *key, F.when(logged, F.exp("Pvalue")).otherwise(F.col("Pvalue")).alias("p"), *[values[m].alias(m) for m, _, _ in used]
    )
    table = lambda_by_cutoffs(prepared, key, "p", {m: cutoffs for m, cutoffs, _ in used})
    named = reduce(lambda e, b: F.when(F.col("measure") == FREQUENCIES[b][0], b).otherwise(e), by, F.lit(None).cast("string"))
    return table.withColumn("measure", named)


def lambda_by_frequency(
    entries: DataFrame, pheno_cols: DataFrame, by: str = "ac", pheno_key: Sequence[str] = tuple(PHENO_KEY)
) -> DataFrame:
    """:func:`lambda_by_frequencies` of ``ac`` or ``af`` alone, with their own column names."""
    table = lambda_by_frequencies(entries, pheno_cols, [by], pheno_key)
    suffix = FREQUENCIES[by][2]
    return table.select(
        *pheno_key,
        F.col("cutoff").alias(by),
        *[F.col(m).alias(f"{m}_{suffix}") for m in ("lambda_gc", "n_variants", "n_sig")],
    )


def pack_by_cutoff(table: DataFrame, key: Sequence[str], by: str) -> DataFrame:
    """One record per phenotype with arrays over the cutoffs."""
    metrics = [c for c in table.columns if c not in (*key, by)]
    packed = table.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(by, *metrics))).alias("_qc"))
    return packed.select(*key, F.col(f"_qc.{by}").alias(f"{by}_cutoffs"), *[F.col(f"_qc.{m}").alias(m) for m in metrics])


def explode_by_cutoff(table: DataFrame, key: Sequence[str], by: str) -> DataFrame:
    """Arrays over the cutoffs to one record per phenotype and cutoff."""
    metrics = [c for c in table.columns if c not in (*key, f"{by}_cutoffs")]
    zipped = F.arrays_zip(F.col(f"{by}_cutoffs").alias(by), *metrics)
    return table.select(*key, F.inline(zipped))
