"""Scans with declared schemas; nothing is inferred from the data."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenoloom.session import stage


def _schema(**fields: str) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in fields.items())


DICTIONARY = _schema(FieldID="string", Field="string", Notes="string", Path="string", ValueType="string", Coding="int")


def _by_header(spark: SparkSession, path: str | Sequence[str], sep: str, **options) -> DataFrame:
    """All columns of a delimited text table as strings, named by its header.

    Files of one scan must share the header; another one is an error.
    """
    return spark.read.options(header=True, sep=sep, inferSchema=False, enforceSchema=False, **options).csv(path)


@contextmanager
def _one_split_per_task(spark: SparkSession) -> Iterator[None]:
    """Scans planned and run inside have a task for every file, or for every split of a large one."""
    conf = {"spark.sql.files.openCostInBytes": str(1 << 40)}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def first_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, header): the first line of every file of a text scan, staged.

    The files are listed by the scan. Of the splits, each read by its own task, only
    the first line of a file's first one leaves the scan: handing lines to a function
    that takes one and ends had whole files sent to it. Empty files have no line.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("header"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"),
    )
    # The lower 33 bits number the lines of a task.
    first = lines.filter((F.col("_block") == 0) & (F.col("_line").bitwiseAND((1 << 33) - 1) == 0))
    with _one_split_per_task(spark):
        return stage(first.select("file", "header"))


def files_by_header(spark: SparkSession, path: str | Sequence[str]) -> dict[str, list[str]]:
    """The files of a text scan by their first line; a string per file reaches the driver."""
    found: dict[str, list[str]] = {}
    for row in first_lines(spark, path).orderBy("file").toLocalIterator():
        found.setdefault(row["header"], []).append(unquote(row["file"]))
    return found


def _typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.select(
        *[df[f"`{c}`"].try_cast(types[c]).alias(c) if c in types else df[f"`{c}`"] for c in df.columns]
    )


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Data dictionary, TSV or (by extension) quoted CSV; '' is missing."""
    csv = path.endswith(".csv")
    raw = _by_header(spark, path, "," if csv else "\t", nullValue="", quote='"', escape='"', multiLine=csv)
    return _typed(raw, {"Coding": "int"})


def convert_dictionary(spark: SparkSession, source: str, target: str) -> None:
    """Quoted CSV dictionary to plain TSV; tabs and line breaks become spaces."""
    raw = _by_header(spark, source, ",", quote='"', escape='"', multiLine=True)
    flat = raw.select(*[F.regexp_replace(raw[f"`{c}`"], r"[\t\r\n]+", " ").alias(c) for c in raw.columns])
    flat.write.options(header=True, sep="\t", quote="", emptyValue="", nullValue="").mode("overwrite").csv(target)


def read_codings(spark: SparkSession, directory: str) -> DataFrame:
    """All ``coding<N>.tsv`` files (or folders of parts) of a folder, keyed
    (coding_id, coding).

    Files of each header are one scan; a header may be quoted and in any order.
    """
    tables = []
    for header, files in files_by_header(spark, f"{directory}/coding*.tsv").items():
        names = [n.strip('"') for n in header.split("\t")]
        if not {"coding", "meaning"} <= set(names):
            raise ValueError(f"no columns coding and meaning in {files[0]}")
        table = (
            spark.read.schema(_schema(**dict.fromkeys(names, "string")))
            .options(header=True, sep="\t", quote='"' if '"' in header else "", nullValue="NA")
            .csv(files)
            .withColumn("coding_id", F.regexp_extract("_metadata.file_path", r".*coding(\d+)\.tsv", 1).cast("int"))
        )
        tables.append(table)
    union = tables[0]
    for table in tables[1:]:
        union = union.unionByName(table, allowMissingColumns=True)
    for name in ("node_id", "parent_id", "selectable"):
        if name not in union.columns:
            union = union.withColumn(name, F.lit(None).cast("string"))
    return union.select("coding_id", "coding", "meaning", "node_id", "parent_id", "selectable")


def read_icd_codings(spark: SparkSession, path: str) -> DataFrame:
    schema = _schema(coding="string", meaning="string", node_id="int", parent_id="int", selectable="string")
    raw = _by_header(spark, path, "\t", quote="", nullValue="NA")
    return _typed(raw, {"node_id": "int", "parent_id": "int"}).select(*[f.split("`")[1] for f in schema.split(", ")])


def read_wide(
    spark: SparkSession, path: str, types: dict[str, str] | None = None, sep: str = "\t", quote: str = ""
) -> DataFrame:
    """Wide per-person text table: all strings, cast only where asked; '' is missing."""
    raw = _by_header(spark, path, sep, quote=quote, nullValue="")
    return _typed(raw, types or {})


def read_prescriptions(spark: SparkSession, path: str) -> DataFrame:
    schema = _schema(eid="int", data_provider="int", drug_name="string", issue_date="string")
    return spark.read.schema(schema).options(header=True, sep="\t", quote="", nullValue="NA").csv(path)


def read_prescription_map(spark: SparkSession, path: str) -> DataFrame:
    """Drug to generic name and category; empty cells stay empty strings."""
    schema = _schema(Original_Prescription="string", Generic_Name="string", Drug_Category_and_Indication="string")
    raw = spark.read.schema(schema).options(header=True, sep="\t", quote="", nullValue="NA").csv(path)
    return raw.fillna("", ["Generic_Name", "Drug_Category_and_Indication"])


COVID_TESTS = _schema(eid="int", origin="int", result="int", reqorg="int")
HES_MAIN = _schema(eid="int", ins_index="int", epistart="string", admidate="string")
HES_DIAG = _schema(eid="int", ins_index="int", diag_icd10="string")
DEATHS = _schema(eid="int", date_of_death="string")


def read_register(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A tab-separated register extract, '' missing, by header name."""
    kinds = {f.split("`")[1]: f.rsplit(" ", 1)[1] for f in schema.split(", ")}
    return _typed(_by_header(spark, path, "\t", quote="", nullValue=""), kinds).select(*kinds)


MFI = _schema(varid="string", rsid="string", pos="int", ref="string", alt="string", maf="double",
              minor_allele="string", info="double")


def read_variant_info(spark: SparkSession, paths: str | Sequence[str], pattern: str = r".*chr(XY|X|Y|MT|\d+)") -> DataFrame:
    """Headerless per-chromosome variant statistics, keyed by contig, pos, alleles.

    The chromosome is in the file path; the pseudo-autosomal XY counts as X.
    """
    raw = spark.read.schema(MFI).options(sep="\t", nullValue="NA", quote="").csv(paths)
    chromosome = F.regexp_extract("_metadata.file_path", pattern, 1)
    return raw.select(
        F.when(chromosome == "XY", "X").otherwise(chromosome).alias("contig"),
        "pos",
        F.array("ref", "alt").alias("alleles"),
        "varid", "rsid", "ref", "alt", "maf", "minor_allele", "info",
        chromosome.alias("original_chromosome"),
    )


VARIANT_RESULT_TYPES = {
    **dict.fromkeys(("AC", "N", "POS", "Is.SPA.converge", "N.Cases", "N.Controls"), "int"),
    **dict.fromkeys(
        ("AF", "BETA", "SE", "Tstat", "varT", "varTstar", "p.value", "p.value.NA", "AF.Cases", "AF.Controls",
         "AC_Allele2", "AF_Allele2", "imputationInfo"),
        "double",
    ),
}
GENE_RESULT_TYPES = {
    **{f"Nmarker_MACCate_{i}": "int" for i in range(1, 9)},
    **dict.fromkeys(
        ("Pvalue", "Pvalue_Burden", "Pvalue_SKAT", "Pvalue_skato_NA", "Pvalue_burden_NA", "Pvalue_skat_NA",
         "Pvalue.NA", "Pvalue_Burden.NA", "Pvalue_SKAT.NA", "BETA_Burden", "BETA_Burden.NA"),
        "double",
    ),
}


def _result_scans(
    spark: SparkSession, groups: Sequence[Sequence[str]], types: dict[str, str], path_col: str | None
) -> list[DataFrame]:
    """A scan for each group of paths, whose files share a header."""
    scans = []
    for group in groups:
        raw = _by_header(spark, list(group), " ", nullValue="NA", quote="")
        if path_col:
            raw = raw.select("*", F.col("_metadata.file_path").alias(path_col))
        scans.append(_typed(raw, types))
    return scans


def result_scans(spark: SparkSession, groups: Sequence[Sequence[str]], gene: bool = False, path_col: str | None = None) -> list[DataFrame]:
    """Typed scans of variant or gene results, one per group of files with a common header."""
    return _result_scans(spark, groups, GENE_RESULT_TYPES if gene else VARIANT_RESULT_TYPES, path_col)


def _read_results(
    spark: SparkSession, directories: str | Sequence[str], extension: str, types: dict[str, str],
    mixed_headers: bool, path_col: str | None,
) -> DataFrame:
    folders = [directories] if isinstance(directories, str) else list(directories)
    paths = [f"{folder}/*.{extension}" for folder in folders]
    groups = list(files_by_header(spark, paths).values()) if mixed_headers else [paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), _result_scans(spark, groups, types, path_col))


def read_variant_results(
    spark: SparkSession, directories: str | Sequence[str], extension: str = "single.txt",
    mixed_headers: bool = False, path_col: str | None = None,
) -> DataFrame:
    """Space-separated single-variant results of one or many directories; NA is missing.

    The files share one header, and another one is an error. With
    ``mixed_headers`` their first lines are read first and a scan is made for
    each header; columns that a file lacks are NULL. ``path_col`` names a
    column for the file, from which keys can be taken.
    """
    return _read_results(spark, directories, extension, VARIANT_RESULT_TYPES, mixed_headers, path_col)


def read_gene_results(
    spark: SparkSession, directories: str | Sequence[str], extension: str = "gene.txt",
    mixed_headers: bool = False, path_col: str | None = None,
) -> DataFrame:
    """Space-separated gene results; NA is missing. See :func:`read_variant_results`."""
    return _read_results(spark, directories, extension, GENE_RESULT_TYPES, mixed_headers, path_col)


GTF = _schema(seqname="string", source="string", feature="string", start="int", end="int", score="string",
              strand="string", frame="string", attribute="string")


def parse_gtf(lines: DataFrame) -> DataFrame:
    """GTF fields with gene and transcript ids stripped of their version."""

    def attribute(name: str):
        found = F.regexp_extract("attribute", rf'(?:^|;)\s*{name}\s+"?([^";]*)"?', 1)
        return F.nullif(found, F.lit(""))

    def unversioned(name: str):
        return F.get(F.split(attribute(name), r"\."), F.lit(0))

    return lines.withColumns(
        {
            "gene_id": unversioned("gene_id"),
            "transcript_id": unversioned("transcript_id"),
            "gene_type": attribute("gene_type"),
            "gene_name": attribute("gene_name"),
        }
    ).drop("attribute")


def read_gtf(spark: SparkSession, path: str, contigs: Sequence[str] | None = None) -> DataFrame:
    """GTF annotation; records off the given contigs are left out."""
    raw = spark.read.schema(GTF).options(sep="\t", comment="#", quote="").csv(path)
    return parse_gtf(raw if contigs is None else raw.filter(F.col("seqname").isin(list(contigs))))


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Text lines with their place: ``file``, ``block`` (offset of the part of
    the file read together), ``line`` (order within the block), ``value``."""
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )


def read_groups_of_region(spark: SparkSession, path: str, contig: str, start: int, end: int) -> DataFrame:
    """Gene groups whose gene starts in ``[start, end)`` of a contig, from the region's bins alone."""
    widths = spark.read.parquet(f"{path}/genes").select("bin_width").limit(1).collect()
    groups = spark.read.parquet(f"{path}/groups").withColumn("contig", F.col("contig").cast("string"))
    if not widths:  # no genes
        return groups.filter("false")
    width = widths[0]["bin_width"]
    within = (F.col("bin") >= start // width) & (F.col("bin") <= (end - 1) // width)
    return groups.filter((F.col("contig") == contig) & within & (F.col("start") >= start) & (F.col("start") < end))


def read_groups_of_gene(spark: SparkSession, path: str, symbol: str) -> DataFrame:
    """Gene groups of the genes with a symbol, from the bins those start in."""
    genes = spark.read.parquet(f"{path}/genes").filter(F.col("gene_symbol") == symbol)
    found = genes.select("gene_id", "contig", "bin").limit(1000).collect()  # genes that share a symbol are few
    groups = spark.read.parquet(f"{path}/groups").withColumn("contig", F.col("contig").cast("string"))
    places = [(F.col("contig") == r["contig"]) & (F.col("bin") == r["bin"]) & (F.col("gene_id") == r["gene_id"]) for r in found]
    return groups.filter(reduce(lambda a, b: a | b, places, F.lit(False)) & (F.col("gene_symbol") == symbol))
