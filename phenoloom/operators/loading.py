"""Loads that put several operators together."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phenoloom.functions.keys import QUANTITATIVE_TRAITS, joined_key
from phenoloom.model import PHENO_KEY
from phenoloom.operators import codings, logs, results
from phenoloom.scale import one_per_key
from phenoloom.session import stage
from phenoloom.sinks.writers import write_table
from phenoloom.sources import readers


def metadata_from_logs(test_logs: DataFrame, model_logs: DataFrame, phenotypes: DataFrame) -> DataFrame:
    """Association metadata of every phenotype from its logs.

    ``test_logs`` are line tables with the five-part key and ``chrom``;
    ``model_logs`` line tables by ``file``, as read; ``phenotypes`` maps each
    five-part key to its model log ``file``. One pass over either kind of log;
    facts not found keep their -1, 'NA' or 'Unknown'.
    """
    facts = logs.facts_from_logs(model_logs)
    counts = logs.case_counts_from_logs(test_logs, PHENO_KEY)
    quantitative = F.col("trait_type").isin(QUANTITATIVE_TRAITS)
    defaults: dict[str, Column] = {
        "n_cases": F.lit(-1), "n_controls": F.lit(-1), "heritability": F.lit(-1.0),
        "saige_version": F.lit("NA"), "inv_normalized": F.lit("NA"),
    }
    joined = phenotypes.join(facts, "file", "left").join(counts, PHENO_KEY, "left").withColumn(
        "heritability", F.when(quantitative, F.col("heritability_quantitative")).otherwise(F.col("heritability_binary"))
    )
    return joined.select(*PHENO_KEY, *[F.coalesce(name, default).alias(name) for name, default in defaults.items()])


def phenotype_folder(path: Column, extension: str) -> Column:
    """The folder that holds a result file, or holds the folder of its parts; a
    ``name=`` before it is left out."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(plain, rf".*/(?:\w+=)?([^/]+)/[^/]*\.{re.escape(extension)}(?:/[^/]*)?$", 1)


def keyed_by_folder(
    df: DataFrame, path_col: str, phenotypes: DataFrame, extension: str, files: DataFrame | None = None
) -> DataFrame:
    """Rows with the key of the phenotype whose joined key names their folder.

    The key is looked up, not cut from the name: parts may hold the delimiter,
    and a slash of the phenotype's code is an underscore in the name. Rows of
    other folders are dropped; :func:`unknown_folders` lists them.

    ``files`` lists the paths in ``file``, each once; then a path is matched for
    each file instead of for each row.
    """
    names = one_per_key(phenotypes.select(*PHENO_KEY, joined_key(phenotypes, safe_phenocode=True).alias("_folder")), ["_folder"])
    if files is not None:
        keys = files.select(F.col("file").alias(path_col), phenotype_folder(F.col("file"), extension).alias("_folder"))
        return df.join(stage(keys.join(names, "_folder").drop("_folder")), path_col).drop(path_col)
    return df.withColumn("_folder", phenotype_folder(F.col(path_col), extension)).join(names, "_folder").drop("_folder", path_col)


def unknown_folders(files: DataFrame, phenotypes: DataFrame, extension: str) -> DataFrame:
    """Folders of result files that no phenotype's key names."""
    names = phenotypes.select(joined_key(phenotypes, safe_phenocode=True).alias("folder"))
    return files.select(phenotype_folder(F.col("file"), extension).alias("folder")).distinct().join(names, "folder", "left_anti")


def load_association_results(
    spark: SparkSession, root: str, phenotypes: DataFrame, metadata: DataFrame, target: str,
    annotation: DataFrame, intervals: DataFrame | None = None, analysis: str = "gene", log_pvalue: bool = False,
) -> dict[str, DataFrame]:
    """Load the results of all phenotypes, one folder each under ``root``, and write them.

    ``analysis`` ``gene`` has variant results in ``*.single.txt`` and gene results
    in ``*.gene.txt``; any other has variant results in ``*.single_variant.txt``.
    Files may have different headers: first lines are read first, then a scan is
    made for each header, so the plan grows with the headers and not with the
    phenotypes. Keys come from the folders' names, ``metadata`` is keyed by
    phenotype (see :func:`metadata_from_logs`). A folder without a phenotype is
    an error.

    Writes and returns ``variant_results`` and, with genes, ``gene_results``.
    """
    wanted = {"variant_results": "single.txt" if analysis == "gene" else "single_variant.txt"}
    if analysis == "gene":
        wanted["gene_results"] = "gene.txt"
    metadata = stage(metadata)
    out = {}
    for name, extension in wanted.items():
        gene = name == "gene_results"
        heads = readers.first_lines(spark, f"{root}/*/*.{extension}")
        strange = [r["folder"] for r in unknown_folders(heads, phenotypes, extension).orderBy("folder").limit(5).collect()]
        if strange:
            raise ValueError(f"no phenotype for the folders {strange}")
        groups: dict[str, list[str]] = {}
        for row in heads.orderBy("file").toLocalIterator():
            groups.setdefault(row["header"], []).append(unquote(row["file"]))
        loaded = []
        for scan in readers.result_scans(spark, list(groups.values()), gene, path_col="_file"):
            keyed = keyed_by_folder(scan, "_file", phenotypes, extension, heads)
            loaded.append(
                results.load_gene_results(keyed, None, metadata, intervals) if gene
                else results.load_variant_results(keyed, None, metadata, annotation, log_pvalue)
            )
        out[name] = write_table(results.union_tables(loaded), f"{target}/{name}")
    return out


def load_phenotype_metadata(
    spark: SparkSession, dictionary_csv: str, codings_dir: str, icd_codings: dict[str, str], target: str
) -> None:
    """Convert the dictionary and write all codings and full code meanings.

    ``icd_codings`` maps an output name (such as icd10, icd9) to its coding file.
    """
    readers.convert_dictionary(spark, dictionary_csv, f"{target}/dictionary.tsv")
    write_table(readers.read_codings(spark, codings_dir), f"{target}/codings")
    for name, path in icd_codings.items():
        write_table(codings.full_meanings(readers.read_icd_codings(spark, path)), f"{target}/{name}_codings")
