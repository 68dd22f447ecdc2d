"""Loads of many result folders: headers, keys from folders, errors."""

import pytest
from pyspark.sql import functions as F

from phenoloom.model import PHENO_KEY
from phenoloom.operators import loading
from phenoloom.sources import readers

EXOME = "markerID AC N Tstat p.value"
IMPUTED = "CHR POS SNPID Allele1 Allele2 BETA N Tstat p.value"


def test_first_lines_reads_no_bodies(spark, tmp_path):
    """One line a file reaches the task; of the large body only the reader's buffers are read."""
    (tmp_path / "a b+c.txt").write_text("head one\n" + "x" * 60 + "\n" + ("y" * 99 + "\n") * 200_000)
    (tmp_path / "d.txt").write_text("head two\n")
    (tmp_path / "e.txt").write_text("")
    seen = spark.sparkContext.accumulator(0)
    plain = readers.stage

    def watched(df):
        source = df.mapInArrow(lambda batches: counted(batches), df.schema)
        return plain(source)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    readers.stage = watched
    try:
        rows = readers.first_lines(spark, str(tmp_path)).collect()
    finally:
        readers.stage = plain
    assert sorted(r["header"] for r in rows) == ["head one", "head two"] and seen.value == 2
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"
    groups = readers.files_by_header(spark, str(tmp_path))
    assert groups["head one"][0].endswith("a b+c.txt")


@pytest.fixture
def results_root(tmp_path):
    def put(folder, name, *lines):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / name).write_text("\n".join(lines) + "\n")

    put("icd10-E11-both_sexes--", "result_chr1.single.txt", EXOME, "chr1:5_A/G 3 10 0.5 0.01", "chr1:5_A/G 4 10 0.5 0.02")
    put("icd10-E11-both_sexes--", "result_chr2.single.txt", EXOME, "chr2:7_A/T 3 10 0.5 NA")
    put("continuous-p_1-x-males--irnt", "result_chr1.single.txt", IMPUTED, "chr1 5 chr1:5_A/G A G 0.25 10 0.5 0.5")
    put("icd10-E11-both_sexes--", "result.gene.txt", "Gene Pvalue Nmarker_MACCate_1", "ENSG1_AB_lof 0.5 3", "odd 0.1 1")
    return tmp_path


def _phenotypes(spark):
    rows = [("icd10", "E11", "both_sexes", "", ""), ("continuous", "p/1-x", "males", "", "irnt"), ("icd10", "Z99", "both_sexes", "", "")]
    return spark.createDataFrame(rows, ", ".join(f"{k} string" for k in PHENO_KEY))


def _load(spark, root, target, **more):
    phenotypes = _phenotypes(spark)
    metadata = phenotypes.select("*", F.lit(7).alias("n_cases"), F.lit(-1).alias("n_controls"), F.lit(0.5).alias("heritability"))
    annotation = spark.createDataFrame([("chr1", 5, ["A", "G"], "g", "lof")], "contig string, pos int, alleles array<string>, gene string, annotation string")
    intervals = spark.createDataFrame([("ENSG1", "i")], "gene_id string, interval string")
    return loading.load_association_results(spark, str(root), phenotypes, metadata, str(target), annotation, intervals, **more)


def test_load_of_two_shapes(spark, results_root):
    """Keys with a slash and with the delimiter, repeats, absent values, both outputs written."""
    out = _load(spark, results_root, results_root / "out")
    rows = {(r.phenocode, r.contig): r for r in out["variant_results"].collect()}
    assert set(rows) == {("E11", "chr1"), ("E11", "chr2"), ("p/1-x", "chr1")}
    first = rows["E11", "chr1"]
    assert (first.AC, first.Pvalue, first.n_cases, first.n_controls, first.gene) == (3, 0.01, 7, None, "g")
    assert rows["E11", "chr2"].Pvalue is None and rows["E11", "chr2"].gene is None
    other = rows["p/1-x", "chr1"]
    assert (other.trait_type, other.pheno_sex, other.modifier, other.BETA, other.AC) == ("continuous", "males", "irnt", 0.25, None)
    gene = out["gene_results"].collect()
    assert [(g.gene_id, g.total_variants, g.phenocode, g.interval) for g in gene] == [("ENSG1", 3, "E11", "i")]
    assert spark.read.parquet(str(results_root / "out" / "variant_results")).count() == 3


def test_plan_grows_with_headers_only(spark, results_root):
    for k in range(30):
        folder = results_root / f"icd10-K{k}-both_sexes--"
        folder.mkdir()
        (folder / "r.single.txt").write_text(EXOME + f"\nchr1:{k}_A/G 1 1 1 0.5\n")
    groups = readers.files_by_header(spark, str(results_root / "*" / "*.single.txt"))
    scans = readers.result_scans(spark, list(groups.values()), path_col="_file")
    assert len(groups) == 2 and len(scans) == 2
    leaves = sum(s._jdf.queryExecution().optimizedPlan().toString().count("Relation [") for s in scans)
    assert leaves == 2 and sum(s.count() for s in scans) == 34


def test_folder_without_phenotype_is_an_error(spark, results_root):
    (results_root / "icd10-X-both_sexes--").mkdir()
    (results_root / "icd10-X-both_sexes--" / "r.single.txt").write_text(EXOME + "\n")
    with pytest.raises(ValueError, match="icd10-X-both_sexes--"):
        _load(spark, results_root, results_root / "out")


def test_first_lines_hands_no_line_to_python(spark, tmp_path):
    """Only first lines leave the scan, also of a file with many splits."""
    (tmp_path / "a.txt").write_text("head one\n" + ("y" * 99 + "\n") * 20_000)
    (tmp_path / "b.txt").write_text("head two\nbody\n")
    plain, plans, name = readers.stage, [], "spark.sql.files.maxPartitionBytes"

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df)

    readers.stage = watched
    spark.conf.set(name, "100000")
    try:
        rows = readers.first_lines(spark, str(tmp_path)).collect()
    finally:
        readers.stage = plain
        spark.conf.unset(name)
    assert sorted(r["header"] for r in rows) == ["head one", "head two"]
    assert "MapInArrow" not in plans[0]


def test_keys_are_looked_up_by_file(spark, results_root):
    """A path is matched once for each file, not for each row."""
    heads = readers.first_lines(spark, str(results_root / "*" / "*.single.txt"))
    scan = readers.read_variant_results(spark, str(results_root / "icd10*"), path_col="_file")
    keyed = loading.keyed_by_folder(scan, "_file", _phenotypes(spark), "single.txt", heads)
    assert "regexp_extract" not in keyed._jdf.queryExecution().optimizedPlan().toString()
    want = loading.keyed_by_folder(scan, "_file", _phenotypes(spark), "single.txt")
    assert keyed.columns == want.columns
    got, want = [sorted(map(str, df.collect())) for df in (keyed, want)]
    assert got == want and len(got) == 3
