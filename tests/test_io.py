import pytest
from pyspark.sql import functions as F

from phenoloom.model import PHENO_KEY, MatrixFrame
from phenoloom.operators import export, loading, logs
from phenoloom.sinks import writers
from phenoloom.sources import readers


def lines_of(spark, files, block=2, **extra):
    rows = [(name, i // block, i % block, text) for name, texts in files.items() for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "file string, block int, line int, value string")
    return df.withColumns(extra)


LOG = [
    "12 samples have been used to fit the glmm null model", "Analyzing 5 cases", "Analyzing x cases and 3 controls",
    "Analyzing 7 cases and 8 controls", "Analyzing 9 cases and 9 controls",
]


@pytest.mark.parametrize("block", [1, 2, 100])
def test_case_counts(spark, block):
    chrom = F.substring("file", 1, 2).cast("int")
    files = {"12": LOG, "11": LOG[:2], "09": LOG}
    got = logs.case_counts_from_logs(lines_of(spark, files, block, chrom=chrom, ph=F.lit("p")), ["ph"]).collect()
    assert [tuple(r) for r in got] == [("p", 12, -1)]  # chromosome 11 is read first
    only = logs.case_counts_from_logs(lines_of(spark, {"12": LOG}, block, chrom=chrom, ph=F.lit("p")), ["ph"]).collect()
    assert [tuple(r) for r in only] == [("p", 7, 8)]
    none = logs.case_counts_from_logs(lines_of(spark, {"12": ["nothing"]}, block, chrom=chrom, ph=F.lit("p")), ["ph"]).collect()
    assert [tuple(r) for r in none] == [("p", -1, -1)]


def test_heritability(spark):
    files = {"a": ["Final 1 x y", "Final 1 2", "Final 1 0.5 end", "Final 1 9 end"], "b": ["no"]}
    df = lines_of(spark, files)
    binary = {r.file: r.heritability for r in logs.heritability_from_logs(df).collect()}
    assert binary["a"] == pytest.approx(0.5 / (0.5 + 3.289868133696453)) and binary["b"] == -1
    quantitative = {r.file: r.heritability for r in logs.heritability_from_logs(df, F.lit(True)).collect()}
    assert quantitative["a"] == pytest.approx(0.5 / 1.5)


@pytest.mark.parametrize("block", [1, 2, 3, 100])
def test_facts_below_markers_cross_blocks(spark, block):
    text = ["other attached packages:", "[1] A_1 SAIGE_0.36 B", "x", "other attached packages:", "[1] SAIGE_0.44", "other attached packages:", "none here",
            "$invNormalize", "[1] TRUE", "t_end - t_begin", "user system", "1.5 0.1 9.5"]
    df = lines_of(spark, {"a": text, "b": ["$invNormalize"]}, block)
    assert {r.file: r.saige_version for r in logs.version_from_logs(df).collect()} == {"a": "SAIGE_0.44", "b": "NA"}
    assert {r.file: r.inv_normalized for r in logs.normalization_from_logs(df).collect()} == {"a": "True", "b": "Unknown"}
    assert {r.file: (r.cpu, r.wall) for r in logs.model_timing_from_logs(df).collect()} == {"a": ("1.5", "9.5"), "b": ("NA", "NA")}


def test_logs_read_from_text_files_in_small_blocks(spark, tmp_path):
    body = "\n".join(["filler line %d" % i for i in range(300)] + ["other attached packages:", "[1] SAIGE_1.0"] + ["tail"] * 300)
    (tmp_path / "one.log").write_text(body + "\n")
    (tmp_path / "result_chr10_000000001.variant.log").write_text("x\nAnalysis took 12.5 s\nAnalysis took 99 s\nERROR: bad\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = readers.read_lines(spark, str(tmp_path))
        assert df.select("block").distinct().count() > 3
        facts = {r.file.split("/")[-1]: r.saige_version for r in logs.version_from_logs(df).collect()}
        assert facts["one.log"] == "SAIGE_1.0"
        nexts = logs.with_next_lines(df.filter(F.col("file").endswith("one.log")), 2).filter("next1 IS NOT NULL")
        assert nexts.count() == 601
        assert [tuple(r) for r in logs.timing_from_logs(df).collect()] == [("chr10:000000001", 12.5)]
        assert logs.count_problem_files(df).collect()[0][0] == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_metadata_from_logs(spark):
    key = dict(zip(PHENO_KEY, ("continuous", "50", "both_sexes", "", "irnt")))
    test = lines_of(spark, {"t": LOG}, chrom=F.lit(10), **{k: F.lit(v) for k, v in key.items()})
    model = lines_of(spark, {"m": ["Final 1 0.5 end", "$invNormalize", "[1] FALSE"]})
    phenotypes = spark.createDataFrame([(*key.values(), "m"), ("icd10", "E11", "both_sexes", "", "", "gone")], ", ".join(f"{k} string" for k in [*PHENO_KEY, "file"]))
    got = {r.phenocode: r for r in loading.metadata_from_logs(test, model, phenotypes).collect()}
    assert (got["50"].n_cases, got["50"].n_controls, got["50"].inv_normalized, got["50"].saige_version) == (7, 8, "False", "NA")
    assert got["50"].heritability == pytest.approx(1 / 3)
    assert (got["E11"].n_cases, got["E11"].heritability, got["E11"].inv_normalized) == (-1, -1.0, "NA")


def test_load_phenotype_metadata(spark, tmp_path):
    (tmp_path / "raw.csv").write_text('FieldID,Field,Notes,Path,ValueType,Coding\n1,"a, b","line1\nline2",p,Continuous,\n2,c,,p,Integer,7\n')
    (tmp_path / "coding7.tsv").write_text("coding\tmeaning\n1\tone\n-1\tNA\n")
    (tmp_path / "coding19.tsv").write_text("coding\tmeaning\tnode_id\tparent_id\tselectable\nA\tTop\t1\t0\tN\nB\tSub\t2\t1\tY\n")
    target = str(tmp_path / "out")
    loading.load_phenotype_metadata(spark, str(tmp_path / "raw.csv"), str(tmp_path), {"icd10": str(tmp_path / "coding19.tsv")}, target)
    dictionary = {r.FieldID: r for r in readers.read_dictionary(spark, f"{target}/dictionary.tsv").collect()}
    assert dictionary["1"].Field == "a, b" and dictionary["1"].Notes == "line1 line2" and dictionary["1"].Coding is None
    assert dictionary["2"].Coding == 7 and dictionary["2"].Notes is None
    codes = {(r.coding_id, r.coding): r for r in spark.read.parquet(f"{target}/codings").collect()}
    assert codes[(7, "1")].node_id is None and codes[(19, "B")].parent_id == "1" and codes[(7, "-1")].meaning is None
    icd = {r.coding: r.meaning for r in spark.read.parquet(f"{target}/icd10_codings").collect()}
    assert icd == {"A": "Top", "B": "Top | Sub"}


def test_codings_by_header(spark, tmp_path):
    (tmp_path / "coding1.tsv").write_text("coding\tmeaning\ncoding\tthe word itself\n")
    (tmp_path / "coding2.tsv").write_text('"coding"\t"meaning"\n"a"\t"quoted"\n')
    (tmp_path / "coding3.tsv").write_text("meaning\tcoding\nturned\tb\n")
    got = {(r.coding_id, r.coding, r.meaning) for r in readers.read_codings(spark, str(tmp_path)).collect()}
    assert got == {(1, "coding", "the word itself"), (2, "a", "quoted"), (3, "b", "turned")}
    (tmp_path / "coding4.tsv").write_text("code\tmeaning\n1\tx\n")
    with pytest.raises(ValueError, match="coding4.tsv"):
        readers.read_codings(spark, str(tmp_path))


def test_results_of_mixed_headers(spark, tmp_path):
    for name, text in {"one": "markerID p.value AC\n1:1_A/T 0.5 7\n", "two b": "markerID AC p.value\n1:2_A/T 9 NA\n", "three": "AC markerID\n3 1:3_A/T\n"}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.single.txt").write_text(text)
    folders = [str(tmp_path / name) for name in ("one", "two b", "three")]
    got = readers.read_variant_results(spark, folders, mixed_headers=True, path_col="path").collect()
    assert {(r.markerID, r["p.value"], r.AC) for r in got} == {("1:1_A/T", 0.5, 7), ("1:2_A/T", None, 9), ("1:3_A/T", None, 3)}
    assert {r.path.split("/")[-2] for r in got} == {"one", "two%20b", "three"}
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_variant_results(spark, folders[:2]).collect()


def test_group_file_layouts(spark, tmp_path):
    groups = spark.createDataFrame([("g1", "1:2_A/T"), ("g1", "1:1_A/T"), ("big", "v1"), ("big", "v2"), ("big", "v3" * 20)], "group_id string, variant string")
    writers.write_group_file(groups, str(tmp_path / "g"))
    lines = {r.value for r in spark.read.text(str(tmp_path / "g")).collect()}
    assert lines == {"g1\t1:1_A/T\t1:2_A/T", "big\tv1\tv2\t" + "v3" * 20}
    writers.write_group_file(groups, str(tmp_path / "long"), layout="long")
    long = spark.read.csv(str(tmp_path / "long"), sep="\t").collect()
    assert [tuple(r) for r in long] == [("big", "v1"), ("big", "v2"), ("big", "v3" * 20), ("g1", "1:1_A/T"), ("g1", "1:2_A/T")]


def test_vcf_text(spark, tmp_path):
    rows = [("1", 5, ["A", "C", "G"], "b", [0, 2]), ("1", 5, ["A", "C", "G"], "a", None), ("1", 4, ["A", "T"], "b", [1])]
    g = spark.createDataFrame(rows, "contig string, pos int, alleles array<string>, sample string, GT array<int>")
    writers.write_vcf(g, g.select("sample").distinct(), str(tmp_path / "v"))
    body = [r.value.split("\t") for r in spark.read.text(str(tmp_path / "v/body")).collect()]
    assert sorted(body) == sorted([["1", "4", "1:4_A/T", "A", "T", ".", ".", ".", "GT", "./.", "1"], ["1", "5", "1:5_A/C", "A", "C,G", ".", ".", ".", "GT", "0/0", "0/2"]])
    header = [r.value for r in spark.read.text(str(tmp_path / "v/header")).collect()]
    assert header[0] == "##fileformat=VCFv4.2" and header[1].startswith("##FORMAT=<ID=GT,") and header[2].endswith("FORMAT\ta\tb")


def test_vcf_genome_order(spark, tmp_path):
    contigs = ["chr10", "chrX", "chr2", "chrM", "alt", "chr1"]
    g = spark.createDataFrame(
        [(c, 1, ["A", "C"], "a", [0, 1]) for c in contigs], "contig string, pos int, alleles array<string>, sample string, GT array<int>"
    )
    writers.write_vcf(g, g.select("sample").distinct(), str(tmp_path / "v"))
    parts = sorted((tmp_path / "v/body").glob("part-*"))
    assert [line.split("\t")[0] for p in parts for line in p.read_text().splitlines()] == ["chr1", "chr2", "chr10", "chrX", "chrM", "alt"]


@pytest.mark.parametrize("block", [1, 2, 1024])
def test_vcf_blocks_of_samples(spark, block):
    rows = [("1", 5, ["A", "C"], "c", [0, 1]), ("1", 6, ["A", "C"], "a", [1, 1]), ("1", 6, ["A", "C"], "e", None)]
    g = spark.createDataFrame(rows, "contig string, pos int, alleles array<string>, sample string, GT array<int>")
    names = spark.createDataFrame([(x,) for x in "abcde"], "sample string")
    got = {r.pos: r.value.split("\t")[9:] for r in writers.vcf_lines(g, names, block).collect()}
    assert got == {5: ["./.", "./.", "0/1", "./.", "./."], 6: ["1/1", "./.", "./.", "./.", "0/0"]}


def test_drop_staged(spark, tmp_path):
    import os

    from phenoloom import session

    session.stage(spark.range(3))
    path = session._staged[-1].removeprefix("file:")
    assert os.path.isdir(path)
    session.drop_staged(spark)
    assert not os.path.exists(path) and not session._staged


def export_frame(spark):
    key = ("icd10", "E11")
    cells = [(i, *key, "both_sexes", "", "", 1.0 if i < 4 else 0.0) for i in range(6)]
    entries = spark.createDataFrame(cells, "userId int, " + ", ".join(f"{k} string" for k in PHENO_KEY) + ", both_sexes double")
    sex = F.col("userId") % 2
    entries = entries.withColumns({"females": F.when(sex == 0, F.col("both_sexes")), "males": F.when(sex == 1, F.col("both_sexes"))})
    cols = entries.select(*PHENO_KEY).distinct().withColumns({"n_cases_females": F.lit(1), "n_cases_males": F.lit(9)})
    rows = entries.select("userId").distinct().withColumn("sex", (F.col("userId") % 2).cast("int"))
    return MatrixFrame(rows, cols, entries, ["userId"], PHENO_KEY)


def test_export_falls_back_to_both_sexes_and_single_sex(spark):
    frame = export_frame(spark)
    ask = frame.cols.withColumn("pheno_sex", F.lit("males"))
    got = {r.userId: r.value for r in export.export_values(frame, ask).collect()}
    assert got == {0: None, 1: 1.0, 2: None, 3: 1.0, 4: None, 5: 0.0}
    both = frame.cols
    assert {r.userId for r in export.export_values(frame, both, 0.1).collect()} == {1, 3, 5}  # at most 10 % female
    assert export.export_values(frame, both, 0.05).count() == 6
    flat = frame.with_(cols=frame.cols.withColumns({"n_cases_females": F.lit(0), "n_cases_males": F.lit(0)}))
    assert export.export_values(flat, both, 0.1).count() == 6  # no cases at all: no restriction


def test_vcf_in_one_folder(spark, tmp_path):
    """Files in order: header first, chromosome 2 before 10, one order over the parts."""
    rows = [(f"chr{c}", p, ["A", "C"], s, [0, 1]) for c in ("10", "2", "X", "1") for p in range(1, 40) for s in ("s1", "s2")]
    entries = spark.createDataFrame(rows, "contig string, pos int, alleles array<string>, sample string, GT array<int>")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_vcf(entries, entries.select("sample").distinct(), str(tmp_path / "one"), layout="one")
        writers.write_vcf(entries.limit(0), entries.select("sample").limit(0), str(tmp_path / "none"), layout="one")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted((tmp_path / "one").glob("part-*"))
    lines = [line for p in parts for line in p.read_text().splitlines()]
    assert len(parts) > 2 and lines[0] == "##fileformat=VCFv4.2" and lines[1].startswith("##FORMAT")
    assert lines[2].split("\t")[:2] == ["#CHROM", "POS"] and lines[2].split("\t")[-2:] == ["s1", "s2"]
    found = [tuple(x.split("\t")[:2]) for x in lines[3:]]
    assert found == [(f"chr{c}", str(p)) for c in ("1", "2", "10", "X") for p in range(1, 40)]
    empty = [line for p in sorted((tmp_path / "none").glob("part-*")) for line in p.read_text().splitlines()]
    assert len(empty) == 3 and empty[2].split("\t") == writers.VCF_COLUMNS
    with pytest.raises(ValueError):
        writers.write_vcf(entries, entries.select("sample"), str(tmp_path / "x"), layout="odd")


def test_gene_groups_by_region_and_gene(spark, tmp_path):
    """A region reads its bins alone, a gene its own bin; genes that share a symbol all count."""
    genes = spark.createDataFrame(
        [(f"G{k}", "DUP" if k in (3, 17) else f"S{k}", f"chr{k % 3}", 1000 * k, 1000 * k + 500) for k in range(60)],
        "gene_id string, gene_symbol string, contig string, start int, end int",
    )
    groups = genes.selectExpr("gene_id", "gene_symbol", "'pLoF' AS annotation", "concat(contig, ':', start) AS variant", "concat(gene_id, '_pLoF') AS group_id")
    writers.write_gene_groups(genes, groups, str(tmp_path), bin_width=5000)
    region = readers.read_groups_of_region(spark, str(tmp_path), "chr1", 4000, 19000)
    assert sorted(r.gene_id for r in region.collect()) == ["G10", "G13", "G16", "G4", "G7"]
    plan = region._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "bin" in pruned and "chr1" in pruned
    scan = region._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in scan
    both = readers.read_groups_of_gene(spark, str(tmp_path), "DUP")
    assert {(r.gene_id, r.start) for r in both.collect()} == {("G3", 3000), ("G17", 17000)}
    assert readers.read_groups_of_gene(spark, str(tmp_path), "NONE").count() == 0
    writers.write_gene_groups(genes.limit(0), groups.limit(0), str(tmp_path / "empty"))


@pytest.mark.parametrize("layout", ["split", "one"])
def test_vcf_of_few_calls_moves_little(spark, tmp_path, layout):
    """Absent calls are made last: what is staged and written follows the stored calls, the lines are whole."""
    import os

    from phenoloom import session

    n_samples, n_variants = 20_000, 300
    key = ["'1' AS contig", "id AS pos", "array('A', 'C') AS alleles"]
    entries = spark.range(n_variants).selectExpr(*key, "concat('s', (id * 7919 + 13) % 20000) AS sample", "array(0, 1) AS GT")
    samples = spark.range(n_samples).selectExpr("concat('s', id) AS sample")
    n_staged = len(session._staged)
    writers.write_vcf(entries, samples, str(tmp_path / "v"), layout, compression="gzip")
    order = {name: i for i, name in enumerate(sorted(f"s{i}" for i in range(n_samples)))}
    lines = [r.value.split("\t") for r in spark.read.text(str(tmp_path / ("v" if layout == "one" else "v/body"))).collect()]
    lines = [x for x in lines if not x[0].startswith("#")]
    assert len(lines) == n_variants
    for line in lines:
        calls, at = line[9:], order[f"s{(int(line[1]) * 7919 + 13) % 20000}"]
        assert len(calls) == n_samples and calls[at] == "0/1" and calls.count("./.") == n_samples - 1
    places = [str(tmp_path / "v"), *[p.removeprefix("file:") for p in session._staged[n_staged:]]]
    size = sum(os.path.getsize(os.path.join(d, f)) for p in places for d, _, files in os.walk(p) for f in files)
    assert size < n_samples * n_variants * 4 / 20
