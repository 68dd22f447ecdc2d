import random

import pytest
from pyspark.sql import functions as F

from phenoloom.functions import consequence
from phenoloom.functions.genome import CONTIG_LENGTHS, even_interval, global_position
from phenoloom.operators import genotypes, variants


def test_annotation_rules(spark):
    rows = [("missense_variant", "HC"), ("missense_variant", "LC"), ("missense_variant", None), ("stop_gained", None), ("splice_region_variant", None),
            ("stop_retained_variant", None), ("intron_variant", "OS"), (None, None), ("stop_lost", None)]
    df = spark.createDataFrame(rows, "t string, lof string")
    t, lof = F.col("t"), F.col("lof")
    got = df.select(consequence.annotation_group(t, lof), consequence.annotation_group(t), consequence.annotation_group(t, lof, strict=True),
                    consequence.annotation_group_legacy(t, lof)).collect()
    assert [r[0] for r in got] == ["pLoF", "LC", "missense", None, None, "synonymous", "non-coding", None, "missense"]
    assert [r[1] for r in got] == ["missense"] * 3 + ["pLoF", None, "synonymous", "non-coding", None, "missense"]
    assert got[5][2] is None and got[8][2] is None
    assert [r[3] for r in got] == ["pLoF", "LC", "missense", None, None, None, None, None, None]


def test_mac_category_bounds(spark):
    rows = [(0, .5), (5, .5), (6, .5), (10, .5), (20, .5), (21, .001), (21, .01), (21, .1), (21, .11)]
    df = spark.createDataFrame(rows, "ac int, af double")
    got = [r[0] for r in df.select(consequence.mac_category(F.col("ac"), F.col("af"))).collect()]
    assert got == [0, 5, 10, 10, 20, .001, .01, .1, .99]


def test_sample_for_plink_filters_and_keeps_small_categories(spark):
    rows = [(c, i, ["A", "G"], (ac, 0.5, an)) for i, (c, ac, an) in enumerate(
        [("1", 1, 200), ("X", 1, 200), ("chr5", 6, 190), ("2", 0, 200), ("3", 7, 189)] + [("4", 30, 200)] * 2000)]
    df = spark.createDataFrame(rows, "contig string, pos int, alleles array<string>, call_stats struct<AC:int,AF:double,AN:int>")
    kept = variants.sample_for_plink(df, 100, per_maf=500).collect()
    assert {r.pos for r in kept if r.mac_category >= 1} == {0, 2}
    assert 400 < sum(r.mac_category == 0.99 for r in kept) < 600
    again = variants.sample_for_plink(df, 100, per_maf=500).collect()
    assert {r.pos for r in kept} == {r.pos for r in again}


def test_genome_intervals_edges(spark, many_tiles):
    genes = [("1", 100, 200, "a", "A"), ("1", 150, 160, "n", "N"), ("1", 161, 300, "b", "B"), ("1", 310, 320, "c", "C"), ("2", 50, 60, "d", "D")]
    df = spark.createDataFrame(genes, "contig string, start long, end long, gene_id string, gene_name string")
    gaps = {tuple(r)[:4] for r in variants.genome_intervals(df).filter("NOT within_gene").collect()}
    # a nested gene is the predecessor of the next one: a gap of 1 leaves only its second half
    assert gaps == {("1", 160, 161, "b"), ("1", 301, 305, "b"), ("1", 305, 310, "c")}
    assert variants.genome_intervals(df).filter("within_gene").count() == 5


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_overlaps_match_brute_force(spark, width):
    rng = random.Random(width)
    points = [(rng.choice("12"), rng.randrange(100), i) for i in range(200)]
    intervals = [(rng.choice("12"), s, s + rng.randrange(0, 30)) for s in rng.sample(range(100), 20)]
    p = spark.createDataFrame(points, "contig string, pos long, i int")
    iv = spark.createDataFrame(intervals, "contig string, start long, end long")
    got = sorted((r.i, r.start, r.end) for r in variants.overlap_join(p, iv, bin_width=width).collect())
    want = sorted((i, s, e) for c, x, i in points for d, s, e in intervals if c == d and s <= x < e)
    assert got == want
    assert sorted(r.i for r in variants.within_intervals(p, iv, bin_width=width).collect()) == sorted({w[0] for w in want})


def vep(spark):
    schema = ("contig string, pos int, alleles array<string>, af double, transcript_consequences array<struct<gene_id:string,gene_symbol:string,"
              "canonical:int,most_severe_consequence:string,lof:string>>")
    def tc(g, term, lof=None, canonical=1):
        return (g, g.lower(), canonical, term, lof)
    rows = [
        ("1", 10, ["A", "T"], 0.5, [tc("ENSG1", "intron_variant"), tc("ENSG1", "missense_variant"), tc("ENSG2", "stop_gained", "HC")]),
        ("1", 20, ["A", "T"], 0.001, [tc("ENSG1", "stop_gained", "LC"), tc("LRG_1", "stop_gained", "HC")]),
        ("1", 30, ["A", "T"], None, [tc("ENSG1", "missense_variant")]),
        ("2", 5, ["A", "T"], 0.2, [tc("ENSG2", "splice_region_variant"), tc("ENSG3", "stop_gained", "HC", None)]),
    ]
    return spark.createDataFrame(rows, schema)


def test_gene_map_and_groups(spark):
    genes, members = variants.gene_map(vep(spark), "af")
    assert {tuple(r) for r in genes.collect()} == {("ENSG1", "ensg1", "1", 10, 30), ("ENSG2", "ensg2", "1", 5, 10)}
    got = {(r.gene_id, r.annotation, r.variant) for r in members.collect()}
    assert got == {("ENSG1", "missense", "1:10_A/T"), ("ENSG1", "LC", "1:20_A/T"), ("ENSG1", "missense", "1:30_A/T"),
                   ("ENSG2", "pLoF", "1:10_A/T"), ("ENSG2", None, "2:5_A/T")}
    groups = {}
    for r in variants.gene_groups(members).collect():
        groups.setdefault((r.gene_id, r.annotation), []).append(r.variant)
    assert sorted(groups[("ENSG1", "missense|LC")]) == ["1:10_A/T", "1:20_A/T", "1:30_A/T"]
    assert ("ENSG1", "pLoF") not in groups and groups[("ENSG2", "pLoF|missense|LC")] == ["1:10_A/T"]
    split = {(r.annotation, r.variant): (r.common_variant, r.group_id) for r in variants.gene_groups(members, 0.1).filter("gene_id = 'ENSG1'").collect()}
    assert split[("missense", "1:10_A/T")] == (True, "ENSG1_ensg1_missense_1:10_A/T")
    assert split[("missense|LC", "1:20_A/T")] == (False, "ENSG1_ensg1_missense|LC")
    assert not any(v == "1:30_A/T" for _, v in split)
    assert [r.gene_id for r in variants.genes_on_several_contigs(vep(spark)).collect()] == ["ENSG2"]


def test_one_gene_per_variant(spark):
    key = ["contig", "pos", "alleles"]
    got = {r.pos: (r.gene, r.annotation) for r in variants.one_gene_per_variant(variants.annotate_variants(vep(spark), key), key).collect()}
    assert got[10] == ("ensg2", "pLoF") and got[30] == ("ensg1", "missense") and got[5] == ("ensg2", None)


def test_global_position_slices(spark):
    lengths = CONTIG_LENGTHS["GRCh38"]
    df = spark.createDataFrame([("chr1", 1), ("chr2", 1), ("chrM", 16569), ("odd", 5)], "c string, p int")
    got = df.select(global_position(F.col("c"), F.col("p"), lengths).alias("g")).withColumn("s", even_interval(F.col("g"), sum(lengths.values()), 10)).collect()
    assert [r.g for r in got] == [0, lengths["chr1"], sum(lengths.values()) - 1, None] and [r.s for r in got] == [0, 0, 9, None]


def genotype_table(spark):
    rows = [("1", 5, ["A", "C"], "s1", [0, 1], True), ("1", 5, ["A", "C"], "s2", None, True), ("1", 5, ["A", "C"], "s3", [1], True),
            ("1", 6, ["A", "C"], "s1", [0, 0], True), ("1", 6, ["A", "C"], "s2", [1, 1], False),
            ("1", 7, ["A", "C", "G"], "s1", [1, 2], True), ("1", 7, ["A", "C", "G"], "s2", None, True), ("1", 7, ["A", "C", "G"], "s3", [0, 2], True)]
    return spark.createDataFrame(rows, "contig string, pos int, alleles array<string>, sample string, GT array<int>, adj boolean")


def test_genotype_slice(spark):
    g = genotype_table(spark)
    assert {r.pos for r in genotypes.slice_genotypes(g).collect()} == {5, 7}
    assert {r.pos for r in genotypes.slice_genotypes(g, adjusted_only=False).collect()} == {5, 6, 7}
    assert {r.pos for r in genotypes.slice_genotypes(g, dosages=True).collect()} == {5, 6, 7}
    assert {r.pos for r in genotypes.slice_genotypes(g, dosages=True, min_call_rate=0.7).collect()} == {6}
    iv = spark.createDataFrame([("1", 5, 7)], "contig string, start int, end int")
    assert {r.rsid for r in genotypes.slice_genotypes(g, iv).collect()} == {"1:5_A/C"}


def test_probabilities_and_imputation(spark):
    gp = genotypes.add_probabilities(genotype_table(spark))
    got = {(r.pos, r.sample): r.GP for r in gp.collect()}
    assert got[(5, "s1")] == [0, 1, 0] and got[(5, "s3")] == [0, 0, 1] and got[(5, "s2")] is None
    assert got[(7, "s1")] == [0, 0, 0, 0, 1, 0] and got[(7, "s3")] == [0, 0, 0, 1, 0, 0]
    mean = {(r.pos, r.sample): r.GP for r in genotypes.impute_probabilities(gp).collect()}
    assert mean[(5, "s2")] == [0, 0.5, 0.5] and mean[(7, "s2")] == [0, 0, 0, .5, .5, 0]
    ref = {(r.pos, r.sample): r.GP for r in genotypes.impute_probabilities(gp, mean_impute=False).collect()}
    assert ref[(5, "s2")] == [1, 0, 0]


def test_thin_points_keeps_one_per_cell(spark):
    df = spark.createDataFrame([(float(i % 10), float(i // 10), i) for i in range(100)] + [(float("nan"), 1.0, 999)], "x double, y double, i int")
    kept = variants.thin_points(df, "x", "y", ["i"], n_divisions=5).collect()
    assert len(kept) == 25 and min(r.i for r in kept) == 0


def test_worst_by_gene_stays_in_the_row(spark):
    part = "gene_id string, gene_symbol string, most_severe_consequence string, lof string, canonical int, transcript_id string"
    rows = [
        ("1", 5, [("G1", "a", "synonymous_variant", None, 1, "t1"), ("G1", "a", "stop_gained", "HC", 1, "t2"),
                  ("G1", "a", "transcript_ablation", None, 0, "t3"), (None, None, "intron_variant", None, 1, "t4"),
                  (None, None, "stop_gained", None, 1, "t5"), ("G2", "b", "made_up", None, 1, "t7"), ("G2", "b", "made_up", None, 1, "t6")]),
        ("1", 6, []), ("1", 7, None),
    ]
    df = spark.createDataFrame(rows, f"contig string, pos int, transcript_consequences array<struct<{part.replace(' string', ':string').replace(' int', ':int')}>>")
    worst = variants.worst_by_gene(df, ["contig", "pos"])
    assert {(r.pos, r.gene_id, r.transcript_id) for r in worst.collect()} == {(5, "G1", "t2"), (5, None, "t5"), (5, "G2", "t6")}
    assert "Exchange" not in worst._jdf.queryExecution().executedPlan().toString()


def test_means_share_one_exchange(spark):
    """Entries cross once, whatever the number of genotype classes; variants without a known value stay missing."""
    from phenoloom.operators import genotypes

    rows = [("1", 5, ["A", "C"], s, g) for s, g in (("a", [1.0, 0.0, 0.0]), ("b", [0.0, 0.5, 0.5]), ("c", None), ("d", [None, 1.0, 0.0]))]
    rows += [("1", 6, ["A", "C", "G"], s, g) for s, g in (("a", [0.0, 0.0, 0.0, 0.0, 0.0, 1.0]), ("b", None))] + [("2", 1, ["A", "C"], "a", None)]
    entries = spark.createDataFrame(rows, "contig string, pos int, alleles array<string>, sample string, GP array<double>")
    filled = genotypes.impute_probabilities(entries)
    got = {(r.pos, r["sample"]): r.GP for r in filled.collect()}
    assert got[5, "c"] == [0.5, 0.5, 1 / 6] and got[5, "a"] == [1.0, 0.0, 0.0] and got[5, "d"] == [None, 1.0, 0.0]
    assert got[6, "b"] == [0.0, 0.0, 0.0, 0.0, 0.0, 1.0] and got[1, "a"] is None
    plan = filled._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") + plan.count("BroadcastExchange") <= 2 and "Generate" not in plan
    assert genotypes.impute_probabilities(entries.filter("pos = 1")).collect()[0].GP is None


def test_gene_groups_are_made_within_the_row(spark):
    """No join by the few annotations, which would gather all variants in as few tasks."""
    kinds = ["pLoF", "LC", "missense", "synonymous", "non-coding", None]
    members = spark.createDataFrame([("ENSG1", "A", kind, f"v{i}") for i, kind in enumerate(kinds)], "gene_id string, gene_symbol string, annotation string, variant string")
    groups = variants.gene_groups(members)
    plan = groups._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    want = {(group, f"v{kinds.index(part)}") for group, parts in variants.GENE_GROUPS.items() for part in parts}
    assert sorted((r.annotation, r.variant) for r in groups.collect()) == sorted(want)
    assert groups.columns == ["gene_id", "gene_symbol", "annotation", "variant", "group_id"]


def test_spans_of_genes_rank_no_transcripts(spark):
    """Places of genes come from all canonical transcripts, repeated, missing and null ones included."""
    shape = "contig string, pos long, alleles array<string>, transcript_consequences array<struct<gene_id string, gene_symbol string, canonical int, most_severe_consequence string, lof string>>"
    one = ("ENSG1", "A", 1, "stop_gained", None)
    rows = [
        ("chr1", 9, ["A", "C"], [one, one, ("ENSG2", None, 1, None, None), None]), ("chr1", 5, ["A", "C"], [one]),
        ("chr2", 7, ["A", "C"], [one, ("LRG1", "L", 1, None, None), ("ENSG3", "B", None, None, None)]), ("chr1", 1, None, None), (None, None, None, [one]),
    ]
    table = spark.createDataFrame(rows, shape)
    genes, _ = variants.gene_map(table)
    assert "sort_array" not in genes._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, genes.collect())) == [("ENSG1", "A", "chr1", 5, 9), ("ENSG2", None, "chr1", 9, 9)]
    assert [tuple(r) for r in variants.genes_on_several_contigs(table).collect()] == [("ENSG1", "A", "chr1", "chr2")]


def test_first_gene_is_taken_within_the_row(spark):
    """What is sorted has one record per row, with the same result."""
    kind = "gene_id string, gene_symbol string, canonical int, most_severe_consequence string, lof string"
    rows = [
        ("1", 5, ["A", "G"], [("ENSG2", "B", 1, "stop_gained", "HC"), ("ENSG1", "C", 1, "stop_gained", "HC"), ("ENSG0", "D", 1, "synonymous_variant", None)]),
        ("1", 5, ["A", "G"], [("ENSG1", "A", 1, "stop_gained", "LC"), (None, "Z", 1, "intron_variant", None)]),
        ("1", 6, ["A", "G"], [("ENSG3", "E", None, "stop_gained", "HC")]),
        ("1", 7, ["A", "G"], [(None, "Y", 1, "synonymous_variant", None), ("ENSG4", "F", 1, "synonymous_variant", None)]),
    ]
    table = spark.createDataFrame(rows, f"contig string, pos int, alleles array<string>, transcript_consequences array<struct<{kind.replace(' ', ':')}>>".replace(",:", ", "))
    key = ["contig", "pos", "alleles"]
    first = variants.annotate_variants(table, key, first_gene=True)
    assert sorted(r["pos"] for r in first.collect()) == [5, 5, 7]
    every = variants.one_gene_per_variant(variants.annotate_variants(table, key), key)
    got = sorted(map(tuple, variants.one_gene_per_variant(first, key).collect()))
    assert got == sorted(map(tuple, every.collect())) and [r[3] for r in got] == ["A", "Y"]
