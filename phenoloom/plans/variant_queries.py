"""Queries over variant, gene, genome and genotype operators."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import functions as F

from phenoloom.functions.consequence import (
    MISSENSE_TERMS,
    OTHER_TERMS,
    PLOF_TERMS,
    SEVERITY,
    SYNONYMOUS_TERMS,
    annotation_group,
    annotation_group_legacy,
    mac_category,
)
from phenoloom.functions.genome import (
    CONTIG_LENGTHS,
    even_interval,
    global_position,
    split_locus_alleles,
)
from phenoloom.operators import genotypes, variants
from phenoloom.plans.registry import query
from phenoloom.plans.views import with_views


def _terms(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _group_sql(lof: bool = True, strict: bool = False, term: str = "term") -> str:
    first = "WHEN lof = 'HC' THEN 'pLoF' WHEN lof = 'LC' THEN 'LC'" if lof else f"WHEN {term} IN {_terms(PLOF_TERMS)} THEN 'pLoF'"
    missense = ["missense_variant"] if strict else MISSENSE_TERMS
    synonymous = ["synonymous_variant"] if strict else SYNONYMOUS_TERMS
    return (
        f"CASE {first} WHEN {term} IN {_terms(missense)} THEN 'missense' WHEN {term} IN {_terms(synonymous)} THEN 'synonymous' "
        f"WHEN {term} IN {_terms(OTHER_TERMS)} THEN 'non-coding' END"
    )


_LEGACY_SQL = """CASE WHEN lof = 'HC' THEN 'pLoF' WHEN lof = 'LC' THEN 'LC'
    WHEN term IN ('missense_variant', 'inframe_insertion', 'inframe_deletion') THEN 'missense'
    WHEN term = 'synonymous_variant' THEN 'synonymous' END"""


@query(
    "C1_annotation_groups",
    with_views(
        f"""SELECT contig, pos, gene_id, term, lof, {_group_sql()} AS with_lof, {_group_sql(lof=False)} AS by_term,
        {_group_sql(strict=True)} AS strict,
        CASE WHEN lof = 'HC' THEN 'pLoF' WHEN lof = 'LC' THEN 'LC'
             WHEN term IN {_terms(MISSENSE_TERMS)} AND pos % 2 = 0 AND pos % 3 = 0 THEN 'damaging_missense'
             WHEN term IN {_terms(MISSENSE_TERMS)} THEN 'other_missense'
             WHEN term IN {_terms(SYNONYMOUS_TERMS)} THEN 'synonymous' WHEN term IN {_terms(OTHER_TERMS)} THEN 'non-coding' END AS predicted
        FROM transcripts""",
        "transcripts",
    ),
)
def c1(t):
    rows = t.transcripts.select("contig", "pos", F.inline("transcript_consequences"))
    term, lof = F.col("most_severe_consequence"), F.col("lof")
    polyphen = F.when(F.col("pos") % 2 == 0, "probably_damaging")
    sift = F.when(F.col("pos") % 3 == 0, "deleterious").otherwise("tolerated")
    return rows.select(
        "contig", "pos", "gene_id", term.alias("term"), "lof",
        annotation_group(term, lof).alias("with_lof"),
        annotation_group(term).alias("by_term"),
        annotation_group(term, lof, strict=True).alias("strict"),
        annotation_group(term, lof, polyphen=polyphen, sift=sift).alias("predicted"),
    )


@query(
    "C2_annotation_groups_legacy",
    with_views(f"SELECT contig, pos, gene_id, {_LEGACY_SQL} AS annotation FROM transcripts", "transcripts"),
)
def c2(t):
    rows = t.transcripts.select("contig", "pos", F.inline("transcript_consequences"))
    return rows.select(
        "contig", "pos", "gene_id",
        annotation_group_legacy(F.col("most_severe_consequence"), F.col("lof")).alias("annotation"),
    )


_MAC_SQL = """CASE WHEN ac IS NULL THEN NULL WHEN ac <= 5 THEN ac::DOUBLE WHEN ac <= 10 THEN 10 WHEN ac <= 20 THEN 20
    WHEN af <= 0.001::DOUBLE THEN 0.001 WHEN af <= 0.01::DOUBLE THEN 0.01 WHEN af <= 0.1::DOUBLE THEN 0.1 ELSE 0.99 END::DOUBLE"""


@query(
    "C3_mac_category",
    with_views(f"SELECT pos, line, ac, af, {_MAC_SQL} AS mac_category FROM call_stats", "call_stats"),
)
def c3(t):
    ac, af = F.col("call_stats.AC"), F.col("call_stats.AF")
    return t.call_stats.select("pos", "line", ac.alias("ac"), af.alias("af"), mac_category(ac, af).alias("mac_category"))


@query(
    "A19_mac_histogram",
    with_views(f"SELECT {_MAC_SQL} AS mac_category, count(*) AS n FROM call_stats GROUP BY 1", "call_stats"),
)
def a19(t):
    ac, af = F.col("call_stats.AC"), F.col("call_stats.AF")
    return variants.category_counts(t.call_stats.withColumn("mac_category", mac_category(ac, af)))


@query(
    "F1_stratified_sample",
    with_views(
        f""", usable AS (SELECT *, {_MAC_SQL} AS mac_category FROM call_stats
            WHERE contig::INTEGER <= 22 AND an >= 0.95::DOUBLE * 2000 AND ac > 0),
        sizes AS (SELECT mac_category, count(*) AS n FROM usable GROUP BY 1)
        SELECT contig, pos, line, mac_category FROM usable JOIN sizes USING (mac_category)
        WHERE (pos * 7919 + line * 104729) % 1000 / 1000.0::DOUBLE < (CASE WHEN mac_category >= 1 THEN 200 ELSE 1000 END) / n""",
        "call_stats",
    ),
)
def f1(t):
    def draw(pos, line):
        return (pos * 7919 + line * 104729) % 1000 / F.lit(1000.0)

    kept = variants.sample_for_plink(t.call_stats, 1000, per_mac=200, per_maf=1000, draw=draw, key=["pos", "line"])
    return kept.select("contig", "pos", "line", "mac_category")


@query(
    "F2_thinned_points",
    with_views(
        """, edge AS (SELECT min(quantity) AS x0, max(quantity) AS x1, min(tstat) AS y0, max(tstat) AS y1 FROM sumstats),
        cells AS (SELECT order_id, quantity, tstat, pos,
            least(floor((quantity - x0) / (x1 - x0) * 30), 29) AS cx, least(floor((tstat - y0) / (y1 - y0) * 30), 29) AS cy
            FROM sumstats, edge),
        first AS (SELECT *, row_number() OVER (PARTITION BY cx, cy ORDER BY order_id, pos, quantity, tstat) AS k FROM cells)
        SELECT quantity, tstat, order_id, pos FROM first WHERE k = 1""",
        "sumstats",
    ),
)
def f2(t):
    return variants.thin_points(t.sumstats, "quantity", "tstat", ["order_id", "pos"], n_divisions=30)


_WORST = f""", ranked AS (SELECT *, coalesce(list_position([{', '.join(f"'{s}'" for s in SEVERITY)}], term) - 1, {len(SEVERITY)}) AS rank
        FROM transcripts WHERE canonical = 1),
    worst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY contig, pos, gene_id, gene_symbol
        ORDER BY rank, canonical, term, lof NULLS FIRST) AS k FROM ranked) WHERE k = 1)"""


@query(
    "W2_worst_consequence_by_gene",
    with_views(_WORST + " SELECT contig, pos, gene_id, term, lof, rank::INTEGER AS rank FROM worst", "transcripts"),
)
def w2(t):
    worst = variants.worst_by_gene(t.transcripts, ["contig", "pos", "alleles"])
    return worst.select(
        "contig", "pos", "gene_id", F.col("most_severe_consequence").alias("term"), "lof", F.col("_rank").alias("rank")
    )


@query(
    "S12_annotated_variants",
    with_views(
        _WORST + f""" SELECT contig, pos, gene, annotation FROM (SELECT contig, pos, gene_symbol AS gene, {_group_sql()} AS annotation,
        row_number() OVER (PARTITION BY contig, pos ORDER BY rank, gene_id) AS first FROM worst) WHERE first = 1""",
        "transcripts",
    ),
)
def s12(t):
    key = ["contig", "pos", "alleles"]
    return variants.one_gene_per_variant(variants.annotate_variants(t.transcripts, key, first_gene=True), key).drop("alleles")


@query(
    "A18_gene_map_spans",
    with_views(
        _WORST + """ SELECT gene_id, gene_symbol, min(contig) AS contig, min(pos) AS start, max(pos) AS "end" FROM worst
        WHERE gene_id LIKE 'ENSG%' GROUP BY 1, 2""",
        "transcripts",
    ),
)
def a18(t):
    return variants.gene_map(t.transcripts)[0]


@query(
    "A18_gene_map_members",
    with_views(
        _WORST + f""" SELECT gene_id, gene_symbol, {_group_sql()} AS annotation, contig || ':' || pos || '_C/T' AS variant, af FROM worst
        WHERE gene_id LIKE 'ENSG%'""",
        "transcripts",
    ),
)
def a18_members(t):
    return variants.gene_map(t.transcripts, "af")[1]


@query(
    "A18_genes_on_several_contigs",
    with_views(
        _WORST + """ SELECT gene_id, gene_symbol, min(contig) AS first_contig, max(contig) AS last_contig FROM worst
        WHERE gene_id LIKE 'ENSG%' GROUP BY 1, 2 HAVING count(DISTINCT contig) > 1""",
        "transcripts",
    ),
)
def a18_check(t):
    return variants.genes_on_several_contigs(t.transcripts)


_GROUPS = """, members AS (SELECT gene_id, gene_symbol, """ + _group_sql() + """ AS part, contig || ':' || pos || '_C/T' AS variant, af
        FROM worst WHERE gene_id LIKE 'ENSG%'),
    grouped AS (SELECT gene_id, gene_symbol, g.name AS annotation, variant, af, gene_id || '_' || gene_symbol || '_' || g.name AS base
        FROM members JOIN (VALUES ('pLoF', 'pLoF'), ('missense|LC', 'missense'), ('missense|LC', 'LC'), ('pLoF|missense|LC', 'pLoF'),
            ('pLoF|missense|LC', 'missense'), ('pLoF|missense|LC', 'LC'), ('synonymous', 'synonymous'), ('missense', 'missense'))
        g(name, part) USING (part))"""


@query(
    "G1_gene_groups",
    with_views(
        _WORST + _GROUPS + " SELECT gene_id, gene_symbol, annotation, variant, base AS group_id FROM grouped", "transcripts"
    ),
)
def g1(t):
    return variants.gene_groups(variants.gene_map(t.transcripts)[1])


@query(
    "G1_gene_groups_by_frequency",
    with_views(
        _WORST + _GROUPS + """ SELECT gene_id, gene_symbol, annotation, af >= 0.08::DOUBLE AS common_variant, variant,
        CASE WHEN af >= 0.08::DOUBLE THEN base || '_' || variant ELSE base END AS group_id FROM grouped""",
        "transcripts",
    ),
)
def g1_frequency(t):
    return variants.gene_groups(variants.gene_map(t.transcripts, "af")[1], 0.08)


@query(
    "W1_genome_intervals",
    with_views(
        """, ordered AS (SELECT *, lag(end_pos) OVER w AS prev_end, lag(gene_id) OVER w AS prev_id, lag(gene_name) OVER w AS prev_name
            FROM genes WINDOW w AS (PARTITION BY contig ORDER BY start_pos, end_pos, gene_id)),
        gaps AS (SELECT *, prev_end + (start_pos - prev_end) // 2 AS middle FROM ordered WHERE start_pos > prev_end)
        SELECT contig, start_pos AS start, end_pos AS "end", gene_id, gene_name, true AS within_gene FROM genes
        UNION ALL SELECT contig, prev_end + 1, middle, prev_id, prev_name, false FROM gaps WHERE prev_end + 1 < middle
        UNION ALL SELECT contig, middle, start_pos, gene_id, gene_name, false FROM gaps WHERE middle < start_pos""",
        "genes",
    ),
)
def w1(t):
    return variants.genome_intervals(t.genes)


_POINTS = """points AS (SELECT 'Brand' || (l_suppkey % 25 + 1) AS contig, l_partkey * 100 + l_linenumber * 5 AS pos, l_orderkey AS order_id
    FROM lineitem)"""


def points(t):
    return t.lineitem.select(
        F.concat(F.lit("Brand"), (F.col("l_suppkey") % 25 + 1).cast("string")).alias("contig"),
        (F.col("l_partkey") * 100 + F.col("l_linenumber") * 5).alias("pos"),
        F.col("l_orderkey").alias("order_id"),
    )


@query(
    "J10_overlap_join",
    with_views(
        """SELECT p.contig, pos, order_id, gene_id FROM points p JOIN genes g ON p.contig = g.contig
        AND pos >= start_pos AND pos < end_pos""",
        "genes", extra=_POINTS,
    ),
)
def j10(t):
    genes = t.genes.select("contig", "start", "end", "gene_id")
    return variants.overlap_join(points(t), genes, bin_width=1000).select("contig", "pos", "order_id", "gene_id")


@query(
    "J10_filter_intervals",
    with_views(
        """SELECT contig, pos, order_id FROM points p WHERE EXISTS (SELECT 1 FROM genes g WHERE p.contig = g.contig
        AND pos >= start_pos - 300 AND pos < end_pos)""",
        "genes", extra=_POINTS,
    ),
)
def j10_filter(t):
    wide = t.genes.select("contig", F.greatest(F.col("start") - 300, F.lit(0)).alias("start"), "end")
    return variants.within_intervals(points(t), wide, bin_width=1000)


@query(
    "P3_split_locus_alleles",
    with_views(
        """SELECT contig AS chrom, pos, 'A' AS ref, 'G' AS alt, phenotype, order_id FROM sumstats""", "sumstats"
    ),
)
def p3(t):
    return split_locus_alleles(t.sumstats.select("contig", "pos", "alleles", "phenotype", "order_id"), True)


_LENGTHS = CONTIG_LENGTHS["GRCh37"]
_OFFSETS = ", ".join(f"('{c}', {o})" for c, o in zip(_LENGTHS, [0, *accumulate(_LENGTHS.values())]))


@query(
    "C8_even_intervals",
    f"""SELECT l_orderkey AS order_id, l_partkey AS part_id, ofs + l_orderkey * 100 % 40000000 AS global_pos,
        ((ofs + l_orderkey * 100 % 40000000) // {int(sum(_LENGTHS.values()) / 50) + 1})::INTEGER AS slice
    FROM lineitem JOIN (VALUES {_OFFSETS}) offsets(contig, ofs) ON contig = (l_partkey % 22 + 1)::VARCHAR""",
)
def c8(t):
    placed = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("part_id"),
        global_position(
            (F.col("l_partkey") % 22 + 1).cast("string"), F.col("l_orderkey") * 100 % 40000000 + 1, _LENGTHS
        ).alias("global_pos"),
    )
    return placed.withColumn("slice", even_interval(F.col("global_pos"), sum(_LENGTHS.values()), 50))


_SLICE = """, kept AS (SELECT * FROM genotypes WHERE adj AND contig IN ('chr1', 'chr2', 'chr3', 'chr4', 'chr5', 'chr6', 'chr7') AND pos < 1500),
    passing AS (SELECT contig, pos FROM kept GROUP BY 1, 2 HAVING count(*) FILTER (WHERE list_max(gt) > 0) > 0
        AND count(gt) / count(*) >= 0.6::DOUBLE)"""


def _slice(t):
    contigs = F.explode(F.array(*[F.lit(f"chr{i}") for i in range(1, 8)]))
    intervals = t.region.filter("r_regionkey = 0").select(
        contigs.alias("contig"), F.lit(0).alias("start"), F.lit(1500).alias("end")
    )
    return genotypes.slice_genotypes(t.genotypes, intervals, min_call_rate=0.6, bin_width=1000)


@query(
    "P16_genotype_slice",
    with_views(
        _SLICE + """ SELECT contig, pos, sample, array_to_string(gt, '/') AS gt,
        contig || ':' || pos || '_A/C' AS rsid FROM kept JOIN passing USING (contig, pos)""",
        "genotypes",
    ),
)
def p16(t):
    call = F.array_join(F.transform("GT", lambda a: a.cast("string")), "/")
    return _slice(t).select("contig", "pos", "sample", call.alias("gt"), "rsid")


_GP = """, doubled AS (SELECT *, CASE WHEN len(gt) = 1 THEN [gt[1], gt[1]] ELSE gt END AS g FROM genotypes),
    probs AS (SELECT contig, pos, sample, i, CASE WHEN g IS NOT NULL THEN
            (list_max(g) * (list_max(g) + 1) // 2 + list_min(g) = i)::INTEGER::DOUBLE END AS gp
        FROM doubled, range(0, 6) r(i) WHERE i < n_alleles * (n_alleles + 1) // 2)"""


@query(
    "P17_genotype_probabilities",
    with_views(_GP + " SELECT contig, pos, sample, i::INTEGER AS i, gp FROM probs WHERE gp IS NOT NULL", "genotypes"),
)
def p17(t):
    gp = genotypes.add_probabilities(t.genotypes)
    return gp.select("contig", "pos", "sample", F.posexplode("GP").alias("i", "gp"))


@query(
    "P18_impute_probabilities",
    with_views(
        _GP + """, means AS (SELECT contig, pos, i, avg(gp) AS mean FROM probs GROUP BY 1, 2, 3)
        SELECT contig, pos, sample, i::INTEGER AS i, round(coalesce(gp, mean), 6) AS gp FROM probs JOIN means USING (contig, pos, i)
        WHERE mean IS NOT NULL""",
        "genotypes",
    ),
)
def p18(t):
    filled = genotypes.impute_probabilities(genotypes.add_probabilities(t.genotypes))
    return filled.select("contig", "pos", "sample", F.posexplode("GP").alias("i", "gp")).withColumn("gp", F.round("gp", 6))


