"""Queries that write the tables in an external format and scan them back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenoloom.model import PHENO_KEY, MatrixFrame, pheno_key
from phenoloom.functions.keys import joined_key
from phenoloom.operators import icd, loading, logs, registry, results, variants
from phenoloom.plans import phenotype_queries as phenotypes
from phenoloom.plans.registry import query
from phenoloom.plans.result_queries import _MARKERS, _SINGLE, gene_scan, variant_scan
from phenoloom.plans.variant_queries import _GROUPS, _WORST
from phenoloom.plans.views import Tables, with_views
from phenoloom.scale import number_rows
from phenoloom.session import stage, staging_root
from phenoloom.sinks import writers
from phenoloom.sources import catalogue, readers


_CODES = ["AF", "AO", "NF", "NO", "RF", "RO"]


def folder(t: Tables) -> str:
    return f"{staging_root(t.spark).rstrip('/')}/text-{uuid.uuid4().hex}"


def delimited(df: DataFrame, path: str, sep: str = "\t", header: bool = True, **options) -> str:
    df.write.options(sep=sep, header=header, **{"nullValue": "", "emptyValue": "", **options}).csv(path)
    return path


def dictionary(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").cast("string").alias("FieldID"),
        F.concat_ws(", ", "p_name", "p_brand").alias("Field"),
        F.concat(F.lit('say "'), "p_type", F.lit('"')).alias("Notes"),
        F.col("p_brand").alias("Path"),
        F.lit("Continuous").alias("ValueType"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("Coding"),
    )


_DICTIONARY_SQL = """SELECT p_partkey::VARCHAR AS "FieldID", p_name || ', ' || p_brand AS "Field", 'say "' || p_type || '"' AS "Notes",
    p_brand AS "Path", 'Continuous' AS "ValueType", CASE WHEN p_size % 2 = 0 THEN p_size END AS "Coding" FROM part"""


@query("S1_read_dictionary", _DICTIONARY_SQL)
def s1(t):
    path = delimited(dictionary(t), folder(t) + ".csv", ",", quote='"', escape='"')
    return readers.read_dictionary(t.spark, path)


@query("S2_convert_dictionary", _DICTIONARY_SQL)
def s2(t):
    root = folder(t)
    source = delimited(dictionary(t), f"{root}/raw.csv", ",", quote='"', escape='"')
    readers.convert_dictionary(t.spark, source, f"{root}/dictionary.tsv")
    return readers.read_wide(t.spark, f"{root}/dictionary.tsv", {"Coding": "int"})


@query(
    "S3_read_codings",
    """SELECT n_regionkey AS coding_id, n_nationkey::VARCHAR AS coding, n_name AS meaning,
    CASE WHEN n_regionkey < 2 THEN (n_nationkey + 1)::VARCHAR END AS node_id, CASE WHEN n_regionkey < 2 THEN '0' END AS parent_id,
    CASE WHEN n_regionkey < 2 THEN 'Y' END AS selectable FROM nation""",
)
def s3(t):
    root = folder(t)
    for region in range(5):
        base = t.nation.filter(F.col("n_regionkey") == region).select(
            F.col("n_nationkey").cast("string").alias("coding"), F.col("n_name").alias("meaning")
        )
        if region < 2:
            base = base.withColumns(
                {"node_id": (F.col("coding").cast("int") + 1).cast("string"), "parent_id": F.lit("0"), "selectable": F.lit("Y")}
            )
        delimited(base, f"{root}/coding{region}.tsv")
    return readers.read_codings(t.spark, root)


@query(
    "S4_read_wide_text",
    f"""WITH {phenotypes._WIDE_SQL} SELECT user_id::INTEGER AS user_id, v0, n1::INTEGER AS n1, b2::VARCHAR AS b2 FROM wide""",
)
def s4(t):
    path = delimited(phenotypes.wide_orders(t), folder(t))
    wide = readers.read_wide(t.spark, path, {"userId": "int", "50_irnt": "double", "61": "int"})
    return wide.select(
        F.col("userId").alias("user_id"), F.col("`50_irnt`").alias("v0"), F.col("`61`").alias("n1"),
        F.col("`20002_102_x`").alias("b2"),
    )


@query(
    "S6_read_variant_info",
    """SELECT CASE WHEN l_suppkey % 3 = 0 THEN 'X' ELSE (l_suppkey % 3)::VARCHAR END AS contig,
    CASE WHEN l_suppkey % 3 = 0 THEN 'XY' ELSE (l_suppkey % 3)::VARCHAR END AS original_chromosome,
    l_partkey::INTEGER AS pos, l_discount AS maf, l_tax AS info, l_orderkey::VARCHAR AS rsid FROM lineitem""",
)
def s6(t):
    root = folder(t)
    for i, chromosome in enumerate(("XY", "1", "2")):
        rows = t.lineitem.filter(F.col("l_suppkey") % 3 == i).select(
            F.lit("id").alias("varid"), F.col("l_orderkey").cast("string").alias("rsid"), "l_partkey", F.lit("A").alias("ref"),
            F.lit("G").alias("alt"), "l_discount", F.lit("G").alias("minor"), "l_tax",
        )
        delimited(rows, f"{root}/mfi_chr{chromosome}.txt", header=False)
    return readers.read_variant_info(t.spark, f"{root}/mfi_chr*.txt").select(
        "contig", "original_chromosome", "pos", "maf", "info", "rsid"
    )


@query(
    "S7_read_variant_results",
    """SELECT 'chr' || (l_partkey % 22 + 1) || ':' || l_partkey || '_A/G' AS marker, l_linenumber AS ac, l_quantity AS beta,
    CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE (l_orderkey % 1000 + 1) / 1000.0::DOUBLE END AS p FROM lineitem""",
)
def s7(t):
    scan = variant_scan(t, False)
    missing = scan.withColumn("p.value", F.when(F.round(F.col("`p.value`") * 1000) % 10 != 1, F.col("`p.value`")))
    root = delimited(missing.drop(*PHENO_KEY), folder(t), " ", nullValue="NA")
    return readers.read_variant_results(t.spark, root, "csv").select(
        F.col("markerID").alias("marker"), F.col("AC").alias("ac"), F.col("BETA").alias("beta"), F.col("`p.value`").alias("p")
    )


@query(
    "S8_read_gene_results",
    """SELECT 'ENSG' || p_partkey || '_' || replace(p_brand, '#', '') || '_' || p_type || CASE WHEN p_partkey % 10 = 0 THEN '_x' ELSE '' END AS gene,
    p_size / 100.0::DOUBLE AS pvalue, CASE WHEN p_size % 2 <> 0 THEN p_size + 1 END AS n1 FROM part""",
)
def s8(t):
    root = delimited(gene_scan(t), folder(t), " ", nullValue="NA")
    return readers.read_gene_results(t.spark, root, "csv").select(
        F.col("Gene").alias("gene"), F.col("Pvalue").alias("pvalue"), F.col("Nmarker_MACCate_1").alias("n1")
    )


@query(
    "S9_read_gtf",
    with_views(
        """SELECT contig, start_pos::INTEGER AS start, end_pos::INTEGER AS "end", gene_id, gene_name, CASE WHEN start_pos % 300 = 0
        THEN 'lincRNA' ELSE 'protein_coding' END AS gene_type, 'T' || gene_id AS transcript_id FROM genes""",
        "genes",
    ),
)
def s9(t):
    quoted = F.concat(
        F.lit('gene_id "'), "gene_id", F.lit('.7"; transcript_id "T'), "gene_id", F.lit('.1"; gene_type "'),
        F.when(F.col("start") % 300 == 0, "lincRNA").otherwise("protein_coding"), F.lit('"; gene_name "'), "gene_name", F.lit('";'),
    )
    fields = ["contig", F.lit("X"), F.lit("gene"), F.col("start").cast("string"), F.col("end").cast("string"), F.lit("."), F.lit("+"), F.lit("."), quoted]
    path = folder(t)
    t.genes.select(F.concat_ws("\t", *fields).alias("value")).write.text(path)
    return readers.read_gtf(t.spark, path).select(
        F.col("seqname").alias("contig"), "start", "end", "gene_id", "gene_name", "gene_type", "transcript_id"
    )


@query(
    "W1_protein_coding_intervals",
    with_views(
        """, coding AS (SELECT * FROM genes WHERE start_pos % 300 <> 0),
        ordered AS (SELECT *, lag(end_pos) OVER (PARTITION BY contig ORDER BY start_pos, end_pos, gene_id) AS prev_end FROM coding)
        SELECT within_gene, count(*) AS n, sum(len)::BIGINT AS total FROM (
            SELECT true AS within_gene, end_pos - start_pos AS len FROM coding
            UNION ALL SELECT false, (start_pos - prev_end) // 2 - 1 FROM ordered WHERE (start_pos - prev_end) // 2 > 1
            UNION ALL SELECT false, (start_pos - prev_end) - (start_pos - prev_end) // 2 FROM ordered WHERE start_pos > prev_end)
        GROUP BY 1""",
        "genes",
    ),
)
def w1_protein_coding(t):
    kinds = F.when(F.col("start") % 300 == 0, "lincRNA").otherwise("protein_coding")
    gtf = t.genes.select(
        F.col("contig").alias("seqname"), F.lit("gene").alias("feature"), "start", "end", "gene_id", "gene_name", kinds.alias("gene_type")
    )
    regions = variants.genome_intervals(variants.protein_coding_genes(gtf))
    return regions.groupBy("within_gene").agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start")).alias("total"))


@query(
    "S10_finished_outputs",
    "SELECT l_orderkey AS order_id, l_quantity::DOUBLE AS value FROM lineitem WHERE l_returnflag <> 'R'",
)
def s10(t):
    root = folder(t)
    order = F.col("l_orderkey").alias("order_id")
    for flag, value in (("A", F.col("l_quantity").cast("int")), ("N", F.col("l_quantity"))):
        t.lineitem.filter(F.col("l_returnflag") == flag).select(order, value.alias("value")).write.parquet(
            f"{root}/{flag}/variant_results"
        )
    done = catalogue.finished_outputs(t.spark, [f"{root}/{f}" for f in "ANR"])
    return catalogue.read_and_union(t.spark, done)


@query(
    "J8_J9_matrix_of_finished_folders",
    """SELECT l_partkey AS pos, phenocode, n_cases, segment, count(*) AS n, max(l_quantity)::DOUBLE AS top,
        CASE WHEN phenocode LIKE 'A%' THEN NULL ELSE min(l_tax) END AS low
    FROM (SELECT *, l_returnflag || l_linestatus AS phenocode, ascii(l_returnflag)::INTEGER AS n_cases, l_linestatus AS segment FROM lineitem
        WHERE l_returnflag <> 'R') GROUP BY 1, 2, 3, 4""",
)
def matrix_of_folders(t):
    """Folders of per-phenotype results in two schemas, one of them not finished, as one annotated matrix."""
    root = folder(t)
    stats = t.lineitem.select(
        F.col("l_partkey").alias("pos"), F.concat("l_returnflag", "l_linestatus").alias("phenocode"),
        F.ascii("l_returnflag").alias("n_cases"), "l_quantity", "l_tax",
    ).groupBy("pos", "phenocode", "n_cases").agg(
        F.count("*").alias("n"), F.max("l_quantity").alias("top"), F.min("l_tax").alias("low")
    )
    for code in _CODES:
        own = stats.filter(F.col("phenocode") == code)
        own = own.drop("low").withColumn("top", F.col("top").cast("int")) if code.startswith("A") else own
        # Without a marker the write does not count as finished.
        own.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", code[0] != "R").parquet(f"{root}/{code}/variant_results")
    long = catalogue.read_and_union(t.spark, catalogue.finished_outputs(t.spark, f"{root}/*"))
    codes = t.lineitem.select(F.concat("l_returnflag", "l_linestatus").alias("phenocode"), F.col("l_linestatus").alias("segment")).distinct()
    annotated = results.union_with_phenotypes(long, codes, ["phenocode"], strict=True)
    matrix = results.results_matrix(annotated, ["pos"], ["phenocode"], ["n_cases", "segment"])
    return matrix.entries.join(matrix.cols, "phenocode")


@query(
    "S11_K1_matrix_round_trip",
    with_views("SELECT user_id, pheno, value FROM measures", "measures"),
)
def s11(t):
    entries = t.measures
    frame = MatrixFrame(entries.select("user_id").distinct(), entries.select("pheno").distinct(), entries, ["user_id"], ["pheno"])
    path = folder(t)
    writers.write_matrix(frame, path)
    again = writers.write_matrix(frame, path, overwrite=False)
    return again.with_(entries=readers_matrix(t, path).entries).entries


def readers_matrix(t: Tables, path: str) -> MatrixFrame:
    return writers.read_matrix(t.spark, path, ["user_id"], ["pheno"])


@query(
    "K2_export_tsv",
    with_views("SELECT user_id, pheno, value FROM measures", "measures"),
)
def k2(t):
    path = folder(t)
    writers.write_tsv(t.measures, path)
    schema = "user_id long, pheno string, value double"
    return t.spark.read.schema(schema).options(sep="\t", header=True, nullValue="NA").csv(path)


@query(
    "K3_export_phenotypes",
    with_views(
        """SELECT user_id, 'phecode-' || replace(pheno, '/', '_') || '-females--' AS export,
        CASE WHEN sex = 0 THEN 1.0::DOUBLE END AS value FROM cases LEFT JOIN samples ON user_id = "userId" """,
        "cases", "samples",
    ),
)
def k3(t):
    frame = phenotypes.case_matrix(t)
    path = folder(t)
    writers.write_phenotypes(frame, frame.cols.withColumn("pheno_sex", F.lit("females")).select(*PHENO_KEY), path)
    raw = t.spark.read.schema("userId long, value double, export string").options(sep="\t", header=True, nullValue="NA").csv(path)
    return raw.withColumnRenamed("userId", "user_id")


@query(
    "K4_qq_table",
    "SELECT 'chr1' AS \"CHR\", l_partkey AS \"BP\", (l_orderkey % 1000 + 1) / 1000.0::DOUBLE AS \"Pvalue\" FROM lineitem",
)
def k4(t):
    shaped = t.lineitem.select(
        F.lit("chr1").alias("contig"), F.col("l_partkey").alias("pos"), ((F.col("l_orderkey") % 1000 + 1) / F.lit(1000.0)).alias("Pvalue")
    )
    path = folder(t)
    writers.write_qq(shaped, path)
    return t.spark.read.schema("CHR string, BP long, Pvalue double").options(sep="\t", header=True, nullValue="NA").csv(path)


@query(
    "K5_group_file",
    with_views(
        _WORST + _GROUPS + " SELECT base || chr(9) || string_agg(variant, chr(9) ORDER BY variant) AS value FROM grouped GROUP BY base",
        "transcripts",
    ),
)
def k5(t):
    path = folder(t)
    writers.write_group_file(variants.gene_groups(variants.gene_map(t.transcripts)[1]), path)
    return t.spark.read.text(path)


@query(
    "K6_vcf_lines",
    with_views(
        """, samples_seen AS (SELECT DISTINCT sample FROM genotypes), variants_seen AS (SELECT DISTINCT contig, pos, n_alleles FROM genotypes)
        SELECT contig || chr(9) || pos || chr(9) || contig || ':' || pos || '_A/C' || chr(9) || 'A' || chr(9)
            || CASE WHEN n_alleles = 3 THEN 'C,G' ELSE 'C' END || chr(9) || '.' || chr(9) || '.' || chr(9) || '.' || chr(9) || 'GT' || chr(9)
            || string_agg(call, chr(9) ORDER BY sample) AS value
        FROM (SELECT v.contig, v.pos, v.n_alleles, s.sample, CASE WHEN g.sample IS NULL THEN './.'
                WHEN gt IS NULL THEN '0/0' ELSE array_to_string(gt, '/') END AS call
            FROM variants_seen v CROSS JOIN samples_seen s LEFT JOIN genotypes g ON g.contig = v.contig AND g.pos = v.pos AND g.sample = s.sample)
        GROUP BY contig, pos, n_alleles""",
        "genotypes",
    ),
)
def k6(t):
    path = folder(t)
    writers.write_vcf(t.genotypes, t.genotypes.select("sample").distinct(), path, compression="gzip")
    return t.spark.read.text(f"{path}/body")


@query(
    "K6_vcf_one_folder",
    with_views(
        """, lines AS (SELECT DISTINCT contig, pos FROM genotypes),
        ranked AS (SELECT *, row_number() OVER (ORDER BY replace(contig, 'chr', '')::INTEGER, contig, pos) + 2 AS n FROM lines)
        SELECT n, contig || ':' || pos AS place FROM ranked
        UNION ALL SELECT 0, '##fileformat=VCFv4.2' UNION ALL SELECT 1, '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">'
        UNION ALL SELECT 2, '#CHROM:' || (SELECT 9 + count(DISTINCT sample) FROM genotypes)""",
        "genotypes",
    ),
)
def k6_one(t):
    """Every line of the written folder by its place in file order: header first, chr2 before chr10."""
    path = folder(t)
    writers.write_vcf(t.genotypes, t.genotypes.select("sample").distinct(), path, layout="one", compression="gzip")
    lines = readers.read_lines(t.spark, path)
    parts = F.split("value", "\t", 3)
    place = F.when(F.col("value").startswith("##"), F.col("value")).when(
        F.col("value").startswith("#"), F.concat_ws(":", parts[0], F.size(F.split("value", "\t")).cast("string"))
    ).otherwise(F.concat_ws(":", parts[0], F.get(parts, F.lit(1))))
    # A line is as long as the cohort, so it is read once and only its place is numbered.
    short = stage(lines.select("file", "block", "line", place.alias("place")))
    placed = number_rows(short, [], ["file", "block", "line"], "at")
    return placed.select((F.col("at") - 1).alias("n"), "place")


_SPANS = """, spans AS (SELECT gene_id, gene_symbol, min(contig) AS contig, min(pos) AS start, max(pos) AS "end" FROM worst
        WHERE gene_id LIKE 'ENSG%' GROUP BY 1, 2)
    SELECT contig, start, "end", gene_id, gene_symbol, annotation, variant, base AS group_id FROM grouped JOIN spans USING (gene_id, gene_symbol)"""


def keyed_groups(t: Tables) -> str:
    genes, members = variants.gene_map(t.transcripts)
    path = folder(t)
    writers.write_gene_groups(genes, variants.gene_groups(members), path, bin_width=10_000)
    return path


@query("G1_groups_of_region", with_views(_WORST + _GROUPS + _SPANS + " WHERE contig = 'chr3' AND start >= 2000 AND start < 120000", "transcripts"))
def groups_of_region(t):
    return readers.read_groups_of_region(t.spark, keyed_groups(t), "chr3", 2000, 120000).drop("bin")


@query(
    "G1_groups_of_gene",
    with_views(_WORST + _GROUPS + _SPANS + " WHERE gene_symbol = (SELECT min(gene_symbol) FROM spans)", "transcripts"),
)
def groups_of_gene(t):
    path = keyed_groups(t)
    symbol = t.spark.read.parquet(f"{path}/genes").agg(F.min("gene_symbol")).first()[0]
    return readers.read_groups_of_gene(t.spark, path, symbol).drop("bin")


@query(
    "S_log_text_scan",
    with_views("SELECT count(DISTINCT k) AS n_lines, min(n::VARCHAR) AS lowest FROM log_facts", "log_facts"),
)
def log_scan(t):
    path = folder(t)
    t.orders.select(
        F.concat_ws("\t", F.col("o_orderkey").cast("string"), (F.col("o_custkey") % 1000).cast("string")).alias("value")
    ).write.text(path)
    lines = readers.read_lines(t.spark, path)
    parts = F.split("value", "\t")
    return logs.with_next_lines(lines).agg(F.count_distinct(parts[0]).alias("n_lines"), F.min(parts[1]).alias("lowest"))


@query(
    "load_prescriptions_text",
    """SELECT user_id::INTEGER AS eid, event_type AS generic, count(*) AS n_records, min(epoch(date_trunc('day', ts)))::BIGINT AS first_date
    FROM events WHERE event_type <> 'error' GROUP BY 1, 2""",
)
def load_prescriptions(t):
    root = folder(t)
    rows = t.events.select(
        F.col("user_id").alias("eid"), F.lit(1).alias("data_provider"), F.col("event_type").alias("drug_name"),
        F.date_format("ts", "dd/MM/yyyy").alias("issue_date"),
    )
    mapping = t.events.select("event_type").distinct().select(
        F.col("event_type").alias("Original_Prescription"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("Generic_Name"),
        F.lit("any").alias("Drug_Category_and_Indication"),
    )
    delimited(rows, f"{root}/prescriptions")
    delimited(mapping, f"{root}/map")
    records = registry.prescription_records(
        readers.read_prescriptions(t.spark, f"{root}/prescriptions"), readers.read_prescription_map(t.spark, f"{root}/map")
    )
    return registry.prescription_matrix(records).entries.select(
        "eid", F.col("Generic_Name").alias("generic"), "n_records", "first_date"
    )




_LOADED = """, totals AS (SELECT l_returnflag || l_linestatus AS phenocode, count(*) AS n FROM lineitem GROUP BY 1),
    facts AS (SELECT phenocode, n::INTEGER AS n_cases, (2 * n)::INTEGER AS n_controls, round(0.5 / (0.5 + pi() ** 2 / 3), 6) AS heritability,
        'SAIGE_0.' || (n % 50) AS saige_version, CASE WHEN n % 2 = 0 THEN 'True' ELSE 'False' END AS inv_normalized FROM totals),
    kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY contig, pos, phenocode ORDER BY
        CASE WHEN phenocode LIKE 'N%' THEN l_quantity ELSE l_linenumber END, l_discount, l_quantity, p) AS k FROM single) WHERE k = 1)
    SELECT 'variant' AS kind, contig || ':' || pos AS id, k.phenocode, p AS pvalue, p_brand AS gene, p_type AS annotation,
        CASE WHEN k.phenocode LIKE 'N%' THEN NULL ELSE l_linenumber::INTEGER END AS ac, n_cases, n_controls, heritability, saige_version, inv_normalized
    FROM kept k JOIN facts f ON f.phenocode = k.phenocode LEFT JOIN part ON p_partkey = l_partkey
    UNION ALL SELECT 'gene', 'ENSG' || p_partkey, f.phenocode, p_size / 100.0::DOUBLE, replace(p_brand, '#', ''), p_type,
        (MARKERS)::INTEGER, n_cases, n_controls, heritability, saige_version, inv_normalized
    FROM part JOIN facts f ON f.phenocode = (['AF', 'AO', 'NF', 'NO', 'RF', 'RO'])[p_partkey % 6 + 1] WHERE p_partkey % 10 <> 0""".replace("MARKERS", _MARKERS)


@query("load_results_main", "WITH dummy AS (SELECT 1)" + _SINGLE + _LOADED)
def load_results_main(t):
    """Result folders of six phenotypes in two header shapes, their logs, and the load of all."""
    root = folder(t)
    counts = t.lineitem.groupBy(*pheno_key("icd10", F.concat("l_returnflag", "l_linestatus"))).agg(F.count("*").alias("n"))
    phenotypes = counts.select(*PHENO_KEY, joined_key(counts).alias("file"), "n")
    lines = {
        "model": [
            F.lit("Final 1 0.5 end"), F.lit("other attached packages:"), F.concat(F.lit("[1] SAIGE_0."), (F.col("n") % 50).cast("string")),
            F.lit("$invNormalize"), F.when(F.col("n") % 2 == 0, "[1] TRUE").otherwise("[1] FALSE"),
        ],
        "test": [F.concat_ws(" ", F.lit("Analyzing"), F.col("n").cast("string"), F.lit("cases and"), (2 * F.col("n")).cast("string"), F.lit("controls"))],
    }
    read = {}
    for kind, texts in lines.items():
        # One log per phenotype, its lines in order.
        exploded = phenotypes.select("file", F.posexplode(F.array(*texts)).alias("at", "value"))
        exploded.repartitionByRange("file", "at").sortWithinPartitions("file", "at").select("file", "value").write.partitionBy("file").text(f"{root}/{kind}")
        name = F.regexp_extract("file", "/file=([^/]+)/", 1)
        read[kind] = readers.read_lines(t.spark, f"{root}/{kind}").withColumn("file", name)
    tests = read["test"].join(phenotypes.drop("n"), "file").withColumn("chrom", F.lit(10))
    genes = gene_scan(t)
    number = F.regexp_extract("Gene", r"ENSG(\d+)_", 1).cast("int")
    for i, code in enumerate(_CODES):
        place = f"{root}/results/icd10-{code}-both_sexes--"
        single = variant_scan(t, code.startswith("N")).filter(F.col("phenocode") == code).drop(*PHENO_KEY)
        delimited(single, f"{place}/all.single.txt", " ", nullValue="NA")
        delimited(genes.filter(number % 6 == i), f"{place}/all.gene.txt", " ", nullValue="NA")
    contig = F.concat(F.lit("chr"), (F.col("p_partkey") % 22 + 1).cast("string"))
    annotation = t.part.select(
        contig.alias("contig"), F.col("p_partkey").cast("int").alias("pos"), F.array(F.lit("A"), F.lit("G")).alias("alleles"),
        F.col("p_brand").alias("gene"), F.col("p_type").alias("annotation"),
    )
    intervals = t.part.select(F.concat(F.lit("ENSG"), F.col("p_partkey").cast("string")).alias("gene_id"), F.col("p_size").alias("interval"))
    out = loading.load_association_results(
        t.spark, f"{root}/results", phenotypes.drop("n"), loading.metadata_from_logs(tests, read["model"], phenotypes.drop("n")),
        f"{root}/loaded", annotation, intervals,
    )
    facts = ["n_cases", "n_controls", F.round("heritability", 6).alias("heritability"), "saige_version", "inv_normalized"]
    single = out["variant_results"].select(
        F.lit("variant").alias("kind"), F.concat_ws(":", "contig", F.col("pos").cast("string")).alias("id"), "phenocode",
        F.col("Pvalue").alias("pvalue"), "gene", "annotation", F.col("AC").alias("ac"), *facts,
    )
    gene = out["gene_results"].select(
        F.lit("gene").alias("kind"), F.col("gene_id").alias("id"), "phenocode", F.col("Pvalue").alias("pvalue"),
        F.col("gene_symbol").alias("gene"), "annotation", F.col("total_variants").alias("ac"), *facts,
    )
    return single.unionByName(gene)


_ICD_TEXT = """SELECT user_id, icd_code, false AS truncated, p AS primary_codes, s AS secondary_codes, e AS external_codes,
        d AS cause_of_death_codes, 'meaning of ' || icd_code AS meaning FROM icd
    UNION ALL SELECT user_id, icd_code, true, p, s, e, d, 'meaning of ' || icd_code FROM rolled"""


@query("load_icd_data", with_views(_ICD_TEXT, "codes", extra=phenotypes._ROLLUP))
def load_icd_data(t):
    """Diagnosis codes from the wide text and the coding file: matrix, roll-up and meanings."""
    root = folder(t)
    found = t.codes.groupBy("userId").agg(
        *[F.sort_array(F.collect_list(F.when(F.col("source") == s, F.col("icd_code")))).alias(s) for s in icd.ICD10_FIELDS]
    )
    width = found.agg(F.max(F.greatest(*[F.size(s) for s in icd.ICD10_FIELDS]))).first()[0]
    wide = found.select(
        "userId", *[F.get(s, F.lit(i)).alias(f"x{field}_0_{i}") for s, field in icd.ICD10_FIELDS.items() for i in range(width)]
    )
    delimited(wide, f"{root}/wide")
    every = t.codes.select("icd_code").distinct()
    every = every.unionByName(every.select(F.substring("icd_code", 1, 3).alias("icd_code"))).distinct()
    number = F.lit(None).cast("int")
    coding = every.select(
        F.col("icd_code").alias("coding"), F.concat(F.lit("meaning of "), "icd_code").alias("meaning"),
        number.alias("node_id"), number.alias("parent_id"), F.lit("Y").alias("selectable"),
    )
    delimited(coding, f"{root}/coding19.tsv", nullValue="NA")
    table = readers.read_wide(t.spark, f"{root}/wide", {"userId": "bigint"})
    codings = readers.read_icd_codings(t.spark, f"{root}/coding19.tsv").select("coding", "meaning")
    frame = icd.load_icd(table, codings)
    joined = frame.entries.join(frame.cols.select(*frame.col_key, "meaning"), list(frame.col_key))
    return joined.select(F.col("userId").alias("user_id"), "icd_code", "truncated", *icd.ICD10_FIELDS, "meaning")


@query(
    "load_metadata_main",
    """SELECT 'field' AS kind, p_partkey::VARCHAR AS key, p_name || ', ' || p_brand AS value FROM part
    UNION ALL SELECT 'coding', n_regionkey || ':' || n_nationkey, n_name FROM nation
    UNION ALL SELECT 'icd10', 'N' || n_nationkey, r_name || ' | ' || n_name FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT 'icd10', 'R' || r_regionkey, r_name FROM region""",
)
def load_metadata_main(t):
    """The dictionary, all codings and the full meanings of a code tree, from their files to tables."""
    root = folder(t)
    delimited(dictionary(t), f"{root}/raw.csv", ",", quote='"', escape='"')
    for region in range(5):
        own = t.nation.filter(F.col("n_regionkey") == region)
        delimited(own.select(F.col("n_nationkey").cast("string").alias("coding"), F.col("n_name").alias("meaning")), f"{root}/codings/coding{region}.tsv")
    tree = t.region.select(
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("coding"), F.col("r_name").alias("meaning"),
        (F.col("r_regionkey") + 1000).alias("node_id"), F.lit(0).cast("long").alias("parent_id"), F.lit("N").alias("selectable"),
    ).unionByName(t.nation.select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("coding"), F.col("n_name").alias("meaning"),
        (F.col("n_nationkey") + 1).alias("node_id"), (F.col("n_regionkey") + 1000).alias("parent_id"), F.lit("Y").alias("selectable"),
    ))
    delimited(tree, f"{root}/tree/coding19.tsv", nullValue="NA")
    loading.load_phenotype_metadata(t.spark, f"{root}/raw.csv", f"{root}/codings", {"icd10": f"{root}/tree/coding19.tsv"}, f"{root}/out")
    fields = readers.read_dictionary(t.spark, f"{root}/out/dictionary.tsv").select(
        F.lit("field").alias("kind"), F.col("FieldID").alias("key"), F.col("Field").alias("value")
    )
    codes = t.spark.read.parquet(f"{root}/out/codings").select(
        F.lit("coding").alias("kind"), F.concat_ws(":", F.col("coding_id").cast("string"), "coding").alias("key"), F.col("meaning").alias("value")
    )
    full = t.spark.read.parquet(f"{root}/out/icd10_codings").select(F.lit("icd10").alias("kind"), F.col("coding").alias("key"), F.col("meaning").alias("value"))
    return fields.unionByName(codes).unionByName(full)


_COVID_CELLS = """, sampled AS (SELECT c_custkey AS eid, 11000 + c_nationkey AS center, origin, inpatient, result, death FROM customer LEFT JOIN status ON c_custkey = eid),
    analyses AS (SELECT eid, 'A2_v2' AS coding, coalesce(death, false) AS v FROM sampled
        UNION ALL SELECT eid, 'B1_v2', CASE WHEN result THEN inpatient END FROM sampled
        UNION ALL SELECT eid, 'B1_v2_origin', CASE WHEN result THEN origin END FROM sampled
        UNION ALL SELECT eid, 'C2_v2', coalesce(result, false) FROM sampled
        UNION ALL SELECT eid, 'C2_v2_england_controls', CASE WHEN center IN (CENTERS) THEN coalesce(result, false) END FROM sampled
        UNION ALL SELECT eid, 'C1_v2', result FROM sampled
        UNION ALL SELECT eid, 'B2_v2', coalesce(result AND inpatient, false) FROM sampled
        UNION ALL SELECT eid, 'B2_v2_origin', coalesce(result AND origin, false) FROM sampled),
    counts AS (SELECT coding, count(*) FILTER (WHERE v) AS n_cases, count(*) FILTER (WHERE NOT v) AS n_controls FROM analyses GROUP BY 1)
    SELECT eid::INTEGER AS eid, coding, v::INTEGER::DOUBLE AS value, n_cases, n_controls FROM analyses JOIN counts USING (coding)""".replace(
    "CENTERS", ", ".join(map(str, registry.ENGLAND_CENTERS))
)


@query("load_covid_data", f"WITH {phenotypes._COVID_SQL.format(days=30)}" + _COVID_CELLS)
def load_covid_data(t):
    """The registers and the sample list from their text files to the analysis matrix."""
    root = folder(t)
    schemas = [readers.COVID_TESTS, readers.HES_MAIN, readers.HES_DIAG, readers.DEATHS]
    registers = []
    for name, table, schema in zip(("tests", "main", "diag", "deaths"), phenotypes.covid_inputs(t), schemas):
        delimited(table, f"{root}/{name}")
        registers.append(readers.read_register(t.spark, f"{root}/{name}", schema))
    people = t.customer.select(F.col("c_custkey").alias("eid"), (F.col("c_nationkey") + 11000).alias("recruitment_center"))
    delimited(people, f"{root}/samples")
    samples = readers.read_wide(t.spark, f"{root}/samples", {"eid": "int", "recruitment_center": "int"})
    frame = registry.covid_matrix(samples, registry.covid_status(*registers))
    return frame.entries.join(frame.cols, PHENO_KEY).select("eid", "coding", "value", "n_cases", "n_controls")
