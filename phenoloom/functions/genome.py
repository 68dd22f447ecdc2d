"""Loci, alleles and genotypes as column expressions."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sequence lengths of the two public human assemblies.
CONTIG_LENGTHS = {
    "GRCh37": {
        "1": 249250621, "2": 243199373, "3": 198022430, "4": 191154276, "5": 180915260,
        "6": 171115067, "7": 159138663, "8": 146364022, "9": 141213431, "10": 135534747,
        "11": 135006516, "12": 133851895, "13": 115169878, "14": 107349540, "15": 102531392,
        "16": 90354753, "17": 81195210, "18": 78077248, "19": 59128983, "20": 63025520,
        "21": 48129895, "22": 51304566, "X": 155270560, "Y": 59373566, "MT": 16569,
    },
    "GRCh38": {
        "chr1": 248956422, "chr2": 242193529, "chr3": 198295559, "chr4": 190214555, "chr5": 181538259,
        "chr6": 170805979, "chr7": 159345973, "chr8": 145138636, "chr9": 138394717, "chr10": 133797422,
        "chr11": 135086622, "chr12": 133275309, "chr13": 114364328, "chr14": 107043718, "chr15": 101991189,
        "chr16": 90338345, "chr17": 83257441, "chr18": 80373285, "chr19": 58617616, "chr20": 64444167,
        "chr21": 46709983, "chr22": 50818468, "chrX": 156040895, "chrY": 57227415, "chrM": 16569,
    },
}


def split_locus_alleles(df: DataFrame, drop_and_prefix: bool = False) -> DataFrame:
    """Add chrom, pos, ref, alt; or put them first in place of the key."""
    parts = {
        "chrom": F.col("contig"),
        "pos": F.col("pos"),
        "ref": F.get("alleles", F.lit(0)),
        "alt": F.get("alleles", F.lit(1)),
    }
    if not drop_and_prefix:
        return df.withColumns(parts)
    rest = [c for c in df.columns if c not in {"contig", "alleles", *parts}]
    return df.select(*[expr.alias(name) for name, expr in parts.items()], *rest)


def variant_id(contig: Column, pos: Column, alleles: Column) -> Column:
    """``contig:pos_ref/alt``."""
    return F.concat(
        contig, F.lit(":"), pos.cast("string"), F.lit("_"),
        F.get(alleles, F.lit(0)), F.lit("/"), F.get(alleles, F.lit(1)),
    )


def global_position(contig: Column, pos: Column, lengths: dict[str, int]) -> Column:
    """0-based position on the contigs laid end to end; NULL off the reference."""
    names = list(lengths)
    starts = [0, *accumulate(lengths.values())][:-1]
    offsets = F.create_map(*[F.lit(x) for pair in zip(names, starts) for x in pair])
    return F.try_element_at(offsets, contig) + pos.cast("long") - 1


def even_interval(position: Column, genome_size: int, n: int) -> Column:
    """Which of ``n`` equal genome slices a global position falls into."""
    width = int(genome_size / n) + 1
    return F.floor(position / F.lit(width)).cast("int")


def genotype_index(gt: Column) -> Column:
    """Rank of an unphased diploid call among all allele pairs."""
    high, low = F.array_max(gt), F.array_min(gt)
    return F.floor(high * (high + 1) / 2).cast("int") + low


def diploid(gt: Column) -> Column:
    """Haploid calls doubled, others unchanged."""
    return F.when(F.size(gt) == 1, F.array(gt[0], gt[0])).otherwise(gt)


def genotype_probabilities(gt: Column, n_alleles: Column) -> Column:
    """One-hot probabilities over the allele pairs; NULL for a missing call."""
    pairs = F.floor(n_alleles * (n_alleles + 1) / 2).cast("int")
    index = genotype_index(gt)
    hot = F.transform(F.sequence(F.lit(0), pairs - 1), lambda i: F.when(i == index, 1.0).otherwise(0.0))
    return F.when(gt.isNotNull(), hot)


def is_non_ref(gt: Column) -> Column:
    return F.exists(gt, lambda allele: allele > 0)
