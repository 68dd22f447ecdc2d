"""Consequence grouping and frequency categories as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Consequence terms of the public sequence-ontology vocabulary,
# grouped as the annotation rules need them.
PLOF_TERMS = [
    "transcript_ablation",
    "splice_acceptor_variant",
    "splice_donor_variant",
    "stop_gained",
    "frameshift_variant",
]
MISSENSE_TERMS = [
    "stop_lost",
    "start_lost",
    "transcript_amplification",
    "inframe_insertion",
    "inframe_deletion",
    "missense_variant",
]
SYNONYMOUS_TERMS = ["stop_retained_variant", "synonymous_variant"]
OTHER_TERMS = [
    "mature_miRNA_variant",
    "5_prime_UTR_variant",
    "3_prime_UTR_variant",
    "non_coding_transcript_exon_variant",
    "intron_variant",
    "NMD_transcript_variant",
    "non_coding_transcript_variant",
    "upstream_gene_variant",
    "downstream_gene_variant",
    "TFBS_ablation",
    "TFBS_amplification",
    "TF_binding_site_variant",
    "regulatory_region_ablation",
    "regulatory_region_amplification",
    "feature_elongation",
    "regulatory_region_variant",
    "feature_truncation",
    "intergenic_variant",
]

# Terms from most to least severe, after the public ranking of
# the variant effect predictor.
SEVERITY = [
    "transcript_ablation",
    "splice_acceptor_variant",
    "splice_donor_variant",
    "stop_gained",
    "frameshift_variant",
    "stop_lost",
    "start_lost",
    "transcript_amplification",
    "feature_elongation",
    "feature_truncation",
    "inframe_insertion",
    "inframe_deletion",
    "missense_variant",
    "protein_altering_variant",
    "splice_region_variant",
    "incomplete_terminal_codon_variant",
    "stop_retained_variant",
    "synonymous_variant",
    "coding_sequence_variant",
    "mature_miRNA_variant",
    "5_prime_UTR_variant",
    "3_prime_UTR_variant",
    "non_coding_transcript_exon_variant",
    "intron_variant",
    "NMD_transcript_variant",
    "non_coding_transcript_variant",
    "upstream_gene_variant",
    "downstream_gene_variant",
    "TFBS_ablation",
    "TFBS_amplification",
    "TF_binding_site_variant",
    "regulatory_region_ablation",
    "regulatory_region_amplification",
    "regulatory_region_variant",
    "intergenic_variant",
]


def severity_rank(term: Column) -> Column:
    """0 for the most severe term; unknown terms rank last."""
    position = F.array_position(F.array(*[F.lit(t) for t in SEVERITY]), term)
    return F.when(position > 0, position - 1).otherwise(len(SEVERITY)).cast("int")


def annotation_group(
    term: Column,
    lof: Column | None = None,
    *,
    polyphen: Column | None = None,
    sift: Column | None = None,
    strict: bool = False,
) -> Column:
    """pLoF / LC / missense / synonymous / non-coding, else NULL.

    With ``lof`` the loss-of-function call decides pLoF and LC, without it the
    term does. With ``polyphen`` and ``sift`` missense is split into damaging
    and other.
    """
    missense = term == "missense_variant" if strict else term.isin(MISSENSE_TERMS)
    synonymous = term == "synonymous_variant" if strict else term.isin(SYNONYMOUS_TERMS)
    if lof is not None:
        rule = F.when(lof == "HC", "pLoF").when(lof == "LC", "LC")
    else:
        rule = F.when(term.isin(PLOF_TERMS), "pLoF")
    if polyphen is not None and sift is not None:
        all_missense = term.isin(MISSENSE_TERMS)
        damaging = (polyphen == "probably_damaging") & (sift == "deleterious")
        rule = rule.when(all_missense & damaging, "damaging_missense").when(all_missense, "other_missense")
    else:
        rule = rule.when(missense, "missense")
    return rule.when(synonymous, "synonymous").when(term.isin(OTHER_TERMS), "non-coding")


def annotation_group_legacy(term: Column, lof: Column) -> Column:
    """The older, narrower grouping."""
    return (
        F.when(lof == "HC", "pLoF")
        .when(lof == "LC", "LC")
        .when(term.isin("missense_variant", "inframe_insertion", "inframe_deletion"), "missense")
        .when(term == "synonymous_variant", "synonymous")
    )


def mac_category(ac: Column, af: Column) -> Column:
    """Allele-count class up to 20, allele-frequency class above; missing counts have none."""
    rule = F.when(ac.isNull(), F.lit(None).cast("double")).when(ac <= 5, ac.cast("double"))
    for bound in (10, 20):
        rule = rule.when(ac <= bound, float(bound))
    for bound in (0.001, 0.01, 0.1):
        rule = rule.when(af <= bound, bound)
    return rule.when(ac.isNotNull() & af.isNotNull(), 0.99)
