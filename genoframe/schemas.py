"""Columns of the relations that operators take and return. Coordinates are 0-based and half-open unless stated."""

from pyspark.sql import types as T

_TYPES = {"s": T.StringType(), "i": T.LongType(), "d": T.DoubleType()}


def _schema(spec: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (x.split(":") for x in spec.split())])


#: Alignment records; tags de, cs and cg by name.
PAF = _schema("q_name:s q_len:i q_start:i q_end:i strand:s t_name:s t_len:i t_start:i t_end:i nmatch:i alnlen:i mapq:i de:d cs:s cg:s")
#: Chromosomes and their lengths.
FAI = _schema("chrom:s len:i")
#: Gene models.
BED6 = _schema("chrom:s start:i end:i gene:s score:s strand:s")
#: Anchor pairs within blocks, numbered in file order.
ANCHORS = _schema("block_id:i ord:i gene1:s gene2:s")
#: Pairs of syntenic intervals; t is the first sequence of a line, q the second.
COORDS = _schema("t:s t_start:i t_end:i q:s q_start:i q_end:i strand:s block:s")
WINDOWS = _schema("chrom:s start:i end:i")
#: Values of alignments along a chromosome.
SCORED_BED = _schema("chrom:s start:i end:i de:d")
#: Weighted values of chromosome pairs.
PAIR_WEIGHTS = _schema("id1:s id2:s weight:d value:d")
#: Single-base variants; both alleles as in the alignment.
VARIANTS = _schema("ref_contig:s ref_start:i ref_end:i ref_allele:s query_allele:s query_contig:s query_start:i query_end:i")
INDELS = _schema("op:s q_name:s q_start:i q_end:i t_name:s t_start:i t_end:i length:i")
KS = _schema("id1:s id2:s ks:d")
