"""Reads: collapsing, plate keys, totals and the outcome of edits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locus.functions.sequence import cigar_bases, cigar_ops


def collapsed(reads: DataFrame, min_count: int = 1, keys=()) -> DataFrame:
    """seq, n, the quality of its last read and first_ord, of sequences with min_count reads."""
    out = reads.groupBy(*keys, "seq").agg(F.count(F.lit(1)).alias("n"), F.max_by("qual", "ord").alias("qual"), F.min("ord").alias("first_ord"))
    return out.filter(F.col("n") >= min_count)


def trimmed_reads(reads: DataFrame, leading: int = 20, adapter: str | None = None) -> DataFrame:
    """reads without their first bases and without what follows the adapter, from its first place on."""
    seq, qual = F.col("seq"), F.col("qual")
    if adapter:
        at = F.instr(seq, adapter)
        cut = lambda c: F.when(at > 0, F.substring(c, F.lit(1), at - 1)).otherwise(c)
        seq, qual = cut(seq), cut(qual)
    tail = lambda c: F.substring(c, F.lit(leading + 1), F.length(c))
    return reads.withColumns({"seq": tail(seq), "qual": tail(qual)})


def merged_pairs(pairs: DataFrame, min_overlap: int = 12) -> DataFrame:
    """pairs (r1, and r2 as the reverse complement of the second read) with merged: both over their longest
    exact overlap; null without one."""
    longest = F.least(F.length("r1"), F.length("r2"))
    sizes = F.sequence(longest, F.lit(min_overlap), F.lit(-1))
    fits = F.filter(sizes, lambda k: F.right(F.col("r1"), k) == F.left(F.col("r2"), k))
    k = F.get(fits, F.lit(0))
    merged = F.when((longest >= min_overlap) & k.isNotNull(), F.concat("r1", F.substring("r2", k + 1, F.length("r2"))))
    return pairs.withColumn("merged", merged)


def expand_grid(tables: list[DataFrame]) -> DataFrame:
    """Every combination of rows of small tables."""
    out = tables[0]
    for t in tables[1:]:
        out = out.crossJoin(t)
    return out


def keyfile(wells: DataFrame, plates: DataFrame, plasmids: DataFrame) -> DataFrame:
    """Wells with their plates and plasmids; inner joins on the columns that they share."""
    natural = lambda a, b: a.join(b, [c for c in a.columns if c in b.columns])
    return natural(natural(wells, plates), plasmids)


def samples_to_use(keys: DataFrame, out: tuple[int, ...] = (1, 2, *range(9, 22))) -> DataFrame:
    return keys.filter(~F.col("sample_number").isin(list(out)))


def totals(alignments: DataFrame, keys=("sample",)) -> DataFrame:
    """total_counts, the denominator of fractions: a line each, and the counts of mapped ones besides."""
    return alignments.groupBy(*keys).agg((F.count(F.lit(1)) + F.coalesce(F.sum(F.when(F.col("chrom") != "*", F.col("n"))), F.lit(0))).alias("total_counts"))


def _nearest(first: Column, bases: Column) -> Column:
    """The least distance from zero of first, first + 1, ... for so many bases."""
    last = first + bases - 1
    return F.when(first >= 0, first).when(last <= 0, -last).otherwise(0)


def walk(cigar: Column, pos: Column, pam: Column, donor_first: Column, donor_last: Column, seq: Column) -> Column:
    """What a CIGAR string says of an edit: a fold over its operations with places in reference and read."""
    far = F.lit(1000)
    texts = F.array().cast("array<string>")
    start = F.struct(
        F.lit(0).alias("at"), pos.cast("int").alias("ref"), F.lit(True).alias("perfect"), far.alias("indel_dist"), far.alias("mismatch_dist"), F.lit(False).alias("in_donor"),
        texts.alias("inserted"), F.array().cast("array<int>").alias("insertion_sites"), F.array().cast("array<int>").alias("deletion_sites"),
    )

    def step(s: Column, x: Column) -> Column:
        n, op = x["n"], x["op"]
        indel, mismatch = op.isin("I", "D"), op.isin("X", "M")
        near = _nearest(pam - s["ref"], n)
        overlap = F.greatest(s["ref"], donor_first + 1) <= F.least(s["ref"] + n - 1, donor_last - 1)
        return F.struct(
            (s["at"] + F.when(op.isin("S", "X", "M", "=", "I"), n).otherwise(0)).alias("at"),
            (s["ref"] + F.when(op.isin("X", "M", "=", "D"), n).otherwise(0)).alias("ref"),
            (s["perfect"] & ~indel & ~mismatch).alias("perfect"),
            F.when(indel, F.least(s["indel_dist"], near)).otherwise(s["indel_dist"]).alias("indel_dist"),
            F.when(mismatch, F.least(s["mismatch_dist"], near)).otherwise(s["mismatch_dist"]).alias("mismatch_dist"),
            (s["in_donor"] | ((indel | mismatch) & overlap)).alias("in_donor"),
            F.when(op == "I", F.array_append(s["inserted"], F.substring(seq, s["at"] + 1, n))).otherwise(s["inserted"]).alias("inserted"),
            F.when(op == "I", F.array_append(s["insertion_sites"], s["ref"])).otherwise(s["insertion_sites"]).alias("insertion_sites"),
            F.when(op == "D", F.array_append(s["deletion_sites"], s["ref"])).otherwise(s["deletion_sites"]).alias("deletion_sites"),
        )

    return F.aggregate(cigar_ops(cigar), start, step)


def edit_outcomes(alignments: DataFrame, keys=("sample",)) -> DataFrame:
    """Of alignments (keys, chrom, pos, cigar, seq, n) with their guide's PAM place (pam) and the donor's
    range: match, distances of indels and mismatches to the PAM, whether under 20 and so in the guide site,
    donor overlap, fraction of all reads, clipped and inserted bases and places. Unmapped ones go."""
    mapped = alignments.filter("chrom <> '*'").join(totals(alignments, keys), list(keys))
    w = mapped.withColumn("w", walk(F.col("cigar"), F.col("pos"), F.col("pam"), F.col("donor_first"), F.col("donor_last"), F.col("seq")))
    return w.select(
        *keys, "n", "chrom", F.col("w.perfect").alias("perfect_match"), "cigar", (F.col("w.indel_dist") < 20).alias("indel_in_guide"), F.col("w.indel_dist").alias("indel_distance"),
        (F.col("w.mismatch_dist") < 20).alias("mismatch_in_guide"), F.col("w.mismatch_dist").alias("mismatch_distance"), F.col("w.in_donor").alias("mismatch_in_donor"),
        (F.col("n") / F.col("total_counts")).alias("fraction"), cigar_bases("cigar", "S").alias("soft_clipped"), F.col("w.inserted").alias("inserted"),
        F.col("w.insertion_sites").alias("insertion_sites"), F.col("w.deletion_sites").alias("deletion_sites"), "seq",
    )
