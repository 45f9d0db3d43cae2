"""Guides beside PAMs: search in a genome, screens, and joins to scores, frames and edits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locus.functions.sequence import COMPLEMENT_IUPAC, hamming_to, has_site, reverse_complement, substr0
from locus.operators.intervals import stab
from locus.operators.motifs import windows


def complement_text(seq: str) -> str:
    return seq[::-1].translate(str.maketrans(*COMPLEMENT_IUPAC))


def find_guides(genome: DataFrame, pam: str = "NGG", length: int = 20, pam_after: bool = True, flank: tuple[int, int] = (4, 3)) -> DataFrame:
    """chrom, pam_strand, pam_first (the lowest base of the PAM, from 0), pam, guide and target (with ``flank``
    bases before the guide and after the PAM) of each PAM on either strand with a whole guide beside it."""
    n, (before, after) = len(pam), flank
    reach = length + before + after
    wide = n + 2 * reach
    # the PAM stands in the middle of a window; sequences are padded so that those at the ends have one too
    pad = F.lit("." * reach)
    places = windows(genome.withColumn("seq", F.concat(pad, F.upper("seq"), pad)), wide, last=True)
    mid = F.substring("kmer", reach + 1, n)
    low, high = F.substring("kmer", reach + 1 - length, length), F.substring("kmer", reach + n + 1, length)
    up = F.substring("kmer", reach + 1 - length - before, length + before + n + after) if pam_after else F.substring("kmer", reach + 1 - after, after + n + length + before)
    down = F.substring("kmer", reach + 1 - after, after + n + length + before) if pam_after else F.substring("kmer", reach + 1 - length - before, length + before + n + after)
    rc = lambda c: reverse_complement(c, iupac=True)
    plus = F.struct(F.lit("+").alias("pam_strand"), mid.alias("pam"), (low if pam_after else high).alias("guide"), up.alias("target"))
    minus = F.struct(F.lit("-").alias("pam_strand"), rc(mid).alias("pam"), rc(high if pam_after else low).alias("guide"), rc(down).alias("target"))
    rows = places.select("chrom", F.col("mstart").alias("pam_first"), F.explode(F.array(plus, minus)).alias("x")).select("chrom", "pam_first", "x.*")
    return rows.filter((hamming_to(pam, "pam") == 0) & ~F.contains(F.col("guide"), F.lit(".")))


def screened(guides: DataFrame, most_t: int = 4, sites: list[str] | None = None, excluded: DataFrame | None = None, disallowed: DataFrame | None = None) -> DataFrame:
    """Guides without a longer run of T, a site, or a place in either list (guide; chrom, pam_first, pam_strand)."""
    out = guides.filter(~F.contains(F.col("guide"), F.lit("T" * (most_t + 1))))
    out = out.filter(~has_site("guide", sites)) if sites else out
    out = out.join(excluded.select("guide"), "guide", "left_anti") if excluded is not None else out
    return out.join(disallowed.select("chrom", "pam_first", "pam_strand"), ["chrom", "pam_first", "pam_strand"], "left_anti") if disallowed is not None else out


def scored_guides(guides: DataFrame, orfs: DataFrame, scores: DataFrame, t_run: int = 6, late_t: tuple[int, int] = (4, 6), sites: tuple[str, ...] = ("GGCGCGCC", "GCGGCCGC", "GCTCTTC"), prefix: str = "CGCC", suffix: str = "GTTT", most: tuple[int, int, int] = (0, 0, 0), flank: int = 20, length: int = 20, pam_length: int = 3) -> DataFrame:
    """Guides around ORFs (orf, chrom, first, last): no run of T, at most late_t[0] of T in the last late_t[1]
    bases, no site (or its complement) with what goes before and after, and few enough near targets by the
    scores of their targets (aseq, m0, m1, m2). Guides without a score are dropped."""
    reach = length + pam_length + flank
    spans = orfs.select("orf", "chrom", (F.col("first") - reach).alias("__a"), (F.col("last") + reach - 1).alias("__b"))
    near = stab(guides, "pam_first", spans, "__a", "__b", keys=("chrom",)).drop("__a", "__b")
    whole = F.concat(F.lit(prefix), "guide", F.lit(suffix))
    bad = has_site(whole, [x for s in sites for x in (s, complement_text(s))])
    late = F.regexp_count(F.right("guide", F.lit(late_t[1])), F.lit("T"))
    kept = near.filter(~bad & ~F.contains(F.col("guide"), F.lit("T" * t_run)) & (late <= late_t[0]))
    few = (F.col("m0") <= most[0]) & (F.col("m1") <= most[1]) & (F.col("m2") <= most[2])
    return kept.join(scores.select(F.col("aseq").alias("target"), "m0", "m1", "m2"), "target").filter(few)


def proximal_guides(codons: DataFrame, guides: DataFrame, reach: int = 49, start: int = 20, most: int = 10, t_run: int = 6) -> DataFrame:
    """For each codon (key, chrom, strand, coord, upstream) the first ``most`` guides on each strand in the
    order of a walk that begins ``start`` bases behind the codon and goes on ``reach`` bases past it, upstream
    or downstream as the gene reads; rank is their place."""
    down = (F.col("strand") == "+") == F.col("upstream")  # the walk goes to lower places
    first = F.when(down, F.col("coord") - reach + 1).otherwise(F.col("coord") - start)
    spans = codons.withColumns({"__a": first, "__b": F.when(down, F.col("coord") + start).otherwise(F.col("coord") + reach - 1)})
    own = guides.filter(~F.contains(F.col("guide"), F.lit("T" * t_run)))
    near = stab(own, "pam_first", spans, "__a", "__b", keys=("chrom",)).drop("__a", "__b")
    step = F.when((F.col("strand") == "+") == F.col("upstream"), -F.col("pam_first")).otherwise(F.col("pam_first"))
    rank = F.row_number().over(Window.partitionBy("key", "pam_strand").orderBy(step))
    return near.withColumn("rank", rank).filter(F.col("rank") <= most)


def guides_for_edits(edits: DataFrame, guides: DataFrame, reach: int = 120, seed: int = 3) -> DataFrame:
    """For each edit (key, chrom, strand, left, right, mid) guides with the PAM in [left - reach, right +
    reach), the nearest to the middle first: distance has a sign in the direction of the gene. ``guides``
    have pam_coord."""
    spans = edits.withColumns({"__a": F.col("left") - reach, "__b": F.col("right") + reach - 1})
    near = stab(guides, "pam_coord", spans, "__a", "__b", keys=("chrom",)).drop("__a", "__b")
    away = F.col("mid") - F.when(F.col("pam_strand") == "+", F.col("pam_coord") - seed).otherwise(F.col("pam_coord") + seed)
    out = near.withColumn("distance", F.when(F.col("strand") == "-", -away).otherwise(away))
    order = Window.partitionBy("key").orderBy(F.abs("distance"), "distance", "chrom", "pam_coord", "pam_strand", "guide", "pam")
    return out.withColumn("rank", F.row_number().over(order))


def disrupted_literally(guide: Column, donor: Column, target: Column) -> Column:
    """Whether the guide with any PAM is nowhere in the donor and somewhere in the target, both strands."""
    pams = [f"{b}GG" for b in "ACTG"]
    there = lambda seq: F.contains(seq, F.concat(guide, F.lit(pams[0]))) | F.contains(seq, F.concat(guide, F.lit(pams[1]))) | F.contains(seq, F.concat(guide, F.lit(pams[2]))) | F.contains(seq, F.concat(guide, F.lit(pams[3])))
    both = lambda seq: there(seq) | there(reverse_complement(seq, iupac=True))
    return ~both(donor) & both(target)


def flanks(rows: DataFrame, genome: DataFrame, first: Column, last: Column, name: str = "context") -> DataFrame:
    """rows with the genome from first to last (from 0, without last), where that begins, and the length of
    the chromosome."""
    seqs = genome.select("chrom", F.col("seq").alias("__seq"))
    out = rows.join(seqs, "chrom")
    return out.withColumns({name: substr0("__seq", first, last), f"{name}_first": F.greatest(first, F.lit(0)), "chrom_length": F.length("__seq")}).drop("__seq")
