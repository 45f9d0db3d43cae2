"""Motif search in sequences, set operations on hits, and what lies near them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locus.functions.sequence import hamming_to, reverse_complement, substr0
from locus.operators.intervals import KEYS, overlaps, stab


def chunks(genome: DataFrame, overlap: int, size: int = 20_000) -> DataFrame:
    """chrom, offset and seq: pieces of sequences that overlap by ``overlap``, so that a long chromosome is
    many tasks' work."""
    at = F.sequence(F.lit(0), F.greatest(F.length("seq") - 1, F.lit(0)), F.lit(size))
    return genome.select("chrom", F.length("seq").alias("chrom_length"), "seq", F.explode(at).alias("offset")).select("chrom", "chrom_length", "offset", F.substring("seq", F.col("offset") + 1, F.lit(size + overlap)).alias("seq"))


def windows(genome: DataFrame, n: int, last: bool = False, size: int = 20_000) -> DataFrame:
    """chrom, mstart and kmer: each place with its n bases; the last place of a sequence only with ``last``."""
    parts = chunks(genome, n - 1, size)
    stop = F.least(F.col("chrom_length") - n - F.lit(0 if last else 1), F.col("offset") + size - 1)
    places = parts.withColumn("__stop", stop).filter("__stop >= offset").withColumn("mstart", F.explode(F.sequence("offset", "__stop")))
    return places.select("chrom", "mstart", F.substring("seq", F.col("mstart") - F.col("offset") + 1, F.lit(n)).alias("kmer"))


def motif_scan(genome: DataFrame, motif: str, mismatches: int = 0, both: bool = True, last: bool = False) -> DataFrame:
    """chrom, mstart, mend, strand, match and mismatches of each place with at most so many mismatches, IUPAC
    codes of the motif allowed. Where both strands match, the minus strand is given; match is the plus
    strand's text. The last place isn't looked at unless ``last``."""
    n = len(motif)
    places = windows(genome, n, last).withColumns({"__s": hamming_to(motif, "kmer"), "__a": hamming_to(motif, reverse_complement("kmer", iupac=True))})
    minus = (F.col("__a") <= mismatches) if both else F.lit(False)
    hits = places.filter((F.col("__s") <= mismatches) | minus)
    return hits.select("chrom", "mstart", (F.col("mstart") + n).alias("mend"), F.when(minus, "-").otherwise("+").alias("strand"), F.col("kmer").alias("match"), F.when(minus, F.col("__a")).otherwise(F.col("__s")).alias("mismatches"))


def motif_sites(genome: DataFrame, motif: str, mismatches: int = 0, both: bool = False) -> DataFrame:
    """chrom, mstart, mend and mismatches of each place that matches on the plus strand (or either, with
    ``both``): the fewer of both strands' mismatches, whichever matched."""
    n = len(motif)
    places = windows(genome, n).withColumns({"__s": hamming_to(motif, "kmer"), "__a": hamming_to(motif, reverse_complement("kmer", iupac=True))})
    hits = places.filter((F.col("__s") <= mismatches) | ((F.col("__a") <= mismatches) if both else F.lit(False)))
    return hits.select("chrom", "mstart", (F.col("mstart") + n).alias("mend"), F.least("__s", "__a").alias("mismatches"))


def best_motif(spans: DataFrame, genome: DataFrame, motif: str, mismatches: int, buffer: int = 0) -> DataFrame:
    """spans (chrom, start, end) with the best match of the motif inside: fewest mismatches, leftmost, plus
    before minus; match is in the motif's direction. Spans without one at most ``mismatches`` away go."""
    n = len(motif)
    seqs = spans.join(genome.select("chrom", "seq"), "chrom").withColumn("__from", F.greatest(F.col("start") - buffer, F.lit(0)))
    seqs = seqs.withColumn("__seq", substr0("seq", F.col("__from"), F.col("end") + buffer)).drop("seq").filter(F.length("__seq") > n)
    places = seqs.withColumn("__i", F.explode(F.sequence(F.lit(0), F.length("__seq") - n - 1))).withColumn("__k", F.substring("__seq", F.col("__i") + 1, F.lit(n)))
    sides = F.array(*[F.struct(hamming_to(motif, k).alias("mm"), F.col("__i").alias("i"), F.lit(o).alias("o"), F.lit(s).alias("strand"), k.alias("match")) for o, s, k in ((0, "+", F.col("__k")), (1, "-", reverse_complement("__k", iupac=True)))])
    best = places.groupBy("chrom", "start", "end", "__from").agg(F.min(F.array_min(sides)).alias("b")).filter((F.col("b.mm") <= mismatches) & (F.col("b.mm") < n))
    return best.select("chrom", "start", "end", (F.col("__from") + F.col("b.i")).alias("mstart"), (F.col("__from") + F.col("b.i") + n).alias("mend"), "b.strand", "b.match", F.col("b.mm").alias("mismatches"))


def combine_motifs(a: DataFrame, b: DataFrame, union: bool = True, on=("chrom", "mstart", "mend")) -> DataFrame:
    """Hits in either, a's before b's; or a's hits that b has too."""
    if not union:
        return a.join(b.select(*on), list(on), "left_semi")
    return a.unionByName(b.join(a.select(*on), list(on), "left_anti"))


def suppressed(rows: DataFrame, distance: int = 2, start: str = "start", end: str = "end", order: str = "ord") -> DataFrame:
    """rows whose span, widened by ``distance``, meets that of no earlier row of its chromosome, suppressed
    ones too. ``order`` is unique in a chromosome."""
    wide = rows.select("chrom", F.col(order).alias("__o"), (F.col(start) - distance).alias("__a"), (F.col(end) + distance - 1).alias("__b"))
    first = wide.select("chrom", F.struct("chrom", "__o").alias("__of"), F.col("__a").alias("__a1"), F.col("__b").alias("__b1"))
    blocked = overlaps(first, wide, "__a1", "__b1", "__a", "__b", keys=("chrom",)).filter(F.col("__o") < F.col("__of.__o"))
    return rows.join(blocked.select("__of.chrom", F.col("__of.__o").alias(order)).distinct(), ["chrom", order], "left_anti")


def downstream_footprint(peaks: DataFrame, footprints: DataFrame, window: int, having: bool = True) -> DataFrame:
    """peaks (chrom, strand, pos) with a footprint (chrom, pos) in the ``window`` positions from them
    downstream (plus: from pos on; minus: those before), or those without one."""
    plus = F.col("strand") == "+"
    spans = peaks.withColumns({"__first": F.when(plus, F.col("pos")).otherwise(F.col("pos") - window), "__last": F.when(plus, F.col("pos") + window).otherwise(F.col("pos")) - 1}).withColumnRenamed("pos", "__pos")
    found = stab(footprints.select("chrom", "pos").distinct(), "pos", spans, "__first", "__last", keys=("chrom",)).select("chrom", "strand", F.col("__pos").alias("pos")).distinct()
    return peaks.join(found, ["chrom", "strand", "pos"], "left_semi" if having else "left_anti")


def nearby_loop(sites: DataFrame, loops: DataFrame, reach: int = 10_000) -> DataFrame:
    """sites (chrom, strand, pos) with loop_pos, of a scan that goes away from the site upstream first and
    then downstream, to ``reach``, and keeps the last hit; null without one."""
    spans = sites.select(*KEYS, F.col("pos").alias("__pos")).distinct().withColumns({"__first": F.col("__pos") - reach, "__last": F.col("__pos") + reach})
    hits = stab(loops.select(*KEYS, "pos").distinct(), "pos", spans, "__first", "__last")
    off = F.col("pos") - F.col("__pos")
    best = hits.groupBy(*KEYS, "__pos").agg(F.max_by("pos", F.struct((off >= 0).cast("int"), F.abs(off))).alias("loop_pos"))
    return sites.join(best.withColumnRenamed("__pos", "pos"), [*KEYS, "pos"], "left")


def motif_counts(sequences: DataFrame, motifs: list[str], seq: str = "seq", per_sequence: bool = True) -> DataFrame:
    """motif and value: occurrences that don't overlap, over the number of sequences."""
    count = lambda m: F.regexp_count(F.col(seq), F.lit("\\Q" + m + "\\E"))
    sums = sequences.agg(F.count(F.lit(1)).alias("n"), *[F.sum(count(m)).alias(f"m{i}") for i, m in enumerate(motifs)])
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("motif"), F.coalesce(F.col(f"m{i}"), F.lit(0)).cast("double").alias("total")) for i, m in enumerate(motifs)]))
    value = F.try_divide(F.col("x.total"), F.col("n")) if per_sequence else F.col("x.total")
    return sums.select("n", pairs.alias("x")).select("x.motif", F.when(F.col("n") > 0, value).otherwise(F.col("x.total")).alias("value"))


def variant_counts(hits: DataFrame) -> DataFrame:
    return hits.groupBy("match").agg(F.count(F.lit(1)).alias("n"))


def signal_near_motifs(motifs: DataFrame, query: DataFrame, reference: DataFrame, rna: DataFrame, upstream: tuple[int, int], downstream: int, min_reads: float, min_fold: float, floor: float = 0.01, min_rna: float = 1, flank: int = 50, fixed: bool = False) -> DataFrame:
    """motifs (chrom, strand, mstart, mend) with class, side, value, expression and distance.

    On each strand the signal upstream of the motif decides (upregulated: enough reads at one position,
    enough fold, no higher peak up to ``downstream`` beyond the motif); then reference signal around it
    (not_upregulated); then RNA over the flanks (rna, or no_rna). Of two strands the one with more counts,
    plus at ties. The minus strand's reference signal is read from the plus track, and its RNA mean is the
    plus strand's, unless ``fixed``.
    """
    near, far = upstream
    key = ["chrom", "strand", "mstart", "mend"]
    # Motifs of a column or two in compressed files seem small enough to broadcast, but aren't once they are spans.
    m = motifs.select(*key).distinct().withColumn("side", F.explode(F.array(F.lit("+"), F.lit("-")))).hint("merge")
    plus = F.col("side") == "+"
    spans = {
        "up": (F.when(plus, F.col("mstart") - far).otherwise(F.col("mend") + near), F.when(plus, F.col("mstart") - near).otherwise(F.col("mend") + far)),
        "wide": (F.when(plus, F.col("mstart") - far).otherwise(F.col("mstart") - downstream), F.when(plus, F.col("mend") + downstream).otherwise(F.col("mend") + far)),
        "rna": (F.col("mstart") - flank, F.col("mend") + flank),
    }

    def values(span: str, cov: DataFrame, strand, name: str) -> DataFrame:
        a, b = spans[span]
        asked = m.select(*[F.col(k).alias(f"__{k}") if k in ("strand",) else F.col(k) for k in key], "side", a.alias("__a"), (b - 1).alias("__b"), strand.alias("strand"))
        got = stab(cov.select("chrom", "strand", "pos", "reads"), "pos", asked, "__a", "__b")
        top = F.max_by("pos", F.struct("reads", -F.col("pos")))
        return got.groupBy("chrom", F.col("__strand").alias("strand"), "mstart", "mend", "side").agg(F.sum("reads").alias(f"{name}_sum"), F.max("reads").alias(f"{name}_max"), top.alias(f"{name}_at"), F.min("reads").alias(f"{name}_min"), F.count(F.lit(1)).alias(f"{name}_n"))

    flank_strand = F.col("side") if fixed else F.lit("+")
    out = m
    for part in (values("up", query, F.col("side"), "q"), values("wide", query, F.col("side"), "w"), values("up", reference, F.col("side"), "r"), values("wide", reference, flank_strand, "f"), values("rna", rna, F.col("side"), "n")):
        out = out.join(part, [*key, "side"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    length = 2 * flank + F.col("mend") - F.col("mstart")
    fold = zero("q_sum") / F.greatest(zero("r_sum"), F.lit(floor))
    start = lambda s: spans[s][0]
    from_motif = lambda at: F.when(plus, at - F.col("mstart")).otherwise(F.col("mend") - at)
    out = out.withColumns(
        {
            "fold": fold, "mean_rna": zero("n_sum") / length, "min_rna": F.when(F.col("n_n") >= length, F.col("n_min")).otherwise(0.0),
            "q_dist": from_motif(F.coalesce(F.col("q_at"), start("up"))), "f_dist": from_motif(F.coalesce(F.col("f_at"), start("wide"))),
        }
    )
    hit = (zero("q_max") >= min_reads) & (F.col("fold") >= min_fold) & (zero("q_max") >= zero("w_max"))
    kind = F.when(hit, 0).when(zero("f_sum") >= min_reads, 1).when(F.col("min_rna") >= min_rna, 2).otherwise(3)
    weight = F.when(F.col("kind") == 0, zero("q_sum")).when(F.col("kind") == 1, zero("f_sum")).otherwise(F.col("mean_rna"))
    ranked = out.withColumn("kind", kind).withColumn("weight", weight)
    of = Window.partitionBy(*key)
    both = ranked.withColumns({"__k": F.min("kind").over(of), "plus_mean": F.max(F.when(plus, F.col("mean_rna"))).over(of)})
    best = both.filter("kind = __k").withColumn("__n", F.row_number().over(of.orderBy(F.desc("weight"), F.col("side")))).filter("__n = 1")
    mean = F.col("mean_rna") if fixed else F.col("plus_mean")
    label = F.element_at(F.array(*map(F.lit, ("upregulated", "not_upregulated", "rna", "no_rna"))), F.col("kind") + 1)
    value = F.when(F.col("kind") == 0, F.col("fold")).when(F.col("kind") == 1, zero("f_sum")).otherwise(mean)
    shown = F.when(F.col("kind") <= 1, zero("q_sum")).otherwise(F.col("min_rna"))
    return best.select(*key, label.alias("class"), "side", value.alias("value"), shown.alias("expression"), F.when(F.col("kind") == 0, F.col("q_dist")).when(F.col("kind") == 1, F.col("f_dist")).alias("distance"))
