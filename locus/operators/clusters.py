"""Clusters of covered positions: islands, growth under a fold threshold, and width by signal."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locus.operators.annotate import type_and_gene
from locus.operators.coverage import SITE
from locus.operators.intervals import KEYS, stab
from locus.operators.motifs import nearby_loop


def numbered_islands(cov: DataFrame, flank: int, width: int = 4096) -> DataFrame:
    """cov with island, which grows along a strand: positions are in one if gaps are at most ``flank``.

    Gaps are found within bins of ``width`` positions, so that no task holds a strand; a row for each bin,
    its first and last position and its number of gaps, carries the count along the strand."""
    here = Window.partitionBy(*KEYS, "__bin").orderBy("pos")
    new = F.when(F.col("pos") - F.lag("pos").over(here) > flank, 1).otherwise(0)
    own = cov.withColumn("__bin", F.floor(F.col("pos") / width)).withColumn("__new", new).withColumn("__gaps", F.sum("__new").over(here)).drop("__new")
    along = Window.partitionBy(*KEYS).orderBy("__bin")
    each = own.groupBy(*KEYS, "__bin").agg(F.min("pos").alias("__first"), F.max("pos").alias("__last"), F.max("__gaps").alias("__all"))
    each = each.withColumn("__begins", F.when(F.col("__first") - F.lag("__last").over(along) <= flank, 0).otherwise(1))
    each = each.withColumn("__before", F.sum(F.col("__begins") + F.col("__all")).over(along) - F.col("__all")).select(*KEYS, "__bin", "__before")
    return own.join(each, [*KEYS, "__bin"]).withColumn("island", F.col("__before") + F.col("__gaps")).drop("__bin", "__before", "__gaps")


def islands(cov: DataFrame, flank: int) -> DataFrame:
    """chrom, strand, cstart, cend, n_sites, total_reads, peak_pos and peak_reads of each island. An island
    of one position ends after it, others at their last position."""
    by = numbered_islands(cov, flank).groupBy(*KEYS, "island")
    out = by.agg(F.min("pos").alias("cstart"), F.max("pos").alias("last"), F.count(F.lit(1)).alias("n_sites"), F.sum("reads").alias("total_reads"), F.max_by("pos", F.struct("reads", -F.col("pos"))).alias("peak_pos"), F.max("reads").alias("peak_reads"))
    return out.withColumn("cend", F.when(F.col("n_sites") == 1, F.col("cstart") + 1).otherwise(F.col("last"))).drop("island", "last")


def signal_width(pos: np.ndarray, reads: np.ndarray, start: int, end: int, total: float, fraction: float) -> tuple[float, int, int, int]:
    """Most reads and where, and the width and number of positions left when the weaker side has been
    trimmed until ``fraction`` of the signal is left. pos ascend; those between start and end count, both
    within. The number starts at one, and grows each time the trimmed part has reached its share."""
    inside = (pos >= start) & (pos <= end)
    p, v = pos[inside], reads[inside]
    covered = v != 0
    p, v = p[covered], v[covered]
    if not len(p):
        return 0.0, start, end - start, 1
    top = int(np.argmax(v))
    left, right, i, j, lo, hi, distinct = 0.0, 0.0, 0, len(p) - 1, start, end, 1
    while i <= j and (left + right) / total <= 1 - fraction:
        lo, hi = max(lo, int(p[i])), min(hi, int(p[j]))
        if v[j] + right < v[i] + left:
            right, hi, j = right + float(v[j]), hi - 1, j - 1
        else:
            left, lo, i = left + float(v[i]), lo + 1, i + 1
        if (left + right) / total >= 1 - fraction:
            distinct += int(((pos[inside] >= lo) & (pos[inside] <= hi)).sum())
    return float(v[top]), int(p[top]), hi - lo, distinct


def _sums(pos: np.ndarray, values: np.ndarray):
    before = np.concatenate([[0.0], np.cumsum(values)])
    return lambda a, b: float(before[np.searchsorted(pos, b)] - before[np.searchsorted(pos, a)]) if b > a else 0.0


GROWN = "chrom string, strand string, seed int, cstart int, cend int, cluster_reads double, n_sites int, peak_pos int, peak_reads double, width int, n_distinct int, fold double, center_of_mass double"


#: Islands that one call of a function takes; a call for each would cost more than its work.
TOGETHER = 512


def _each_island(sites: pd.DataFrame):
    """The rows of each island, ascending."""
    sites = sites.sort_values(["island", "pos"], kind="stable")
    cuts = np.flatnonzero(np.diff(sites["island"].to_numpy())) + 1
    columns = {c: np.split(sites[c].to_numpy(), cuts) for c in sites.columns if c not in ("chrom", "strand", "island", "__together")}
    for i in range(len(cuts) + 1):
        yield {c: x[i] for c, x in columns.items()}


def _grown(q: tuple, r: tuple, up: tuple, flank: int, min_fold: float, floor: float, fraction: float, fold_floor: float):
    """Clusters of one island; q, r and up are positions and reads."""
    pos, reads = q
    q_sum, r_sum, up_sum, up_mass = _sums(*q), _sums(*r), _sums(*up), _sums(up[0], up[0] * up[1])
    last_up, seen = int(up[0].max()), np.zeros(len(pos), bool)
    for seed in up[0]:
        s = int(np.searchsorted(pos, seed))
        if seen[s]:
            continue
        seen[s], lo, hi, end = True, s, s, int(seed) + 1

        def keeps(a: int, b: int) -> bool:
            return q_sum(a, b) / max(r_sum(a, b), floor) >= min_fold

        while lo > 0 and pos[lo - 1] >= 1 and pos[lo] - pos[lo - 1] <= flank and not seen[lo - 1] and keeps(pos[lo - 1], seed):
            lo -= 1
            seen[lo] = True
        while hi + 1 < len(pos) and pos[hi + 1] <= last_up and pos[hi + 1] - pos[hi] <= flank and not seen[hi + 1] and keeps(seed, pos[hi + 1]):
            hi += 1
            seen[hi], end = True, int(pos[hi])
        start, own = int(pos[lo]), reads[lo : hi + 1]
        most, at, width, distinct = signal_width(pos, reads, start, end, float(own.sum()), fraction)
        mass = up_sum(start, end)
        yield int(seed), start, end, float(own.sum()), hi - lo + 1, at, most, width, distinct, q_sum(start, end) / max(r_sum(start, end), fold_floor), up_mass(start, end) / mass if mass else 0.0


def _grow(*how):
    def run(key: tuple, sites: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for x in _each_island(sites):
            q, r = ~np.isnan(x["q"]), ~np.isnan(x["r"])
            rows += [(key[0], key[1], *c) for c in _grown((x["pos"][q], x["q"][q]), (x["pos"][r], x["r"][r]), (x["pos"][x["up"]], x["q"][x["up"]]), *how)]
        return pd.DataFrame(rows, columns=[x.split()[0] for x in GROWN.split(", ")])

    return run


def upregulated_clusters(query: DataFrame, reference: DataFrame, upregulated: DataFrame, flank: int, min_fold: float, fraction: float = 0.8, floor: float = 0.01, fold_floor: float = 1.0) -> DataFrame:
    """Clusters that grow from upregulated positions over positions of query, as long as gaps are at most
    ``flank`` and the part between seed and the next position keeps the fold; with width by signal, centre
    of mass of the upregulated positions and the cluster's fold.

    Growth can't cross a larger gap, so that an island of query is all that one cluster can need: the fold
    runs over some hundred islands at once, not over a chromosome.
    """
    q = numbered_islands(query.select(*SITE, "reads"), flank)
    hot = q.join(upregulated.select(*SITE, F.lit(True).alias("up")), list(SITE), "left")
    sites = hot.select(*SITE, "island", F.col("reads").alias("q"), F.lit(None).cast("double").alias("r"), F.coalesce("up", F.lit(False)).alias("up"))
    spans = sites.groupBy(*KEYS, "island").agg(F.min("pos").alias("__first"), F.max("pos").alias("__last"), F.max("up").alias("any")).filter("any").drop("any")
    ref = stab(reference.select(*SITE, "reads"), "pos", spans, "__first", "__last").select(*SITE, "island", F.lit(None).cast("double").alias("q"), F.col("reads").alias("r"), F.lit(False).alias("up"))
    both = sites.join(spans.select(*KEYS, "island"), [*KEYS, "island"], "left_semi").unionByName(ref)
    return both.groupBy(*KEYS, _together()).applyInPandas(_grow(flank, min_fold, floor, fraction, fold_floor), GROWN)


PLAIN = "chrom string, strand string, seed int, cstart int, cend int, cluster_reads double, n_sites int, peak_pos int, peak_reads double, width int, n_distinct int"


def _together():
    return F.floor(F.col("island") / TOGETHER).alias("__together")


def _plain(fraction: float):
    def run(key: tuple, sites: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for x in _each_island(sites):
            pos, reads = x["pos"], x["reads"]
            start, end = int(pos[0]), int(pos[0]) + 1 if len(pos) == 1 else int(pos[-1])
            most, at, width, distinct = signal_width(pos, reads, start, end, float(reads.sum()), fraction)
            rows.append((key[0], key[1], start, start, end, float(reads.sum()), len(pos), at, most, width, distinct))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in PLAIN.split(", ")])

    return run


def site_clusters(cov: DataFrame, flank: int, fraction: float = 0.8) -> DataFrame:
    """Islands with their width by signal."""
    return numbered_islands(cov.select(*SITE, "reads"), flank).groupBy(*KEYS, _together()).applyInPandas(_plain(fraction), PLAIN)


def with_second_fold(clusters: DataFrame, query: DataFrame, reference: DataFrame, reach: int = 20, floor: float = 0.1) -> DataFrame:
    """clusters with second_fold: reads of another query over another reference within ``reach`` of the peak."""
    out = clusters.withColumns({"__first": F.col("peak_pos") - reach, "__last": F.col("peak_pos") + reach - 1})
    for name, cov in (("__q", query), ("__r", reference)):
        spans = out.select(*KEYS, "__first", "__last").distinct()
        sums = stab(cov.select(*SITE, "reads"), "pos", spans, "__first", "__last").groupBy(*KEYS, "__first", "__last").agg(F.sum("reads").alias(name))
        out = out.join(sums, [*KEYS, "__first", "__last"], "left").fillna(0.0, [name])
    return out.withColumn("second_fold", F.col("__q") / F.greatest("__r", F.lit(floor))).drop("__q", "__r", "__first", "__last")


def annotated_clusters(clusters: DataFrame, types: DataFrame, annotations: DataFrame, priorities: list[str]) -> DataFrame:
    """Clusters of either kind with annotation_type, gene_name, gene_id and sense at their peak."""
    peaks = clusters.select(*KEYS, F.col("peak_pos").alias("pos")).distinct()
    named = type_and_gene(peaks, types, annotations, priorities).withColumnRenamed("pos", "peak_pos")
    return clusters.join(named, [*KEYS, "peak_pos"])


def loop_clusters(cov: DataFrame, loops: DataFrame, types: DataFrame, annotations: DataFrame, priorities: list[str], flank: int, fraction: float = 0.8, reach: int = 10_000) -> DataFrame:
    """Islands with their width, the loop near their seed, its distance, and the annotation of the seed (not
    of the peak)."""
    own = site_clusters(cov, flank, fraction)
    seeds = own.select(*KEYS, F.col("seed").alias("pos")).distinct()
    near = nearby_loop(type_and_gene(seeds, types, annotations, priorities), loops, reach).withColumnRenamed("pos", "seed")
    return own.join(near, [*KEYS, "seed"]).withColumn("loop_distance", F.col("loop_pos") - F.col("seed"))
