"""Coverage tracks: sample, chrom, strand, pos (from 0) and reads; absent positions have none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locus.operators.intervals import KEYS, bins, stab

SITE = ("chrom", "strand", "pos")


def total(cov: DataFrame) -> DataFrame:
    """total_reads of a track."""
    return cov.agg(F.coalesce(F.sum("reads"), F.lit(0.0)).alias("total_reads"))


def expression(features: DataFrame, cov: DataFrame, name: str = "reads", first: str = "fstart", end: str = "fend") -> DataFrame:
    """features with the sum of reads in [first, end), zero where there are none. Features are told apart
    by all their columns."""
    spans = features.select(*KEYS, first, end).distinct().withColumn("__last", F.col(end) - 1)
    sums = stab(cov.select(*SITE, "reads"), "pos", spans, first, "__last").groupBy(*KEYS, first, end).agg(F.sum("reads").alias(name))
    return features.join(sums, [*KEYS, first, end], "left").fillna(0.0, [name])


def positions(features: DataFrame, first: Column, end: Column, name: str = "pos") -> DataFrame:
    """A row for each position in [first, end) of each feature."""
    return features.filter(end > first).withColumn(name, F.explode(F.sequence(first, end - 1)))


def expression_vector(features: DataFrame, cov: DataFrame, key: str, pseudo: float = 0.0, exclude: DataFrame | None = None, first: str = "fstart", end: str = "fend") -> DataFrame:
    """For each feature the reads at each of its positions in order; absent and excluded ones (key, pos) are
    ``pseudo``."""
    spots = positions(features.select(key, *KEYS, first, end), F.col(first), F.col(end)).join(cov.select(*SITE, "reads"), list(SITE), "left")
    if exclude is not None:
        spots = spots.join(exclude.select(key, "pos").distinct().withColumn("__out", F.lit(True)), [key, "pos"], "left").withColumn("reads", F.when(F.col("__out").isNull(), F.col("reads")))
    got = F.array_sort(F.collect_list(F.struct("pos", F.coalesce("reads", F.lit(pseudo)).alias("v"))))
    return spots.groupBy(key).agg(F.transform(got, lambda x: x["v"]).alias("values"))


def peak(features: DataFrame, cov: DataFrame, key: str, first: str = "fstart", end: str = "fend") -> DataFrame:
    """The position with most reads in [first, end), the leftmost of equals; null where all are zero."""
    spans = features.select(key, *KEYS, first, end).withColumn("__last", F.col(end) - 1)
    best = stab(cov.select(*SITE, "reads").filter("reads > 0"), "pos", spans, first, "__last").groupBy(key).agg(F.max_by("pos", F.struct("reads", -F.col("pos"))).alias("peak_pos"), F.max("reads").alias("peak_reads"))
    return features.join(best, key, "left")


def center_of_mass(features: DataFrame, cov: DataFrame, key: str, first: str = "fstart", end: str = "fend") -> DataFrame:
    """The mean position in [first, end), weighted by reads; zero where there are none."""
    spans = features.select(key, *KEYS, first, end).withColumn("__last", F.col(end) - 1)
    mass = stab(cov.select(*SITE, "reads"), "pos", spans, first, "__last").groupBy(key).agg((F.sum(F.col("reads") * F.col("pos")) / F.nullif(F.sum("reads"), F.lit(0.0))).alias("center_of_mass"))
    return features.join(mass, key, "left").fillna(0.0, ["center_of_mass"])


def _both(query: DataFrame, reference: DataFrame) -> DataFrame:
    return query.select(*SITE, F.col("reads").alias("q"), F.lit(None).cast("double").alias("r")).unionByName(reference.select(*SITE, F.lit(None).cast("double").alias("q"), F.col("reads").alias("r")))


def _factor(query: DataFrame, reference: DataFrame, query_over_reference: bool) -> DataFrame:
    q, r = query.agg(F.sum("reads").alias("tq")), reference.agg(F.sum("reads").alias("tr"))
    return q.crossJoin(r).select((F.col("tq") / F.col("tr") if query_over_reference else F.col("tr") / F.col("tq")).alias("factor"))


def upregulated_in_window(query: DataFrame, reference: DataFrame, window: int, min_fold: float, min_reads: float, floor: float = 0.01) -> DataFrame:
    """Positions of query whose reads over [pos - window, pos + window), scaled by the tracks' totals
    (reference over query), are min_fold times those of reference, with min_reads at the position itself.
    A task has a bin of positions, with those within ``window`` of it."""
    near = Window.partitionBy(*KEYS, "__bin").orderBy("pos").rangeBetween(-window, window - 1)
    both = _both(query, reference).withColumn("__bin", F.explode(bins(F.col("pos") - window, F.col("pos") + window, max(4096, 4 * window))))
    sums = both.select(*SITE, "q", "__bin", F.coalesce(F.sum("q").over(near), F.lit(0.0)).alias("q_sum"), F.coalesce(F.sum("r").over(near), F.lit(0.0)).alias("r_sum"))
    sums = sums.filter(F.col("q").isNotNull() & (F.col("__bin") == F.floor(F.col("pos") / max(4096, 4 * window)))).drop("__bin")
    fold = F.col("q_sum") * F.col("factor") / F.greatest("r_sum", F.lit(floor))
    return sums.crossJoin(F.broadcast(_factor(query, reference, False))).withColumn("fold", fold).filter((F.col("fold") >= min_fold) & (F.col("q") >= min_reads)).select(*SITE, F.col("q").alias("reads"), "fold")


def classified(query: DataFrame, reference: DataFrame, min_fold: float, min_reads: float, floor: float = 0.01, max_fold: float = 1.0, fixed: bool = False) -> DataFrame:
    """Positions of query with a class: up, not_up, or neither. Reads are scaled by query over reference
    totals (``fixed``: reference over query) and must reach min_reads then. A reference position with zero
    reads counts as zero, and gives null fold and no class; ``fixed`` uses the floor there too."""
    r = F.coalesce("r", F.lit(floor))
    r = F.greatest(r, F.lit(floor)) if fixed else r
    sites = query.select(*SITE, "reads").join(reference.select(*SITE, F.col("reads").alias("r")), list(SITE), "left").crossJoin(F.broadcast(_factor(query, reference, not fixed)))
    scaled = sites.withColumn("scaled", F.col("reads") * F.col("factor")).filter(F.col("scaled") >= min_reads).withColumn("fold", F.try_divide(F.col("scaled"), r))
    return scaled.select(*SITE, "reads", "fold", F.when(F.col("fold") >= min_fold, "up").when(F.col("fold") <= max_fold, "not_up").otherwise("neither").alias("class"))


def upregulated(query: DataFrame, reference: DataFrame, min_fold: float, min_reads: float, floor: float = 0.01, fixed: bool = False) -> DataFrame:
    """Positions of query with min_fold times the reads of reference, each for itself."""
    return classified(query, reference, min_fold, min_reads, floor, fixed=fixed).filter("class = 'up'").drop("class")


def upregulated_values(vector: DataFrame, min_fold: float) -> DataFrame:
    """Of rows with q and r: q where r is zero or q is min_fold times r, else zero, as value."""
    return vector.withColumn("value", F.when((F.col("r") == 0) | (F.try_divide(F.col("q"), F.col("r")) >= min_fold), F.col("q")).otherwise(0.0))


def intersect(a: DataFrame, b: DataFrame, buffer: int = 0, fixed: bool = False) -> DataFrame:
    """Positions of a that b has too. The buffer has no effect unless ``fixed``, and then reaches both ways."""
    if not fixed:
        return a.join(b.select(*SITE), list(SITE), "left_semi")
    spans = b.select(*KEYS, (F.col("pos") - buffer).alias("__first"), (F.col("pos") + buffer).alias("__last"))
    return stab(a, "pos", spans, "__first", "__last", how="left_semi")


def excluding(cov: DataFrame, regions: DataFrame) -> DataFrame:
    """A track without the positions listed (chrom, strand, pos)."""
    return cov.join(regions.select(*SITE), list(SITE), "left_anti")


def fold_check(features: DataFrame, query: DataFrame, reference: DataFrame, floor: float = 1.0) -> DataFrame:
    """features with fold: reads of query over those of reference, which count as ``floor`` at least."""
    out = expression(expression(features, query, "q_sum"), reference, "r_sum")
    return out.withColumn("fold", F.col("q_sum") / F.greatest("r_sum", F.lit(floor)))


def differential(values: DataFrame, key: str, length: Column, min_mean: float = 0.0) -> DataFrame:
    """Of rows (key, side A or B, one for each replicate, value): status, ratio of means, means for each
    base, their difference, and each side's variation (population deviation over mean)."""
    side = lambda s: F.when(F.col("side") == s, F.col("value"))
    agg = values.groupBy(key).agg(length.alias("length"), *[f(side(s)).alias(f"{n}_{s}") for s in "AB" for n, f in (("mean", F.avg), ("sd", F.stddev_pop))])
    a, b, n = F.coalesce("mean_A", F.lit(0.0)), F.coalesce("mean_B", F.lit(0.0)), F.col("length")
    status = F.when((a / n < min_mean) & (b / n < min_mean), "no sample B or A signal").when(b == 0, "no sample B signal").when(a == 0, "no sample A signal").otherwise("both")
    shown = agg.withColumn("status", status).withColumn("no", F.col("status") == "no sample B or A signal")
    at = lambda ok, x: F.when(~F.col("no") & ok, x)
    return shown.select(
        key, "status", F.when(F.col("status") == "both", F.try_divide(a, b)).alias("ratio"), F.when(F.col("status") == "both", a / n - b / n).alias("difference"),
        at(a != 0, a / n).alias("mean_a"), at(b != 0, b / n).alias("mean_b"), at(a != 0, F.try_divide(F.col("sd_A"), a)).alias("cv_a"), at(b != 0, F.try_divide(F.col("sd_B"), b)).alias("cv_b"),
    )


def smooth(rows: DataFrame, value: str, order: str, window: int, keys=(), width: int = 4096) -> DataFrame:
    """The mean of the ``window`` values before each, itself and window - 1 after; the first and last
    ``window`` values stay as they are. ``order`` is a whole number. Rows are numbered by bins of it, and a
    task has a run of numbers with the ``window`` before and after it."""
    width = max(width, 4 * window)
    binned = rows.withColumn("__bin", F.floor(F.col(order) / width))
    every, before = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    each = binned.groupBy(*keys, "__bin").agg(F.count(F.lit(1)).alias("__c")).select(*keys, "__bin", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__before"), F.sum("__c").over(every).alias("__n"))
    i = F.col("__before") + F.row_number().over(Window.partitionBy(*keys, "__bin").orderBy(order))
    placed = binned.join(each, [*keys, "__bin"]).withColumn("__i", i).withColumn("__run", F.explode(bins(F.col("__i") - window, F.col("__i") + window, width)))
    mean = F.avg(value).over(Window.partitionBy(*keys, "__run").orderBy("__i").rowsBetween(-window, window - 1))
    out = placed.withColumn("smooth", F.when((F.col("__i") <= window) | (F.col("__i") > F.col("__n") - window), F.col(value)).otherwise(mean))
    return out.filter(F.col("__run") == F.floor(F.col("__i") / width)).select(*rows.columns, "smooth")
