"""Profiles of signal over features: upstream, a body of fixed size, downstream.

A feature isn't made dense: covered positions are joined to features, given their place in the profile,
and only what differs from zero is summed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locus.operators.annotate import other_strand
from locus.operators.coverage import SITE
from locus.operators.intervals import KEYS, stab


def placed(features: DataFrame, cov: DataFrame, key: str, upstream: int, body: int, downstream: int, stranded: bool = True, exclude: DataFrame | None = None, by=()) -> DataFrame:
    """key, side (sense, antisense), idx (place in the profile, from 0) and v, of each feature, for covered
    positions, with the columns ``by`` of cov. In the body a later position of the same bin replaces an earlier one, zeros too."""
    plus = F.col("strand") == "+"
    spans = features.select(key, *KEYS, "fstart", "fend").withColumns(
        {"__first": F.col("fstart") - F.when(plus, upstream).otherwise(downstream), "__last": F.col("fend") + F.when(plus, downstream).otherwise(upstream) - 1, "__own": F.col("strand")}
    )
    if stranded:
        spans = spans.withColumn("strand", F.explode(F.array("strand", other_strand(F.col("strand")))))
        hits = stab(cov.select(*by, *SITE, "reads"), "pos", spans, "__first", "__last")
    else:
        hits = stab(cov.select(*by, "chrom", "pos", "reads"), "pos", spans.drop("strand"), "__first", "__last", keys=("chrom",)).withColumn("strand", F.col("__own"))
    if exclude is not None:
        hits = hits.join(exclude.select(key, "pos").distinct().withColumn("__out", F.lit(True)), [key, "pos"], "left")
        hits = hits.filter(F.col("__out").isNull() | (F.col("strand") != F.col("__own")))
    # the place from the 5' end of the feature
    step = F.when(F.col("__own") == "+", F.col("pos") - F.col("fstart")).otherwise(F.col("fend") - 1 - F.col("pos"))
    hits = hits.withColumns({"__i": step, "__n": F.col("fend") - F.col("fstart"), "side": F.when(F.col("strand") == F.col("__own"), "sense").otherwise("antisense")})
    bin_ = F.least((F.col("__i") * F.lit(body).cast("double") / F.col("__n")).cast("int"), F.lit(body - 1))
    inside = (F.col("__i") >= 0) & (F.col("__i") < F.col("__n"))
    place = F.when(F.col("__i") < 0, F.col("__i") + upstream).when(inside, bin_ + upstream).otherwise(F.col("__i") - F.col("__n") + upstream + body)
    out = hits.withColumns({"idx": place.cast("int"), "__in": inside})
    if not body:
        out = out.filter("NOT __in")
    # the last position of a body's bin: the next one would be in the next bin, or there is none
    after = F.least(((F.col("__i") + 1) * F.lit(body).cast("double") / F.col("__n")).cast("int"), F.lit(body - 1))
    last = ~F.col("__in") | (F.col("__i") + 1 >= F.col("__n")) | (after != bin_) if body else F.lit(True)
    return out.filter(last).select(*by, key, "side", "idx", F.col("reads").alias("v"))


def profile(places: DataFrame, length: int, by=()) -> DataFrame:
    """places (side, idx, v) summed, with all places from 0 to length, for each side (and ``by``)."""
    sums = places.groupBy(*by, "side", "idx").agg(F.sum("v").alias("v"))
    every = sums.select(*by, "side").distinct().withColumn("idx", F.explode(F.sequence(F.lit(0), F.lit(length - 1))))
    return every.join(sums, [*by, "side", "idx"], "left").fillna(0.0, ["v"])


def metagene(features: DataFrame, cov: DataFrame, key: str, upstream: int, body: int, downstream: int, min_reads: float = 1, scaling: float = 1, both: bool = True, exclude: DataFrame | None = None) -> DataFrame:
    """side, idx and v of a stranded profile: features with min_reads (over both strands, or for each
    strand alone unless ``both``) count, each scaled to its greatest value; the profile is scaled so too."""
    own = placed(features, cov, key, upstream, body, downstream, exclude=exclude)
    of = Window.partitionBy(key, *(() if both else ("side",)))
    own = own.withColumns({"__sum": F.sum("v").over(of), "__max": F.max("v").over(of)}).filter((F.col("__sum") >= min_reads) & (F.col("__max") > 0))
    out = profile(own.withColumn("v", F.col("v") * (scaling / F.col("__max"))), upstream + body + downstream)
    top = Window.partitionBy("side")
    return out.withColumn("v", F.col("v") * F.try_divide(F.lit(float(scaling)), F.max("v").over(top)))


def metagene_nonstranded(features: DataFrame, cov: DataFrame, key: str, upstream: int, body: int, downstream: int, normalize: bool = False, scaling: float = 1, most_zeros: int | None = None) -> DataFrame:
    """idx and v of a profile of a track without strands (chrom, pos, reads). With ``most_zeros``, features
    with as many zero places are left out, all zeros counted. The profile is scaled to its greatest size."""
    length = upstream + body + downstream
    own = placed(features, cov, key, upstream, body, downstream, stranded=False)
    if most_zeros is not None:
        filled = own.filter("v <> 0").groupBy(key).agg(F.countDistinct("idx").alias("n")).filter(length - F.col("n") < most_zeros).select(key)
        own = own.join(filled, key, "left_semi")
    if normalize:
        of = Window.partitionBy(key)
        own = own.withColumn("v", F.when(F.sum("v").over(of) != 0, F.col("v") / F.abs(F.max("v").over(of))).otherwise(F.col("v")))
    out = profile(own.withColumns({"v": F.col("v") * scaling, "side": F.lit("sense")}), length).drop("side")
    return out.withColumn("v", F.col("v") * F.try_divide(F.lit(float(scaling)), F.max(F.abs("v")).over(Window.partitionBy(F.lit(1)))))


def metagene_samples(features: DataFrame, cov: DataFrame, key: str, upstream: int, body: int, downstream: int, min_reads: float, scaling: float = 100) -> DataFrame:
    """sample, side, idx and v: profiles of several samples (cov has sample) on one scale. A feature counts
    if its sense reads over all samples are above min_reads, and is scaled by their sum; in the end the
    greatest value of all sense profiles, and that of all antisense ones, becomes ``scaling``."""
    own = placed(features, cov, key, upstream, body, downstream, by=["sample"])
    totals = own.filter("side = 'sense'").groupBy(key).agg(F.sum("v").alias("total")).filter(F.col("total") > min_reads)
    scaled = own.join(totals, key).withColumn("v", F.col("v") * scaling / F.col("total"))
    out = profile(scaled, upstream + body + downstream, ["sample"])
    return out.withColumn("v", F.col("v") * F.try_divide(F.lit(float(scaling)), F.max("v").over(Window.partitionBy("side"))))


def binned(values: DataFrame, body: int, column: str = "values") -> DataFrame:
    """An array column cut to ``body`` bins; a bin holds its last value, none of them zero."""
    n = F.size(column)
    at = lambda i: F.least((i * F.lit(float(body)) / n).cast("int"), F.lit(body - 1))
    places = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i + 1 >= n) | (at(i + 1) != at(i)))
    last = F.map_from_arrays(F.transform(places, at), F.transform(places, lambda i: F.get(column, i)))
    out = F.transform(F.sequence(F.lit(0), F.lit(body - 1)), lambda b: F.coalesce(F.try_element_at(last, b), F.lit(0.0))) if body else F.array().cast("array<double>")
    return values.withColumn("binned", F.when(n > 0, out).otherwise(F.array_repeat(F.lit(0.0), body)))
