"""Sequence variants: chrom, pos (from 1), ref, alt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CALL = ("chrom", "pos", "ref", "alt")


def trimmed(variants: DataFrame) -> DataFrame:
    """Where ref and alt end in the same base, both lose all but as many leading bases as the shorter has
    less one, and pos moves with them."""
    same = F.right(F.col("ref"), F.lit(1)) == F.right(F.col("alt"), F.lit(1))
    k = F.when(same, F.least(F.length("ref"), F.length("alt")) - 1).otherwise(0)
    cut = lambda c: F.substring(c, F.col("__k") + 1, F.length(c))
    out = variants.withColumn("__k", k)
    return out.withColumns({"pos": F.col("pos") + F.col("__k"), "ref": cut("ref"), "alt": cut("alt")}).drop("__k")


def cleaned(variants: DataFrame, no_mito: bool = True) -> DataFrame:
    """Trimmed variants without those of several alternatives or mitochondria, each call once, the first."""
    own = trimmed(variants.filter(~F.contains(F.col("alt"), F.lit(","))))
    own = own.filter(~F.contains(F.col("chrom"), F.lit("M"))) if no_mito else own
    return own.groupBy(*CALL).agg(F.min("ord").alias("ord"))


def combined(sources: list[DataFrame]) -> DataFrame:
    """Calls of several sources, each once, with the place of the first source that has it and the number
    of calls at its position."""
    out = None
    for i, s in enumerate(sources):
        one = s.select(*CALL, F.lit(i).alias("source_ord"), F.col("ord"))
        out = one if out is None else out.unionByName(one)
    kept = out.groupBy(*CALL).agg(F.min(F.struct("source_ord", "ord")).alias("x")).select(*CALL, "x.source_ord", "x.ord")
    return kept.withColumn("calls_at_pos", F.count(F.lit(1)).over(Window.partitionBy("chrom", "pos")))


def _islands(calls: DataFrame, max_gap: int, width: int = 4096) -> DataFrame:
    """calls with island, the first position of the run that they are in: each starts less than ``max_gap``
    after the furthest end before it. Runs are found by bins of positions; a row for each bin carries on."""
    end = F.col("pos") + F.length("ref")
    own = calls.withColumns({"__end": end, "__bin": F.floor(F.col("pos") / width)})
    earlier = Window.partitionBy("chrom").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    here = Window.partitionBy("chrom", "__bin").orderBy("pos")
    reach = own.groupBy("chrom", "__bin").agg(F.max("__end").alias("__far")).select("chrom", "__bin", F.max("__far").over(earlier).alias("__far"))
    own = own.join(reach, ["chrom", "__bin"]).withColumn("__far", F.greatest("__far", F.max("__end").over(here.rangeBetween(Window.unboundedPreceding, -1))))
    begins = F.col("__far").isNull() | (F.col("pos") - F.col("__far") >= max_gap)
    own = own.withColumn("__first", F.last(F.when(begins, F.col("pos")), ignorenulls=True).over(here.rangeBetween(Window.unboundedPreceding, 0)))
    each = own.groupBy("chrom", "__bin").agg(F.max("__first").alias("__last")).select("chrom", "__bin", F.max("__last").over(earlier).alias("__last"))
    return own.join(each, ["chrom", "__bin"]).withColumn("island", F.coalesce("__first", "__last")).drop("__bin", "__end", "__far", "__first", "__last")


def linked_chains(variants: DataFrame, max_gap: int = 5, most_chains: int = 1_000_000) -> DataFrame:
    """All chains of two or more variants, of any length, in which the next starts less than ``max_gap``
    after the end of the one before (an overlap is less, too; some may be skipped): chrom, first, end,
    members and n_members.

    A chain lies within a run of close variants. A run's chains are made together, by adding its variants
    one after another to all chains that they may follow. Where variants are dense their number grows
    exponentially: a run with more than ``most_chains`` fails with its place, nothing is left out.
    """
    runs = _islands(variants.select("chrom", "pos", "ref", "alt"), max_gap)
    runs = runs.groupBy("chrom", "island").agg(F.array_sort(F.collect_list(F.struct("pos", "ref", "alt"))).alias("x")).filter(F.size("x") > 1)
    chain = lambda members, v: F.struct(members.alias("members"), (v["pos"] + F.length(v["ref"])).alias("end"), v["pos"].alias("last"))
    kind = runs.select(F.array(chain(F.col("x"), F.col("x")[0])).alias("c")).schema["c"].dataType

    def longer(chains: Column, v: Column) -> Column:
        may = F.filter(chains, lambda c: (v["pos"] > c["last"]) & (v["pos"] - c["end"] < max_gap))
        return F.concat(chains, F.transform(may, lambda c: chain(F.array_append(c["members"], v), v)), F.array(chain(F.array(v), v)))

    checked = lambda chains: F.when(F.size(chains) > most_chains, F.raise_error(F.concat(F.lit(f"more than {most_chains} chains of linked variants at "), F.col("chrom"), F.lit(":"), F.col("island").cast("string"))).cast(kind)).otherwise(chains)
    chains = F.aggregate("x", F.array().cast(kind), lambda chains, v: checked(longer(chains, v)))
    made = runs.select("chrom", F.explode(F.filter(chains, lambda c: F.size(c["members"]) > 1)).alias("c"))
    return made.select("chrom", F.col("c.members")[0]["pos"].alias("first"), "c.end", "c.members", F.size("c.members").alias("n_members"))


def spliced(members: Column, ref: Column, first: Column) -> Column:
    """The reference from ``first`` on with the members' alternatives put in, one after another."""
    start = F.struct(ref.alias("seq"), first.cast("long").alias("offset"))

    def put(state: Column, m: Column) -> Column:
        at = m["pos"] - state["offset"]
        seq = F.concat(F.substring(state["seq"], F.lit(1), at.cast("int")), m["alt"], F.substring(state["seq"], (at + F.length(m["ref"]) + 1).cast("int"), F.length(state["seq"])))
        return F.struct(seq.alias("seq"), (state["offset"] + F.length(m["ref"]) - F.length(m["alt"])).cast("long").alias("offset"))

    return F.aggregate(members, start, put)["seq"]


def linked(genome: DataFrame, variants: DataFrame, max_gap: int = 5) -> DataFrame:
    """Chains as one variant each: chrom, pos, ref, alt and members; of chains that come to the same call
    the one with fewest members stays."""
    chains = linked_chains(variants, max_gap).join(genome.select("chrom", "seq"), "chrom")
    ref = F.substring("seq", F.col("first").cast("int"), (F.col("end") - F.col("first")).cast("int"))
    made = chains.withColumn("ref", ref).select("chrom", F.col("first").alias("pos"), "ref", spliced(F.col("members"), F.col("ref"), F.col("first")).alias("alt"), "members")
    return made.groupBy(*CALL).agg(F.min_by("members", F.struct(F.size("members"), F.to_json("members"))).alias("members"))


def processed(files: list[DataFrame]) -> DataFrame:
    """Variants of several files, each call from the first that has it."""
    out = None
    for i, f in enumerate(files):
        f = f.withColumn("__prio", F.lit(i))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    first = Window.partitionBy(*CALL).orderBy("__prio", "ord")
    return out.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n", "__prio")
