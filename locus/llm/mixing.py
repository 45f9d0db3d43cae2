"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in the order of a hash, make blocks. A block is a unit job: with the target
weight w, block j of a source is released at slot floor(j / w) and due by slot ceil((j + 1) / w), and in
each slot the released block with the earliest deadline goes next. With weights that sum to one every block
meets its deadline, so that in any prefix a source has less than one block more or less than its share.

Releases and deadlines follow from the exact weights, as ratios of integers, over the whole run: no weight
is rounded and nothing drifts. The driver goes through the slots and writes those of each source's blocks,
some thousand to a row; documents are joined to that table. When a source is used up, a new phase begins, in
which the weights of the others are scaled up; nothing is dropped or repeated. The place of a document in its
source comes from counts by bucket of the hash, so that no task ever holds a source.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locus.llm.common import shuffle_partitions, table, written

#: Blocks of a source in one row of the plan, and slots that the driver holds before it writes them.
ROW_BLOCKS, HELD_SLOTS = 1024, 1 << 20
PLAN = pa.schema([("__source", pa.string()), ("__part", pa.int64()), ("__first", pa.int64()), ("__slots", pa.list_(pa.int64()))])


def order(blocks: dict[str, int], weights: dict[str, float]) -> Iterator[str]:
    """The source of each slot's block, by earliest deadline among the released, with exact weights."""
    left = {s: n for s, n in blocks.items() if n}
    while left:
        exact = {s: Fraction(weights[s]) for s in left if weights.get(s, 0.0) > 0} or {s: Fraction(n) for s, n in left.items()}
        unit = math.lcm(*(w.denominator for w in exact.values()))
        names = sorted(exact)
        parts = [int(exact[s] * unit) for s in names]
        total = sum(parts)
        n, done = [left[s] for s in names], [0] * len(names)
        coming, ready = [(0, k) for k in range(len(names))], []
        slot = 0
        while True:
            while coming and coming[0][0] <= slot:
                k = heapq.heappop(coming)[1]
                heapq.heappush(ready, (-(-(done[k] + 1) * total // parts[k]), k))
            k = heapq.heappop(ready)[1]
            yield names[k]
            done[k] += 1
            slot += 1
            if done[k] == n[k]:
                break
            heapq.heappush(coming, (done[k] * total // parts[k], k))
        left = {s: left[s] - (done[names.index(s)] if s in exact else 0) for s in left}
        left = {s: x for s, x in left.items() if x}


def plan(spark: SparkSession, blocks: dict[str, int], weights: dict[str, float]) -> DataFrame:
    """Rows of up to ROW_BLOCKS blocks: source, number of the row in its source, its first block and the
    slots from there. What the driver has gone through is written now and then, so that it holds
    HELD_SLOTS slots and no more, however many blocks there are."""
    rows: list[tuple] = []
    tables: list[DataFrame] = []
    held: dict[str, array] = {}
    done = dict.fromkeys(blocks, 0)

    def put(s: str) -> None:
        first = done[s] - len(held[s])
        rows.append((s, first // ROW_BLOCKS, first, held.pop(s)))

    def write() -> None:
        for s in list(held):
            put(s)
        made = pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True) if rows else [()] * 4, PLAN, strict=True)], schema=PLAN)
        tables.append(written(spark.createDataFrame(made), "slots"))
        rows.clear()

    for slot, s in enumerate(order(blocks, weights)):
        held.setdefault(s, array("q")).append(slot)
        done[s] += 1
        if done[s] % ROW_BLOCKS == 0:
            put(s)
        if (slot + 1) % HELD_SLOTS == 0:
            write()
    if rows or held or not tables:
        write()
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    # a row that was written before it was full goes on in the next table
    parts = out.groupBy("__source", "__part").agg(F.sort_array(F.collect_list(F.struct("__first", "__slots"))).alias("x"))
    return parts.select("__source", "__part", F.flatten("x.__slots").alias("__slots"))


def tempered(counts: dict[str, int], power: float = 0.5) -> dict[str, float]:
    """Weights in proportion to a power of the sources' sizes: small sources get more than their share."""
    total = math.fsum(n**power for n in counts.values()) or 1.0
    return {s: n**power / total for s, n in counts.items()}


def source_key(source_col: str = "source") -> Column:
    """A null source is a source of its own, other than the empty name."""
    return F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))


def _placed(docs: DataFrame, weights: dict[str | None, float] | None = None, block_docs: int = 8, power: float = 0.5, id_col: str = "doc_id", source_col: str = "source", seed: int = 10) -> DataFrame:
    """Each row of docs, as __row, with __block, __slot and __place."""
    spark = docs.sparkSession
    own = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(row.alias("__row"), source_key(source_col).alias("__source"), F.col(id_col).alias("__id"), F.xxhash64(F.col(id_col), *own, F.lit(seed)).alias("__hash"))
    counts = {r["__source"]: r["n"] for r in keyed.groupBy("__source").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    rows = max(256, math.isqrt(total))
    buckets = 1 << max(0, (max(1, total // rows) - 1).bit_length())
    keyed = keyed.withColumn("__bucket", F.pmod("__hash", F.lit(buckets)))

    by_bucket = keyed.groupBy("__source", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_bucket.select("__source", "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))

    if weights is None:
        given = tempered(counts, power)
    else:
        given = {"" if s is None else f"={s}": w for s, w in weights.items()}
    slots = plan(spark, {s: -(-n // block_docs) for s, n in counts.items()}, given)

    in_bucket = Window.partitionBy("__source", "__bucket").orderBy("__hash", "__id")
    rank = F.col("__before") + F.row_number().over(in_bucket) - 1
    placed = keyed.join(offsets, ["__source", "__bucket"]).withColumn("__rank", rank).withColumns({"__block": F.floor(F.col("__rank") / block_docs), "__place": F.col("__rank") % block_docs})
    placed = placed.withColumn("__part", F.floor(F.col("__block") / ROW_BLOCKS)).join(slots, ["__source", "__part"])
    slot = F.get("__slots", (F.col("__block") % ROW_BLOCKS).cast("int"))
    return placed.select("__row", F.col("__block").cast("long"), slot.cast("long").alias("__slot"), F.col("__place").cast("long"))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, **how) -> DataFrame:
    """docs with __block (of its source, from 0), __slot and __place (in its block), which replace own
    columns of these names; all other columns stay, whatever their names.

    ``weights``: target weight of each source; without it a power of the sources' sizes (``power``). Sources
    without a weight, or one that isn't above zero, come after all others, in proportion to their sizes.
    Every row of docs comes once; a null id or source is a value like others. Rows of a source are in the
    order of a hash of their columns (but maps), so that rows of one id are spread over tasks; rows that are
    equal in all of these are alike, and any of them may come first. In any prefix of the slots of a phase a
    source is off its exact target weight by less than a block. The number of sources is that of a weights
    table; the plan has a number for each block, in a written table that is joined.
    """
    places = ["__block", "__slot", "__place"]
    return _placed(docs, weights, **how).select(*[F.col("__row")[c].alias(c) for c in docs.columns if c not in places], *places)


def mixed(docs: DataFrame, **how) -> DataFrame:
    """docs, with all their columns, in the order of the mixture: partitions, and rows in them, follow slots."""
    n = shuffle_partitions(docs.sparkSession)
    return _placed(docs, **how).repartitionByRange(n, "__slot", "__place").sortWithinPartitions("__slot", "__place").select("__row.*")


def op10_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mix(docs).select("doc_id", "source", F.col("__block").alias("block"), F.col("__slot").alias("slot"), F.col("__place").alias("place"))
