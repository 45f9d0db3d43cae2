"""Coverage, collapsed reads, edit totals and clusters in time, over streaming DataFrames.

Each takes a stream with the columns of its batch operator and gives a streaming aggregate; state is a row
for each key. On a batch DataFrame they equal the batch operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def coverage(sites: DataFrame, keys=("sample",)) -> DataFrame:
    """reads at each position of sites (keys, chrom, strand, pos, n): n summed."""
    return sites.groupBy(*keys, "chrom", "strand", "pos").agg(F.sum("n").cast("double").alias("reads"))


def collapsed(reads: DataFrame, keys=("sample",)) -> DataFrame:
    """seq, n, the quality of its last read and first_ord. A least count is for the reader of the result, as
    a sequence may reach it later."""
    return reads.groupBy(*keys, "seq").agg(F.count(F.lit(1)).alias("n"), F.max_by("qual", "ord").alias("qual"), F.min("ord").alias("first_ord"))


def edit_totals(alignments: DataFrame, keys=("sample",)) -> DataFrame:
    """total_counts: a line each, and the counts of mapped ones besides."""
    return alignments.groupBy(*keys).agg((F.count(F.lit(1)) + F.coalesce(F.sum(F.when(F.col("chrom") != "*", F.col("n"))), F.lit(0))).alias("total_counts"))


def bursts(events: DataFrame, gap: str, late: str, keys=("user_id",), time: str = "ts", value: str = "value") -> DataFrame:
    """Islands in time: runs of events of a key with gaps of at most ``gap``. Events later than ``late``
    behind the latest seen are dropped, and a run is final once the watermark has passed its end."""
    seen = events.withWatermark(time, late)
    runs = seen.groupBy(*keys, F.session_window(time, gap).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return runs.select(*keys, F.col("w.start").alias("first"), F.col("w.end").alias("closed"), "n", "total")


def keep_table(aggregate: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write the whole aggregate anew after each batch, one folder a batch; the newest is the table. A batch
    that is run again after a failure writes the same folder."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number:012d}")

    return aggregate.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(save).trigger(**(trigger or {"availableNow": True})).start()


def newest(spark, path: str) -> DataFrame:
    """The table that keep_table() wrote last."""
    table = spark.read.parquet(path)
    last = table.agg(F.max("batch")).first()[0]
    return table.filter(F.col("batch") == last).drop("batch")
