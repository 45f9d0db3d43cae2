import datetime as dt

from pyspark.sql import functions as F

from locus.operators import reads as batch
from locus.streaming import aggregates as agg

READS = "sample string, seq string, qual string, ord long"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_collapsed_reads_over_two_batches(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    parts = [[("s", "AC", "q0", 0), ("s", "GG", "q1", 1)], [("s", "AC", "q2", 2), ("t", "AC", "q3", 3)]]
    whole = spark.createDataFrame(parts[0] + parts[1], READS)
    for part in parts:
        spark.createDataFrame(part, READS).write.mode("append").parquet(source)
        agg.keep_table(agg.collapsed(spark.readStream.schema(READS).parquet(source)), out, state).awaitTermination()
    want = batch.collapsed(whole, keys=["sample"])
    assert rows(agg.newest(spark, out).select(want.columns)) == rows(want)


def test_coverage_and_totals_equal_batch(spark, tmp_path):
    schema = "sample string, chrom string, strand string, pos int, n long"
    data = [("s", "c", "+", 5, 2), ("s", "c", "+", 5, 3), ("s", "*", "+", 0, 9), ("t", "c", "-", 1, 1)]
    df = spark.createDataFrame(data, schema)
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    agg.keep_table(agg.coverage(stream), str(tmp_path / "cov"), str(tmp_path / "s1")).awaitTermination()
    agg.keep_table(agg.edit_totals(stream), str(tmp_path / "tot"), str(tmp_path / "s2")).awaitTermination()
    assert ("s", "c", "+", 5, 5.0) in rows(agg.newest(spark, str(tmp_path / "cov")))
    assert rows(agg.newest(spark, str(tmp_path / "tot"))) == rows(batch.totals(df))


def test_bursts(spark):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    df = spark.createDataFrame([(1, at(0), 1.0), (1, at(4), 2.0), (1, at(20), 5.0), (2, at(1), 7.0)], "user_id long, ts timestamp, value double")
    got = rows(agg.bursts(df, "5 minutes", "1 hour").select("user_id", F.minute("first"), "n", "total"))
    assert got == [(1, 0, 2, 3.0), (1, 20, 1, 5.0), (2, 1, 1, 7.0)]
