import os

from locus.llm.common import clear_scratch, drop_written, scratch_dir, written, written_buckets


def tables(spark):
    folder = scratch_dir(spark).removeprefix("file:")
    return os.listdir(folder) if os.path.exists(folder) else []


def test_tables_are_written_read_and_deleted(spark):
    a = written(spark.range(5), "a")
    b = written_buckets(spark.range(5).selectExpr("id AS block"), "b", "block", 3)
    assert a.count() == b.count() == 5 and len(tables(spark)) >= 2
    before = len(tables(spark))
    drop_written(a)
    assert len(tables(spark)) == before - 1
    clear_scratch(spark)
    assert not tables(spark) and not any(t.name.startswith("locus_") for t in spark.catalog.listTables())
