"""What the operators of this folder share: the scratch folder, written tables and reading of tables."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named table, by Spark's own reader, so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """This application's own folder in the shared folder of spark.checkpoint.dir. Only where that is unset and
    all runs in one JVM, as in tests, a folder of our own; a cluster must name one that its hosts share."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="locus-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder}/locus-{spark.sparkContext.applicationId}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: lineage ends here, and a lost
    executor costs no more than the tasks that were running on it."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._locus_path = path
    return out


def _own(spark: SparkSession) -> str:
    """The application's id as a part of table names."""
    return "".join(c if c.isalnum() else "_" for c in spark.sparkContext.applicationId).lower()


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's tables in the shared folder, and no other's. For the end of a job, when no
    result is read any more: results are lazy and read such tables."""
    for t in spark.catalog.listTables():
        if t.name.startswith(f"locus_{_own(spark)}_"):
            spark.sql(f"DROP TABLE {t.name}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_written(*frames: DataFrame) -> None:
    """Delete tables of written() that no later result reads."""
    for df in frames:
        path = getattr(df, "_locus_path", None)
        if path:
            spark = df.sparkSession
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def free_shuffles(spark: SparkSession) -> None:
    """Have the driver notice that exchanges before the last written table aren't needed any more, so that
    executors delete their files now and not at some later garbage collection. Twice, as what the first
    collection frees may hold more."""
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def whole(text: str = "text"):
    """The text column, null as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def in_written_order(docs: DataFrame, place: str = "__place") -> DataFrame:
    """docs, as read from the files of one written table, with the place of each row: files follow the
    partitions that wrote them, and rows keep their number in a file whoever reads it. Other docs are
    written first. What is sent to all tasks is a number for each file."""
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        docs = written(docs, "ordered")
    named = docs.withColumns({"__file": F.col("_metadata.file_name"), "__row": F.col("_metadata.row_index")})
    part = F.regexp_extract("__file", r"^part-(\d+)", 1).try_cast("long")
    before = Window.orderBy(F.coalesce(part, F.lit(0)), "__file").rowsBetween(Window.unboundedPreceding, -1)
    files = named.groupBy("__file").agg(F.count(F.lit(1)).alias("__n")).select("__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return named.join(F.broadcast(files), "__file").withColumn(place, F.col("__before") + F.col("__row")).select(*docs.columns, place)


def written_buckets(df: DataFrame, tag: str, key: str, n: int) -> DataFrame:
    """As written(), in n buckets by key: what is grouped by that key later need not be moved again."""
    spark, name = df.sparkSession, f"locus_{_own(df.sparkSession)}_{tag}_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(n, key).option("path", f"{scratch_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name)
