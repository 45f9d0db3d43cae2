"""Exact deduplication by a tree-merge of sorted digest runs.

Every scan partition makes one run: its distinct texts, sorted by a 64-bit digest. Runs are merged in
binomial rounds: the holders of runs are numbered in base ``radix``; in round k the holders that differ
only in digit k exchange parts, each keeping the part whose digest has its own digit k. After all rounds
each holder has one part of the digests, merged from all runs. At every level entries are merged only
when length and SHA-256 agree as well (the digest alone routes and sorts), and the entry retains the
smallest (or largest) identifier. A text thus costs at most one row for each run that has it, however
many copies there are; the answers go back to the runs, which hold the identifiers of their own copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.llm.common import shuffle_partitions, table, whole, written

RUN = "digest long, sha binary, n_bytes long, keep_id long, keep_run long, copies long"


def _better(ids: pd.Series, largest: bool) -> pd.Series:
    """Keys by which a larger value is retained; null identifiers lose to all others."""
    return ids if largest else -ids


def _heads(pdf: pd.DataFrame) -> np.ndarray:
    """Where a new text begins in rows sorted by digest, SHA-256 and length."""
    d, s, n = pdf["digest"].to_numpy(), pdf["sha"].to_numpy(), pdf["n_bytes"].to_numpy()
    new = np.ones(len(pdf), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (n[1:] != n[:-1]) | (s[1:] != s[:-1])
    return new


def _streamed(batches: Iterator[pd.DataFrame], fold) -> Iterator[pd.DataFrame]:
    """Fold groups of adjacent equal texts; the last group of a batch waits for the next batch."""
    rest = None
    for pdf in batches:
        if not len(pdf):
            continue
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        last = int(np.flatnonzero(_heads(pdf))[-1])
        rest = pdf.iloc[last:].reset_index(drop=True)
        if last:
            yield fold(pdf.iloc[:last].reset_index(drop=True))
        if len(rest) > 4096:  # a long group is folded as it comes
            rest = fold(rest)
    if rest is not None:
        yield fold(rest)


def _pick(pdf: pd.DataFrame, group: np.ndarray, largest: bool) -> pd.DataFrame:
    """One row a group: the retained identifier, the run it comes from, and the number of copies."""
    order = pd.DataFrame({"g": group, "null": pdf["keep_id"].isna(), "k": -_better(pdf["keep_id"].astype("Int64"), largest), "r": pdf["keep_run"]}).sort_values(["g", "null", "k", "r"], kind="stable")
    first = order.drop_duplicates("g").index
    out = pdf.loc[first].reset_index(drop=True)
    out["copies"] = np.bincount(group, weights=pdf["copies"]).astype("int64")
    return out


def _merge(largest: bool):
    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        return _pick(pdf, np.cumsum(_heads(pdf)) - 1, largest)[["digest", "sha", "n_bytes", "keep_id", "keep_run", "copies"]]

    return lambda batches: _streamed((b.astype({"keep_id": "Int64"}) for b in batches), fold)


def _local(largest: bool):
    """The run of one partition: distinct texts, with the identifiers of the rows that have them."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        group = np.cumsum(_heads(pdf)) - 1
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        out = _pick(pdf, group, largest)
        out["members"] = [sum(map(list, x), []) for x in np.split(pdf["members"].to_numpy(), starts[1:])]
        return out[["run", "digest", "sha", "n_bytes", "keep_id", "keep_run", "copies", "members"]]

    def run(batches):
        ready = (b.assign(keep_id=b["keep_id"].astype("Int64"), keep_run=b["run"], copies=1, members=[[None if pd.isna(i) else int(i)] for i in b["keep_id"].astype("Int64")]) for b in batches)
        yield from _streamed(ready, fold)

    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", radix: int = 4, digest=None) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row of docs.

    Texts are equal when their bytes are; null counts as empty, so null and empty texts are copies of
    each other. ``keep``: ``min`` or ``max``, which identifier stays; of repeated rows with that
    identifier exactly one is kept. A null identifier stays only if the group has no other. Other columns
    of docs are not looked at. An empty table gives an empty result. ``digest``: a bigint column that
    routes texts (xxhash64 of the text by default); whatever it is, unequal texts are never merged.
    """
    spark, largest = docs.sparkSession, keep == "max"
    text = whole(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("keep_id"),
        (F.xxhash64(text) if digest is None else digest).alias("digest"),
        F.unhex(F.sha2(text, 256)).alias("sha"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.spark_partition_id().cast("long").alias("run"),
    )
    runs = written(rows.sortWithinPartitions("digest", "sha", "n_bytes").mapInPandas(_local(largest), f"run long, {RUN}, members array<long>"), "runs")

    rounds = max(1, int(np.floor(np.log(max(radix, shuffle_partitions(spark))) / np.log(radix) + 1e-9)))
    holders = radix**rounds
    part = F.pmod(F.xxhash64("digest"), F.lit(holders))
    merged = runs.select("digest", "sha", "n_bytes", "keep_id", "keep_run", "copies", F.pmod("run", F.lit(holders)).alias("holder"))
    for k in range(rounds):
        unit = radix**k
        digit = lambda c: F.floor(c / F.lit(unit)) % F.lit(radix)  # noqa: B023, E731
        to = (F.col("holder") + (digit(part) - digit(F.col("holder"))) * F.lit(unit)).cast("int")
        merged = merged.withColumn("holder", to).repartitionById(holders, F.col("holder"))
        merged = merged.sortWithinPartitions("digest", "sha", "n_bytes").drop("holder").mapInPandas(_merge(largest), RUN)
        merged = merged.withColumn("holder", F.spark_partition_id().cast("long"))
    best = written(merged.drop("holder"), "merged")

    back = runs.select("run", "digest", "sha", "n_bytes", "members").join(best, ["digest", "sha", "n_bytes"])
    first = F.when(F.col("run") == F.col("keep_run"), F.coalesce(F.array_position("members", F.col("keep_id")) - 1, F.lit(0)))
    return back.withColumn("first", first).select(F.posexplode("members").alias("at", id_col), "keep_id", "copies", "first", "sha").select(
        id_col, "keep_id", F.col("copies").alias("group_size"), F.coalesce(F.col("at") == F.col("first"), F.lit(False)).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's query: of equal texts the row with the largest doc_id stays."""
    return exact_dedup(table(spark, sf_dir, "documents"), keep="max")


OP5_SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
