import os

import duckdb
import pytest

from locus.llm import registry

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the driver's tables aren't here")

COLUMNS = {
    "op2": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op3": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op4": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op5": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op6": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string", "formatted_chars": "bigint"},
    "op7": {"doc_id": "bigint", "n_bytes": "bigint", "payload_bytes": "bigint", "payload_sha256": "string", "tail_crc32": "bigint", "media_bytes": "bigint", "media_sha256": "string", "feature": "string"},
    "op8": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
}


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in registry.QUERIES] == [f"op{k}" for k in range(1, 11)]
    assert set(registry.SQL) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", registry.QUERIES)
def test_query_over_the_whole_table(spark, name):
    df = registry.QUERIES[name](spark, SMALL)
    want = COLUMNS.get(name.split("_")[0], {})
    assert {c: t for c, t in df.dtypes if c in want} == want
    rows = df.collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    if name.startswith(("op1_", "op2_", "op3_", "op4_", "op5_", "op7_", "op10_")):
        assert len(rows) == docs
    assert rows


@pytest.mark.parametrize("name", registry.SQL)
def test_sql(spark, name):
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    df = registry.QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    rel = c.sql(registry.SQL[name])
    assert sorted(rel.columns) == columns
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(rel.select(", ".join(columns)).fetchall())
