import random

import corpus_pipeline
from locus.llm import mixing
from locus.llm.common import in_written_order, written


def test_stages_on_a_small_corpus(spark, frame, prose, tmp_path):
    rng = random.Random(4)
    good = prose(240, 80, vocabulary=2000)
    base = [f"b{i}" for i in range(80)]
    near = [" ".join(base[:40] + [f"e{k}"] + base[41:]) for k in range(5)]
    junk = [(f"junk{k % 4}### " * 40).strip() for k in range(60)]
    texts = good + near + good[:20] + junk
    rng.shuffle(texts)
    rows = [(i, t, f"s{i % 4}") for i, t in enumerate(texts)]
    docs = frame(rows, more=False)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int("###" not in t), 0) for i, t, _ in rows], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    now, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {i: t for i, t, _ in rows}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "n-gram Jaccard join", "mixing sources", "best-fit packing"]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        now = written(stage(spark, now, str(tmp_path)), "t")
        if k < 4:
            assert now.columns == docs.columns
            ids = [r.doc_id for r in now.select("doc_id").collect()]
            assert len(ids) == len(set(ids)) and set(ids) <= set(kept)
        if k == 0:
            assert not any("###" in kept[i] for i in ids) and len(ids) >= 0.97 * (len(texts) - len(junk))
        if k == 1:
            last = {}
            for i in before:  # noqa: F821
                last[kept[i]] = max(i, last.get(kept[i], -1))
            assert sorted(ids) == sorted(last.values())
        if k == 2:
            mine = [i for i in before if kept[i] in near]  # noqa: F821
            assert sorted(ids) == sorted(set(before) - set(mine) | {min(mine)})  # noqa: F821
        if k == 3:
            assert sorted(ids) == sorted(before)  # noqa: F821
        before = ids if k < 4 else before  # noqa: F821
    assert {r.doc_id for r in now.collect()} == set(before)
    assert corpus_pipeline.ORACLE_SQL is None
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(before)


def test_near_copies_with_null_and_repeated_ids(spark, frame):
    """One row of each class, whatever its id; a row that only shares a copy's id stays."""
    base = [f"b{i}" for i in range(80)]
    near = lambda k, of: " ".join(of[:40] + [f"e{k}"] + of[41:])
    other, third, clean = ([f"{x}{i}" for i in range(80)] for x in "qrz")
    rows = [(None, near(k, base)) for k in range(3)]  # null ids alone
    rows += [(7, near(k, other)) for k in range(3)]  # one id for all
    rows += [(1, near(1, third)), (9, near(2, third)), (None, near(3, third)), (9, " ".join(clean))]  # a clean sibling of 9
    rows += [(20, "same words here"), (20, "same words here"), (21, "same words here"), (3, None), (3, ""), (3, "")]
    docs = frame(rows, more=False)
    got = [(r.doc_id, r.text) for r in written(corpus_pipeline.near_stage(spark, docs, ""), "t").collect()]
    assert sum(i is None for i, _ in got) == 1 and sum(i == 7 for i, _ in got) == 1
    assert [t for i, t in got if i == 1] == [rows[6][1]] and [t for i, t in got if i == 9] == [rows[9][1]]
    assert sorted(i for i, t in got if t == "same words here") == [20] and sum(i == 3 for i, _ in got) == 3
    assert len(got) == 8 and corpus_pipeline.near_stage(spark, docs, "").columns == docs.columns


def test_sequences_follow_the_mixture(spark, frame):
    """Prefixes of the sequences have the share of each source that is its target."""
    rng = random.Random(1)
    words = lambda: " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(100, 400)))
    sources = {i: "small" if i < 900 else "large" for i in range(9000)}
    docs = frame([(i, words(), s) for i, s in sources.items()], more=False).repartition(5)
    first = written(corpus_pipeline.mixing_stage(spark, docs, ""), "t")
    place = {r.doc_id: r["__place"] for r in in_written_order(first).select("doc_id", "__place").collect()}
    slots = sorted(mixing.mix(docs).select("__slot", mixing.F.col("__place").alias("p"), "doc_id").collect())
    assert [r.doc_id for r in slots] == sorted(place, key=place.get) and sorted(place.values()) == list(range(9000))
    pieces = corpus_pipeline.packing_stage(spark, first, "").select("sequence_id", "offset", "length", "doc_id").collect()
    assert len(pieces) == 9000 and {r.doc_id for r in pieces} == set(sources)
    order = [r.doc_id for r in sorted(pieces)]  # by sequence_id
    share = 900**0.5 / (900**0.5 + 8100**0.5)  # 1/4 until the small source is used up, at 3,600
    for n in (500, 1000, 2000, 3000):
        assert abs(sum(sources[i] == "small" for i in order[:n]) / n - share) < 0.05
    assert sum(sources[i] == "small" for i in order[:4500]) > 800


def test_odd_rows_and_empty_tables(spark, frame, odd, tmp_path):
    for name, rows in (("odd", odd), ("empty", [])):
        d = tmp_path / name
        frame(rows, more=False).write.parquet(str(d / "documents.parquet"))
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(d / "labels.parquet"))
        got = corpus_pipeline.run(spark, str(d)).collect()
        assert {r.doc_id for r in got} == ({2, 3, 5, 6, 7, 8} if rows else set())


def test_exact_stage_takes_one_row_of_those_that_repeat_an_id(spark):
    rows = [(1, "same", "b", 2), (1, "same", "a", 9), (None, "same", "c", 1), (None, None, "x", 1), (None, "", "w", 5), (2, "other", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __sha256 string, __row long")
    got = corpus_pipeline.exact_stage(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, "same", "a", 9), (None, None, "x", 1), (2, "other", None, None)], key=repr)
