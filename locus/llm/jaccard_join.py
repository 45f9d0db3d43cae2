"""N-gram Jaccard join by MinHash banding.

A text is the set of its word n-grams. Texts with equal sets are one class, and only its smallest row goes
on. Its MinHash signature is cut into bands; the numbers of bands and of rows in each are the cheapest
that find a pair of the wanted similarity with the wanted recall. Rows that share a band's hash are linked
to the smallest of them, a star and not all pairs, and the components of these stars hold every candidate
pair. Within a component pairs are verified on full n-gram sets, in tasks of bounded size that compare two
blocks of sets and put out how many links each set has, and of the links only a spanning forest.

A large component has a pivot, the n-grams that most of some of its sets have, and distances (one less the
similarity) obey the triangle inequality: sets nearer to the pivot than half the allowed distance are
linked, all of them to each other, without a look at pairs; sets whose distances to the pivot differ by
more than the allowed distance can't be; and neither can sets of too different sizes. Only blocks that may
hold other links are compared. The pivot decides what is looked at, never what is linked.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.llm.blocks import paired, squeeze_sorted, unsqueeze_sorted, word_hashes
from locus.llm.common import table, whole, written
from locus.llm.components import components


def bands_and_rows(similarity: float, recall: float, most_hashes: int = 400, far: float = 0.5) -> tuple[int, int]:
    """The bands and rows that find a pair of this similarity with this recall and, with at most so many
    hashes, take a pair of similarity ``far`` for a candidate as rarely as possible."""
    best = (2.0, 1, 1)
    for rows in range(1, 33):
        bands = 1 if similarity >= 1 else max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows)))
        if bands * rows <= most_hashes:
            best = min(best, (1 - (1 - far**rows) ** bands, bands, rows))
    return best[1], best[2]


def shingles(text: str, n: int) -> np.ndarray:
    """The distinct hashes of a text's word n-grams, sorted; of fewer words, that of them all."""
    words = text.encode().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = word_hashes(words)
    k = min(n, len(words))
    out = h[: len(h) - k + 1]
    for i in range(1, k):
        out = paired(out, h[i : len(h) - k + 1 + i])
    return np.unique(out)


def signature(grams: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of each hash function over the n-grams, a few thousand n-grams at a time."""
    x = (grams >> np.uint64(32)).astype(np.uint32) ^ grams.astype(np.uint32)
    least = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(least, (x[i : i + 2048, None] * a + b).min(axis=0), out=least)
    return least


SIGNED = "doc_id long, uid long, h1 long, h2 long, digest binary, n_grams int, bands array<long>"


def _sign(n: int, bands: int, rows: int, seed: int):
    schema = pa.schema([("doc_id", pa.int64()), ("uid", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("digest", pa.binary()), ("n_grams", pa.int32()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(seed)
        a = (rng.integers(0, 2**31, bands * rows, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
        b = rng.integers(0, 2**32, bands * rows, dtype=np.uint32)
        salt = rng.integers(1, 2**63, bands, dtype=np.uint64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, out = batch.slice(at, 256), []
                for *row, text in zip(*(part.column(i).to_pylist() for i in range(5)), strict=True):
                    grams = shingles(text, n)
                    if len(grams):
                        s = signature(grams, a, b).reshape(bands, rows).astype(np.uint64)
                        h = salt
                        for i in range(rows):
                            h = paired(h, s[:, i])
                        out.append((*row, hashlib.blake2b(grams.tobytes(), digest_size=16).digest(), len(grams), h.view(np.int64)))
                    else:
                        out.append((*row, None, 0, None))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


GRAMS = "uid long, n_grams int, grams binary"


def _sets(n: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            grams = [shingles(t, n) for t in pdf["text"]]
            yield pd.DataFrame({"uid": pdf["uid"], "n_grams": [len(g) for g in grams], "grams": [squeeze_sorted(g) for g in grams]})

    return run


def _linked(left: list[np.ndarray], right: list[np.ndarray], similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places in left and right whose sets are similar, some rows of left at a time."""
    flat = np.concatenate(right)
    who = np.repeat(np.arange(len(right)), [len(x) for x in right])
    order = np.argsort(flat, kind="stable")
    flat, who = flat[order], who[order]
    grams, begin, count = np.unique(flat, return_index=True, return_counts=True)
    sizes = np.array([len(x) for x in right])
    for i, own in enumerate(left):
        at = np.searchsorted(grams, own)
        at = at[(at < len(grams)) & (grams[np.minimum(at, len(grams) - 1)] == own)]
        n = count[at]
        hits = who[np.repeat(begin[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        common = np.bincount(hits, minlength=len(right))
        yield i, np.flatnonzero(common >= similarity * (len(own) + sizes - common) - 1e-9)


#: Rings of distance around a pivot, each half the allowed distance wide; the last one has all beyond.
RINGS = 64


def _pivot(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """The n-grams that more than half of a component's sampled sets have."""
    grams, n = np.unique(np.concatenate([unsqueeze_sorted(g) for g in pdf["grams"]]), return_counts=True)
    return pd.DataFrame({"root": [key[0]], "pivot": [squeeze_sorted(grams[2 * n > len(pdf)])]})


def _distances(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        pivots = {p: unsqueeze_sorted(p) for p in pdf["pivot"].unique()}
        out = []
        for grams, pivot in zip(pdf["grams"], pdf["pivot"], strict=True):
            own, other = unsqueeze_sorted(grams), pivots[pivot]
            common = len(np.intersect1d(own, other, assume_unique=True))
            out.append(1 - common / max(1, len(own) + len(other) - common))
        yield pd.DataFrame({"uid": pdf["uid"], "distance": out})


LINKS = "uid long, links long, u long, v long"


def _verify(similarity: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """The links between the sets of a task: of each set their weights' sum, and a spanning forest."""
        pdf = pdf.sort_values("uid").reset_index(drop=True)
        uid, weight, block = (pdf[c].to_numpy() for c in ("uid", "copies", "block"))
        sets = [unsqueeze_sorted(g) for g in pdf["grams"]]
        first = pdf["pair_first"].to_numpy()
        a = np.flatnonzero(block == first)
        b = np.flatnonzero(block != first)
        same = bool(first[0] == pdf["pair_second"].iloc[0])
        other = a if same else b
        links, parent = np.zeros(len(pdf), np.int64), np.arange(len(pdf))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        forest = []
        if len(a) and len(other):
            for i, js in _linked([sets[k] for k in a], [sets[k] for k in other], similarity):
                x, ys = int(a[i]), other[js]
                ys = ys[ys != x]
                links[x] += weight[ys].sum()
                if not same:
                    links[ys] += weight[x]
                for y in ys.tolist():
                    if (p := root(x)) != (q := root(y)):
                        parent[max(p, q)] = min(p, q)
                        forest.append((uid[x], uid[y]))
        some = np.flatnonzero(links)
        out = [pd.DataFrame({"uid": uid[some], "links": links[some], "u": None, "v": None})]
        if forest:
            out.append(pd.DataFrame({"uid": None, "links": None, "u": [x for x, _ in forest], "v": [y for _, y in forest]}))
        return pd.concat(out).astype("Int64")

    return run


def row_key(id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> tuple[Column, Column]:
    """128 bits that rows of the same id, which may be null, and the same text share, and no others."""
    key = (F.col(id_col).isNull(), F.col(id_col), whole(text_col))
    return F.xxhash64(*key).alias("h1"), F.xxhash64(F.lit(seed), *key).alias("h2")


def _joined(docs: DataFrame, n: int = 5, similarity: float = 0.8, recall: float = 0.999, block_sets: int = 128, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """Rows of docs (doc_id, uid, h1, h2, digest) and, for each digest, class_id, set_id, n_links and best:
    the uid of the row that stands for the class."""
    bands, rows = bands_and_rows(similarity, recall)
    hashes = row_key(id_col, text_col, seed)
    numbered = docs.select(F.col(id_col).cast("long"), F.monotonically_increasing_id().alias("uid"), *hashes, whole(text_col).alias("text"))
    signed = written(numbered.mapInArrow(_sign(n, bands, rows, seed), SIGNED), "signed")

    order = F.struct(F.col("doc_id").isNull(), "doc_id", "uid")
    classes = signed.filter("digest IS NOT NULL").groupBy("digest").agg(F.min_by(F.struct("uid", "h1", "h2", "doc_id", "n_grams", "bands"), order).alias("r"), F.count(F.lit(1)).alias("copies"))
    classes = written(classes.select("digest", "r.*", "copies"), "classes")

    bucketed = classes.select("uid", F.posexplode("bands").alias("band", "hash"))
    buckets = bucketed.groupBy("band", "hash").agg(F.min("uid").alias("v"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    stars = bucketed.join(buckets, ["band", "hash"]).filter("uid <> v").select(F.col("uid").alias("u"), "v")
    near = components(stars)
    near = written(near.unionByName(near.select("root").distinct().select(F.col("root").alias("v"), "root")).select(F.col("v").alias("uid"), "root"), "near")

    members = written(classes.select("uid", "h1", "h2", "n_grams", "copies").join(near, "uid"), "members")
    # texts are found again by hashes of their rows, which are the same whenever docs are read; members have
    # no bound and are never sent to all tasks
    texts = docs.select(*hashes, whole(text_col).alias("text")).join(members.select("uid", "h1", "h2").hint("merge"), ["h1", "h2"]).dropDuplicates(["h1", "h2"])
    sets = written(texts.select("uid", "text").mapInPandas(_sets(n), GRAMS), "sets").select("uid", "grams")
    # what is joined by component is written first: Spark can then split a large one's rows over tasks
    totals = written(members.groupBy("root").agg(F.count(F.lit(1)).alias("all")), "totals")
    members = members.select("uid", "root", "n_grams", "copies").join(totals, "root")
    small, large = members.filter(F.col("all") <= block_sets), members.filter(F.col("all") > block_sets)

    # large components: a pivot from some 64 of their sets, and distances to it
    some = large.filter(F.pmod(F.xxhash64("uid", F.lit(seed)), F.ceil(F.col("all") / 64)) == 0).select("root", "uid")
    pivots = written(some.join(sets, "uid").groupBy("root").applyInPandas(_pivot, "root long, pivot binary"), "pivots")
    measured = large.select("uid", "root").join(sets, "uid").join(pivots, "root").select("uid", "grams", "pivot").mapInPandas(_distances, "uid long, distance double")
    allowed = 1 - similarity
    width = allowed / 2 if allowed > 0 else 1.0
    ring = F.least(F.floor(F.coalesce("distance", F.lit(1.0)) / width).cast("int"), F.lit(RINGS - 1))
    size = F.floor(F.log("n_grams") / F.lit(math.log(1 / similarity) if similarity < 1 else 1.0)).cast("int")
    large = written(large.join(measured, "uid", "left").withColumns({"ring": F.when((F.col("distance") < width - 1e-9) & F.lit(allowed > 0), F.lit(0)).otherwise(F.greatest(ring, F.lit(1))), "size": size}), "large")
    core = large.filter("ring = 0")
    cores = written(core.groupBy("root").agg(F.min("uid").alias("v"), F.sum("copies").alias("weight")), "cores")
    inner = core.join(cores, "root").select("uid", (F.col("weight") - F.col("copies")).alias("links"), F.col("uid").alias("u"), "v")

    # their blocks, by size class, ring and number; a block meets those that it may have links with
    kind = F.col("size") * RINGS + F.col("ring")
    counts = large.groupBy("root", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    parts = written(counts.groupBy("root").agg(F.map_from_entries(F.collect_list(F.struct("kind", F.ceil(F.col("n") / block_sets).cast("int")))).alias("parts")), "parts")
    large = large.join(parts, "root").withColumn("kind", kind)
    part_of = lambda k: F.coalesce(F.try_element_at("parts", k), F.lit(0))
    name = lambda k, i: k.cast("long") * F.lit(1 << 32) + i.cast("long")
    upto = lambda k, ok: F.when(ok & (part_of(k) > 0), F.transform(F.sequence(F.lit(0), F.greatest(part_of(k) - 1, F.lit(0))), lambda i: name(k, i))).otherwise(F.array().cast("array<bigint>"))
    reach = lambda s, r: (F.col("ring") + r >= 0) & (F.col("ring") + r < RINGS) & ~((F.col("ring") == 0) & (F.lit(r) == 0))
    others = F.concat(*[upto((F.col("size") + s) * RINGS + F.col("ring") + r, reach(s, r)) for s in (-1, 0, 1) for r in range(-3, 4)])
    large = large.withColumns({"block": name(F.col("kind"), F.pmod(F.xxhash64("uid"), part_of(F.col("kind")))), "others": others})
    both = large.select("uid", "copies", "root", "block", F.explode("others").alias("other")).unionByName(small.select("uid", "copies", "root", F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("other")))
    dealt = both.select("uid", "copies", "root", "block", F.least("block", "other").alias("pair_first"), F.greatest("block", "other").alias("pair_second"))
    tasks = dealt.join(sets, "uid")
    found = written(tasks.groupBy("root", "pair_first", "pair_second").applyInPandas(_verify(similarity), LINKS).unionByName(inner), "links")
    links = found.filter("uid IS NOT NULL").groupBy("uid").agg(F.sum("links").alias("links"))
    roots = components(found.filter("u <> v").select("u", "v")).withColumnRenamed("v", "uid")

    known = classes.select("uid", "digest", F.col("doc_id").alias("set_id"), "copies").join(links, "uid", "left").join(roots, "uid", "left")
    known = written(known.withColumn("root", F.coalesce("root", "uid")).withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1), "known")
    least = known.groupBy("root").agg(F.min("set_id").alias("class_id"), F.min_by("uid", F.struct(F.col("set_id").isNull(), "set_id", "uid")).alias("best"))
    known = known.join(least, "root").select("digest", "class_id", "set_id", "n_links", "best")
    return signed, known


def jaccard_join(docs: DataFrame, n: int = 5, similarity: float = 0.8, recall: float = 0.999, block_sets: int = 128, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """doc_id, class_id, set_id and n_links for each row of docs.

    A link is between two rows whose sets of word ``n``-grams have a Jaccard similarity of ``similarity`` or
    more; words are what white space parts, as written. ``n_links``: a row's links, equal sets too;
    ``class_id``: the smallest doc_id that can be reached by links; ``set_id``: the smallest with the same
    set. A text of fewer words than n has one n-gram, all its words; a null, empty or blank text has none
    and no links, and is a class of its own, as is any row without links. Repeated rows link to each other.
    A null id counts as the largest. An empty table gives an empty result.
    """
    signed, known = _joined(docs, n, similarity, recall, block_sets, id_col, text_col, seed)
    out = signed.select("doc_id", "digest").join(known.drop("best"), "digest", "left")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("set_id", "doc_id").alias("set_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, **how) -> DataFrame:
    """docs with one row of each class: that of the smallest id, a null one being the largest.

    Rows are known by id and text, so that ids may be null or repeat. Rows that are the same in both are
    near copies of each other. Texts without words are no copies and all stay.
    """
    signed, known = _joined(docs, id_col=id_col, text_col=text_col, seed=seed, **how)
    stands = written(signed.join(known.select("digest", "best"), "digest").select("h1", "h2", (F.col("uid") == F.col("best")).alias("stays")), "stands")
    by_key = stands.groupBy("h1", "h2").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("rows"))
    key = dict(zip(("h1", "h2"), row_key(id_col, text_col, seed), strict=True))
    keyed = docs.withColumns({f"__{k}": c for k, c in key.items()})
    on = lambda t: (F.col("__h1") == t["h1"]) & (F.col("__h2") == t["h2"])
    gone, again = by_key.filter("NOT stays OR rows > 1"), by_key.filter("stays AND rows > 1")
    once = keyed.join(gone, on(gone), "left_anti")
    return once.unionByName(keyed.join(again, on(again), "left_semi").dropDuplicates(["__h1", "__h2"])).select(*docs.columns)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))
