"""Quality classifier by compression with zstandard dictionaries.

Two dictionaries are trained, from good and from bad labelled texts. A text is compressed with each, piece
by piece so that a dictionary tells as much about the end of a long text as about its start, and once
without. The difference of the two sizes over their sum, with the sizes over the length, goes through a
logistic curve of second degree that is fitted on labelled texts other than those of the dictionaries; the
result is the likelihood of label 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.llm.common import table, whole, written

PIECE = 2048
LEVEL = 3


@dataclass
class Model:
    good: bytes = b""
    bad: bytes = b""
    weights: list[float] = field(default_factory=lambda: [0.0] * 7)
    mean: list[float] = field(default_factory=lambda: [0.0] * 6)
    scale: list[float] = field(default_factory=lambda: [1.0] * 6)


def _dictionary(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary; of texts too few to train one, their end."""
    pieces = [t[i : i + PIECE] for t in texts for i in range(0, len(t), PIECE)]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-size:]


class _Sizes:
    """Compressed sizes of a text with both dictionaries and without."""

    def __init__(self, model: Model):
        self.by = [self._compressor(model.good), self._compressor(model.bad), self._compressor(b"")]

    @staticmethod
    def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
        small = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        if len(dictionary) < 8:
            return zstandard.ZstdCompressor(**small)
        (data := zstandard.ZstdCompressionDict(dictionary)).precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=data, **small)

    def features(self, text: str | None) -> tuple[float, float, float]:
        raw = (text or "").encode()
        good, bad, plain = (sum(len(c.compress(raw[i : i + PIECE])) for i in range(0, max(1, len(raw)), PIECE)) for c in self.by)
        return (bad - good) / (bad + good), (bad + good) / (2 * len(raw) + 16), plain / (len(raw) + 16)


def _design(x: np.ndarray) -> np.ndarray:
    a, b, c = x.T
    return np.stack([a, b, c, a * b, a * a, b * b], axis=1)


def calibrate(x: np.ndarray, y: np.ndarray, model: Model, penalty: float = 0.1) -> None:
    """Fit the curve by Newton's steps, each halved until it helps."""
    d = _design(x)
    mean, scale = d.mean(0), np.maximum(d.std(0), 1e-9)
    z = np.column_stack([np.ones(len(d)), (d - mean) / scale])
    ridge = penalty * np.eye(z.shape[1])
    ridge[0, 0] = 1e-6

    def loss(w):
        s = z @ w
        return float(np.logaddexp(0, s).sum() - (y * s).sum() + w @ ridge @ w / 2)

    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        t = 1.0
        while t > 1e-6 and loss(w + t * step) > loss(w):
            t /= 2
        if t <= 1e-6 or np.abs(t * step).max() < 1e-8:
            break
        w = w + t * step
    model.weights, model.mean, model.scale = w.tolist(), mean.tolist(), scale.tolist()


def probabilities(x: np.ndarray, model: Model) -> np.ndarray:
    z = (_design(x) - np.asarray(model.mean)) / np.asarray(model.scale)
    s = model.weights[0] + np.clip(z, -50, 50) @ np.asarray(model.weights[1:])
    return 1 / (1 + np.exp(-np.clip(s, -500, 500)))


def training_rows(labels: DataFrame) -> DataFrame:
    """doc_id and label of the rows to learn from: those whose crc32(doc_id) mod 3 is not 1. Labels that
    differ for one doc_id count by their majority; null ids and labels don't count."""
    own = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    return own.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 12_000, class_bytes: int = 4_000_000, dictionary_bytes: int = 112_640) -> Model:
    """Learn from a bounded sample of labelled rows, in the order of a hash of doc_id: at most
    ``sample_rows`` rows, of which one half makes dictionaries (whole texts, as many as have
    ``class_bytes`` bytes in each class, but none of more than a quarter of that) and the other half the
    curve. Of rows with one doc_id the least text is the one that counts."""
    chosen = training_rows(labels).withColumn("h", F.xxhash64("doc_id", F.lit(3))).orderBy("h", "doc_id").limit(sample_rows)
    found = docs.select(F.col("doc_id").cast("long"), whole().alias("text")).join(F.broadcast(chosen), "doc_id")
    found = found.groupBy("doc_id", "label", "h").agg(F.min("text").alias("text"))  # of rows of one id, one
    found = written(found.withColumn("half", F.pmod("h", F.lit(2))), "sample")
    sums = found.filter("half = 0").select("doc_id", "label", "h", F.octet_length("text").alias("n"), "text")
    sizes = sums.select("doc_id", "label", "h", "n").orderBy("h").toPandas()
    sizes = sizes[sizes["n"] <= class_bytes // 4]  # one text makes no dictionary alone
    sizes["sum"] = sizes.groupby("label")["n"].cumsum()
    ids = sizes.loc[sizes["sum"] <= class_bytes, ["doc_id"]]
    model = Model()
    if len(ids):
        wanted = F.col("doc_id").isin([int(i) for i in ids["doc_id"].unique()])
        texts = sums.filter(wanted).filter(F.col("n") <= class_bytes // 4).select("doc_id", "label", "h", "text").orderBy("h", "text").toPandas()
        for label in (0, 1):
            own = [t.encode() for t in texts.loc[texts["label"] == label, "text"]]
            setattr(model, "good" if label else "bad", _dictionary(own, dictionary_bytes))
    rest = found.filter("half = 1").select("label", "text").mapInPandas(_features(model), "label int, a double, b double, c double").toPandas()
    if len(rest):
        calibrate(rest[["a", "b", "c"]].to_numpy(), rest["label"].to_numpy(float), model)
    return model


def _features(model: Model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes = _Sizes(model)
        for pdf in batches:
            x = np.array([sizes.features(t) for t in pdf["text"]]).reshape(-1, 3)
            yield pd.DataFrame({"label": pdf["label"], "a": x[:, 0], "b": x[:, 1], "c": x[:, 2]})

    return run


def score_column(model: Model, text_col: str = "text") -> Column:
    """The likelihood of label 1, between 0 and 1."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizes = _Sizes(model)
        for texts in batches:
            yield pd.Series(probabilities(np.array([sizes.features(t) for t in texts]).reshape(-1, 3), model))

    return score(whole(text_col))


def classify(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of docs.

    Scores depend on texts alone; a null text is empty and has the score of its sizes. Without labelled
    rows every score is 0.5. Repeated rows stay; a null doc_id stays null and counts as not held out.
    """
    model = fit(docs, labels, **how)
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"), score_column(model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **how) -> DataFrame:
    """The rows of docs, all columns, that are likelier good than bad."""
    return docs.filter(score_column(fit(docs, labels, **how)) >= threshold)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
