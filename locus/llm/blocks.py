"""Documents as blocks of word numbers, and exchanges of sorted keys between blocks and owners.

A block is one row: the documents of a scan partition, up to a number of words, as the words that are in
them and a number for each word of each document. Blocks are written once; later passes over the corpus
read these instead of texts. Counting over the corpus goes through exchanges: a block sends its own
distinct keys, each once with a count however often it comes, to the tasks that own their hash ranges; an
owner merges what all blocks sent and answers each with values in the order of its keys. Keys travel
sorted, as differences, compressed. So a key that a third of all rows have costs one entry a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locus.llm.common import whole

_ZERO = np.uint64(0)


def squeeze(x: np.ndarray) -> bytes:
    """Numbers as bytes, like bytes of all numbers together, compressed."""
    x = np.ascontiguousarray(x)
    return zstandard.ZstdCompressor(level=1).compress(x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()) if len(x) else b""


def unsqueeze(raw: bytes, kind) -> np.ndarray:
    if not raw:
        return np.zeros(0, kind)
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(flat.reshape(size, -1).T).view(kind).ravel()


def squeeze_sorted(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=_ZERO))


def unsqueeze_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(raw, np.uint64), dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finish: a one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of pairs in their order."""
    return mixed(a * np.uint64(0x9E3779B97F4A7C15) + mixed(b + np.uint64(0xD1B54A32D192ED03)))


def owner(keys: np.ndarray, owners: int) -> np.ndarray:
    """Who owns a (scrambled) key: its place in the range of all keys, so that owners' keys stay sorted."""
    return ((keys >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


BLOCK = "block long, n long, docs binary, nulls binary, held binary, sizes binary, words binary, ids binary"


def _blocks(most_words: int, lower: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        docs: list[int | None] = []
        held: list[bool] = []
        sizes: list[int] = []
        ids: list[np.ndarray] = []
        seen: _Numbers = _Numbers()
        count = 0

        def close() -> pa.RecordBatch:
            row = [
                number, count, squeeze(np.array([d or 0 for d in docs], np.int64)), squeeze(np.array([d is None for d in docs], np.uint8)), squeeze(np.array(held, np.uint8)), squeeze(np.array(sizes, np.int64)),
                zstandard.ZstdCompressor(level=3).compress(b" ".join(seen)), squeeze(np.concatenate(ids).astype(np.uint32)),
            ]
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=[x.split()[0] for x in BLOCK.split(", ")])

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for doc, text, out in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                    raw = text.encode()
                    words = (raw.lower() if lower else raw).split()
                    docs.append(doc)
                    held.append(out)
                    sizes.append(len(words))
                    ids.append(np.fromiter(map(seen.__getitem__, words), np.int64, len(words)))
                    count += len(words)
                    if count >= most_words or len(docs) >= 1 << 17:
                        yield close()
                        docs, held, sizes, ids, seen, count, number = [], [], [], [], _Numbers(), 0, number + 1
        if docs:
            yield close()

    return run


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def blocks(docs: DataFrame, lower: bool = False, held_out=None, most_words: int = 2_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs as blocks. Words are what stands between the bytes 0x20 and 0x09 to 0x0D; a null text has none."""
    held = F.coalesce(held_out, F.lit(False)) if held_out is not None else F.lit(False)
    return docs.select(F.col(id_col).cast("long"), whole(text_col), held).mapInArrow(_blocks(most_words, lower), BLOCK)


class Block:
    """A block read back."""

    def __init__(self, row):
        self.number = row.block
        self.docs = unsqueeze(row.docs, np.int64)
        self.null = unsqueeze(row.nulls, np.uint8).astype(bool)
        self.held = unsqueeze(row.held, np.uint8).astype(bool)
        self.sizes = unsqueeze(row.sizes, np.int64)
        self.ids = unsqueeze(row.ids, np.uint32).astype(np.int64)
        self._words = row.words

    @property
    def words(self) -> list[bytes]:
        raw = zstandard.ZstdDecompressor().decompress(self._words)
        return raw.split(b" ") if len(raw) else []

    @property
    def doc_ids(self) -> list[int | None]:
        return [None if n else int(d) for d, n in zip(self.docs, self.null, strict=True)]


ASK = "owner int, block long, keys binary, a binary, b binary"
ANSWER = "block long, owner int, x binary, y binary"


def ask(block: int, keys: np.ndarray, owners: int, a: np.ndarray | None = None, b: np.ndarray | None = None) -> pd.DataFrame:
    """The rows that send sorted distinct keys, with up to two numbers each, to their owners."""
    cut = np.searchsorted(owner(keys, owners), np.arange(owners + 1))
    rows = [(o, block, squeeze_sorted(keys[i:j]), None if a is None else squeeze(a[i:j]), None if b is None else squeeze(b[i:j])) for o, (i, j) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if j > i]
    return pd.DataFrame(rows, columns=[x.split()[0] for x in ASK.split(", ")])


def answered(rows: pd.DataFrame, kind, column: str = "x") -> np.ndarray:
    """A block's answers in the order of the keys that it asked for."""
    got = rows.sort_values("owner")[column]
    return np.concatenate([np.zeros(0, kind), *(unsqueeze(x, kind) for x in got)])


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, sorted; a place where each stands; and the place of each key among them."""
    order = np.argsort(keys)
    flat = keys[order]
    new = np.ones(len(flat), bool)
    np.not_equal(flat[1:], flat[:-1], out=new[1:])
    where = np.empty(len(flat), np.int64)
    where[order] = np.cumsum(new) - 1
    return flat[new], order[new], where


def merged(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of all parts, sorted, and the place of each part's keys among them."""
    keys, _, where = distinct(np.concatenate(parts))
    return keys, where
