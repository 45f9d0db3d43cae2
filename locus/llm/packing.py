"""Best-fit packing of tokenised documents by a grouping genetic algorithm on islands.

Documents become token ids plus an end token; those longer than a sequence are cut into pieces. Pieces as
long as a sequence need no search. The others are dealt at random into groups of a bounded size, and each
group is a bin-packing problem that some islands search at once: an island's solutions start from best-fit
over pieces in different orders; crossover injects the well-filled bins of one parent whole into the
other, removes the bins that then hold a piece twice, and best-fits the pieces so displaced; after each
round the best solution of an island migrates to the next one. A solution with as few bins as the total
length allows ends the search of its group. What lies in the least filled bins of all groups is pooled
and packed again in the same way, level by level, until one group is left.

Where documents have an order, pieces are numbered by it, groups hold what lies together in it, and a
sequence has the number of its middle piece: in the order of their numbers, sequences follow the documents
(a pooled one holds pieces from a wider range, in whose middle it then is, not at its start).
"""

from __future__ import annotations

import math
import os
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locus.llm.common import table, whole, written


class _Vocabulary(dict):
    """Words to the places of their ids. Words not met before are encoded a batch at a time; those that an
    older vocabulary has are taken from it, so that what is frequent outlives it."""

    def __init__(self, path: str, older: _Vocabulary | None = None):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = older.tokenizer if older is not None else Tokenizer.from_file(path)
        self.older = older
        if older is not None:
            older.older = None
        self.new: list[bytes] = []
        self.starts, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        self.new.append(word)
        return at

    def settle(self) -> None:
        """Find the ids of the new words."""
        words, self.new = self.new, []
        known = np.fromiter((self.older.get(w, -1) for w in words), np.int64, len(words)) if self.older is not None else np.full(len(words), -1)
        lengths, unknown = np.zeros(len(words), np.int64), np.flatnonzero(known < 0)
        old = known[known >= 0]
        lengths[unknown], encoded_ids = self._encode([words[i].decode() for i in unknown.tolist()])
        if len(old):
            n = self.older.starts[old + 1] - self.older.starts[old]
            lengths[known >= 0] = n
        starts = self.starts[-1] + np.cumsum(lengths)
        ids = np.empty(int(starts[-1] - self.starts[-1]), np.uint32)
        mine = np.repeat(known < 0, lengths)
        ids[mine] = encoded_ids
        if len(old):
            ids[~mine] = _gathered(self.older.ids, self.older.starts[old], n)
        self.starts, self.ids = np.concatenate([self.starts, starts]), np.concatenate([self.ids, ids])

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and all ids. Many words are encoded as one text, as a call for each
        costs more than the words do; which word an id belongs to follows from where in the text it stands."""
        lengths, ids = np.zeros(len(words), np.int64), [np.zeros(0, np.uint32)]
        for at in range(0, len(words), 256):
            part = words[at : at + 256]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            begins = np.cumsum([0, *(len(w) + 1 for w in part)])[:-1]
            stands = np.fromiter(chain.from_iterable(found.offsets), np.int64)[::2]
            lengths[at : at + 256] = np.bincount(np.searchsorted(begins, stands, "right") - 1, minlength=len(part))
            ids.append(np.asarray(found.ids, np.uint32))
        return lengths, np.concatenate(ids)


def _gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of flat that begin at starts, one after another."""
    stop = np.cumsum(lengths)
    return flat[np.repeat(starts - (stop - lengths), lengths) + np.arange(int(stop[-1]) if len(stop) else 0)]


_KEPT: dict[str, _Vocabulary] = {}


def vocabulary(path: str, most_words: int) -> _Vocabulary:
    """The words that this Python process has met; beyond ``most_words`` a new one begins, with this one to
    take from."""
    if path not in _KEPT or len(_KEPT[path]) > most_words:
        _KEPT[path] = _Vocabulary(path, _KEPT.get(path))
    return _KEPT[path]


def encoded(texts: list[str], words: _Vocabulary, end: int) -> Iterator[np.ndarray]:
    """The ids of each text, then the end id. The tokenizer splits at white space before anything else, so
    that a text's ids are those of its words one after the other (tests hold this against whole texts)."""
    found = [np.fromiter(map(words.__getitem__, t.encode().split()), np.int64) for t in texts]
    if words.new:
        words.settle()
    for at in found:
        begin = words.starts[at]
        yield np.append(_gathered(words.ids, begin, words.starts[at + 1] - begin), np.uint32(end))


def numbers_of_tokens(texts: Iterable[str], words: _Vocabulary) -> list[int]:
    """How many ids each text has, without an end id."""
    found = [np.fromiter(map(words.__getitem__, t.encode().split()), np.int64) for t in texts]
    if words.new:
        words.settle()
    lengths = np.diff(words.starts)
    return [int(lengths[at].sum()) for at in found]


PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("uid", pa.int64())])
PIECE_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, uid long"


#: A piece's number is its document's place and, in these bits, which piece of it it is.
PIECE_BITS = 20


def _pieces(path: str, size: int, end: int, most_words: int = 300_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # a few texts at once, however long they are
                part = batch.slice(at, 256)
                words = vocabulary(path, most_words)
                out: list[tuple] = []
                for doc, place, ids in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), encoded(part.column(1).to_pylist(), words, end), strict=True):
                    if place is not None:
                        uid = place << PIECE_BITS
                    for k, start in enumerate(range(0, len(ids), size)):
                        cut = ids[start : start + size]
                        out.append((doc, k, start, len(cut), zlib.crc32(cut.astype("<u4").tobytes()), uid))
                        uid += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), PIECE, strict=True)], schema=PIECE)

    return run


def pieces(docs: DataFrame, tokenizer_path: str, size: int = 4096, end: int = 1, id_col: str = "doc_id", text_col: str = "text", place_col: str | None = None) -> DataFrame:
    """A row for each piece of each document, with the CRC-32 of its ids and a number of its own, which
    follows ``place_col`` where that is given: a number from 0 that no two documents share."""
    place = F.col(place_col).cast("long") if place_col else F.lit(None).cast("long")
    return docs.select(F.col(id_col).cast("long"), whole(text_col), place.alias("__place")).mapInArrow(_pieces(tokenizer_path, size, end), PIECE_DDL)


# ---- the search in one group -------------------------------------------------------------------------


class _Bins:
    """Open bins by room left; the smallest room that is enough is found in a bit mask."""

    def __init__(self, size: int):
        self.size, self.rooms, self.mask, self.n = size, [[] for _ in range(size + 1)], 0, 0

    def add(self, bin_: int, room: int) -> None:
        self.rooms[room].append(bin_)
        self.mask |= 1 << room

    def fit(self, length: int) -> int:
        above = self.mask >> length
        if not above:
            bin_, room = self.n, self.size
            self.n += 1
        else:
            room = length + ((above & -above).bit_length() - 1)
            bin_ = self.rooms[room].pop()
            if not self.rooms[room]:
                self.mask ^= 1 << room
        if room - length:  # a full bin is closed
            self.add(bin_, room - length)
        return bin_


def best_fit(lengths: np.ndarray, order: np.ndarray, size: int) -> np.ndarray:
    bins, out = _Bins(size), np.empty(len(lengths), np.int32)
    ls = lengths.tolist()
    for i in order.tolist():
        out[i] = bins.fit(ls[i])
    return out


def _cost(lengths: np.ndarray, solution: np.ndarray, size: int) -> tuple[int, float]:
    """Fewer bins are better; of as many, those filled more unevenly."""
    fill = np.bincount(solution, weights=lengths) / size
    return int((fill > 0).sum()), -float((fill**2).sum())


def least_bins(lengths: np.ndarray, size: int) -> int:
    """As few bins as any packing needs (Martello and Toth's second bound): for each k, pieces longer than
    size - k have bins of their own, those longer than half a bin too, and pieces from k to half a bin go
    into what these leave free or into more."""
    x = np.sort(lengths.astype(np.int64))
    sums = np.concatenate([[0], np.cumsum(x)])
    ks = np.unique(np.concatenate([[0], x[x <= size // 2]]))
    half = np.searchsorted(x, size // 2, "right")
    low, high = np.searchsorted(x, ks, "left"), np.maximum(half, np.searchsorted(x, size - ks, "right"))
    free = (high - half) * size - (sums[high] - sums[half])
    more = np.maximum(0, -(-(sums[half] - sums[low] - free) // size))
    return int((len(x) - half + more).max())


def _crossover(rng, lengths: np.ndarray, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """b, where -1 is in no bin, with some well-filled bins of a."""
    fill = np.bincount(a, weights=lengths) / size
    good = np.flatnonzero(fill >= np.quantile(fill[fill > 0], 0.5))
    injected = good[rng.random(len(good)) < 0.5]
    taken = np.isin(a, injected)
    hit = np.unique(b[taken])  # bins of b with a piece that the injected bins hold too
    stays = (b >= 0) & ~np.isin(b, hit)
    loads_b = np.bincount(b[stays], weights=lengths[stays])
    weak = np.flatnonzero((loads_b > 0) & (loads_b < np.quantile(loads_b[loads_b > 0], 0.1))) if (loads_b > 0).any() else []
    stays &= ~np.isin(b, weak)
    out = np.full(len(a), -1, np.int64)
    _, out[taken] = np.unique(a[taken], return_inverse=True)
    n = int(out.max()) + 1 if taken.any() else 0
    if stays.any():
        _, kept = np.unique(b[stays], return_inverse=True)
        out[stays] = kept + n
        n = int(out.max()) + 1
    bins = _Bins(size)
    bins.n = n
    load = np.bincount(out[out >= 0], weights=lengths[out >= 0], minlength=n).astype(np.int64)
    for k in np.flatnonzero(load < size).tolist():
        bins.add(k, size - int(load[k]))
    loose = np.flatnonzero(out < 0)
    for i in loose[np.argsort(-lengths[loose], kind="stable")].tolist():
        out[i] = bins.fit(int(lengths[i]))
    return out.astype(np.int32)


def _mutate(rng, lengths: np.ndarray, a: np.ndarray, size: int) -> np.ndarray:
    """a with a few bins emptied and their pieces fitted again."""
    n = int(a.max()) + 1
    gone = np.isin(a, rng.choice(n, size=min(n, 3), replace=False))
    return _crossover(rng, lengths, a, np.where(gone, -1, a), size) if n > 1 else a


def evolve(lengths: np.ndarray, population: list[np.ndarray], rng, size: int, generations: int, most: int) -> list[np.ndarray]:
    """The best ``most`` solutions after some generations; the first is the best."""
    least = least_bins(lengths, size)
    scored = sorted(((_cost(lengths, s, size), k, s) for k, s in enumerate(population)), key=lambda x: x[:2])
    for _ in range(generations):
        if scored[0][0][0] <= least:
            break
        i, j = (int(x) for x in rng.integers(0, len(scored), 2))
        child = _crossover(rng, lengths, scored[min(i, j)][2], scored[max(i, j)][2], size) if i != j else _mutate(rng, lengths, scored[i][2], size)
        scored = sorted([*scored, (_cost(lengths, child, size), -1, child)], key=lambda x: x[:2])[:most]
    return [s for _, _, s in scored]


ISLAND = "grp long, island int, uids array<long>, lengths array<int>, population array<binary>, migrant binary"


def _island(size: int, generations: int, most: int, seed: int, round_: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = []
            for r in pdf.itertuples(index=False):
                lengths = np.asarray(r.lengths, np.int64)
                rng = np.random.default_rng([seed, round_, int(r.grp), int(r.island)])
                if r.population is None or not len(r.population):
                    down = np.argsort(-lengths, kind="stable")
                    orders = [down] if r.island == 0 else []
                    while len(orders) < most:  # nearly descending, each a little different
                        orders.append(np.argsort(-lengths * rng.uniform(0.8, 1.25, len(lengths)), kind="stable"))
                    population = []
                    least = least_bins(lengths, size)
                    for o in orders:
                        population.append(best_fit(lengths, o, size))
                        if int(population[-1].max()) + 1 <= least:
                            break
                else:
                    population = [np.frombuffer(x, np.int32) for x in r.population]
                if r.migrant is not None:
                    population.append(np.frombuffer(r.migrant, np.int32))
                population = evolve(lengths, population, rng, size, generations, most)
                done.append((r.grp, r.island, r.uids, r.lengths, [x.tobytes() for x in population], None))
            yield pd.DataFrame(done, columns=["grp", "island", "uids", "lengths", "population", "migrant"])

    return run


def _places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each piece: its bin, its offset there, how full the bin is and its middle piece."""
    for pdf in batches:
        for r in pdf.itertuples(index=False):
            lengths, bins = np.asarray(r.lengths, np.int64), np.frombuffer(r.best, np.int32)
            order = np.lexsort((np.asarray(r.uids), bins))
            stop = np.cumsum(lengths[order])
            first = np.flatnonzero(np.diff(bins[order], prepend=-1))
            uids, count = np.asarray(r.uids)[order], np.diff(np.append(first, len(order)))
            before = np.repeat((stop - lengths[order])[first], count)
            fill = np.bincount(bins, weights=lengths).astype(np.int64)
            yield pd.DataFrame({"grp": r.grp, "uid": uids, "length": lengths[order], "bin": bins[order].astype(np.int64), "offset": stop - lengths[order] - before, "fill": fill[bins[order]], "middle": np.repeat(uids[first + count // 2], count)})


def _cost_of(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cost = [_cost(np.asarray(r.lengths, np.int64), np.frombuffer(r.population[0], np.int32), size) for r in pdf.itertuples(index=False)]
            yield pd.DataFrame({"grp": pdf["grp"], "island": pdf["island"], "bins": [c[0] for c in cost], "uneven": [c[1] for c in cost], "uids": pdf["uids"], "lengths": pdf["lengths"], "best": [p[0] for p in pdf["population"]]})

    return run


def pack_items(items: DataFrame, size: int, group_items: int, islands: int, rounds: int, generations: int, population: int, seed: int, ordered: bool = False) -> tuple[DataFrame, int]:
    """Bins for items (uid, length): grp, uid, length, bin, offset, fill, middle; and the number of groups."""
    n = items.count()
    groups = max(1, math.ceil(n / group_items))
    if ordered:  # runs of places, whose items are counted, one after another into groups
        items = items.withColumn("run", F.floor(F.shiftright("uid", PIECE_BITS) / max(1, group_items // 16)))
        before = F.coalesce(F.sum("n").over(Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        runs = items.groupBy("run").agg(F.count(F.lit(1)).alias("n")).select("run", F.floor(before / group_items).alias("grp"))
        grouped = items.join(runs, "run").groupBy("grp")
    else:
        grouped = items.groupBy(F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(groups)).alias("grp"))
    dealt = grouped.agg(F.sort_array(F.collect_list(F.struct("uid", F.col("length").cast("int").alias("length")))).alias("x"))
    state = dealt.select("grp", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), F.col("x.uid").alias("uids"), F.col("x.length").alias("lengths"), F.lit(None).cast("array<binary>").alias("population"), F.lit(None).cast("binary").alias("migrant"))
    for k in range(rounds):
        state = written(state.mapInPandas(_island(size, generations, population, seed, k), ISLAND), "islands")
        if k + 1 < rounds and islands > 1:
            migrants = state.select("grp", ((F.col("island") + 1) % islands).alias("island"), F.col("population")[0].alias("migrant"))
            state = state.drop("migrant").join(migrants, ["grp", "island"])
    scored = state.mapInPandas(_cost_of(size), "grp long, island int, bins int, uneven double, uids array<long>, lengths array<int>, best binary")
    best = scored.groupBy("grp").agg(F.min_by(F.struct("uids", "lengths", "best"), F.struct("bins", "uneven", "island")).alias("b")).select("grp", "b.uids", "b.lengths", "b.best")
    return best.mapInPandas(_places, "grp long, uid long, length long, bin long, offset long, fill long, middle long"), groups


def pack(pieces_: DataFrame, size: int = 4096, group_items: int = 2048, islands: int = 2, rounds: int = 2, generations: int = 12, population: int = 4, seed: int = 7, repack_below: float = 0.98, ordered: bool = False) -> DataFrame:
    """sequence_id and offset for each piece (as pieces() gives them, written).

    A piece as long as a sequence has one of its own. Groups hold ``group_items`` pieces on average,
    whatever the input; the number of groups follows the number of pieces. After a level, pieces in bins
    filled below ``repack_below`` are pooled over all groups and packed again, until there is one group or
    what is pooled needs more than nine tenths of the groups before, as pieces do that fit with no others.
    ``ordered``: the pieces' numbers are an order, which groups and the numbers of sequences follow.
    """
    alone = pieces_.filter(F.col("length") == size).select("uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    items, level, parts = pieces_.filter(F.col("length") < size).select("uid", "length"), 0, [alone]
    while True:
        placed, groups = pack_items(items, size, group_items, islands, rounds, generations, population, seed + level, ordered)
        placed = written(placed.withColumn("level", F.lit(level)), "placed")
        number = F.col("middle").alias("sequence_id") if ordered else ((F.lit(level + 1).cast("long") * F.lit(1 << 58)) + F.col("grp") * F.lit(1 << 16) + F.col("bin")).alias("sequence_id")
        last = groups == 1
        full = placed if last else placed.filter(F.col("fill") >= repack_below * size)
        parts.append(full.select("uid", number, "offset"))
        if last:
            break
        poor = placed.filter(F.col("fill") < repack_below * size)
        if (left := poor.count()) == 0:
            break
        if math.ceil(left / group_items) > 0.9 * groups:
            parts.append(poor.select("uid", number, "offset"))
            break
        items, level = poor.select("uid", "length"), level + 1
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return pieces_.join(out, "uid").drop("uid")


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = 4096, end: int = 1, id_col: str = "doc_id", text_col: str = "text", place_col: str | None = None, **search) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset for each piece of docs.

    A null text is empty: one piece that holds the end token alone. Rows that repeat a doc_id are packed
    each for itself. Other columns are not looked at; an empty table gives an empty result. With
    ``place_col`` sequences follow the order of documents: see pieces().
    """
    return pack(written(pieces(docs, tokenizer_path, size, end, id_col, text_col, place_col), "pieces"), size, ordered=place_col is not None, **search)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), default_tokenizer())
