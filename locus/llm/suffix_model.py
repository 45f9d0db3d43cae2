"""Scores of a probabilistic suffix tree over words.

A state is a context of up to ``depth`` words before a token (the start of a text counts as a word). A
context that occurs ``least`` times in the training texts, whatever their size, is kept as a state if the
distribution of the tokens after it diverges from that of its longest shorter state: if the log-likelihood gained over all its
occurrences is ``gain`` for each distinct token after it. A state's distribution is that of its parent
with its own counts (Witten and Bell's weights); the root has every word once more than seen, and one
place for all unseen words. A token is scored in the state that is the longest suffix of what precedes it.

The corpus is counted in exchanges (blocks.py): words, then at each depth the (context, token) pairs and
the contexts. What an exchange moves grows with the distinct pairs of each block; no task holds a model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.llm.blocks import ANSWER, ASK, Block, answered, ask, blocks, distinct, merged, mixed, paired, squeeze, squeeze_sorted, unsqueeze, unsqueeze_sorted, word_hashes
from locus.llm.common import free_shuffles, shuffle_partitions, table, written, written_buckets

#: Bits of a key beyond those that number the training tokens: of a million keys one is another's, at any size.
SPARE_BITS = 20
END, START = mixed(np.array([0x656E64, 0x7374617274], np.uint64))


def _split(x: np.ndarray, parts: list[np.ndarray]) -> list[bytes]:
    return [squeeze(y) for y in np.split(x, np.cumsum([len(p) for p in parts])[:-1])]


def _count_words(owners: int):
    """Totals and numbers of an owner's words; in a row for block -1 its tokens, words and texts."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [unsqueeze_sorted(k) for k in pdf["keys"]]
        keys, where = merged(parts)
        n = np.bincount(where, weights=np.concatenate([unsqueeze(a, np.uint32) for a in pdf["a"]]), minlength=len(keys)).astype(np.int64)
        own = int(pdf["owner"].iloc[0])
        places = np.split(where.astype(np.uint64), np.cumsum([len(p) for p in parts])[:-1])  # in the order of keys, and so sorted
        out = pd.DataFrame({"block": pdf["block"], "owner": own, "x": _split(n[where], parts), "y": [squeeze_sorted(p) for p in places]})
        sums = np.array([n.sum(), (n > 0).sum(), n[keys == END].sum()], np.int64)
        return pd.concat([out, pd.DataFrame({"block": [-1], "owner": [own], "x": [squeeze(sums)], "y": [None]})])

    return run


def _count_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
    """Totals of an owner's pairs, and for which of them a block is the one that counts them for their context."""
    parts = [unsqueeze_sorted(k) for k in pdf["keys"]]
    flat = np.concatenate(parts)
    keys, first, where = distinct(flat)
    n = np.bincount(where, weights=np.concatenate([unsqueeze(a, np.uint32) for a in pdf["a"]]), minlength=len(keys)).astype(np.uint32)
    mine = np.zeros(len(flat), np.uint8)
    mine[first] = 1
    return pd.DataFrame({"block": pdf["block"], "owner": pdf["owner"], "x": _split(n[where], parts), "y": _split(mine, parts)})


def _sum_contexts(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each of an owner's contexts the distinct tokens after it if it diverges enough to be a state, else 0."""
    parts = [unsqueeze_sorted(k) for k in pdf["keys"]]
    keys, where = merged(parts)
    distinct = np.bincount(where, weights=np.concatenate([unsqueeze(a, np.uint32) for a in pdf["a"]]), minlength=len(keys)).astype(np.uint32)
    gained = np.bincount(where, weights=np.concatenate([unsqueeze(b, np.float32) for b in pdf["b"]]), minlength=len(keys))
    state = np.where(gained >= 0, distinct, 0).astype(np.uint32)
    return pd.DataFrame({"block": pdf["block"], "owner": pdf["owner"], "x": _split(state[where], parts), "y": None})


class _Texts:
    """The tokens of a block, one after another, and what is known of them so far."""

    def __init__(self, b: Block, owners: int):
        self.owners, words = owners, b.words
        n, docs = b.sizes + 1, len(b.sizes)
        self.number, self.stop = b.number, np.cumsum(n)
        self.doc = np.repeat(np.arange(docs), n)
        last = np.zeros(int(n.sum()), bool)
        last[self.stop - 1] = True
        self.token = np.full(len(last), len(words))
        self.token[~last] = b.ids
        self.first = np.zeros(len(last), bool)
        self.first[self.stop - n] = True
        self.train = ~b.held[self.doc]
        hashes = np.append(word_hashes(words), END)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def ask_words(self) -> pd.DataFrame:
        n = np.bincount(self.token[self.train], minlength=len(self.order)).astype(np.uint32)
        return ask(self.number, self.hashes, self.owners, n[self.order])

    def hear_words(self, said: pd.DataFrame, totals: np.ndarray) -> None:
        self.n_tokens, self.n_words, n_texts = (int(x) for x in totals)
        bits = min(64, int(self.n_tokens).bit_length() + SPARE_BITS)
        self.mask = ~np.uint64((1 << (64 - bits)) - 1)
        n, number = np.empty(len(self.order), np.int64), np.empty(len(self.order), np.uint64)
        n[self.order] = answered(said, np.int64)
        told = said.sort_values("owner")
        number[self.order] = np.concatenate([unsqueeze_sorted(y) * np.uint64(self.owners) + np.uint64(o) for o, y in zip(told["owner"], told["y"], strict=True)])
        self.n, self.id = n[self.token], mixed(number)[self.token]
        self.p = (self.n + 1) / (self.n_tokens + self.n_words + 1)
        self.base = np.log10(self.p)
        self.context = np.full(len(self.token), START)  # of 1 word, then of more
        self.context[1:] = np.where(self.first[1:], START, paired(np.zeros(len(self.id) - 1, np.uint64), self.id[:-1]))
        self.seen = np.full(len(self.token), n_texts)  # how often the training texts have the context
        self.seen[1:] = np.where(self.first[1:], n_texts, self.n[:-1])

    def begin_depth(self, least: int) -> None:
        """Where the contexts of this depth are frequent enough, and the distinct pairs there."""
        self.at = np.flatnonzero(self.seen >= least)
        self.pairs, self.pair_first, self.pair = distinct(paired(self.context[self.at], self.id[self.at]) & self.mask)

    def ask_pairs(self) -> pd.DataFrame:
        n = np.bincount(self.pair, weights=self.train[self.at], minlength=len(self.pairs)).astype(np.uint32)
        return ask(self.number, self.pairs, self.owners, n)

    def hear_pairs(self, said: pd.DataFrame) -> None:
        """How often pairs come; contexts of one word more follow from them."""
        self.pair_n, self.mine = answered(said, np.uint32).astype(np.int64), answered(said, np.uint8, "y")
        now = np.zeros(len(self.token), np.int64)
        now[self.at] = self.pair_n[self.pair]
        self.now = now
        at = self.at[self.pair_first]
        self.contexts, first, self.of = distinct(self.context[at] & self.mask)
        self.ctx, self.ctx_n = self.of[self.pair], self.seen[at][first]
        self.next_context, self.next_seen = self.context.copy(), np.zeros(len(self.token), np.int64)
        self.next_context[1:] = paired(self.context[:-1], self.id[:-1])
        self.next_seen[1:] = np.where(self.first[1:], 0, now[:-1])

    def ask_contexts(self, gain: float) -> pd.DataFrame:
        """This block's part of each context's distinct tokens, and of the log-likelihood that its own counts
        gain on its parent beyond what a state must; of a context's parts the sum over all blocks decides."""
        mine = (self.mine > 0) & (self.pair_n > 0)
        add = lambda of, x: np.bincount(of, weights=x, minlength=len(self.contexts))
        kinds = add(self.of, mine)
        own = add(self.of, mine * self.pair_n * np.log(np.maximum(self.pair_n, 1)))
        below = add(self.ctx, self.train[self.at] * (np.log(self.p[self.at]) + np.log(np.maximum(self.ctx_n, 1))[self.ctx]))
        return ask(self.number, self.contexts, self.owners, kinds.astype(np.uint32), (own - below - gain * kinds).astype(np.float32))

    def hear_contexts(self, said: pd.DataFrame) -> None:
        t = answered(said, np.uint32).astype(np.float64)[self.ctx]
        p = (self.now[self.at] + t * self.p[self.at]) / np.maximum(self.ctx_n[self.ctx] + t, 1)
        self.p[self.at] = np.where(t > 0, p, self.p[self.at])

    def next_depth(self) -> None:
        self.context, self.seen = self.next_context, self.next_seen

    def replay(self, said: pd.DataFrame, totals: np.ndarray, upto: int, least: int) -> None:
        """Hear the answers of all phases up to one: words are 0, pairs at depth d 2d - 1, contexts 2d."""
        self.hear_words(said[said["phase"] == 0], totals)
        for phase in range(1, upto + 1):
            if phase % 2:
                if phase > 1:
                    self.next_depth()
                self.begin_depth(least)
                self.hear_pairs(said[said["phase"] == phase])
            else:
                self.hear_contexts(said[said["phase"] == phase])


def _first(owners: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                yield _Texts(Block(row), owners).ask_words()

    return run


KINDED = "kind int, " + ASK


def _asking(depth: int, most: int, owners: int, totals: np.ndarray, least: int, gain: float):
    """With all answers up to the pairs of ``depth`` (0: the words), ask for the contexts of that depth and
    the pairs of the next."""

    def run(key, left: pd.DataFrame, said: pd.DataFrame) -> pd.DataFrame:
        out = [ask(0, np.zeros(0, np.uint64), owners).assign(kind=0)]
        for row in left.itertuples(index=False):
            t = _Texts(Block(row), owners)
            t.replay(said, totals, 2 * depth - 1 if depth else 0, least)
            if depth:
                out.append(t.ask_contexts(gain).assign(kind=2 * depth))
                t.next_depth()
            if depth < most:
                t.begin_depth(least)
                out.append(t.ask_pairs().assign(kind=2 * depth + 1))
        return pd.concat(out)[["kind", "owner", "block", "keys", "a", "b"]]

    return run


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    kind = int(pdf["kind"].iloc[0])
    return (_count_pairs(pdf) if kind % 2 else _sum_contexts(pdf)).assign(phase=kind)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(most: int, owners: int, totals: np.ndarray, least: int):
    def run(key, left: pd.DataFrame, said: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in left.itertuples(index=False):
            b = Block(row)
            t = _Texts(b, owners)
            t.replay(said, totals, 2 * most, least)
            by = lambda x: np.bincount(t.doc, weights=x, minlength=len(b.sizes))  # noqa: B023, E731
            out.append(pd.DataFrame({"doc_id": pd.array(b.doc_ids, dtype="Int64"), "held_out": b.held, "n_tokens": b.sizes + 1, "n_known": by(t.n > 0).astype(np.int64), "train_tokens": t.n_tokens, "base_score": by(t.base), "score": by(np.log10(t.p))}))
        return pd.concat(out)

    return run


def suffix_scores(docs: DataFrame, held_out: Column, depth: int = 3, share: float = 0.0, gain: float = 1.0, id_col: str = "doc_id", text_col: str = "text", most_words: int = 700_000, least: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of each row of docs,
    by a tree learnt from the rows where ``held_out`` is not true.

    Words are in lower case (A to Z alone); the end of a text is a token. A null or empty text has that
    token alone. Repeated rows are scored, and learnt from, each. A null id stays null. Other columns are
    not looked at; an empty table gives an empty result. ``least``: how often a
    context that may be a state must occur; it doesn't depend on the input, so that states grow with it.
    ``share`` raises it to a part of all training tokens; none by default.
    """
    spark = docs.sparkSession
    owners = shuffle_partitions(spark)
    own = written_buckets(blocks(docs, lower=True, held_out=held_out, id_col=id_col, text_col=text_col, most_words=most_words), "texts", "block", owners)
    words = written(own.mapInPandas(_first(owners), ASK).groupBy("owner").applyInPandas(_count_words(owners), ANSWER).withColumn("phase", F.lit(0)), "words")
    totals = sum((unsqueeze(r["x"], np.int64) for r in words.filter("block = -1").select("x").collect()), np.zeros(3, np.int64))
    least = max(least, math.ceil(share * int(totals[0])))
    said = words.filter("block >= 0")
    free_shuffles(spark)
    for d in range(depth + 1):
        asked = own.groupBy("block").cogroup(said.groupBy("block")).applyInPandas(_asking(d, depth, owners, totals, least, gain), KINDED)
        heard = asked.groupBy("kind", "owner").applyInPandas(_answer, ANSWER + ", phase int")
        said = said.unionByName(written(heard, "heard"))
        del asked, heard
        free_shuffles(spark)
    return own.groupBy("block").cogroup(said.groupBy("block")).applyInPandas(_score(depth, owners, totals, least), SCORES)


def op2_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_scores(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 == 2)
