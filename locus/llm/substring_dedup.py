"""Substring deduplication by prefix-partitioned suffix trees over words.

A suffix begins at each word of each document. Suffixes are split by their prefixes, first by one of
``short`` words: a prefix that one suffix alone has begins no repeat; one that at most ``group_suffixes``
have makes a group; one that more have is made longer by two fifths, step by step up to the window, and
its suffixes are split anew. A window can repeat only if none of the short prefixes in it stands alone, so
that nearly all other suffixes leave before groups are formed. Groups are dealt to tasks whose number
follows from the counts, so that a task's groups fit into memory.

In a group the suffixes are sorted by hashes of their longer and longer prefixes, at the same steps: they
are the leaves of a subtree, and the steps that neighbours have in common give its inner nodes, which so
have the depths of the steps. Nodes as deep as the window with two or more leaves are repeats. The words
before and after a node's leaves say whether it branches there. Along a document, nodes between which
nothing branches are one longer repeat: it is given as one span with its copies.

Texts don't move: a block sends hashes of prefixes with counts, then each of its distinct windows that may
repeat once; the answers say for each how many leaves it has and where it branches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.llm.blocks import ANSWER, ASK, Block, answered, ask, blocks, distinct, merged, mixed, owner, paired, squeeze, squeeze_sorted, unsqueeze, unsqueeze_sorted, word_hashes
from locus.llm.common import free_shuffles, shuffle_partitions, table, written, written_buckets

#: Words of the first prefix; bits of a prefix's key beyond those that number all words; bits dropped from the
#: hash of a longer prefix, of which 24 are left, as equal windows agree at every step.
SHORT, SPARE_BITS, STEP_SHIFT = 10, 13, np.uint64(40)
#: Keys, and windows, that one owner has at most on average.
OWNER_KEYS, OWNER_WINDOWS = 8_000_000, 250_000


def prefix_hashes(words: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """Hashes of the ``n`` words from each place on, for each n in lengths; made from those of powers of
    two, and only right where n words follow."""
    at = {1: mixed(words)}
    n = 1
    while 2 * n <= max(lengths):
        x = at[n].copy()
        left = max(0, len(x) - n)
        x[:left] = paired(at[n][:left], at[n][n:])
        at[2 * n], n = x, 2 * n
    out = {}
    for length in lengths:
        x, have = None, 0
        for p in sorted(at, reverse=True):
            if length & p:
                if x is None:
                    x = at[p].copy()
                else:
                    y = x.copy()
                    if len(x) > have:
                        y[: len(x) - have] = paired(x[: len(x) - have], at[p][have:])
                    x = y
                have += p
        out[length] = x
    return out


def steps(short: int, window: int) -> list[int]:
    """Lengths of prefixes, each two fifths longer than the last, up to the window."""
    out = [min(short, window)]
    while out[-1] < window:
        out.append(min(window, -(-out[-1] * 7 // 5)))
    return out


def _starts(sizes: np.ndarray, length: int, window: int) -> np.ndarray:
    """The places, in a block, at which ``length`` words of a document of at least ``window`` words begin."""
    begin = np.cumsum(sizes) - sizes
    n = np.where(sizes >= window, sizes - length + 1, 0)
    first = np.cumsum(n) - n
    return np.repeat(begin - first, n) + np.arange(int(n.sum()))


def _keys(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes & ~np.uint64((1 << (64 - bits)) - 1)


#: Answers about a prefix: no other suffix has it; its group is small; it needs a longer prefix.
ALONE, GROUP, LONGER = 0, 1, 2


def count_prefixes(group_suffixes: int, last: bool):
    """An owner's answers about prefixes; in a row for block -1 the suffixes in groups, prefixes that must
    be longer, and suffixes of the largest group. At the ``last`` step a prefix is a window, one node."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [unsqueeze_sorted(k) for k in pdf["keys"]]
        keys, where = merged(parts)
        n = np.bincount(where, weights=np.concatenate([unsqueeze(a, np.uint32) for a in pdf["a"]]), minlength=len(keys)).astype(np.int64)
        say = np.where(n < 2, ALONE, np.where((n <= group_suffixes) | last, GROUP, LONGER)).astype(np.uint8)
        cut = np.cumsum([len(p) for p in parts])[:-1]
        own = int(pdf["owner"].iloc[0])
        out = pd.DataFrame({"block": pdf["block"], "owner": own, "x": [squeeze(x) for x in np.split(say[where], cut)], "y": None})
        sums = np.array([n[say == GROUP].sum(), (say == LONGER).sum(), 0 if last else n[say == GROUP].max(initial=0)], np.int64)
        return pd.concat([out, pd.DataFrame({"block": [-1], "owner": [own], "x": [squeeze(sums)], "y": [None]})])

    return run


def _counted(keys: np.ndarray, where: np.ndarray) -> np.ndarray:
    return np.bincount(where, minlength=len(keys)).astype(np.uint32)


class _Suffixes:
    """The suffixes of a block that may repeat: their places and the keys of their prefixes."""

    def __init__(self, b: Block, lengths: list[int], bits: int):
        self.b, self.lengths, self.bits = b, lengths, bits
        self.words = word_hashes(b.words)
        self.hashes = prefix_hashes(self.words[b.ids], lengths)
        self.short, self.window = lengths[0], lengths[-1]
        self.begin = _starts(b.sizes, self.short, self.window)
        self.keys, _, self.where = distinct(_keys(self.hashes[self.short][self.begin], bits))

    def hear(self, said: pd.DataFrame, upto: int) -> None:
        """Take in the answers of the steps before ``upto``; then, if there are more, self.keys are those to ask."""
        say = answered(said[said["phase"] == 0], np.uint8)[self.where]
        state = np.zeros(len(self.b.ids) + self.window, np.uint8)
        state[self.begin] = say
        before = np.concatenate([np.zeros(1, np.int64), np.cumsum(state != ALONE)])
        at, inner = _starts(self.b.sizes, self.window, self.window), self.window - self.short + 1
        self.at = at[before[at + inner] - before[at] == inner]
        self.state, self.path = state[self.at], _keys(self.hashes[self.short][self.at], self.bits)
        for phase in range(1, upto + 1):
            if phase == len(self.lengths):
                break
            todo = np.flatnonzero(self.state == LONGER)
            self.keys, _, self.where = distinct(_keys(mixed(self.hashes[self.lengths[phase]][self.at[todo]]), self.bits))
            if phase < upto:
                self.state[todo], self.path[todo] = answered(said[said["phase"] == phase], np.uint8)[self.where], self.keys[self.where]

    def form(self, said: pd.DataFrame) -> None:
        """The distinct windows that are in groups, by path: a place of each, and its leaves in this block."""
        self.hear(said, len(self.lengths))
        stay = self.state == GROUP
        self.at, path = self.at[stay], self.path[stay]
        deep = self.hashes[self.window][self.at]
        order = np.lexsort((deep, path))
        path, deep = path[order], deep[order]
        new = np.ones(len(order), bool)
        new[1:] = (path[1:] != path[:-1]) | (deep[1:] != deep[:-1])
        self.node = np.empty(len(order), np.int64)
        self.node[order] = np.cumsum(new) - 1
        cut = np.flatnonzero(new)
        self.path, self.place, self.leaves = path[new], self.at[order][new], np.diff(np.append(cut, len(order)))
        self.cut, self.order = cut, order

    def sides(self) -> list[np.ndarray]:
        """For each distinct window a hash of the only word before it, and after it."""
        stop = np.cumsum(self.b.sizes)
        edge = np.zeros(len(self.b.ids) + 1, bool)  # a text begins
        edge[np.append(0, stop)] = True
        words = np.append(((self.words >> np.uint64(32)) | np.uint64(1)).astype(np.uint32)[self.b.ids], np.uint32(0))
        sides = (np.where(edge[self.at], 0, words[self.at - 1]), np.where(edge[self.at + self.window], 0, words[self.at + self.window]))
        return [_only(x[self.order], self.cut).astype(np.uint32) for x in sides]

    def ask_windows(self, owners: int, found: bool) -> pd.DataFrame:
        """Each window once: hashes of its prefixes at the steps beyond the first, its leaves, and with
        ``found`` the words beside it."""
        steps = [(self.hashes[n][self.place] >> STEP_SHIFT).astype(np.uint32) for n in self.lengths[1:] or self.lengths]
        columns = np.stack([*steps, self.leaves.astype(np.uint32), *(self.sides() if found else [])])
        cut = np.searchsorted(owner(self.path, owners), np.arange(owners + 1))
        rows = [(o, self.b.number, squeeze_sorted(self.path[i:j]), squeeze(columns[:, i:j].ravel()), None) for o, (i, j) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if j > i]
        return pd.DataFrame(rows, columns=[x.split()[0] for x in ASK.split(", ")])


def _only(x: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """For each run of x that begins at cut its only value, 0 where there are several."""
    if not len(cut):
        return x[:0]
    low, high = np.minimum.reduceat(x, cut), np.maximum.reduceat(x, cut)
    return np.where(low == high, low, 0)


def subtrees(levels: int, found: bool):
    """For each window of an owner's groups: 0 if its node has one leaf, else four times its leaves, and 1
    if it branches to the left, 2 if to the right (without ``found`` it is not known, and neither is said).
    ``levels``: steps beyond the first."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        paths = [unsqueeze_sorted(k) for k in pdf["keys"]]
        path = np.concatenate(paths)
        columns = np.concatenate([unsqueeze(raw, np.uint32).reshape(-1, len(p)) for raw, p in zip(pdf["a"], paths, strict=True)], axis=1)
        order = np.lexsort((*columns[:levels][::-1], path))
        path, columns = path[order], columns[:, order]
        same = columns[:levels, 1:] == columns[:levels, :-1]
        common = np.where(same.all(axis=0), levels, np.argmin(same, axis=0))  # steps that neighbours share
        deep = np.ones(len(path), bool)  # where a node as deep as the window begins
        deep[1:] = (path[1:] != path[:-1]) | (common < levels)
        cut, node = np.flatnonzero(deep), np.cumsum(deep) - 1
        n = np.bincount(node, weights=columns[levels]).astype(np.uint32)
        left, right = ((_only(columns[levels + 1 + k], cut) == 0) if found else 0 for k in (0, 1))
        told = np.empty(len(path), np.uint32)
        told[order] = np.where(n >= 2, 4 * n + left + 2 * right, 0).astype(np.uint32)[node]
        return pd.DataFrame({"block": pdf["block"], "owner": pdf["owner"], "x": [squeeze(x) for x in np.split(told, np.cumsum([len(p) for p in paths])[:-1])], "y": None})

    return run


def _ask_first(lengths: list[int], bits: int, owners: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                s = _Suffixes(Block(row), lengths, bits)
                yield ask(row.block, s.keys, owners, _counted(s.keys, s.where))

    return run


def _ask_longer(phase: int, lengths: list[int], bits: int, owners: int):
    def run(key, left: pd.DataFrame, said: pd.DataFrame) -> pd.DataFrame:
        out = [ask(0, np.zeros(0, np.uint64), owners)]
        for row in left.itertuples(index=False):
            if any((unsqueeze(x, np.uint8) == LONGER).any() for x in said.loc[said["phase"] == phase - 1, "x"]):
                s = _Suffixes(Block(row), lengths, bits)
                s.hear(said, phase)
                out.append(ask(row.block, s.keys, owners, _counted(s.keys, s.where)))
        return pd.concat(out)

    return run


def _ask_windows(lengths: list[int], bits: int, owners: int, found: bool):
    def run(key, left: pd.DataFrame, said: pd.DataFrame) -> pd.DataFrame:
        out = [ask(0, np.zeros(0, np.uint64), owners)]
        for row in left.itertuples(index=False):
            s = _Suffixes(Block(row), lengths, bits)
            s.form(said)
            out.append(s.ask_windows(owners, found))
        return pd.concat(out)

    return run


REMOVED = "doc_id long, n_words long, n_removed long, kept_sha256 string"
FOUND = ", kept_text string, repeats array<struct<first: long, stop: long, copies: long>>"
WINDOWS = -1  # the phase of answers about windows


def _spans(at: np.ndarray, told: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Longer repeats: first place, end and copies of runs of windows between which nothing branches."""
    at, told = at[told > 0], told[told > 0]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (told[1:] & 1 > 0) | (told[:-1] & 2 > 0)
    cut = np.flatnonzero(new)
    return at[cut], at[np.append(cut[1:], len(at)) - 1] + window if len(cut) else at[cut], told[cut].astype(np.int64) >> 2


def _remove(lengths: list[int], bits: int, found: bool):
    def run(key, left: pd.DataFrame, said: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for row in left.itertuples(index=False):
            b = Block(row)
            s = _Suffixes(b, lengths, bits)
            s.form(said)
            told = answered(said[said["phase"] == WINDOWS], np.uint32)[s.node]
            cover = np.zeros(len(b.ids) + 1, np.int64)
            repeat = s.at[told > 0]
            np.add.at(cover, repeat, 1)
            np.add.at(cover, repeat + s.window, -1)
            gone = np.cumsum(cover)[:-1] > 0
            words, stop = b.words, np.cumsum(b.sizes)
            first, end, copies = _spans(s.at, told, s.window) if found else (repeat[:0],) * 3
            of = np.searchsorted(first, np.append(0, stop))
            for k, (doc, i, j) in enumerate(zip(b.doc_ids, (stop - b.sizes).tolist(), stop.tolist(), strict=True)):
                kept = b" ".join([words[w] for w in b.ids[i:j][~gone[i:j]].tolist()])
                more = ()
                if found:
                    span = slice(of[k], of[k + 1])
                    more = (kept.decode(), [{"first": p, "stop": q, "copies": n} for p, q, n in zip((first[span] - i).tolist(), (end[span] - i).tolist(), copies[span].tolist(), strict=True)])
                rows.append((doc, j - i, int(gone[i:j].sum()), hashlib.sha256(kept).hexdigest(), *more))
        out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept_text", "repeats"] if found else [])])
        return out.assign(doc_id=pd.array([r[0] for r in rows], dtype="Int64"))

    return run


def substring_dedup(docs: DataFrame, window: int = 35, short: int = SHORT, group_suffixes: int = 200_000, found: bool = True, id_col: str = "doc_id", text_col: str = "text", most_words: int = 1_000_000) -> DataFrame:
    """For each row of docs: doc_id, n_words, n_removed, kept_sha256 and, with ``found``, kept_text and
    repeats: the spans of words (first, and stop after the last) that stand elsewhere as well, as long as no
    copy is lost or gained, with their number of copies.

    A word goes if a window of ``window`` words that covers it begins anywhere else as well, in the same
    document too; all places go. A null or empty text, and one of fewer words than the window, loses
    nothing. Repeated rows are copies of each other like any. A null id stays null. Other columns are not
    looked at; an empty table gives an empty result.

    ``group_suffixes``: suffixes in a group; a prefix that more have is made longer. A prefix as long as the
    window makes a group of one node, which any number may have: a block sends it once.
    """
    spark, lengths = docs.sparkSession, steps(short, window)
    parts = shuffle_partitions(spark)
    own = written_buckets(blocks(docs, most_words=most_words, id_col=id_col, text_col=text_col), "blocks", "block", parts)
    n_words = own.agg(F.sum("n")).first()[0] or 0
    bits, owners = min(64, n_words.bit_length() + SPARE_BITS), max(parts, -(-n_words // OWNER_KEYS))
    said, suffixes = None, 0
    for phase in range(len(lengths)):
        asked = own.groupBy("block").cogroup(said.groupBy("block")).applyInPandas(_ask_longer(phase, lengths, bits, owners), ASK) if phase else own.mapInPandas(_ask_first(lengths, bits, owners), ASK)
        heard = asked.groupBy("owner").applyInPandas(count_prefixes(group_suffixes, phase == len(lengths) - 1), ANSWER)
        heard = written(heard.withColumn("phase", F.lit(phase)), "prefixes")
        del asked
        free_shuffles(spark)
        sums = sum((unsqueeze(r["x"], np.int64) for r in heard.filter("block = -1").select("x").collect()), np.zeros(3, np.int64))
        said = heard.filter("block >= 0") if said is None else said.unionByName(heard.filter("block >= 0"))
        suffixes += int(sums[0])
        if not sums[1]:
            break
    owners = max(parts, -(-suffixes // OWNER_WINDOWS))
    asked = own.groupBy("block").cogroup(said.groupBy("block")).applyInPandas(_ask_windows(lengths, bits, owners, found), ASK)
    told = written(asked.groupBy("owner").applyInPandas(subtrees(max(1, len(lengths) - 1), found), ANSWER).withColumn("phase", F.lit(WINDOWS)), "windows")
    del asked
    free_shuffles(spark)
    return own.groupBy("block").cogroup(said.unionByName(told).groupBy("block")).applyInPandas(_remove(lengths, bits, found), REMOVED + FOUND * found)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), found=False)


#: Words, their windows as texts, those that begin twice or more, and what isn't covered by one.
OP4_SQL = """WITH w AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
p AS (SELECT r, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h FROM w, unnest(generate_series(1, len(ws) - 34)) AS u(i)),
t AS (SELECT h FROM p GROUP BY h HAVING count(*) > 1),
g AS (SELECT DISTINCT r, i + k AS j FROM p SEMI JOIN t USING (h), unnest(generate_series(0, 34)) AS u(k)),
o AS (SELECT r, j, ws[j] AS word FROM w, unnest(generate_series(1, len(ws))) AS u(j)),
k AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS kept FROM o ANTI JOIN g USING (r, j) GROUP BY r)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256 FROM w LEFT JOIN k USING (r)"""
