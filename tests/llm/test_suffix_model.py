import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from locus.llm.suffix_model import suffix_scores

def held():
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 2



def brute(rows, depth, least, gain):
    """The same model, in dictionaries."""
    texts = [(i, ["<s>", *(t or "").encode().lower().split(), b"\n"], i is not None and zlib.crc32(str(i).encode()) % 7 == 2) for i, t in rows]
    train = [t for _, t, held in texts if not held]
    words = Counter(w for t in train for w in t[1:])
    n, v = sum(words.values()), len(words)
    p0 = lambda w: (words[w] + 1) / (n + v + 1)
    after = defaultdict(Counter)
    for t in train:
        for k in range(1, len(t)):
            for d in range(1, depth + 1):
                if k - d >= 0:
                    after[tuple(t[k - d : k])][t[k]] += 1
    states = {}

    def p(t, k, d):
        if d == 0:
            return p0(t[k])
        below = p(t, k, d - 1)
        ctx = tuple(t[k - d : k]) if k - d >= 0 else None
        if ctx in states:
            total, kinds = states[ctx]
            return (after[ctx][t[k]] + kinds * below) / (total + kinds)
        return below

    for d in range(1, depth + 1):
        parent = defaultdict(float)
        for t in train:
            for k in range(d, len(t)):
                ctx = tuple(t[k - d : k])
                if sum(after[ctx].values()) >= least:
                    parent[ctx] += math.log(p(t, k, d - 1))
        new = {}
        for ctx, below in parent.items():
            c = after[ctx]
            total = sum(c.values())
            if sum(x * math.log(x) for x in c.values()) - total * math.log(total) - below >= gain * len(c):
                new[ctx] = (total, len(c))
        states.update(new)
    out = []
    for i, t, held in texts:
        ks = range(1, len(t))
        out.append((i, held, len(t) - 1, sum(words[t[k]] > 0 for k in ks), n, sum(math.log10(p0(t[k])) for k in ks), sum(math.log10(p(t, k, depth)) for k in ks)))
    return sorted(out, key=repr), len(states)


def check(df, rows, depth, share, gain, least):
    got = sorted((tuple(r) for r in suffix_scores(df, held(), depth=depth, share=share, gain=gain, most_words=400).collect()), key=repr)
    want, states = brute(rows, depth, least, gain)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)
    return states


def test_odd_rows(frame, odd):
    check(frame(odd), odd, 2, 0.0, 1.0, 2)


def test_empty_table(frame):
    assert suffix_scores(frame([]), held()).count() == 0


def test_equals_the_model_in_dictionaries(frame, prose):
    rows = [(i, "The " + t.upper() + " the end of it") for i, t in enumerate(prose(80, 40, vocabulary=12))]
    df = frame(rows).repartition(5)
    for depth in (1, 2, 3):
        assert check(df, rows, depth, 0.0, 0.3, 2) > 3


def test_held_out_texts_score_better_than_words_alone(frame, prose):
    line = "to be or not to be that is the question whether it is nobler in the mind".split()
    rows = [(i, " ".join(line[(i + k) % len(line)] for k in range(12))) for i in range(140)]
    got = suffix_scores(frame(rows), held(), share=0.0).filter("held_out").collect()
    assert got and all(r.score > r.base_score for r in got)


def test_rare_contexts_are_states_however_large_the_corpus(frame):
    """Two occurrences of a context among more than two million tokens: a share of them would need three."""
    filler = "x " * 210_000
    rows = [(100 + i, filler) for i in range(14)] + [(k, "red green blue " + tail) for k, tail in ((201, "one"), (202, "one"))]
    rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 != 2]
    assert sum(r[0] > 200 for r in rows) == 2 and len(rows) * 210_000 > 2_100_000
    got = {r.doc_id: r for r in suffix_scores(frame(rows), held(), gain=0.3).collect()}
    want, _ = brute(rows, 3, 2, 0.3)
    for w in want:
        assert got[w[0]].score == pytest.approx(w[6], rel=1e-9)
