import hashlib
from collections import Counter

import numpy as np
import pandas as pd

from locus.llm.blocks import ask, unsqueeze
from locus.llm.substring_dedup import GROUP, LONGER, count_prefixes, prefix_hashes, steps, substring_dedup


def brute(rows, window):
    texts = [(t or "").encode().split() for _, t in rows]
    seen, longer = (Counter(tuple(w[k : k + n]) for w in texts for k in range(len(w) - n + 1)) for n in (window, window + 1))
    out = []
    for (i, _), w in zip(rows, texts, strict=True):
        gone, spans, last = [False] * len(w), [], 0
        for k in range(len(w) - window + 1):
            n = seen[tuple(w[k : k + window])]
            if n < 2:
                last = 0
                continue
            gone[k : k + window] = [True] * window
            if last and last == n == longer[tuple(w[k - 1 : k + window])]:  # the same copies, one word on
                spans[-1][1] += 1
            else:
                spans.append([k, k + window, n])
            last = n
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode(), [tuple(s) for s in spans]))
    return sorted(out, key=repr)


def check(df, rows, window=35, **how):
    got = substring_dedup(df, window=window, **how).collect()
    assert sorted(((*r[:5], [tuple(x) for x in r.repeats]) for r in got), key=repr) == brute(rows, window)


def test_odd_rows(frame, odd):
    check(frame(odd), odd)


def test_empty_table(frame):
    assert substring_dedup(frame([])).count() == 0


def test_shared_passages_small_alphabet(frame, prose):
    texts = prose(120, 80, vocabulary=3)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, t + (" " + passage + " tail" if i % 3 == 0 else "")) for i, t in enumerate(texts)]
    check(frame(rows).repartition(5), rows, 12)
    check(frame(rows).repartition(5), rows, 35)


def test_small_groups_take_longer_prefixes(frame, prose):
    rows = list(enumerate(prose(150, 60, vocabulary=4, seed=2)))
    check(frame(rows).repartition(6), rows, 9, group_suffixes=2, short=3, most_words=500)


def test_windows_shorter_than_the_first_prefix(frame, prose):
    rows = list(enumerate(prose(60, 30, vocabulary=20, seed=3)))
    check(frame(rows), rows, 4)


def test_prefix_hashes_tell_prefixes_apart():
    x = np.random.default_rng(0).integers(0, 3, 4000).astype(np.uint64)
    for n, h in prefix_hashes(x, [1, 5, 10, 35]).items():
        by = {}
        for i in range(len(x) - n + 1):
            assert by.setdefault(tuple(x[i : i + n]), h[i]) == h[i]
        assert len(set(by.values())) == len(by)


def test_prefixes_grow_step_by_step_to_the_window():
    assert steps(10, 35) == [10, 14, 20, 28, 35]
    assert steps(10, 4) == [4]


def test_no_group_is_above_its_bound_however_often_a_block_has_a_prefix():
    keys, n = np.arange(1, 5, dtype=np.uint64) << np.uint64(40), np.array([1, 200_000, 200_001, 300_000], np.uint32)
    asked = ask(0, keys, 1, n)
    for last in (False, True):
        out = count_prefixes(200_000, last)(asked)
        say = unsqueeze(out["x"].iloc[0], np.uint8).tolist()
        grouped, longer, largest = unsqueeze(out["x"].iloc[1], np.int64).tolist()
        assert say == [0, GROUP, *([GROUP] * 2 if last else [LONGER] * 2)]
        assert (grouped, longer, largest) == ((700_001, 0, 0) if last else (200_000, 2, 200_000))


def test_a_prefix_above_the_default_bound(frame):
    """More suffixes than a group may have begin with the same ten words, in two texts and in one."""
    rows = [(1, "a " * 120_000 + "b"), (2, "c " + "a " * 120_000), (3, "x y z"), (4, "a " * 34)]
    got = {r.doc_id: r for r in substring_dedup(frame(rows), most_words=100_000).collect()}
    assert [(got[i].n_words, got[i].n_removed, got[i].kept_text) for i in (1, 2, 3, 4)] == [(120_001, 120_000, "b"), (120_001, 120_000, "c"), (3, 0, "x y z"), (34, 0, " ".join("a" * 34))]


def test_repeats_are_as_long_as_their_copies_allow(frame):
    words = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(["p", *words[:120], "q"])), (2, " ".join(["r", *words[:120], "s"])), (3, " ".join(["t", *words[40:90], "u"]))]
    got = {r.doc_id: [tuple(x) for x in r.repeats] for r in substring_dedup(frame(rows)).collect()}
    assert got[3] == [(1, 51, 3)]
    assert got[1] == [(1, 75, 2), (41, 91, 3), (57, 121, 2)]
