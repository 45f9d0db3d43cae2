import math
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from locus.llm import mixing
from locus.llm.mixing import mix, mixed, order


def by_hand(blocks, weights):
    """Slot by slot: in each phase the released block with the earliest deadline."""
    left, out = {s: n for s, n in blocks.items() if n}, []
    while left:
        exact = {s: Fraction(weights[s]) for s in left if weights[s] > 0} or {s: Fraction(n) for s, n in left.items()}
        t, own, total = 0, dict.fromkeys(exact, 0), sum(exact.values())
        while all(left[s] for s in exact):
            ready = [(math.ceil((own[s] + 1) * total / w), s) for s, w in sorted(exact.items()) if math.floor(own[s] * total / w) <= t]
            s = min(ready)[1]
            out.append(s)
            own[s] += 1
            left[s] -= 1
            t += 1
        left = {s: n for s, n in left.items() if n}
    return out


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdef"), st.tuples(st.integers(0, 150), st.sampled_from([0.0, 0.1, 0.5, 1.0, 3.0])), min_size=1))
def test_slots_are_those_of_a_scheduler_that_goes_slot_by_slot(sources):
    blocks, weights = {s: n for s, (n, _) in sources.items()}, {s: w for s, (_, w) in sources.items()}
    assert list(order(blocks, weights)) == by_hand(blocks, weights)


def rows(n=3000):
    return [(i, f"t{i}", "hot" if i % 3 else f"s{i % 11}") for i in range(n)]


def test_every_row_once_and_places_without_gaps(frame):
    docs = frame(rows()).repartition(7)
    got = mix(docs, block_docs=8).select("doc_id", "source", "__block", "__slot", "__place").collect()
    assert sorted(r.doc_id for r in got) == list(range(3000))
    by = defaultdict(list)
    for r in got:
        by[r["__slot"]].append((r.source, r["__block"], r["__place"]))
    assert sorted(by) == list(range(len(by)))
    for parts in by.values():
        assert len({(s, b) for s, b, _ in parts}) == 1 and sorted(p for *_, p in parts) == list(range(len(parts)))
    last = Counter(r.source for r in got)
    assert all(sum(len(x) < 8 for x in by.values() if x[0][0] == s) <= 1 for s in last)


def test_given_weights_hold_in_prefixes(frame):
    docs = frame(rows()).repartition(5)
    weights = {"hot": 0.25, **{f"s{k}": 0.75 / 11 for k in range(11)}}
    got = mix(docs, weights, block_docs=1).select("source", "__slot").collect()
    order = [s for s, _ in sorted(((r.source, r["__slot"]) for r in got), key=lambda x: x[1])]
    assert sum(s == "hot" for s in order[:400]) == pytest.approx(100, abs=2)


def test_odd_rows_null_sources_and_no_weight(frame):
    odd = [(1, None, None), (1, None, None), (None, "", ""), (None, "", None), (2, "x", "a"), (3, "x", "b"), (3, "x", "b")]
    for weights in (None, {}, {"a": 1.0}, {None: 2.0, "": 1.0, "a": -1.0, "none": 5.0}):
        got = mix(frame(odd), weights, block_docs=2).collect()
        assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter(odd)
        assert all(r["__slot"] is not None for r in got)
    assert mix(frame([])).count() == 0


def test_mixed_returns_the_columns_in_order(frame):
    docs = frame(rows(400))
    got = mixed(docs, block_docs=4)
    assert got.columns == docs.columns
    want = [r.doc_id for r in sorted(mix(docs, block_docs=4).collect(), key=lambda r: (r["__slot"], r["__place"]))]
    assert [r.doc_id for r in got.collect()] == want


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.text(max_size=3), st.floats(1e-6, 10), min_size=1, max_size=12))
def test_all_prefixes_are_within_a_block_of_the_exact_weights(weights):
    total, done = sum(map(Fraction, weights.values())), dict.fromkeys(weights, 0)
    for t, s in zip(range(1, 1500), order(dict.fromkeys(weights, 5000), weights), strict=False):
        done[s] += 1
        assert all(abs(done[x] - Fraction(weights[x]) * t / total) < 1 for x in weights)


def test_a_long_run_keeps_to_unrounded_weights():
    for weights in ({"a": 1.0, "b": 1.0, "c": 1.0}, {"a": 0.7, "b": 0.2999, "c": 0.0001}):
        total, done = sum(weights.values()), dict.fromkeys(weights, 0)
        for t, s in zip(range(1, 60_001), order(dict.fromkeys(weights, 10**6), weights), strict=False):
            done[s] += 1
            if t % 97 == 0 or t > 59_900:
                assert all(abs(done[x] - weights[x] / total * t) < 1 for x in weights)


def test_prefixes_of_a_long_mix_follow_the_weights(frame, spark, monkeypatch):
    monkeypatch.setattr(mixing, "HELD_SLOTS", 1500)  # rows that go on in the next table
    docs = spark.range(24_000).selectExpr("id AS doc_id", "'' AS text", "'en' AS lang", "concat('s', id % 3) AS source", "0L AS n_chars")
    weights = {"s0": 1.0, "s1": 1.0, "s2": 1.0}
    got = sorted((r["__slot"], r.source) for r in mix(docs, weights, block_docs=1).select("source", "__slot").collect())
    assert [t for t, _ in got] == list(range(24_000))
    done = Counter()
    for t, s in got:
        done[s] += 1
        assert all(abs(done[x] - (t + 1) / 3) < 1 for x in weights)


def test_own_columns_of_clashing_names_and_repeated_ids(frame):
    docs = frame([(5, f"t{i}", "hot") for i in range(600)]).selectExpr("*", "text AS __slot", "text AS __row", "text AS __hash", "text AS __source")
    got = mix(docs, block_docs=4)
    assert [c for c in got.columns if c == "__slot"] == ["__slot"]
    assert sorted(r["__slot"] * 4 + r["__place"] for r in got.collect()) == list(range(600)) and {r["__row"] for r in got.collect()} == {f"t{i}" for i in range(600)}
    back = mixed(docs, block_docs=4)
    assert back.columns == docs.columns
    assert all(r["__slot"] == r["__row"] == r["__hash"] == r["__source"] == r["text"] for r in back.collect())
