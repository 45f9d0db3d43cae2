import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from locus.llm import packing
from locus.llm.packing import _Vocabulary, best_fit, default_tokenizer, encoded, evolve, least_bins, pack, pack_documents


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_tokenizer())


def pieces_of(tokenizer, rows, size):
    out = []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for k, s in enumerate(range(0, len(ids), size)):
            cut = np.asarray(ids[s : s + size], "<u4")
            out.append((i, k, s, len(cut), zlib.crc32(cut.tobytes())))
    return sorted(out, key=repr)


def check(df, rows, tokenizer, size, **how):
    got = pack_documents(df, default_tokenizer(), size, **how).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == pieces_of(tokenizer, rows, size)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(by), least_bins(np.array([r.length for r in got]), size)


def test_odd_rows(frame, odd, tokenizer):
    check(frame(odd), odd, tokenizer, 4096)
    check(frame(odd), odd, tokenizer, 7)


def test_empty_table(frame):
    assert pack_documents(frame([]), default_tokenizer()).count() == 0


def test_nearly_as_few_as_the_lengths_allow(frame, prose, tokenizer):
    rows = list(enumerate(prose(600, 120)))
    n, least = check(frame(rows).repartition(6), rows, tokenizer, 512, group_items=128)
    assert n <= least + 5  # one for each group at most


def test_the_bound_is_below_any_packing():
    rng = np.random.default_rng(5)
    for size in (10, 11, 64):
        for _ in range(60):
            lengths = rng.integers(1, size + 1, rng.integers(1, 40))
            bound = least_bins(lengths, size)
            best = min(len(np.unique(best_fit(lengths, o, size))) for o in (np.argsort(-lengths), *(rng.permutation(len(lengths)) for _ in range(20))))
            assert -(-lengths.sum() // size) <= bound <= best


def test_long_documents_only(frame, tokenizer):
    rows = [(i, "word " * (200 + i)) for i in range(20)]
    check(frame(rows), rows, tokenizer, 100)


def test_words_alone_have_the_ids_that_they_have_in_texts(tokenizer):
    texts = ["a <|endoftext|> b x<|startoftext|>y", "", " é é　日本語 don't I'LL 12a!!b ﬁ İ é q̣̇x 각", "\x00 \x1c a\x85b ́x ‍ ​ \U0001f3f3️‍\U0001f308"]
    words = _Vocabulary(default_tokenizer())
    assert [x.tolist() for x in encoded(texts, words, 1)] == [[*e.ids, 1] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_search_keeps_pieces_and_never_gets_worse():
    rng = np.random.default_rng(1)
    for _ in range(10):
        lengths = rng.integers(1, 100, 60)
        start = [best_fit(lengths, rng.permutation(60), 100) for _ in range(4)]
        bins = lambda s: len(np.unique(s))
        best = evolve(lengths, start, rng, 100, 60, 4)[0]
        assert np.bincount(best, weights=lengths).max() <= 100 and len(best) == 60
        assert bins(best) <= min(map(bins, start))


def test_search_finds_what_best_fit_misses():
    """Perfect packings, shuffled: crossover of well-filled bins comes closer than best fit from any order."""
    rng = np.random.default_rng(3)
    gained = 0
    for _ in range(6):
        lengths = np.concatenate([(c := np.sort(rng.choice(np.arange(1, 100), 3, replace=False))) - np.concatenate([[0], c[:-1]]) for _ in range(30)])
        lengths = np.concatenate([lengths, [100 - lengths[i : i + 3].sum() for i in range(0, 90, 3)]])
        start = [best_fit(lengths, rng.permutation(len(lengths)), 100) for _ in range(4)]
        best = evolve(lengths, start, rng, 100, 200, 4)[0]
        gained += min(len(np.unique(s)) for s in start) - len(np.unique(best))
    assert gained > 0


def test_a_new_vocabulary_takes_from_the_one_before(tokenizer):
    rng = np.random.default_rng(2)
    for _ in range(30):
        texts = [" ".join(f"x{rng.integers(60)}y's" for _ in range(12)) for _ in range(5)]
        words = packing.vocabulary(default_tokenizer(), 25)
        assert [x.tolist() for x in encoded(texts, words, 1)] == [[*e.ids, 1] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert words.older is not None and words.older.older is None and len(words) < 120


def test_pooling_goes_on_while_it_gains_and_stops_where_nothing_fits(spark):
    """Every piece in one place, sequences gapless; pieces that fit with no others end the pooling."""
    rng = np.random.default_rng(5)
    for lengths in ([60] * 300, rng.integers(30, 60, 400).tolist(), [5] * 50):
        items = spark.createDataFrame([(k, int(n)) for k, n in enumerate(lengths)], "uid long, length long")
        got = pack(items, size=100, group_items=16, generations=2).toPandas().sort_values(["sequence_id", "offset"])
        assert len(got) == len(lengths)
        for _, rows in got.groupby("sequence_id"):
            assert rows["offset"].tolist() == np.cumsum([0, *rows["length"]])[:-1].tolist() and rows["length"].sum() <= 100
        if lengths[0] == 60:
            assert got["sequence_id"].nunique() == 300
