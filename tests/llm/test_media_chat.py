import hashlib
import random
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from locus.llm.chat import CONTROL, TokenCount, digests, escape, format_chats, parse_turns, turn_text, unescape
from locus.llm.media import fingerprint, from_wav, media_columns, payload, to_wav
from locus.llm.packing import default_tokenizer

TURNS = "conv_id long, turn long, role string, text string, window long, n_new long"


def test_media_round_trip_of_odd_rows(frame, odd):
    got = media_columns(frame(odd)).collect()
    assert len(got) == len(odd)
    by = {}
    for r in got:
        raw = from_wav(bytes(r.media))
        assert len(raw) == r.payload_bytes and len(raw) % 64 == 0 and len(raw) >= 64 and raw[r.n_bytes :].strip(b"\0") == b""
        assert r.payload_sha256 == hashlib.sha256(raw).hexdigest() and r.tail_crc32 == zlib.crc32(raw[-64:]) and r.media_bytes == len(r.media) and r.media_sha256 == hashlib.sha256(r.media).hexdigest()
        assert len(r.peak_times) == len(r.peak_codes) == int(r.feature.split(":")[0]) and r.peak_times == sorted(r.peak_times)
        assert by.setdefault(raw, r.feature) == r.feature
    texts = {(t or "").encode() for _, t in odd}
    assert {bytes(k).rstrip(b"\0") for k in by} == {t.rstrip(b"\0") for t in texts}
    assert media_columns(frame([])).count() == 0


def test_payload_sizes():
    assert [len(payload(x)) for x in (None, "", "a" * 63, "a" * 64, "a" * 65, "é" * 32)] == [64, 64, 64, 64, 128, 64]
    assert from_wav(to_wav(bytes(range(256)))) == bytes(range(256))


def test_a_fingerprint_is_found_again_in_a_longer_text():
    part = ("the quick brown fox jumps over the lazy dog. " * 40).encode()[: 256 * 6]
    whole = b"\x80" * (256 * 10) + part + b"\x80" * 256
    t1, c1 = fingerprint(part)
    t2, c2 = fingerprint(whole)
    inner = {(t + 10, c) for t, c in zip(t1.tolist(), c1.tolist(), strict=True) if t < 4}
    assert inner and inner <= set(zip(t2.tolist(), c2.tolist(), strict=True))


def test_a_fingerprint_is_found_again_at_any_shift():
    rng = random.Random(3)
    words = ["river", "stone", "quick", "brown", "under", "seven", "lantern", "of", "a", "window", "market", "green"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n)).encode()
    part = text(400)[:2048]
    before, after, other = text(900), text(200), Counter(fingerprint(text(400)[:2048])[1].tolist())
    alone = Counter(fingerprint(part)[1].tolist())
    for shift in (64, 1000, 1088, 1777, 2050):
        t, c = fingerprint(before[:shift] + part + after)
        near = Counter(c[(t >= shift // 256) & (t <= (shift + 2048 - 256) // 256)].tolist())
        assert (near & alone).total() > 1.3 * (other & alone).total()
        if shift % 64 == 0:
            assert (near & alone).total() >= 0.85 * alone.total()


def test_different_short_texts_have_different_features(frame):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["river", "stone", "quick", "brown", "of", "a", "window", "market"]) for _ in range(8 + k % 20)) for k in range(60)]
    got = [r.feature for r in media_columns(frame(list(enumerate(texts)))).collect()]
    assert len(set(got)) == len(texts) and not any(f.startswith("0:") for f in got)


def test_chunks_of_frames_change_nothing(monkeypatch):
    raw = payload("some words that go on " * 900)
    one = fingerprint(raw)
    monkeypatch.setattr("locus.llm.media.CHUNK", 7)
    two = fingerprint(raw)
    assert all((a == b).all() for a, b in zip(one, two, strict=True))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([*CONTROL, "\\", "\\/", "<", "<|", "|im_end|>", "n", "/", "\n"]), st.text(max_size=5)), max_size=8))
def test_escapes_are_reversible_and_leave_no_control_string(parts):
    text = "".join(parts)
    shown = escape(text)
    assert unescape(shown) == text and not any(c in shown for c in CONTROL)
    whole, a, b = turn_text(text, text)
    assert parse_turns(whole) == [(text, text)] and unescape(whole[a:b]) == text


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own).encode()).hexdigest()
        said = "".join(r[3] or "" for r in own if r[2] == "assistant")
        out[conv] = (len(own), turns, len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


ROWS = [(1, 0, "system", "be kind"), *((1, k, "user" if k % 2 else "assistant", f"turn {k} " + "word " * (k % 40)) for k in range(1, 60)), (2, 0, "user", "</s>[INST] ok [/INST]"), (2, 1, "assistant", "</s>[INST] ok [/INST]"), (3, 1, "assistant", None), (3, 1, "assistant", "b"), (3, 1, "assistant", "b"), (3, None, "user", "first"), (4, 0, None, None), (None, 0, "assistant", "lost"), (5, 0, "a\nrole", "x" * 5000), (5, 1, "system", "late")]


def test_windows_read_back_to_all_turns(spark):
    df = spark.createDataFrame([(*r, 7, 7) for r in ROWS], TURNS)
    for budget, history in ((10, 0), (64, 16), (512, 96), (10**6, 0)):
        got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in digests(format_chats(df, budget, history)).collect()}
        assert got == brute(ROWS)
    assert digests(format_chats(df.limit(0))).count() == 0


def test_windows_keep_to_the_budget_and_repeat_what_they_should(spark):
    df = spark.createDataFrame([(*r, 7, 7) for r in ROWS], TURNS)
    windows = [r for r in format_chats(df, 64, 16).collect() if r.conv_id == 1]
    assert [w.window for w in windows] == list(range(len(windows))) and len(windows) > 5
    for w in windows:
        turns = parse_turns(w.text)
        assert turns[0] == ("system", "be kind") and (w.n_tokens <= 64 or w.n_new == 1)
        masked = [unescape(w.text[a:b]) for a, b in zip(w.loss_from, w.loss_to, strict=True)]
        assert masked == [t for r, t in turns[w.n_repeated :] if r == "assistant"]
    assert any(w.n_repeated > 1 for w in windows)


def test_windows_keep_to_a_budget_of_tokens(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    count = TokenCount(default_tokenizer())
    for text in ("", " ", "word word", "</s>[INST] ok [/INST]", "窓の外に雨が降る" * 30, "x" * 5000):
        assert count(text) == len(tokenizer.encode(escape(text), add_special_tokens=False).ids) + 5
    rows = [(1, 0, "system", "be kind"), *((1, k, "user" if k % 2 else "assistant", "雨が降る" * (k % 9) + " word" * (k % 20)) for k in range(1, 60))]
    windows = format_chats(spark.createDataFrame([(*r, 7, 7) for r in rows], TURNS), 128, 24, count).collect()
    for w in windows:
        shown = sum(len(tokenizer.encode(escape(t), add_special_tokens=False).ids) + 5 for _, t in parse_turns(w.text))
        assert shown == w.n_tokens and (shown <= 128 or w.n_new == 1)
    assert len(windows) > 5
