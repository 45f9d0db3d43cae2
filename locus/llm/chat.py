r"""Chat formatting in budgeted windows.

A turn is ``<|im_start|>role\ntext<|im_end|>\n``. Control strings inside roles and texts are broken by a
backslash and a slash after their first character, and a backslash is doubled, so that unescape() gives
the text back. Prefix sums of the turns' tokens choose windows that begin and end at turns: each holds the
system turn that opens the conversation (again), some of the turns before (again, up to ``history``
tokens), and as many new turns as the budget allows, one at least. The loss mask covers the texts of new
assistant turns, so that each is learned from once. A conversation's turns are never held together: rows
come sorted, and only the window being filled is in memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.llm.common import shuffle_partitions, table
from locus.llm.packing import default_tokenizer, numbers_of_tokens, vocabulary

START, END = "<|im_start|>", "<|im_end|>"
CONTROL = (START, END, "<|im_sep|>", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_BEGIN = re.compile("(?=" + "|".join(map(re.escape, CONTROL)) + ")(.)", re.S)
_ESCAPED = re.compile(r"\\([\\/n])")


def escape(text: str) -> str:
    return _BEGIN.sub(r"\1\\/", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: {"\\": "\\", "/": "", "n": "\n"}[m[1]], text)


def turn_text(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and from where to where its text stands in it."""
    head = START + escape(role).replace("\n", "\\n") + "\n"
    body = escape(text)
    return head + body + END + "\n", len(head), len(head) + len(body)


def parse_turns(window: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted window."""
    out = []
    for part in window.split(START)[1:]:
        role, _, rest = part.partition("\n")
        out.append((unescape(role), unescape(rest[: rest.index(END)])))
    return out


def count_tokens(text: str) -> int:
    """Words, and one for each of the turn's marks."""
    return len(text.split()) + 2


class TokenCount:
    """A turn's tokens by the tokenizer at ``path``: those of its text as it is shown, and one for each of the
    marks, the role and the two ends of line. Words are encoded once a worker, up to ``most_words`` of them,
    and those of many texts together."""

    def __init__(self, path: str, most_words: int = 100_000):
        self.path, self.most_words = path, most_words

    def many(self, texts: Iterable[str]) -> list[int]:
        return [n + 5 for n in numbers_of_tokens(map(escape, texts), vocabulary(self.path, self.most_words))]

    def __call__(self, text: str) -> int:
        return self.many([text])[0]


class _Conversation:
    """One conversation's windows, made as its turns come."""

    def __init__(self, conv, budget: int, history: int):
        self.conv, self.budget, self.history = conv, budget, history
        self.system, self.old, self.new, self.used, self.number, self.turns = None, [], [], 0, 0, 0

    def add(self, role: str, text: str, tokens: int) -> dict | None:
        """A window, if this turn doesn't go into it any more."""
        turn = (role, text, tokens)
        out = self.close() if self.new and self.used + turn[2] > self.budget else None
        if not self.new:
            self.used = (self.system[2] if self.system else 0) + sum(t[2] for t in self.old)
            while self.old and self.used + turn[2] > self.budget:  # history gives way to the new turn
                self.used -= self.old.pop(0)[2]
        if self.turns == 0 and role == "system":
            self.system = turn
        self.new.append(turn)
        self.used += turn[2]
        self.turns += 1
        return out

    def close(self) -> dict:
        again = ([self.system] if self.system and self.number else []) + self.old
        text, spans = [], []
        at = 0
        for k, (role, body, _) in enumerate(again + self.new):
            shown, a, b = turn_text(role, body)
            if k >= len(again) and role == "assistant":
                spans.append((at + a, at + b))
            text.append(shown)
            at += len(shown)
        out = {"conv_id": self.conv, "window": self.number, "first_turn": self.turns - len(self.new), "n_repeated": len(again), "n_new": len(self.new), "n_tokens": self.used, "text": "".join(text), "loss_from": [a for a, _ in spans], "loss_to": [b for _, b in spans]}
        left, self.old = self.history, []
        for turn in reversed(self.new):
            if turn is self.system or turn[2] > left:
                break
            self.old.insert(0, turn)
            left -= turn[2]
        self.new, self.number = [], self.number + 1
        return out


WINDOWS = "conv_id long, window long, first_turn long, n_repeated long, n_new long, n_tokens long, text string, loss_from array<long>, loss_to array<long>"
NAMES = [x.split()[0] for x in WINDOWS.split(", ")]


def _format(budget: int, history: int, tokens):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, out = None, []
        for pdf in batches:
            counts = tokens.many(pdf["text"]) if hasattr(tokens, "many") else map(tokens, pdf["text"])
            for conv, role, text, n in zip(pdf["conv_id"].astype("Int64"), pdf["role"], pdf["text"], counts, strict=True):
                conv = None if pd.isna(conv) else int(conv)
                if now is None or now.conv != conv:
                    if now:
                        out.append(now.close())
                    now = _Conversation(conv, budget, history)
                if window := now.add(role, text, n):
                    out.append(window)
                if len(out) >= 256:
                    yield _frame(out, NAMES)
                    out = []
        if now:
            out.append(now.close())
        if out:
            yield _frame(out, NAMES)

    return run


def _frame(rows: list[dict], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    return out.assign(conv_id=pd.array([r["conv_id"] for r in rows], dtype="Int64"))


def format_chats(turns: DataFrame, budget: int = 512, history: int = 96, tokens=count_tokens) -> DataFrame:
    """A row for each window of each conversation; windows of one follow each other in a partition.

    Turns are in the order of ``turn``; ties and repeated rows follow each other by role and text. A null
    text or role is empty; a null turn comes first; turns with a null conv_id are one conversation. A turn
    longer than the budget has a window of its own with the system turn. Only a system turn that comes
    first is retained; others are turns like all. No turns, no rows. Other columns are not looked at.
    """
    n = shuffle_partitions(turns.sparkSession)
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInPandas(_format(budget, history, tokens), WINDOWS)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"
DIGEST_NAMES = [x.split()[0] for x in DIGESTS.split(", ")]


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    now, out = None, []

    def row() -> dict:
        return now["n"] | {"turns_sha256": now["turns"].hexdigest(), "loss_sha256": now["loss"].hexdigest()}

    for pdf in batches:
        for r in pdf.assign(conv_id=pdf["conv_id"].astype("Int64")).itertuples(index=False):
            conv = None if pd.isna(r.conv_id) else int(r.conv_id)
            if now is None or r.window == 0:
                if now:
                    out.append(row())
                now = {"n": {"conv_id": conv, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0, "n_windows": 0}, "turns": hashlib.sha256(), "loss": hashlib.sha256()}
            shown = parse_turns(r.text)
            for role, text in shown[r.n_repeated :]:
                now["turns"].update(f"{role}\n{text}\n".encode())
            for a, b in zip(r.loss_from, r.loss_to, strict=True):
                text = unescape(r.text[a:b])
                now["loss"].update(text.encode())
                now["n"]["loss_chars"] += len(text)
            now["n"]["n_turns"] += len(shown) - r.n_repeated
            now["n"]["formatted_chars"] += len(r.text)
            now["n"]["n_windows"] += 1
        if len(out) >= 4096:
            yield _frame(out, DIGEST_NAMES)
            out = []
    if now:
        out.append(row())
        yield _frame(out, DIGEST_NAMES)


def digests(windows: DataFrame) -> DataFrame:
    """What format_chats() put out, read back: a row for each conversation."""
    return windows.mapInPandas(_digest, DIGESTS)


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{said}'), (-1L, 1L, 'assistant', '{said}') AS t(conv_id, turn, role, text)")
    return digests(format_chats(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more), tokens=TokenCount(default_tokenizer())))


