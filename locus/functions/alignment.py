"""Alignment of short sequences, as Arrow-fed functions: a score matrix filled row by row with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from locus.functions.sequence import COMPLEMENT

_COMPLEMENT = str.maketrans(*COMPLEMENT)


def reverse_complement_text(seq: str) -> str:
    return seq[::-1].translate(_COMPLEMENT)


def fitting_matrix(v: str, w: str, indel: int) -> np.ndarray:
    """Scores of aligning all of w's beginnings to any part of v: match 1, mismatch -1, indel -indel. A gap
    along w makes a cell depend on the one before it in its row, which a running maximum resolves."""
    a, b = np.frombuffer(v.encode("utf-32-le"), np.uint32), np.frombuffer(w.encode("utf-32-le"), np.uint32)
    slope = np.arange(len(b) + 1) * indel
    score = np.empty((len(a) + 1, len(b) + 1), np.int64)
    score[0] = -slope
    for i in range(1, len(a) + 1):
        row = score[i]
        row[0] = 0
        np.maximum(score[i - 1, 1:] - indel, score[i - 1, :-1] + np.where(b == a[i - 1], 1, -1), out=row[1:])
        np.subtract(np.maximum.accumulate(row + slope), slope, out=row)
    return score


def best_end(score: np.ndarray) -> tuple[int, int, int]:
    """Where the best alignment of all of w ends, the first of equals, and its score; 0, 0, 0 if none is above zero."""
    last = score[:, -1]
    i = int(np.argmax(last))
    return (i, score.shape[1] - 1, int(last[i])) if last[i] > 0 else (0, 0, 0)


def fitting_alignment(v: str, w: str, indel: int = 3) -> dict:
    """The best alignment of all of w to a part of v, with places of mismatches and indels from w's end. Of
    equal steps a gap in w comes first, then one in v."""
    score = fitting_matrix(v, w, indel)
    i, j, best = best_end(score)
    end, query, subject, marks, snps, indels = j, [], [], [], [], []
    while j > 0:
        if i > 0 and score[i, j] == score[i - 1, j] - indel:
            step = (v[i - 1], "-", "-")
            indels.append(end - j)
            i -= 1
        elif i == 0 or score[i, j] == score[i, j - 1] - indel:
            step = ("-", w[j - 1], "-")
            indels.append(end - j)
            j -= 1
        else:
            same = v[i - 1] == w[j - 1]
            step = (v[i - 1], w[j - 1], "_" if same else "*")
            if not same:
                snps.append(end - j)
            i, j = i - 1, j - 1
        for out, x in zip((query, subject, marks), step, strict=True):
            out.append(x)
    return {"score": best, "query": "".join(reversed(query)), "subject": "".join(reversed(subject)), "alignment": "".join(reversed(marks)), "snps": snps, "indels": indels}


def disruptions(pam: str, snps: list[int], indels: list[int]) -> list[int]:
    """Places that keep a guide from its target, 1 being next to the PAM. A mismatch at 0, the PAM's first
    base that may be any, is none; an indel there is one."""
    at = [p - len(pam) + 1 for p in snps]
    return [p for p in at if p] + [p - len(pam) + 1 for p in indels]


def disruption_points(places: list[int]) -> int:
    """1 for each place from 11 to 20, 2 from 1 to 10, 3 in the PAM's fixed bases."""
    return sum(1 if 11 <= p <= 20 else 2 if 1 <= p <= 10 else 3 if p in (-1, -2) else 0 for p in places)


def guide_alignment(donor: str, guide: str, pam: str) -> dict:
    """The alignment of a guide with its PAM to the donor, or to its reverse complement unless the donor's
    is strictly better, with the places of disruption."""
    v, w = donor.upper(), guide.upper()
    back = reverse_complement_text(v)
    sense = best_end(fitting_matrix(v, w, 3))[2] > best_end(fitting_matrix(back, w, 3))[2]
    found = fitting_alignment(v if sense else back, w)
    return found | {"disruptions": disruptions(pam, found["snps"], found["indels"])}


def edit_distance_text(v: str, w: str) -> int:
    """The longer length less the best fitting score with indels at 1; not Levenshtein's distance."""
    return max(len(v), len(w)) - best_end(fitting_matrix(v, w, 1))[2]


ALIGNED = "score int, query string, subject string, alignment string, snps array<int>, indels array<int>"
GUIDED = ALIGNED + ", disruptions array<int>, points int"


def _rows(f, *columns: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([f(*x) for x in zip(*columns, strict=True)])


def fitting_column(v: Column, w: Column, indel: int = 3) -> Column:
    """ALIGNED of each pair; nulls are empty."""

    @F.pandas_udf(ALIGNED)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for a, b in batches:
            yield _rows(lambda x, y: fitting_alignment(x, y, indel), a, b)

    return run(F.coalesce(v, F.lit("")), F.coalesce(w, F.lit("")))


def disruption_column(donor: Column, guide: Column, pam: Column) -> Column:
    """GUIDED of each donor and guide with its PAM; points is the disruption score."""

    @F.pandas_udf(GUIDED)
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for d, g, p in batches:
            out = _rows(guide_alignment, d, g, p)
            yield out.assign(points=[disruption_points(x) for x in out["disruptions"]])

    return run(F.coalesce(donor, F.lit("")), F.coalesce(guide, F.lit("")), F.coalesce(pam, F.lit("")))


def edit_distance_column(v: Column, w: Column) -> Column:
    @F.pandas_udf("int")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            yield pd.Series([edit_distance_text(x, y) for x, y in zip(a, b, strict=True)], dtype="int32")

    return run(F.coalesce(v, F.lit("")), F.coalesce(w, F.lit("")))
