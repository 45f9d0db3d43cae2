from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from locus.llm.exact_dedup import exact_dedup


def brute(rows, largest):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        best = (max if largest else min)(known) if known else None
        out += [(i, best, len(ids)) for i in ids]
    return sorted(out, key=repr)


def check(df, rows, keep, **how):
    got = exact_dedup(df, keep=keep, **how).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=repr) == brute(rows, keep == "max")
    by = defaultdict(list)
    for r in got:
        by[r.text_sha256].append(r)
    for group in by.values():
        assert sum(r.kept for r in group) == 1
        assert all(r.doc_id == r.keep_id for r in group if r.kept)


def test_odd_rows_and_clashing_names(frame, odd):
    for keep in ("min", "max"):
        check(frame(odd), odd, keep)


def test_empty_table(frame):
    assert exact_dedup(frame([])).count() == 0


def test_colliding_digests_never_merge_unequal_texts(frame):
    rows = [(i, f"t{i % 17}") for i in range(200)]
    check(frame(rows).repartition(7), rows, "max", digest=F.length("text").cast("long"))


def test_hot_group_over_many_partitions(frame):
    rows = [(i, "same" if i % 3 else f"t{i}") for i in range(600)]
    for radix in (2, 4, 8):
        check(frame(rows).repartition(13), rows, "max", radix=radix)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 9)), st.one_of(st.none(), st.sampled_from(["", "a", "b", "ab", "\x00"]))), min_size=1, max_size=30))
def test_any_rows(frame, rows):
    check(frame(rows).repartition(3), rows, "min")
