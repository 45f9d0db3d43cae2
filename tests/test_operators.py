import random

import pytest
from pyspark.sql import functions as F

from locus.operators import annotate, clusters, coverage, donors, guides, metagene, motifs, orfs, reads, variants
from locus.operators.intervals import nearest_before, overlaps, stab

COV = "chrom string, strand string, pos int, reads double"


@pytest.fixture
def cov(spark):
    return lambda *rows: spark.createDataFrame([("c", "+", p, float(v)) if len(r) == 2 else r for r in rows for p, v in [r[-2:]]], COV)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# ---- intervals --------------------------------------------------------------------------------------------


def test_joins_equal_nested_loops(spark):
    rng = random.Random(0)
    points = [("c", "+-"[rng.randrange(2)], rng.randrange(300)) for _ in range(120)]
    spans = [("c", "+-"[rng.randrange(2)], a, a + rng.randrange(-2, 60), i) for i, a in enumerate(rng.randrange(300) for _ in range(60))]
    p = spark.createDataFrame(points, "chrom string, strand string, pos int")
    s = spark.createDataFrame(spans, "chrom string, strand string, a int, b int, id int")
    hit = sorted((t, x, i) for _, t, x in points for _, u, a, b, i in spans if t == u and a <= x <= b)
    for width in (7, 4096):
        assert rows(stab(p, "pos", s, "a", "b", width=width), "strand", "pos", "id") == hit
        some = sorted((t, x) for _, t, x in points if any(t == u and a <= x <= b for _, u, a, b, _ in spans))
        assert rows(stab(p, "pos", s, "a", "b", how="left_semi", width=width), "strand", "pos") == some
        assert stab(p, "pos", s, "a", "b", how="left_anti", width=width).count() == len(points) - len(some)
        good = [x for x in spans if x[2] <= x[3]]
        t = spark.createDataFrame(good, "chrom string, strand string, c int, d int, id2 int")
        pairs = sorted((x[4], y[4]) for x in good for y in good if x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3])
        assert rows(overlaps(s.filter("a <= b"), t, "a", "b", "c", "d", width=width), "id", "id2") == pairs


# ---- coverage ---------------------------------------------------------------------------------------------


def test_normalisation_goes_opposite_ways(cov):
    q, r = cov((5, 10), (6, 2)), cov((5, 2), (9, 1))
    # by position: times 12 / 3; 40 / 2 and 8 / 0.01
    assert rows(coverage.upregulated(q, r, 20, 5), "pos", "fold") == [(5, 20.0), (6, 800.0)]
    # in a window: times 3 / 12, and the reads themselves must be enough
    assert rows(coverage.upregulated_in_window(q, r, 2, 1.4, 3), "pos", "fold") == [(5, 1.5)]


def test_a_window_leaves_out_its_last_position(cov):
    q = cov((10, 1), (12, 1))
    got = dict(rows(coverage.upregulated_in_window(q, cov((8, 1), (14, 4)), 2, 0, 0), "pos", "fold"))
    assert got[10] == pytest.approx(1 * 2.5 / 1) and got[12] == pytest.approx(2 * 2.5 / 0.01)


def test_classes(cov):
    q, r = cov((1, 8), (2, 4), (3, 6), (4, 1)), cov((1, 4), (2, 4), (3, 4), (5, 7))
    assert rows(coverage.classified(q, r, 2, 2, max_fold=1), "pos", "class") == [(1, "up"), (2, "not_up"), (3, "neither")]


def test_features_without_reads(spark, cov):
    f = spark.createDataFrame([("c", "+", 0, 5, 1), ("x", "+", 0, 5, 2), ("c", "+", 7, 7, 3)], "chrom string, strand string, fstart int, fend int, fid int")
    c = cov((0, 2), (4, 2), (5, 9))
    assert rows(coverage.expression(f, c), "fid", "reads") == [(1, 4.0), (2, 0.0), (3, 0.0)]
    assert rows(coverage.peak(f, c, "fid"), "fid", "peak_pos") == [(1, 0), (2, None), (3, None)]
    assert rows(coverage.center_of_mass(f, c, "fid"), "fid", "center_of_mass") == [(1, 2.0), (2, 0.0), (3, 0.0)]
    assert rows(coverage.expression_vector(f, c, "fid", 0.5), "fid", "values")[0] == (1, [2.0, 0.5, 0.5, 0.5, 2.0])
    out = spark.createDataFrame([(1, 4)], "fid int, pos int")
    assert rows(coverage.expression_vector(f, c, "fid", 0.5, out), "fid", "values")[0] == (1, [2.0, 0.5, 0.5, 0.5, 0.5])


def test_differential_status(spark):
    v = spark.createDataFrame([("a", "A", 4.0), ("a", "A", 2.0), ("a", "B", 1.0), ("b", "A", 2.0), ("c", "B", 2.0), ("d", "A", 0.1), ("d", "B", 0.1)], "g string, side string, value double")
    got = {r.g: r for r in coverage.differential(v, "g", F.lit(2), 0.2).collect()}
    assert [got[k].status for k in "abcd"] == ["both", "no sample B signal", "no sample A signal", "no sample B or A signal"]
    assert (got["a"].ratio, got["a"].mean_a, got["a"].mean_b, got["a"].difference, got["a"].cv_a) == (3.0, 1.5, 0.5, 1.0, pytest.approx(1 / 3))
    assert got["d"].mean_a is None and got["b"].ratio is None and got["b"].mean_a == 1.0


def test_smoothing_leaves_the_edges(spark):
    df = spark.createDataFrame([(i, float(i * i)) for i in range(8)], "i int, v double")
    got = [r.smooth for r in coverage.smooth(df, "v", "i", 2).orderBy("i").collect()]
    assert got == [0, 1, (0 + 1 + 4 + 9) / 4, (1 + 4 + 9 + 16) / 4, (4 + 9 + 16 + 25) / 4, (9 + 16 + 25 + 36) / 4, 36, 49]


# ---- clusters ---------------------------------------------------------------------------------------------


def test_islands(cov):
    got = rows(clusters.islands(cov((0, 1), (3, 5), (6, 5), (10, 2)), 3), "cstart", "cend", "n_sites", "peak_pos")
    assert got == [(0, 6, 3, 3), (10, 11, 1, 10)]


def grown(q, r, up, flank, fold, floor):
    """Growth position by position."""
    seen, out = set(), []
    total = lambda d, a, b: sum(v for p, v in d.items() if a <= p < b)
    ok = lambda a, b: total(q, a, b) / max(total(r, a, b), floor) >= fold
    for seed in sorted(up):
        if seed in seen:
            continue
        seen.add(seed)
        lo, hi, last, n = seed, seed + 1, seed, 1
        for p in range(seed - 1, 0, -1):
            if lo - p > flank:
                break
            if p in q:
                if p in seen or not ok(p, seed):
                    break
                lo = p
                seen.add(p)
                n += 1
        for p in range(seed + 1, max(up) + 1):
            if last - p < -flank:
                break
            if p in q:
                if p in seen or not ok(seed, p):
                    break
                hi = last = p
                seen.add(p)
                n += 1
        out.append((seed, lo, hi, n))
    return sorted(out)


def test_growth_equals_one_position_by_position(spark):
    rng = random.Random(1)
    for k in range(6):
        q = {rng.randrange(0, 120): float(rng.randrange(1, 9)) for _ in range(45)}
        r = {rng.randrange(0, 120): float(rng.randrange(1, 5)) for _ in range(40)}
        up = {p for p in q if rng.random() < 0.3} or {min(q)}
        frame = lambda d: spark.createDataFrame([("c", "+", p, v) for p, v in d.items()], COV)
        # by the last upregulated position of an island nothing beyond it can be reached
        for flank in (1, 3, 6):
            got = rows(clusters.upregulated_clusters(frame(q), frame(r), frame({p: q[p] for p in up}), flank, 1.0), "seed", "cstart", "cend", "n_sites")
            islands, want = [], []
            for p in sorted(q):
                islands = [*islands, [p]] if not islands or p - islands[-1][-1] > flank else [*islands[:-1], [*islands[-1], p]]
            for island in islands:
                own = set(island) & up
                if own:
                    want += grown({p: q[p] for p in island}, r, own, flank, 1.0, 0.01)
            assert got == sorted(want), (k, flank)


def test_signal_width():
    import numpy as np

    pos, v = np.array([1, 3, 5, 9]), np.array([1.0, 8.0, 1.0, 0.5])
    most, at, width, distinct = clusters.signal_width(pos, v, 1, 9, 10.5, 0.8)
    assert (most, at) == (8.0, 3) and width < 8 and distinct >= 1
    assert clusters.signal_width(np.array([4]), np.array([2.0]), 4, 5, 2.0, 0.8)[:2] == (2.0, 4)
    assert clusters.signal_width(np.array([4]), np.array([0.0]), 4, 5, 1.0, 0.8) == (0.0, 4, 1, 1)


# ---- annotation -------------------------------------------------------------------------------------------

ANN = "chrom string, strand string, astart int, aend int, gene_name string, gene_id string, region_type string, sequence_type string, ord long"


def sites(spark, *xs):
    return spark.createDataFrame([("c", s, p) for s, p in xs], "chrom string, strand string, pos int")


def test_the_farthest_start_wins(spark):
    a = spark.createDataFrame([("c", "+", 10, 100, "far", "f", "r", "exon", 1), ("c", "+", 50, 60, "near", "n", "r", "exon", 2), ("c", "+", 10, 100, "later", "l", "r", "intron", 3), ("c", "-", 200, 210, "other", "o", "r", "exon", 4), ("c", "+", 10, 300, "cds", "x", "r", "CDS", 5)], ANN)
    got = rows(annotate.coordinate_annotation(sites(spark, ("+", 55), ("+", 101), ("+", 205), ("+", 102), ("-", 211)), a), "strand", "pos", "gene_name", "sense")
    assert got == [("+", 55, "later", "sense"), ("+", 101, "later", "sense"), ("+", 102, "intergenic", "sense"), ("+", 205, "other", "antisense"), ("-", 211, "other", "sense")]


def test_splice_sites(spark):
    a = spark.createDataFrame([("c", "+", 100, 200, "g", "g", "rt", "intron", 1), ("c", "-", 300, 400, "h", "h", "rt", "CDS", 2)], ANN)
    got = {(r.strand, r.pos): r for r in annotate.splice_annotation(sites(spark, ("+", 98), ("+", 104), ("+", 150), ("+", 202), ("+", 203), ("-", 398), ("+", 350), ("+", 20_000)), a).collect()}
    assert got["+", 98].splice_site == got["+", 104].splice_site == "annotated splice site" and got["+", 150].splice_site == "unannotated splice site"
    assert got["+", 98].gene_name == "g" and got["+", 202].gene_name == "g" and got["+", 203].gene_name == "intergenic"
    assert got["+", 350].sense == "antisense" and got["+", 350].gene_name == "h" and got["-", 398].sense == "sense" and got["+", 20_000].sense == "intergenic"


def test_priorities(spark):
    t = spark.createDataFrame([("c", "+", 0, 10, "tRNA"), ("c", "+", 5, 15, "CDS"), ("c", "+", 20, 30, "odd")], "chrom string, strand string, tstart int, tend int, type string")
    s = sites(spark, ("+", 3), ("+", 7), ("+", 14), ("+", 15), ("+", 25)).withColumn("reads", F.col("pos").cast("double"))
    assert [x[1] for x in rows(annotate.priority_type(s, t, ["CDS", "tRNA"]), "pos", "annotation_type")] == ["tRNA", "CDS", "CDS", "intergenic", "intergenic"]
    assert [x[1] for x in rows(annotate.priority_type(s, t, ["CDS", "genic"]), "pos", "annotation_type")] == ["intergenic", "CDS", "CDS", "genic", "intergenic"]
    assert [tuple(r) for r in annotate.type_distribution(s, t, ["CDS", "tRNA", "snoRNA"]).collect()] == [("snoRNA", 0.0), ("tRNA", 3.0), ("CDS", 21.0)]
    d = annotate.type_distribution(s, t, ["CDS", "tRNA", "intergenic"], by_mass=False)
    assert [tuple(r) for r in annotate.combined_types(d, {"a": ["CDS", "CDS"], "b": ["tRNA"], "c": ["none"]}).collect()] == [("c", 0.0), ("b", 1.0), ("a", 4.0)]


GFF = "chrom string, source string, type string, start int, end int, strand string, frame string, attributes string, ord long"


def test_features_and_names_from_rows(spark):
    r = spark.createDataFrame(
        [
            ("chrI", "protein_coding", "exon", 10, 20, "+", ".", 'gene_id "Y1"; gene_name "N1";', 0), ("chrI", "protein_coding", "exon", 5, 30, "+", ".", 'gene_id "Y1"; gene_name "N1";', 1),
            ("chrM", "protein_coding", "exon", 1, 2, "+", ".", 'gene_id "YM"; gene_name "M";', 2), ("chrI", "protein_coding", "exon", 50, 60, ".", ".", 'gene_id "Y2";', 3),
        ], GFF,
    )
    assert rows(annotate.features_from_gtf(r, "protein_coding"), "feature_id", "strand", "fstart", "fend") == [("Y1", "+", 10, 30), ("Y2", "+", 50, 60)]
    assert rows(annotate.annotations_from_gtf(r.filter("ord = 3")), "strand", "gene_name") == [("+", "Y2"), ("-", "Y2")]
    g = spark.createDataFrame([("chrI", "s", "gene", 1, 9, "+", ".", "ID=Y1;Name=Y1;gene=AAA1;", 0), ("chrI", "s", "gene", 1, 9, "+", ".", "ID=Y1;Name=B;", 1), ("chrI", "s", "intron", 3, 4, ".", ".", "Parent=P;x", 2), ("chrmt", "s", "gene", 1, 9, "+", ".", "ID=Q;Name=Q;", 3)], GFF)
    assert rows(annotate.gene_names(g), "systematic", "common") == [("Y1", "B")]
    assert rows(annotate.gene_names(g, to_common=False), "common", "systematic") == [("AAA1", "Y1"), ("B", "Y1")]
    assert rows(annotate.features_from_gff(g, "intron"), "feature_id", "fstart") == [("P", 3)]
    assert rows(annotate.annotations_from_gff(g.filter("ord = 2")), "strand", "gene_name") == [("+", "P"), ("-", "P")]


def test_transcript_ends(spark):
    iso = spark.createDataFrame([("chrI", "+", 90, 200, 5, "YA"), ("chrI", "+", 80, 210, 4, "YA"), ("chrI", "+", 10, 900, 1, "YA"), ("chrI", "-", 500, 300, 9, "YB"), ("chrI", "-", 520, 290, 1, "YB"), ("chrI", "+", 1, 2, 0, "YZ")], "chrom string, strand string, t5 int, t3 int, reads long, orf string")
    ends = annotate.transcript_ends(iso, 0.9)
    assert rows(ends, "orf", "five", "three") == [("YA", 80, 210), ("YB", 500, 300)]
    codons = spark.createDataFrame([("+", "YA", "A", 100, 190), ("-", "YB", "B", 480, 310)], "strand string, orf string, gene_name string, first_codon int, last_codon int")
    assert rows(annotate.utr_annotations(ends, codons), "gene_id", "chrom", "sequence_type", "astart", "aend") == [("YA", "chrI", "3UTR", 190, 210), ("YA", "chrI", "5UTR", 80, 100), ("YB", "chrII", "3UTR", 300, 310), ("YB", "chrII", "5UTR", 480, 500)]


def test_mispriming(spark):
    genome = spark.createDataFrame([("c", "C" * 10 + "AAAAAGAAAA" + "C" * 10)], "chrom string, seq string")
    iso = spark.createDataFrame([("c", "+", 0, 9, 1, "Y"), ("c", "+", 0, 18, 1, "Y")], "chrom string, strand string, t5 int, t3 int, reads long, orf string")
    assert rows(annotate.misprimed(genome, iso), "t3", "misprimed") == [(9, True), (18, False)]


def test_annotation_types(spark):
    gtf = spark.createDataFrame(
        [
            ("chrI", "protein_coding", "exon", 100, 149, "+", ".", 'gene_id "YA";', 0), ("chrI", "protein_coding", "exon", 200, 249, "+", ".", 'gene_id "YA";', 1), ("chrI", "protein_coding", "CDS", 100, 149, "+", ".", 'gene_id "YA";', 2),
            ("chrI", "protein_coding", "start_codon", 100, 102, "+", ".", 'gene_id "YA";', 3), ("chrI", "protein_coding", "stop_codon", 247, 249, "+", ".", 'gene_id "YA";', 4), ("chrI", "protein_coding", "3UTR", 250, 260, "+", ".", 'gene_id "YA";', 5),
            ("chrI", "snoRNA", "exon", 1000, 1009, "-", ".", 'gene_id "S";', 6), ("chrI", "CUTs", "exon", 2000, 2009, "+", ".", 'gene_id "C";', 7),
        ], GFF,
    )
    gff = spark.createDataFrame([("chrI", "s", "ARS", 3000, 3009, ".", ".", "ID=x;", 0), ("chrI", "s", "gene", 1, 2, "+", ".", "ID=y;", 1)], GFF)
    ends = spark.createDataFrame([("+", "YA", 70, 300)], "strand string, orf string, five int, three int")
    got = set(rows(annotate.annotation_types(gtf, gff, ends), "type", "strand", "tstart", "tend"))
    assert {("intron", "+", 150, 200), ("CDS", "+", 100, 153), ("antisense_CDS", "-", 100, 153), ("3UTR", "+", 250, 350), ("5UTR", "+", 70, 100)} <= got
    assert {("snoRNA", "-", 1000, 1010), ("snoRNA_300_nt_downstream", "-", 700, 1000), ("snoRNA_300_nt_upstream", "-", 1010, 1310), ("CUTs", "+", 1950, 2060), ("ARS", "+", 2900, 3110), ("ARS", "-", 2800, 3210)} <= got
    assert not any(t == "gene" for t, *_ in got)


# ---- profiles ---------------------------------------------------------------------------------------------


def test_bins_keep_the_last_value(spark):
    v = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0, 5.0],), ([7.0],), ([],)], "values array<double>")
    assert [r.binned for r in metagene.binned(v, 2).collect()] == [[3.0, 5.0], [7.0, 0.0], [0.0, 0.0]]
    assert [r.binned for r in metagene.binned(v, 0).collect()] == [[], [], []]


def dense(features, track, up, body, down, strand_of):
    """Profiles built base by base."""
    out = {}
    for fid, strand, a, b in features:
        for side in ("sense", "antisense"):
            get = lambda p: track.get((strand_of(strand, side), p), 0.0)  # noqa: B023, E731
            left, mid, right = ([get(p) for p in range(*x)] for x in ((a - (up if strand == "+" else down), a), (a, b), (b, b + (down if strand == "+" else up))))
            if strand == "-":
                left, mid, right = right[::-1], mid[::-1], left[::-1]
            bins = [0.0] * body
            for i, x in enumerate(mid if body else []):
                bins[min(int(i * body / len(mid)), body - 1)] = x
            out[fid, side] = left + bins + right
    return out


def test_metagene_equals_one_built_base_by_base(spark):
    rng = random.Random(3)
    features = [(i, "+-"[i % 2], a, a + rng.randrange(1, 30)) for i, a in enumerate(rng.randrange(10, 150) for _ in range(12))]
    track = {("+-"[rng.randrange(2)], rng.randrange(0, 200)): float(rng.randrange(1, 9)) for _ in range(120)}
    f = spark.createDataFrame([("c", s, a, b, i) for i, s, a, b in features], "chrom string, strand string, fstart int, fend int, fid int")
    c = spark.createDataFrame([("c", s, p, v) for (s, p), v in track.items()], COV)
    flip = lambda strand, side: strand if side == "sense" else "+-"[strand == "+"]
    for body in (0, 4):
        whole = dense(features, track, 5, body, 3, flip)
        sums = {s: [0.0] * (8 + body) for s in ("sense", "antisense")}
        for i, *_ in features:
            both = whole[i, "sense"] + whole[i, "antisense"]
            if sum(both) >= 10 and max(both) > 0:
                for side in sums:
                    sums[side] = [x + y / max(both) for x, y in zip(sums[side], whole[i, side], strict=True)]
        got = {s: [r.v for r in metagene.metagene(f, c, "fid", 5, body, 3, min_reads=10).filter(F.col("side") == s).orderBy("idx").collect()] for s in sums}
        for side, x in sums.items():
            assert got[side] == pytest.approx([y / max(x) for y in x])


# ---- motifs -----------------------------------------------------------------------------------------------


def test_the_last_place_isnt_looked_at(spark):
    g = spark.createDataFrame([("c", "ACGTTTACG")], "chrom string, seq string")
    assert rows(motifs.motif_scan(g, "ACG", 0), "mstart", "strand") == [(0, "+"), (1, "-")]
    assert rows(motifs.motif_scan(g, "ACG", 0, last=True), "mstart") == [(0,), (1,), (6,)]
    assert rows(motifs.motif_scan(g, "ACG", 0, both=False), "mstart") == [(0,)]


def test_chunks_lose_nothing(spark):
    rng = random.Random(5)
    seq = "".join(rng.choice("ACGT") for _ in range(500))
    g = spark.createDataFrame([("c", seq), ("d", "AC")], "chrom string, seq string")
    want = [(i, seq[i : i + 4]) for i in range(len(seq) - 4)]
    for size in (7, 100, 10_000):
        assert rows(motifs.windows(g, 4, size=size), "mstart", "kmer") == want


def test_suppression(spark):
    rng = random.Random(6)
    spans = [("c", a, a + 1, i) for i, a in enumerate(rng.randrange(200) for _ in range(60))]
    got = rows(motifs.suppressed(spark.createDataFrame(spans, "chrom string, start int, end int, ord int")), "ord")
    assert got == sorted((i,) for _, a, b, i in spans if not any(x - 2 < b + 2 and a - 2 < y + 2 for _, x, y, j in spans if j < i))


def test_footprints_loops_and_counts(spark):
    peaks = sites(spark, ("+", 10), ("-", 10))
    feet = sites(spark, ("+", 10))
    assert rows(motifs.downstream_footprint(peaks, feet, 5), "strand") == [("+",)]
    assert rows(motifs.downstream_footprint(peaks, feet, 5, having=False), "strand") == [("-",)]
    loops = sites(spark, ("+", 1), ("+", 12), ("+", 18), ("-", 3))
    assert rows(motifs.nearby_loop(sites(spark, ("+", 10), ("-", 10), ("+", 100)), loops, 20), "strand", "pos", "loop_pos") == [("+", 10, 18), ("+", 100, None), ("-", 10, 3)]
    seqs = spark.createDataFrame([("AAAAA",), ("A.A",)], "seq string")
    assert rows(motifs.motif_counts(seqs, ["AA", "."]), "motif", "value") == [(".", 0.5), ("AA", 1.0)]
    assert rows(motifs.motif_counts(seqs.limit(0), ["AA"]), "motif", "value") == [("AA", 0.0)]


def test_signal_near_motifs(spark, cov):
    m = spark.createDataFrame([("c", "+", 100, 106)], "chrom string, strand string, mstart int, mend int")
    none = cov((9999, 1))
    call = lambda q, r, n, **k: motifs.signal_near_motifs(m, q, r, n, (8, 20), 20, 5, 2, **k).first()
    up = call(cov((85, 10)), cov((85, 1)), none)
    assert (up["class"], up.side, up.value, up.distance) == ("upregulated", "+", 10.0, -15)
    higher = call(cov((85, 10), (110, 11)), cov((110, 6)), none)
    assert (higher["class"], higher.value) == ("not_upregulated", 6.0)
    rna = cov(*[(p, 2) for p in range(50, 156)])
    assert call(none, none, rna)["class"] == "rna" and call(none, none, none)["class"] == "no_rna"
    minus = call(spark.createDataFrame([("c", "-", 120, 9.0)], COV), none, none)
    assert (minus["class"], minus.side, minus.distance) == ("upregulated", "-", -14)
    minus_rna = spark.createDataFrame([("c", "-", p, 2.0) for p in range(50, 156)], COV)
    assert [(x["class"], x.side, x.value) for x in (call(none, none, minus_rna), call(none, none, minus_rna, fixed=True))] == [("rna", "-", 0.0), ("rna", "-", 2.0)]


def test_signal_near_many_motifs_without_a_broadcast(spark, cov):
    """50,000 motifs are 400 kB to the planner, and as spans of two strands more than it would broadcast."""
    m = spark.range(50_000).select(F.lit("c").alias("chrom"), F.lit("+").alias("strand"), (F.col("id") * 200).cast("int").alias("mstart"), (F.col("id") * 200 + 6).cast("int").alias("mend"))
    found = motifs.signal_near_motifs(m, cov((585, 10)), cov((585, 1), (1010, 6)), cov(*[(p, 2) for p in range(1350, 1456)]), (8, 20), 20, 5, 2)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert {x["class"]: x["count"] for x in found.groupBy("class").count().collect()} == {"upregulated": 1, "not_upregulated": 1, "rna": 1, "no_rna": 49_997}


# ---- variants ---------------------------------------------------------------------------------------------

CALLS = "chrom string, pos int, ref string, alt string, ord long"


@pytest.mark.parametrize("ref,alt,want", [("CAG", "CG", (6, "AG", "G")), ("A", "C", (5, "A", "C")), ("ACA", "AGA", (7, "A", "A")), ("AC", "AG", (5, "AC", "AG"))])
def test_trimming(spark, ref, alt, want):
    assert rows(variants.trimmed(spark.createDataFrame([("c", 5, ref, alt, 0)], CALLS)), "pos", "ref", "alt") == [want]


def test_cleaning_and_combining(spark):
    a = spark.createDataFrame([("c", 5, "A", "C,T", 0), ("chrM", 5, "A", "C", 1), ("c", 5, "A", "C", 3), ("c", 5, "A", "C", 2)], CALLS)
    assert rows(variants.cleaned(a), "chrom", "pos", "ord") == [("c", 5, 2)]
    b = spark.createDataFrame([("c", 5, "A", "G", 0), ("c", 5, "A", "C", 0)], CALLS)
    assert rows(variants.combined([variants.cleaned(a), b]), "alt", "source_ord", "calls_at_pos") == [("C", 0, 2), ("G", 1, 2)]


def chains(calls, gap):
    out, todo = [], [[c] for c in calls]
    while todo:
        x = todo.pop()
        if len(x) > 1:
            out.append(tuple(c[0] for c in x))
        end = x[-1][0] + len(x[-1][1])
        todo += [[*x, c] for c in calls if c[0] > x[-1][0] and c[0] - end < gap]
    return sorted(out)


def test_chains_and_splicing(spark):
    seq = "ACGTACGTACGTACGTACGTACGTACGTACGTACGT"
    calls = [(3, "G", "T"), (5, "AC", "A"), (5, "A", "G"), (9, "A", "ATT"), (30, "C", "G")]
    v = spark.createDataFrame([("c", p, r, a, i) for i, (p, r, a) in enumerate(calls)], CALLS)
    got = sorted(tuple(m.pos for m in r.members) for r in variants.linked_chains(v, 5).collect())
    assert got == chains(calls, 5)
    one = spark.createDataFrame([("c", 3, "G", "T", 0), ("c", 5, "AC", "A", 1), ("c", 9, "A", "ATT", 2)], CALLS)
    got = {(r.pos, r.ref): r.alt for r in variants.linked(spark.createDataFrame([("c", seq)], "chrom string, seq string"), one).collect()}
    assert got[3, "GTACGTA"] in ("TTAGTATT", "TTACGTATT") and got[3, "GTAC"] == "TTA" and got[5, "ACGTA"] == "AGTATT"


def test_chains_of_any_length_over_bins(spark):
    rng = random.Random(4)
    calls = sorted({(p, "ACGTACGT"[: rng.choice((1, 1, 2, 5))], "T") for p in [*(4090 + 4 * i for i in range(9)), *rng.sample(range(1, 20_000), 1500)]} | {(8000, "A" * 300, "T"), (8299, "C", "T")})
    v = spark.createDataFrame([("c", p, r, a, i) for i, (p, r, a) in enumerate(calls)], CALLS)
    got = sorted(tuple(m.pos for m in r.members) for r in variants.linked_chains(v, 5).collect())
    assert got == chains(calls, 5) and max(map(len, got)) >= 9


def test_too_many_chains_fail_and_say_where(spark):
    v = spark.createDataFrame([("c", 100 + i, "A", "T", i) for i in range(12)], CALLS)
    assert variants.linked_chains(v, 13, 5000).count() == 2**12 - 1 - 12
    with pytest.raises(Exception, match="more than 4000 chains of linked variants at c:100"):
        variants.linked_chains(v, 13, 4000).count()


def test_bins_change_nothing(spark):
    """Islands, smoothing, window sums and nearest starts over several bins, against plain windows."""
    rng = random.Random(5)
    sites = [(c, s, p, float(rng.randrange(1, 9))) for c in "ab" for s in "+-" for p in rng.sample(range(30_000), 900)]
    cov = spark.createDataFrame([x for x in sites if x[3] < 8], "chrom string, strand string, pos int, reads double")
    by = {}
    for c, s, p, v in sorted(x for x in sites if x[3] < 8):
        by.setdefault((c, s), []).append((p, v))
    want = []
    for (c, s), x in by.items():
        n = 0
        for k, (p, _) in enumerate(x):
            n += k == 0 or p - x[k - 1][0] > 40
            want.append((c, s, p, n))
    assert rows(clusters.numbered_islands(cov, 40, 64), "chrom", "strand", "pos", "island") == sorted(want)
    mean = [(c, s, p, v if k < 6 or k >= len(x) - 6 else round(sum(y for _, y in x[k - 6 : k + 6]) / 12, 9)) for (c, s), x in by.items() for k, (p, v) in enumerate(x)]
    got = coverage.smooth(cov, "reads", "pos", 6, ["chrom", "strand"], 32)
    assert rows(got.withColumn("smooth", F.round("smooth", 9)), "chrom", "strand", "pos", "smooth") == sorted(mean)
    ref = cov.withColumn("reads", F.lit(1.0))
    q, r = sum(v for x in by.values() for _, v in x), sum(len(x) for x in by.values())
    up = []
    for (c, s), x in by.items():
        for p, v in x:
            near = [y for z, y in x if p - 50 <= z < p + 50]
            fold = sum(near) * (r / q) / len(near)
            if fold >= 1.1 and v >= 3:
                up.append((c, s, p, v, round(fold, 6)))
    got = coverage.upregulated_in_window(cov, ref, 50, 1.1, 3)
    assert rows(got.withColumn("fold", F.round("fold", 6)), "chrom", "strand", "pos", "reads", "fold") == sorted(up) and up
    starts = cov.filter("reads = 7")
    first = {k: [p for p, v in x if v == 7] for k, x in by.items()}
    want = [(c, s, p, max((z for z in first[c, s] if z <= p), default=-1)) for (c, s), x in by.items() for p, _ in x]
    got = nearest_before(cov.select("chrom", "strand", "pos"), "pos", starts, "pos", "at", width=64).fillna(-1, ["at"])
    assert rows(got, "chrom", "strand", "pos", "at") == sorted(want)


# ---- reads ------------------------------------------------------------------------------------------------


def test_collapsing_and_trimming(spark):
    r = spark.createDataFrame([("s", "AC", "q1", 0), ("s", "GG", "q2", 1), ("s", "AC", "q3", 2)], "sample string, seq string, qual string, ord long")
    assert rows(reads.collapsed(r, 1), "seq", "n", "qual") == [("AC", 2, "q3"), ("GG", 1, "q2")] and reads.collapsed(r, 2).count() == 1
    p = spark.createDataFrame([("ACGTACGT", "TACGTGGG"), ("AAAA", "CCCC")], "r1 string, r2 string")
    assert rows(reads.merged_pairs(p, 3), "r1", "merged") == [("AAAA", None), ("ACGTACGT", "ACGTACGTGGG")]
    t = spark.createDataFrame([("ACGTACCCGG", "0123456789")], "seq string, qual string")
    assert rows(reads.trimmed_reads(t, 2, "CCC"), "seq", "qual") == [("GTA", "234")]


def walked(cigar, pos, pam, first, last, seq):
    import re

    ref, at, perfect, indel, miss, donor, ins, ins_at, del_at = pos, 0, True, 1000, 1000, False, [], [], []
    for n, op in ((int(a), b) for a, b in re.findall(r"(\d+)([NXIDSM=])", cigar)):
        for i in range(n):
            if op in "ID":
                indel = min(indel, abs(pam - ref + i))
            if op in "XM":
                miss = min(miss, abs(pam - ref + i))
            if op in "IDXM":
                perfect, donor = False, donor or first < ref + i < last
        if op == "I":
            ins.append(seq[at : at + n])
            ins_at.append(ref)
        if op == "D":
            del_at.append(ref)
        at += n * (op in "SXM=I")
        ref += n * (op in "XM=D")
    return perfect, indel, miss, donor, ins, ins_at, del_at


def test_outcomes_equal_a_walk_base_by_base(spark):
    rng = random.Random(8)
    data = []
    for i in range(80):
        cigar = "".join(f"{rng.randrange(1, 15)}{rng.choice('=XIDSM')}" for _ in range(rng.randrange(1, 6)))
        data.append(("s", "c", rng.randrange(60), cigar, "".join(rng.choice("ACGT") for _ in range(90)), i + 1, rng.randrange(100), 20, 45))
    schema = "sample string, chrom string, pos int, cigar string, seq string, n long, pam int, donor_first int, donor_last int"
    df = spark.createDataFrame([*data, ("s", "*", 0, "*", "A", 7, 0, 0, 0)], schema)
    got = {r.n: r for r in reads.edit_outcomes(df).collect()}
    total = len(data) + 1 + sum(x[5] for x in data)
    assert len(got) == len(data)
    for _, _, pos, cigar, seq, n, pam, a, b in data:
        r = got[n]
        assert (r.perfect_match, r.indel_distance, r.mismatch_distance, r.mismatch_in_donor, list(r.inserted), list(r.insertion_sites), list(r.deletion_sites)) == walked(cigar, pos, pam, a, b, seq)
        assert r.fraction == pytest.approx(n / total) and r.indel_in_guide == (r.indel_distance < 20)


# ---- frames -----------------------------------------------------------------------------------------------


def test_codons_over_exons(spark):
    seq = "TT" + "ATGGC" + "gtaag".upper() + "CTAA" + "TTT"
    g = spark.createDataFrame([("c", seq)], "chrom string, seq string")
    cds = spark.createDataFrame([("Y", "c", 3, 7, "+", 0), ("Y", "c", 13, 16, "+", 1)], "orf string, chrom string, start int, end int, strand string, exon_ord int")
    got = orfs.codons_of(cds, g).orderBy("aa_num").collect()
    assert [(r.codon, r.aa, list(r.coords), list(r.exons)) for r in got] == [("ATG", "M", [2, 3, 4], [1]), ("GCC", "A", [5, 6, 12], [1, 2]), ("TAA", "*", [13, 14, 15], [2])]
    back = seq[::-1].translate(str.maketrans("ACGT", "TGCA"))
    n = len(seq)
    h = spark.createDataFrame([("c", back)], "chrom string, seq string")
    low = lambda a, b: (n + 1 - b, n + 1 - a)
    minus = spark.createDataFrame([("Y", "c", *low(13, 16), "-", 0), ("Y", "c", *low(3, 7), "-", 1)], "orf string, chrom string, start int, end int, strand string, exon_ord int")
    got = orfs.codons_of(minus, h).orderBy("aa_num").collect()
    assert [r.codon for r in got] == ["ATG", "GCC", "TAA"] and list(got[0].coords) == [n + 1 - 3, n + 1 - 4, n + 1 - 5] and list(got[1].exons) == [1, 2]
    assert rows(orfs.stop_counts(orfs.codons_of(cds, g)), "n_stops") == [(1,)]
    part = spark.createDataFrame([("Y", "c", 3, 7, "+", 0)], "orf string, chrom string, start int, end int, strand string, exon_ord int")
    assert [r.partial for r in orfs.codons_of(part, g).orderBy("aa_num").collect()] == [False, True] and orfs.codons_of(part, g, whole=True).count() == 1


def test_genetic_code_and_synonyms(spark):
    code = orfs.genetic_code()
    assert len(code) == 64 and code["ATG"] == "M" and [c for c in code if code[c] == "*"] == ["TAA", "TAG", "TGA"] and sum(a == "L" for a in code.values()) == 6
    t = spark.createDataFrame([("GCT", "A", 0.4, 0), ("GCC", "A", 0.3, 1), ("GCA", "A", 0.3, 2), ("ATG", "M", 1.0, 3)], "codon string, aa string, fraction double, ord int")
    assert rows(orfs.top_codons(t), "codon") == [("ATG",), ("GCT",)]
    assert rows(orfs.synonyms_after(t), "codon", "synonyms") == [("ATG", ["ATG"]), ("GCA", ["GCT", "GCC"]), ("GCC", ["GCA", "GCT"]), ("GCT", ["GCC", "GCA"])]


# ---- guides and donors ------------------------------------------------------------------------------------


def test_guides_at_the_ends_and_on_both_strands(spark):
    guide = "ACGATCGATCGATTACGATC"
    g = spark.createDataFrame([("c", guide + "TGG" + "A" * 5), ("d", "CCA" + guide)], "chrom string, seq string")
    got = rows(guides.find_guides(g), "chrom", "pam_first", "pam_strand", "pam", "guide")
    back = guides.complement_text(guide)
    assert ("c", 20, "+", "TGG", guide) in got and ("d", 0, "-", "TGG", back) in got
    assert guides.screened(guides.find_guides(g), 0).count() == 0


def test_arms_at_chromosome_ends():
    assert donors.arms(500, 501, 1, 1000, 109) == (54, 54, False, False)
    assert donors.arms(10, 11, 1, 1000, 109) == (10, 98, True, False)
    assert donors.arms(990, 991, 1, 1000, 109) == (99, 9, False, True)


def test_arms_move_away_from_sites():
    lay = donors.Layout()
    donor = "A" * 100 + "GCTCTTC" + "AA"
    assert donors.away_from_sites(donor, 54, 54, 1, False, False, lay) == (54 + 9, 54 - 9, False)
    two = "AA" + "A" * 40 + "GCTCTTC" + "A" * 51 + "GAAGAGC" + "AA"
    assert donors.away_from_sites(two, 54, 54, 1, False, False, lay) == (52, 56, True)
    assert donors.away_from_sites("A" * 109, 54, 54, 1, False, False, lay) == (54, 54, False)
    assert lay.donor == 109 and len(set(map(len, lay.reverse))) == 1


def test_a_variant_beside_a_pam(spark):
    rng = random.Random(11)
    left, right = "".join(rng.choice("AT") for _ in range(150)), "".join(rng.choice("AT") for _ in range(150))
    guide = "ATCATCATTACTATTACATC"
    seq = left + guide + "AGG" + right
    g = spark.createDataFrame([("c", seq)], "chrom string, seq string")
    pos = len(left) + 20  # the last base of the guide, from 1
    v = spark.createDataFrame([("c", pos, "C", "G")], "chrom string, pos long, ref string, alt string")
    got = donors.natural_variant_oligos(v, g).collect()
    mine = [r for r in got if r.guide == guide]
    assert len(mine) == 1 and mine[0].disruption == 1 and mine[0].category.startswith("1:") and len(mine[0].oligo) == 170 and guide in mine[0].oligo
    lone = spark.createDataFrame([("c", 40, seq[39], "C" if seq[39] != "C" else "A")], "chrom string, pos long, ref string, alt string")
    assert [r.category for r in donors.natural_variant_oligos(lone, g).collect()] == [None]
    assert {r.what: r.n for r in donors.variant_statistics(donors.natural_variant_oligos(v.union(lone), g)).collect()}["no PAM"] == 1


def test_subpools(spark):
    r = spark.createDataFrame([("Y", 0, 30, 0), ("Y", 100, 110, 0), ("Y", 105, 120, 0), ("Y", 300, 500, 0), ("Y", 600, 610, 0)], "orf string, range_first int, range_last int, orf_first int")
    assert rows(donors.subpools(r), "range_first", "subpool") == [(0, 0), (100, 0), (105, 1), (600, 3)]


def test_sites_in_donors():
    code = orfs.genetic_code()
    syn = {a: [c for c in code if code[c] == a] for a in code.values()}
    donor, change = donors.without_site("AAAGCTCTTCAA", "GCTCTTC", syn, code)
    assert len(donor) == 12 and "GCTCTTC" not in donor.upper() and change
    assert donors.one_site_left("GAAGAGC", "AAAA", "", ) == ("AAAA", [])
    fixed, changes = donors.one_site_left("GAAGAGC" + "GCTCTT", "CAAA", "")
    assert fixed is not None and donors.count_sites("GAAGAGCGCTCTT" + fixed, ("GAAGAGC", "GCTCTTC")) == 1 and changes
    assert donors.one_site_left("GAAGAGC" * 3, "AAAA", "") == (None, [])
    assert not donors.guide_gone("ACGT", "NGG", "TTACGTAGGTT") and donors.guide_gone("ACGT", "NGG", "TTACGTAGG") and donors.guide_gone("ACGT", "NGG", "TTACGTATTTT")
