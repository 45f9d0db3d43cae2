import random

import pytest
from pyspark.sql import functions as F

from locus.functions import alignment as al
from locus.functions import sequence as sq


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def lit(x):
    return F.lit(x)


def test_reverse_complement(spark):
    assert one(spark, sq.reverse_complement(lit("ACGTNRY acgt"))) == "acgt RYNACGT"
    assert one(spark, sq.reverse_complement(lit("ACX"))) is None
    assert one(spark, sq.reverse_complement(lit("ACX"), iupac=True)) == "XGT"
    assert one(spark, sq.reverse_complement(lit(""))) == ""


@pytest.mark.parametrize("a,b,fits", [("A", "A", True), ("N", "A", True), ("A", "N", True), ("N", "R", False), ("N", "N", True), ("R", "C", False), ("X", "X", True), ("A", "C", False)])
def test_base_match(spark, a, b, fits):
    assert one(spark, sq.base_match(lit(a), lit(b))) is fits
    if a != b:
        assert one(spark, sq.base_match(lit(a), lit(b), ambiguous=False)) is False


def test_hamming(spark):
    assert one(spark, sq.hamming(lit("ACGT"), lit("ACCA"))) == 2
    assert one(spark, sq.hamming(lit("ACG"), lit("ACGTTT"))) == 0
    assert one(spark, sq.hamming(lit("ACGT"), lit("ACG"))) is None
    assert one(spark, sq.hamming(lit("ACG"), lit("ACGT"), same_length=True)) is None
    assert one(spark, sq.hamming(lit(""), lit("A"))) == 0
    assert one(spark, sq.hamming_to("NGG", lit("AGG"))) == 0
    assert one(spark, sq.hamming_to("NGG", lit("AG"))) is None


def test_attributes(spark):
    t = lit("ID=a;Parent=b;Name=c")
    assert [one(spark, sq.gff_attribute(t, k)) for k in ("ID", "Parent", "Name")] == ["a", "b", None]
    assert one(spark, sq.gff_attribute(t, "Name", closed=False)) == "c"
    assert one(spark, sq.gff_attribute(lit("xID=a;"), "ID")) == "a"
    assert one(spark, sq.gtf_attribute(lit('gene_id "Y1"; gene_name "N";'), "gene_name")) == "N"
    assert one(spark, sq.common_gene_name(lit("ID=a;Name=n;"))) == "n" and one(spark, sq.common_gene_name(lit("Name=n;gene=g;"))) == "g"


def test_names(spark):
    assert one(spark, sq.numeral(lit("chr9"))) == "chrIX" and one(spark, sq.numeral(lit("chr17"))) is None and one(spark, sq.numeral(lit("chr17"), mito=True)) == "chrM"
    assert one(spark, sq.letter_numeral(lit("P"))) == "chrXVI"
    assert [one(spark, sq.mito(lit("chrmt"), m)) for m in ("upper", "lower", "either", "exact")] == [False, True, True, True]


def test_cigar(spark):
    assert [(x.n, x.op) for x in one(spark, sq.cigar_ops(lit("5S10=1X2I3D4M")))] == [(5, "S"), (10, "="), (1, "X"), (2, "I"), (3, "D"), (4, "M")]
    assert one(spark, sq.cigar_bases(lit("5=1X7="), "=")) == 12


def test_adenosines(spark):
    r = one(spark, sq.adenosine_range(lit("+"), lit("CCGAAAT"), lit(2)))
    assert (r.first, r.last) == (2, 5)
    r = one(spark, sq.adenosine_range(lit("-"), lit("CTTTGAA"), lit(4)))
    assert (r.first, r.last) == (1, 4)


def test_screens_and_slices(spark):
    assert one(spark, sq.has_t_run(lit("ATTTTTTA"))) and not one(spark, sq.has_t_run(lit("ATTTTTA")))
    assert one(spark, sq.has_site(lit("AAGCTCTTCA"), ["GCTCTTC"])) and not one(spark, sq.has_site(lit("A"), []))
    assert one(spark, sq.substr0(lit("ACGT"), lit(-2), lit(2))) == "AC" and one(spark, sq.substr0(lit("ACGT"), lit(1), lit(3))) == "CG" and one(spark, sq.substr0(lit("ACGT"), lit(3), lit(1))) == ""
    assert one(spark, sq.floor_div(lit(-7), 3)) == -3


def cells(v, w, indel):
    """The score matrix cell by cell."""
    s = [[0] * (len(w) + 1) for _ in range(len(v) + 1)]
    for j in range(1, len(w) + 1):
        s[0][j] = s[0][j - 1] - indel
    for i in range(1, len(v) + 1):
        for j in range(1, len(w) + 1):
            s[i][j] = max(s[i - 1][j] - indel, s[i][j - 1] - indel, s[i - 1][j - 1] + (1 if v[i - 1] == w[j - 1] else -1))
    return s


def test_alignment_equals_one_cell_by_cell():
    rng = random.Random(0)
    for _ in range(150):
        v, w = ("".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 14))) for _ in range(2))
        for indel in (1, 3):
            s = cells(v, w, indel)
            assert al.fitting_matrix(v, w, indel).tolist() == s
            got, best = al.fitting_alignment(v, w, indel), max(r[-1] for r in s)
            assert got["score"] == max(0, best)
            if best > 0 and w:
                assert got["subject"].replace("-", "") == w and got["query"].replace("-", "") in v
                points = sum(1 if m == "_" else -1 if m == "*" else -indel for m in got["alignment"])
                assert points == best and len(got["snps"]) == got["alignment"].count("*") and len(got["indels"]) == got["alignment"].count("-")
            else:
                assert got["alignment"] == ""


def test_disruption():
    assert al.disruptions("NGG", [0, 1, 2, 3, 12], [2]) == [-2, -1, 1, 10, 0]
    assert al.disruption_points([-2, -1, 0, 1, 10, 11, 20, 21]) == 3 + 3 + 2 + 2 + 1 + 1
    guide = "ACGTACGTACGTACGTACGTTGG"
    got = al.guide_alignment("TT" + guide[:15] + "C" + guide[16:] + "AA", guide, "NGG")
    assert got["snps"] == [7] and got["disruptions"] == [5]
    back = al.guide_alignment(al.reverse_complement_text("TT" + guide + "AA"), guide, "NGG")
    assert back["disruptions"] == [] and back["score"] == 23


def test_edit_distance_isnt_levenshteins():
    assert al.edit_distance_text("ACGT", "ACGT") == 0
    assert al.edit_distance_text("AAACGTAA", "ACGT") == 4
    assert al.edit_distance_text("", "ACG") == 3
