"""Column expressions over DNA, names and attribute strings. All run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: IUPAC codes and the bases that each stands for.
IUPAC = {"R": "AG", "Y": "CT", "S": "GC", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}
#: Complements of the basic alphabet, and of all IUPAC codes.
COMPLEMENT = ("ATGCNRYatgcnry ", "TACGNYRtacgnyr ")
COMPLEMENT_IUPAC = ("ATGCRYSWKMBDHVNatgcryswkmbdhvn", "TACGYRSWMKVHDBNtacgyrswmkvhdbn")
#: The sixteen nuclear chromosomes in Roman numerals.
NUMERALS = ("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X", "XI", "XII", "XIII", "XIV", "XV", "XVI")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def reverse_complement(seq: Column | str, iupac: bool = False) -> Column:
    """The reverse complement; with ``iupac`` all codes are complemented and others stay, without it a
    base outside of the basic alphabet gives null, as there is no answer for it."""
    s = _c(seq)
    if iupac:
        return F.translate(F.reverse(s), *COMPLEMENT_IUPAC)
    return F.when(F.translate(s, COMPLEMENT[0], "") == "", F.translate(F.reverse(s), *COMPLEMENT))


def base_match(a: Column | str, b: Column | str, ambiguous: bool = True) -> Column:
    """Equal, or one is a code for several bases of which the other is one. Two codes never match."""
    a, b = _c(a), _c(b)
    if not ambiguous:
        return F.coalesce(a == b, F.lit(False))
    codes = F.create_map(*[F.lit(x) for kv in IUPAC.items() for x in kv])
    inside = lambda code, base: F.coalesce(F.contains(F.try_element_at(codes, code), base) & (F.length(base) == 1), F.lit(False))
    return F.coalesce(a == b, F.lit(False)) | inside(a, b) | inside(b, a)


def hamming(a: Column | str, b: Column | str, ambiguous: bool = True, same_length: bool = False) -> Column:
    """Mismatches over the length of a; what b has beyond it doesn't count. Null where b is shorter, or
    with ``same_length`` where lengths differ."""
    a, b = _c(a), _c(b)
    fits = (F.length(a) == F.length(b)) if same_length else (F.length(b) >= F.length(a))
    fit = F.zip_with(F.split(a, ""), F.split(F.left(b, F.length(a)), ""), lambda x, y: base_match(x, y, ambiguous))
    miss = F.size(F.filter(fit, lambda ok: ~ok))
    return F.when(fits, F.when(F.length(a) == 0, F.lit(0)).otherwise(miss))


def hamming_to(pattern: str, seq: Column | str) -> Column:
    """Mismatches between a known pattern and as many bases of seq: a sum of comparisons, no arrays."""
    seq, total = _c(seq), F.lit(0)
    for i, p in enumerate(pattern):
        base = F.substring(seq, i + 1, 1)
        good = [p, *IUPAC.get(p, ""), *(code for code, bases in IUPAC.items() if p in bases)]
        total = total + F.when(base.isin(good), 0).otherwise(1)
    return F.when(F.length(seq) >= len(pattern), total)


def has_t_run(seq: Column | str, n: int = 6) -> Column:
    return F.contains(_c(seq), F.lit("T" * n))


def has_site(seq: Column | str, sites: list[str]) -> Column:
    """Whether any of the (restriction) sites is in seq."""
    found = F.lit(False)
    for s in sites:
        found = found | F.contains(_c(seq), F.lit(s))
    return found


def numeral(chrom: Column | str, mito: bool = False) -> Column:
    """chr7 to chrVII; null for numbers that aren't nuclear (17 is M with ``mito``)."""
    names = dict(enumerate(NUMERALS, 1)) | ({17: "M"} if mito else {})
    table = F.create_map(*[F.lit(x) for k, v in names.items() for x in (f"chr{k}", f"chr{v}")])
    return F.try_element_at(table, _c(chrom))


def letter_numeral(letter: Column | str) -> Column:
    """The chromosome of a systematic name's letter, A to P."""
    table = F.create_map(*[F.lit(x) for k, v in enumerate(NUMERALS) for x in ("ABCDEFGHIJKLMNOP"[k], f"chr{v}")])
    return F.try_element_at(table, _c(letter))


def mito(chrom: Column | str, mode: str = "either") -> Column:
    """Whether a chromosome counts as mitochondrial: ``upper`` M in its name, ``lower`` m, ``either``, or
    ``exact`` names."""
    c = _c(chrom)
    return {"upper": F.contains(c, F.lit("M")), "lower": F.contains(c, F.lit("m")), "either": c.rlike("[mM]"), "exact": c.isin("chrmt", "chrMito")}[mode]


def gff_attribute(text: Column | str, key: str, closed: bool = True) -> Column:
    """What follows the first ``key=`` up to a semicolon; without ``closed`` the end of the text does too.
    Null where there is none."""
    return F.nullif(F.regexp_extract(_c(text), f"{key}=([^;]*)" + (";" if closed else ""), 1), F.lit(""))


def gtf_attribute(text: Column | str, key: str) -> Column:
    return F.nullif(F.regexp_extract(_c(text), f'{key} "([^"]*)"', 1), F.lit(""))


def common_gene_name(text: Column | str, closed: bool = True) -> Column:
    return F.coalesce(gff_attribute(text, "gene", closed), gff_attribute(text, "Name", closed))


def cigar_ops(cigar: Column | str) -> Column:
    """A CIGAR string as an array of n and op."""
    return F.transform(F.regexp_extract_all(_c(cigar), F.lit(r"(\d+)([NXIDSM=])"), F.lit(0)), lambda x: F.struct(F.substring(x, F.lit(1), F.length(x) - 1).cast("int").alias("n"), F.right(x, F.lit(1)).alias("op")))


def cigar_bases(cigar: Column | str, op: str) -> Column:
    """How many bases an operation has in all."""
    return F.aggregate(cigar_ops(cigar), F.lit(0), lambda total, x: total + F.when(x["op"] == op, x["n"]).otherwise(0))


def run_length(seq: Column | str, at: Column, base: str, forward: bool = True) -> Column:
    """How many of ``base`` follow the place ``at`` (from 0) without a gap, or come before it."""
    seq = _c(seq)
    if forward:
        return F.length(F.regexp_extract(F.substring(seq, at + 2, F.length(seq)), f"^{base}*", 0))
    return F.length(F.regexp_extract(F.substring(seq, F.lit(1), F.greatest(at, F.lit(0))), f"{base}*$", 0))


def adenosine_range(strand: Column | str, seq: Column | str, at: Column) -> Column:
    """From and to where a 3' end may lie, as templated adenosines can't be told from the tail."""
    plus = _c(strand) == "+"
    return F.struct(F.when(plus, at).otherwise(at - run_length(seq, at, "T", False)).alias("first"), F.when(plus, at + run_length(seq, at, "A")).otherwise(at).alias("last"))


def floor_div(a: Column, b: int) -> Column:
    """Division that rounds down, below zero too."""
    return F.floor(a / F.lit(b)).cast("int")


def substr0(seq: Column | str, start: Column, stop: Column) -> Column:
    """Characters start to stop, from 0, without stop; what lies outside of seq isn't there."""
    seq, first = _c(seq), F.greatest(start, F.lit(0))
    return F.substring(seq, first + 1, F.greatest(stop - first, F.lit(0)))
