"""Donor design: natural variants, saturation of codons, and amino acid substitutions.

Each design is one row's work: a variant, a codon and direction, or an edit with its candidate guides, with
the piece of genome around it. Rows go through Arrow in batches; what must be in order is in the row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locus.functions.alignment import disruption_points, guide_alignment
from locus.functions.sequence import IUPAC
from locus.operators.guides import complement_text, flanks
from locus.operators.orfs import farthest, genetic_code


def fits(pattern: str, seq: str) -> bool:
    """Whether bases equal a pattern with IUPAC codes, over the length of seq."""
    return all(a == b or b in IUPAC.get(a, "") or a in IUPAC.get(b, "") for a, b in zip(pattern, seq, strict=False))


def count_sites(seq: str, sites) -> int:
    return sum(seq.count(s) for s in sites)


def _frame(rows: list[dict], names: list[str]) -> pd.DataFrame:
    """Rows as a frame whose missing values are None, of whatever type."""
    return pd.DataFrame({n: pd.Series([r.get(n) for r in rows], dtype=object) for n in names})


@dataclass(frozen=True)
class Layout:
    """Sizes and sequences of an oligo."""

    # Fixed values.
    oligo: int = 170
    guide: int = 20
    pam: str = "NGG"
    forward: str = "GGACTTTggcgcgcc"
    cloning: str = "gtttgaagagc"
    amplification: tuple[str, ...] = ("gtccttggactttgc", "cctatccgaactacg", "gtaagatcacctgcg", "ggtacgaggcgactg", "cggagcgttgaggac", "agaccggtgtgcagg", "aggtctgcggagagc")
    gibson: tuple[str, str] = ("GCGAATGGGACTTTgg", "Gtttaagagctatgctggaaa")
    sites: tuple[str, ...] = ("GCTCTTC", "GAAGAGC")
    homology: int = 20
    to_pam: int = 20
    t_run: int = 6
    most_guides: int = 301
    partitions: tuple[int, ...] = (5, 10, 15, 20)
    extension: tuple[int, int] = field(default=(2, 2))

    @property
    def reverse(self) -> list[str]:
        """Primers of the subpools: the complements of their amplification sequences."""
        return [complement_text(x) for x in self.amplification]

    @property
    def donor(self) -> int:
        return self.oligo - len(self.forward) - self.guide - len(self.cloning) - len(self.reverse[0])


# ---- natural variants -------------------------------------------------------------------------------------


def arms(start: int, end: int, alt: int, chrom_length: int, size: int) -> tuple[int, int, bool, bool]:
    """Lengths of the arms around a variant from start to end, and whether the chromosome's start or end
    cut one of them (the other is as much longer)."""
    left = (size - alt) // 2
    right = size - alt - left
    over = max(0, end + right - chrom_length)
    left, right = left + over, right - over
    under = left - start if start - left < 1 else 0
    return left - under, right + under, start - left < 1, over > 0


def away_from_sites(donor: str, left: int, right: int, alt: int, at_start: bool, at_end: bool, lay: Layout) -> tuple[int, int, bool]:
    """Arms moved so that sites fall off the donor's end, and whether sites on both sides forbid that. Of
    several sites on one side the last one's shift counts; a shift below one leaves arms as they are."""
    sides, shift = set(), 0
    for site in lay.sites:
        at = donor.find(site)
        if at < 0 or left <= lay.homology:
            continue
        bound = left + alt + lay.homology
        if at >= bound and not at_start:
            shift = len(donor) - at
            sides.add("right")
        elif at <= bound and not at_end:
            shift = at - (left - lay.homology)
            sides.add("left")
        else:
            left, right = left - lay.extension[0], right + lay.extension[1]
    if shift <= 0:
        return left, right, False
    if len(sides) == 2:
        return left - lay.extension[0], right + lay.extension[1], True
    return left + shift, right - shift, False


def stays_in_donor(guide_pam: str, donor: str, left: int, right: int, first: tuple[str, str], lay: Layout) -> bool:
    """Whether a guide with its PAM is still in the donor around the variant, on either strand; ``first`` are
    the alleles of the (first) variant."""
    more = lay.guide + len(lay.pam) + len(first[0]) + len(first[1])
    for i in range(max(left - more, 0), min(lay.donor - right + more, lay.donor)):
        part = donor[i : i + len(guide_pam)]
        if fits(guide_pam, part) or fits(guide_pam, complement_text(part)):
            return True
    return False


def variant_guides(row, lay: Layout) -> Iterator[dict]:
    """The designs of one variant: guides inside it first, then outwards, minus before plus."""
    at0, n = row.context_first, len(lay.pam)
    g = lambda a, b: row.context[max(a - at0, 0) : max(b - at0, 0)]
    start, end, alt = row.pos - 1, row.pos + len(row.ref) - 1, row.alt
    left, right, at_start, at_end = arms(start, end, len(alt), row.chrom_length, lay.donor)
    build = lambda: g(start - left, start) + alt + g(end, end + right)
    left, right, blocked = away_from_sites(build(), left, right, len(alt), at_start, at_end, lay)
    donor = build()
    first = (row.first_ref, row.first_alt)
    order = [(c, s) for c in range(start, end + 1) for s in "-+"] + [x for d in range(lay.to_pam) for x in ((start - 1 - d, "-"), (end + 1 + d, "+"))]
    found = 0
    for coord, strand in order:
        if found >= lay.most_guides:
            break
        pam = g(coord - n, coord) if strand == "-" else g(coord, coord + n)
        whole = g(coord - n, coord + lay.guide) if strand == "-" else g(coord - lay.guide, coord + n)
        whole = complement_text(whole) if strand == "-" else whole
        if len(pam) < n or not fits(lay.pam, complement_text(pam) if strand == "-" else pam) or len(whole) < lay.guide + n:
            continue
        guide = whole[: lay.guide]
        if stays_in_donor(guide + lay.pam, donor, left, right, first, lay):
            continue
        found += 1
        yield {"coord": coord, "strand": strand, "guide": guide, "guide_pam": whole, "donor": complement_text(donor) if strand == "-" else donor, "blocked": blocked, "guide_ord": found}


def categorised(design: dict, lay: Layout) -> Iterator[dict]:
    """The oligos of a design: its category by the disruption nearest the PAM, or that of guides with a run
    of T; none if a site is in guide, donor or a junction; and the donor before the guide where sites on both
    sides forbade a shift."""
    guide, donor = design["guide"], design["donor"]
    found = guide_alignment(donor, design["guide_pam"], lay.pam)
    near = min(found["disruptions"], default=lay.guide + 1)
    part = next((i for i, most in enumerate(lay.partitions) if near <= most), len(lay.partitions) - 1)
    lows = (0, *lay.partitions)
    category = f"1:PAM_disruption_or_1_to_{lay.partitions[0]}_bp_from_PAM_disruption" if part == 0 else f"{part + 1}:{lows[part]}_to_{lows[part + 1]}_bp_from_PAM_disruption"
    oligo = lambda primer: lay.forward + guide + lay.cloning + donor + primer
    whole = oligo(lay.reverse[part]).upper()
    own = len(lay.forward) + lay.guide + 4
    junction = any(s not in donor and whole.find(s) > 9 and whole.find(s) != own for s in lay.sites)
    clean = not junction and not any(s in guide or s in donor for s in lay.sites)
    base = design | {"disruption": near, "disruptions": found["disruptions"], "query": found["query"], "subject": found["subject"], "alignment": found["alignment"]}
    if clean and "T" * lay.t_run in guide:
        yield base | {"category": "5:guide_with_T_stretch", "oligo": oligo(lay.reverse[4])}
    elif clean:
        yield base | {"category": category, "oligo": oligo(lay.reverse[part])}
    if design["blocked"] and "T" * lay.t_run not in donor + guide:
        yield base | {"category": "6:donor_guide", "oligo": lay.gibson[0].lower() + donor + guide + lay.gibson[1].lower()}


DESIGN = "chrom string, pos long, ref string, alt string, coord long, strand string, guide string, guide_pam string, donor string, guide_ord int, category string, oligo string, disruption int, disruptions array<int>, query string, subject string, alignment string"
_DESIGN = [x.split()[0] for x in DESIGN.split(", ")]


def natural_variant_oligos(variants: DataFrame, genome: DataFrame, lay: Layout = Layout()) -> DataFrame:  # noqa: B008
    """Guide and donor oligos of variants (chrom, pos, ref, alt, and members where linked): DESIGN. Variants
    without a usable guide have one row without a category."""
    first = F.col("members")[0] if "members" in variants.columns else F.struct("ref", "alt")
    reach = lay.donor + lay.guide + 2 * lay.to_pam
    rows = variants.select("chrom", "pos", "ref", "alt", first["ref"].alias("first_ref"), first["alt"].alias("first_alt"))
    rows = flanks(rows, genome, F.col("pos") - 1 - reach, F.col("pos") + F.length("ref") + reach)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                key = {"chrom": row.chrom, "pos": row.pos, "ref": row.ref, "alt": row.alt}
                designs = list(variant_guides(row, lay))
                out += [key | x for d in designs for x in categorised(d, lay)] if designs else [key]
            yield _frame(out, _DESIGN)

    return rows.mapInPandas(run, DESIGN)


def variant_statistics(designs: DataFrame) -> DataFrame:
    """Numbers of variants without, with one and with several guides, and of oligos by category."""
    per = designs.groupBy("chrom", "pos", "ref", "alt").agg(F.countDistinct("guide_ord").alias("n"))
    kinds = per.groupBy(F.when(F.col("n") == 0, "no PAM").when(F.col("n") == 1, "single PAM").otherwise("multiple PAMs").alias("what")).agg(F.count(F.lit(1)).alias("n"))
    return kinds.unionByName(designs.filter("category IS NOT NULL").groupBy(F.col("category").alias("what")).agg(F.count(F.lit(1)).alias("n")))


# ---- saturation of codons ---------------------------------------------------------------------------------


def _differs(a: str, b: str) -> int:
    return sum(x != y for x, y in zip(a, b, strict=True))


def spread_synonyms(codons: list[str], aa: int, n: int, upstream: bool, synonyms: dict[str, list[str]], code: dict[str, str], clear) -> list[str]:
    """codons with the ``n`` beside ``aa`` replaced by the synonym that differs most, the first of equals,
    among those whose donor is clear(codons)."""
    out = list(codons)
    for k in range(1, n + 1):
        i = aa - 1 - k if upstream else aa - 1 + k
        best, most = codons[i], 0
        for other in synonyms[code[codons[i]]]:
            out[i] = other
            if _differs(other, codons[i]) > most and clear(out):
                best, most = other, _differs(other, codons[i])
        out[i] = best
    return out


LIBRARY = "orf string, aa_num int, upstream boolean, name string, pool int, control boolean, donor string, chrom string, ref_start int, ref_region string, alt_region string, guide string, pam_strand string, pam_coord int, pam string, score int, range_first int, range_last int"
_LIBRARY = [x.split()[0] for x in LIBRARY.split(", ")]


def saturate(row, synonyms: dict[str, list[str]], top: set[str], code: dict[str, str], size: int = 109, enough: int = 6, pam: str = "NGG", sites: tuple[str, ...] = ("GCTCTTC", "GAAGAGC"), fixed: bool = False) -> list[dict]:
    """The donors of one codon in one direction: synonyms spread from it until a guide is disrupted enough,
    within its exon, not over the first or past the last codon. Sites are looked for as they stand in the
    donor, whose changed region is in lower case, unless ``fixed``; ``fixed`` also takes places on the minus
    strand for what they are, from 1."""
    codons, exons, aa, up = list(row.codons), [list(x) for x in row.exons], int(row.aa_num), bool(row.upstream)
    at0, plus, total = row.context_first, row.strand == "+", len(codons)
    g = lambda a, b: row.context[max(a - at0, 0) : max(b - at0, 0)]

    def donor(own: list[str], n: int, more: int = 0) -> tuple[str, int, int]:
        """The donor, and the first place and the length of its changed region."""
        length = 3 + 3 * n
        lead = aa - n if plus and up else aa + n if not plus and not up else aa
        first = row.lows[lead - 1] - (1 if fixed and not plus else 0)
        left = (size - length) // 2
        right = size - length - left
        region = "".join(own[aa - 1 - n : aa] if up else own[aa - 1 : aa + n])
        region = region if plus else complement_text(region)
        return g(first - left - more, first) + region.lower() + g(first + length, first + length + right + more), first, length

    best, score, n = None, -1, 0
    while True:
        shown = (lambda x: x.upper()) if fixed else (lambda x: x)
        own = spread_synonyms(codons, aa, n, up, synonyms, code, lambda c: not any(s in shown(donor(c, n)[0]) for s in sites))  # noqa: B023
        control = donor(own, n, 200)[0]
        for guide in row.guides:
            points = disruption_points(guide_alignment(control, guide["guide"] + guide["pam"], pam)["disruptions"])
            if points > score:
                best, score = (guide, own, n, points), points
        n += 1
        beside = aa - n if up else aa + n
        if (up and beside <= 1) or (not up and beside > total) or score >= enough or len(exons[beside - 1]) != 1 or exons[beside - 1][0] != exons[aa - 1][0]:
            break
    if best is None:
        return []
    guide, own, n, points = best
    spread = range(aa - n, aa) if up else range(aa + 1, aa + n + 1)
    changes = ",".join(f"{codons[i - 1]}{i}{own[i - 1]}" for i in spread)
    same = ",".join(f"{code[codons[i - 1]]}{i}{code[codons[i - 1]]}" for i in spread)
    wild, out = codons[aa - 1], []
    for target in code:
        now = [*own[: aa - 1], target, *own[aa:]]
        seq, first, length = donor(now, n)
        cut = slice(aa - 1 - n, aa) if up else slice(aa - 1, aa + n)
        regions = ["".join(x[cut]) if plus else complement_text("".join(x[cut])) for x in (codons, now)]
        control = target == wild
        name = "_".join([row.orf, f"{code[wild]}{aa}{code[target]}", "control" if control else "variant", f"{wild}{aa}{target}", "upstream_synonymous_changes:" if up else "downstream_synonymous_changes:", same, changes])
        out.append({"orf": row.orf, "aa_num": aa, "upstream": up, "name": name, "pool": 0 if not control and target in top else 1, "control": control, "donor": seq, "chrom": row.chrom, "ref_start": first, "ref_region": regions[0], "alt_region": regions[1], "guide": guide["guide"], "pam_strand": guide["pam_strand"], "pam_coord": guide["pam_first"], "pam": guide["pam"], "score": points, "range_first": first, "range_last": first + length})
    return out


def saturation_rows(codons: DataFrame, guides: DataFrame, genome: DataFrame, start: bool = False, stop: bool = False, reach: int = 400) -> DataFrame:
    """A row for each codon that no exon border cuts and each direction, with its ORF, guides (proximal_guides
    with key orf:aa:upstream) and the genome around."""
    whole = codons.groupBy("orf", "chrom", "strand").agg(F.array_sort(F.collect_list(F.struct("aa_num", "codon", "exons", F.array_min("coords").alias("low")))).alias("x"))
    whole = whole.select("orf", "chrom", "strand", F.transform("x", lambda x: x["codon"]).alias("codons"), F.transform("x", lambda x: x["exons"]).alias("exons"), F.transform("x", lambda x: x["low"]).alias("lows"))
    own = codons.filter(F.size("exons") == 1).select("orf", "aa_num", F.array_min("coords").alias("low")).join(whole, "orf")
    own = own.filter((F.col("aa_num") >= (1 if start else 2)) & (F.col("aa_num") <= F.size("codons") - (0 if stop else 1)))
    own = own.withColumn("upstream", F.explode(F.array(F.lit(True), F.lit(False)))).withColumn("key", F.concat_ws(":", "orf", "aa_num", "upstream"))
    listed = guides.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col("pam_strand") == "-", "rank", F.struct("pam_strand", "pam_first", "pam", "guide").alias("g")))), lambda x: x["g"]).alias("guides"))
    return flanks(own.join(listed, "key"), genome, F.col("low") - reach, F.col("low") + reach)


def saturation_library(rows: DataFrame, synonyms: dict[str, list[str]], top: set[str], code: dict[str, str] | None = None, **how) -> DataFrame:
    """LIBRARY of saturation_rows()."""
    code = code or genetic_code()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield _frame([x for row in pdf.itertuples(index=False) for x in saturate(row, synonyms, top, code, **how)], _LIBRARY)

    return rows.mapInPandas(run, LIBRARY)


def combined_libraries(libraries: list[DataFrame]) -> DataFrame:
    """All, of a name that comes again the last library's."""
    out = None
    for i, x in enumerate(libraries):
        x = x.withColumn("__i", F.lit(i))
        out = x if out is None else out.unionByName(x)
    last = Window.partitionBy("name").orderBy(F.desc("__i"))
    return out.withColumn("__n", F.row_number().over(last)).filter("__n = 1").drop("__n", "__i")


SUBPOOLS = "orf string, range_first int, range_last int, subpool int, window_first int, window_last int"


def subpools(ranges: DataFrame, size: int = 110) -> DataFrame:
    """Windows of a fixed size over each ORF's ranges (orf, range_first, range_last, orf_first) in their order:
    the first begins at the ORF's first place, and one begins where a range isn't within the one before.
    Ranges longer than a window get none."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        first, number, out = int(pdf["orf_first"].iloc[0]), 0, []
        for a, b in sorted(set(zip(pdf["range_first"].astype(int), pdf["range_last"].astype(int), strict=True))):
            if not first <= a <= b <= first + size:
                first, number = a, number + 1
            if b <= first + size:
                out.append((key[0], a, b, number, first, first + size))
        return pd.DataFrame(out, columns=[x.split()[0] for x in SUBPOOLS.split(", ")])

    return ranges.groupBy("orf").applyInPandas(run, SUBPOOLS)


def library_oligos(library: DataFrame, pools: DataFrame, lay: Layout, first_primer: int = 0) -> DataFrame:
    """Oligos with the primer of their pool and window: number of windows times pool, and the window's."""
    columns = pools.groupBy("orf").agg((F.max("subpool") + 1).alias("windows"))
    rows = library.join(pools, ["orf", "range_first", "range_last"]).join(columns, "orf")
    index = F.col("pool") * F.col("windows") + first_primer + F.col("subpool")
    primer = F.try_element_at(F.array(*map(F.lit, lay.reverse)), index + 1)
    oligo = F.concat(F.lit(lay.forward.lower()), F.upper("guide"), F.lit(lay.cloning.lower()), "donor", primer)
    return rows.withColumns({"primer": index, "oligo": oligo, "category": F.concat(index.cast("string"), F.lit(":"), "chrom", F.lit("_"), "window_first", F.lit("_"), "window_last")})


# ---- amino acid substitutions -----------------------------------------------------------------------------


def substitution_edits(substitutions: DataFrame, codons: DataFrame, synonyms: dict[str, list[str]]) -> DataFrame:
    """One edit for each substitution (key, orf, aa_nums, alt_aas, alt_codons or null): all amino acids from
    its first to its last, those between by synonyms; each new codon is the one given, or that of its amino
    acid which differs most from the old one. ``codons`` as codons_of() gives them; chrom, strand, left, right
    and mid (places of the changed codons) come with it."""
    asked = substitutions.withColumn("aa_num", F.explode(F.sequence(F.array_min("aa_nums"), F.array_max("aa_nums"))))
    at = F.array_position("aa_nums", F.col("aa_num"))
    given = lambda c: F.when(at > 0, F.try_element_at(c, at.cast("int")))
    rows = asked.join(codons.select("orf", "chrom", "strand", "aa_num", "codon", "aa", "coords"), ["orf", "aa_num"])
    table = F.create_map(*[F.lit(x) if isinstance(x, str) else F.array(*map(F.lit, x)) for kv in synonyms.items() for x in kv])
    alt = F.coalesce(given(F.col("alt_aas")), F.col("aa"))
    new = F.coalesce(given(F.col("alt_codons")), farthest(F.col("codon"), F.try_element_at(table, alt)))
    rows = rows.withColumns({"__alt": alt, "__new": new})
    got = F.array_sort(F.collect_list(F.struct("aa_num", "aa", "codon", F.col("__alt").alias("alt"), F.col("__new").alias("new"), "coords")))
    out = rows.groupBy("key", "orf", "chrom", "strand").agg(got.alias("x"))
    take = lambda f: F.transform("x", lambda x: x[f])
    first, last = F.col("x")[0]["coords"][0], F.element_at("x", -1)["coords"][2]
    return out.select("key", "orf", "chrom", "strand", take("aa_num").alias("aa_nums"), take("aa").alias("ref_aas"), take("codon").alias("ref_codons"), take("alt").alias("alt_aas"), take("new").alias("alt_codons"), F.least(first, last).alias("left"), F.greatest(first, last).alias("right"), F.floor((first + last) / 2).cast("int").alias("mid"))


def without_site(donor: str, site: str, synonyms: dict[str, list[str]], code: dict[str, str]) -> tuple[str, str]:
    """The donor with the codon at the site (or the next whole one) replaced by the synonym that differs
    least, and what was changed."""
    at = donor.upper().index(site)
    i = math.ceil(at / 3) * 3
    codon = donor[i : i + 3].upper()
    choices = synonyms[code[codon]]
    other = min((c for c in choices if c != codon), key=lambda c: _differs(c, codon), default=choices[0]).lower()
    return donor[:i] + other + donor[i + 3 :], f"{site} at {at}: {other}"


def one_site_left(before: str, donor: str, after: str, sites: tuple[str, ...] = ("GAAGAGC", "GCTCTTC")) -> tuple[str | None, list[str]]:
    """The donor with its first or last base changed until the oligo has one site; None if that can't be."""
    count = lambda d: count_sites((before + d + after).upper(), sites)
    fewest = count(donor)
    if fewest == 1:
        return donor, []
    for end in (0, -1):
        old = donor[end]
        for base in "ATCG":
            new = base + donor[1:] if end == 0 else donor[:-1] + base
            if count(new) < fewest:
                donor, fewest = new, count(new)
            if fewest == 1:
                return new, [f"{end}: {old} to {base}"]
    return None, []


def assembled(edit, to_left: int, to_right: int, size: int, homology: int, synonyms: dict[str, list[str]], code: dict[str, str], sites: tuple[str, ...], extend: int = 500) -> dict:
    """The donor of an edit with synonyms beside it, or the reason why there is none. Synonyms stop at the
    ends of the ORF and at exon borders; arms share what is left, in whole codons on one side."""
    codons, coords, plus = list(edit.codons), [list(map(int, c)) for c in edit.coords], edit.strand == "+"
    first, last = int(edit.aa_nums[0]), int(edit.aa_nums[-1])
    up, down = (to_left, to_right) if plus else (to_right, to_left)
    up, down = min(up, first - 1), min(down, len(codons) - last)
    apart = lambda a, b, k: abs(coords[a - 1][k] - coords[b - 1][k]) != 3
    up = next((first - i - 1 for i in range(first - 1, first - up - 1, -1) if apart(i, i + 1, 0)), up)
    down = next((i - 1 - last for i in range(last + 1, last + down + 1) if apart(i - 1, i, 2)), down)
    arm = size - 3 * (up + down + len(edit.aa_nums))
    if arm < 2 * homology:
        return {"reason": "donor does not meet minimum homology requirement"}
    farthest = lambda i: max(synonyms[code[codons[i - 1]]], key=lambda c: _differs(c, codons[i - 1]))
    before, after = [farthest(i) for i in range(first - up, first)], [farthest(i) for i in range(last + 1, last + down + 1)]
    low = round(arm / 6) * 3
    a, b = coords[first - up - 1][0], coords[last + down - 1][2]
    at0 = edit.context_first
    g = lambda x, y: edit.context[max(x - at0, 0) : max(y - at0, 0)]
    if plus:
        left, right = g(a - low - 1, a - 1), g(b, b + arm - low)
        far = (g(a - low - 1 - extend, a - low - 1), g(b + arm - low, b + arm - low + extend))
    else:
        left, right = complement_text(g(a, a + low)), complement_text(g(b - (arm - low) - 1, b - 1))
        far = (complement_text(g(a + low, a + low + extend)), complement_text(g(b - (arm - low) - 1 - extend, b - (arm - low) - 1)))
    donor, changes = left + "".join([*before, *edit.alt_codons, *after]).lower() + right, []
    for _ in range(5):
        for site in sites:
            if site in donor.upper():
                donor, change = without_site(donor, site, synonyms, code)
                changes.append(change)
    if any(s in donor.upper() for s in sites):
        return {"reason": "donor could not be constructed due to unresolvable restriction sites"}
    return {"donor": donor, "extended": far[0] + donor + far[1], "changes": changes, "n_up": up, "up": before, "n_down": down, "down": after}


def guide_gone(guide: str, pam: str, donor: str, pam_after: bool = True) -> bool:
    """Whether the guide with its PAM is nowhere in the donor but at its last place, which isn't looked at."""
    want, seq = guide + pam if pam_after else pam + guide, donor.upper()
    n = len(want)
    return not any(fits(want, seq[i : i + n]) or fits(want, complement_text(seq[i : i + n])) for i in range(len(seq) - n))


EDITED = "key string, orf string, chrom string, strand string, guide_rank int, guide string, pam string, pam_strand string, pam_coord int, distance int, donor string, extended string, oligo string, n_up int, up string, n_down int, down string, changes string, junction string, reason string"
_EDITED = [x.split()[0] for x in EDITED.split(", ")]


def substitution_oligos(edits: DataFrame, synonyms: dict[str, list[str]], lay: Layout, subpool: int = 0, cap: int = 2, homology: int = 20, sites: tuple[str, ...] = ("GCTCTTC", "GAAGAGC"), pam_after: bool = True, code: dict[str, str] | None = None) -> DataFrame:
    """EDITED of edits (key, orf, chrom, strand, aa_nums, alt_codons, codons, coords, guides in order with
    to_left and to_right, and context): the first ``cap`` guides that work, each edit for itself; edits
    without one have a row with the reasons."""
    code, primer = code or genetic_code(), lay.reverse[subpool]
    size = lay.oligo - len(lay.forward) - lay.guide - len(lay.cloning) - len(primer)

    def design(edit) -> list[dict]:
        base = {"key": edit.key, "orf": edit.orf, "chrom": edit.chrom, "strand": edit.strand}
        coords = [list(map(int, c)) for c in edit.coords]
        a, b = coords[int(edit.aa_nums[0]) - 1][0], coords[int(edit.aa_nums[-1]) - 1][2]
        if (abs(a - b) + 1) // 3 != len(edit.aa_nums):
            return [base | {"reason": "aa codons to mutate span an intron, donor cannot be made"}]
        out, seen, reasons = [], set(), []
        for g in edit.guides if edit.guides is not None else []:
            got = assembled(edit, g["to_left"], g["to_right"], size, homology, synonyms, code, sites)
            if "reason" in got:
                reasons.append(got["reason"])
                continue
            donor, junction = one_site_left(lay.forward + g["guide"] + lay.cloning, got["donor"], primer)
            if donor is None:
                reasons.append("donor could not be assembled into oligo due to unresolvable restriction sites")
            elif not guide_gone(g["guide"], lay.pam, got["extended"], pam_after):
                reasons.append("guide not disrupted by donor")
            elif (g["guide"], donor) not in seen:
                seen.add((g["guide"], donor))
                out.append(base | {"guide_rank": g["rank"], "guide": g["guide"], "pam": g["pam"], "pam_strand": g["pam_strand"], "pam_coord": g["pam_coord"], "distance": g["distance"], "donor": donor, "extended": got["extended"], "oligo": lay.forward + g["guide"] + lay.cloning + donor + primer, "n_up": got["n_up"], "up": ",".join(got["up"]), "n_down": got["n_down"], "down": ",".join(got["down"]), "changes": ";".join(got["changes"]), "junction": ";".join(junction)})
                if len(out) == cap:
                    break
        return out or [base | {"reason": ";".join(dict.fromkeys(reasons)) or "no acceptable guides found"}]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield _frame([x for e in pdf.itertuples(index=False) for x in design(e)], _EDITED)

    return edits.mapInPandas(run, EDITED)
