"""Open reading frames: codons over exons, amino acids, exon numbers, synonymous codons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locus.functions.sequence import floor_div, hamming, reverse_complement

#: The standard genetic code, amino acids of codons in the order of bases TCAG.
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
BASES = "TCAG"
STOPS = ("TAA", "TAG", "TGA")


def genetic_code() -> dict[str, str]:
    return {a + b + c: AMINO_ACIDS[16 * i + 4 * j + k] for i, a in enumerate(BASES) for j, b in enumerate(BASES) for k, c in enumerate(BASES)}


def codon_table(spark: SparkSession, code: dict[str, str] | None = None, fractions: dict[str, float] | None = None) -> DataFrame:
    """codon, aa, fraction (of the amino acid's codons; null where unknown) and ord."""
    code = code or genetic_code()
    rows = [(c, a, (fractions or {}).get(c), i) for i, (c, a) in enumerate(code.items())]
    return spark.createDataFrame(rows, "codon string, aa string, fraction double, ord int")


def translated(seq: Column, code: dict[str, str] | None = None) -> Column:
    """The protein of a sequence: whole codons from its first base; ? for those that the code lacks."""
    table = F.create_map(*[F.lit(x) for kv in (code or genetic_code()).items() for x in kv])
    n = F.floor(F.length(seq) / 3).cast("int")
    aa = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.coalesce(F.try_element_at(table, F.upper(F.substring(seq, i * 3 + 1, F.lit(3)))), F.lit("?")))
    return F.when(n > 0, F.array_join(aa, "")).otherwise("")


def top_codons(codons: DataFrame) -> DataFrame:
    """The most frequent codon of each amino acid, the first of equals."""
    first = Window.partitionBy("aa").orderBy(F.desc("fraction"), "ord")
    return codons.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n")


def synonyms_after(codons: DataFrame) -> DataFrame:
    """For each codon its synonyms in the order that begins after it and goes round; itself if it has none."""
    by = Window.partitionBy("aa").orderBy(F.desc("fraction"), "ord")
    ranked = codons.withColumn("i", F.row_number().over(by) - 1)
    lists = ranked.groupBy("aa").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "codon"))), lambda x: x["codon"]).alias("all"))
    n, i = F.size("all"), F.col("i")
    rest = F.concat(F.slice("all", i + 2, F.greatest(n - i - 1, F.lit(0))), F.slice("all", F.lit(1), i))
    return ranked.join(lists, "aa").select("codon", "aa", F.when(n > 1, rest).otherwise(F.col("all")).alias("synonyms"))


def farthest(codon: Column, choices: Column) -> Column:
    """The choice that differs most, the first of equals."""
    best = F.array_max(F.transform(choices, lambda c, i: F.struct(hamming(codon, c).alias("d"), (-i).alias("o"), c.alias("c"))))
    return best["c"]


def nearest_other(codon: Column, choices: Column) -> Column:
    """The choice that differs least but does, the first of equals; the first if none does."""
    scored = F.filter(F.transform(choices, lambda c, i: F.struct(hamming(codon, c).alias("d"), i.alias("o"), c.alias("c"))), lambda x: x["d"] > 0)
    return F.coalesce(F.array_min(scored)["c"], F.get(choices, F.lit(0)))


def orf_bases(cds: DataFrame, genome: DataFrame, one_based: bool = False) -> DataFrame:
    """Each base of each ORF in reading order: orf, chrom, strand, i (from 0), base and coord. Exons (orf,
    chrom, start, end, strand, exon_ord) are read in their order, on the minus strand in reverse. Places are
    from 0 on the plus strand and from 1 on the minus strand, or from 1 on both."""
    plus = F.col("strand") == "+"
    parts = cds.join(genome.select("chrom", "seq"), "chrom").withColumn("__s", F.substring("seq", F.col("start"), F.col("end") - F.col("start") + 1)).drop("seq")
    parts = parts.withColumns({"__s": F.when(plus, F.col("__s")).otherwise(reverse_complement("__s")), "__o": F.when(plus, F.col("exon_ord")).otherwise(-F.col("exon_ord"))})
    before = F.coalesce(F.sum(F.length("__s")).over(Window.partitionBy("orf").orderBy("__o").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spots = parts.withColumn("__before", before).select("orf", "chrom", "strand", "start", "end", "__before", F.posexplode(F.split("__s", "")).alias("__k", "base")).filter("base <> ''")
    coord = F.when(F.col("strand") == "+", F.col("start") + F.col("__k") - (0 if one_based else 1)).otherwise(F.col("end") - F.col("__k"))
    return spots.select("orf", "chrom", "strand", (F.col("__before") + F.col("__k")).cast("int").alias("i"), "base", coord.cast("int").alias("coord"))


def codons_of(cds: DataFrame, genome: DataFrame, code: dict[str, str] | None = None, one_based: bool = False, whole: bool = False) -> DataFrame:
    """orf, chrom, strand, aa_num, codon, coords, aa, exons and partial, for each codon, also those that
    exons cut in two. ``whole`` leaves out a last codon of fewer than three bases."""
    table = F.create_map(*[F.lit(x) for kv in (code or genetic_code()).items() for x in kv])
    by = orf_bases(cds, genome, one_based).groupBy("orf", "chrom", "strand", (F.floor(F.col("i") / 3) + 1).cast("int").alias("aa_num"))
    got = by.agg(F.array_sort(F.collect_list(F.struct("i", "base", "coord"))).alias("x"))
    out = got.select("orf", "chrom", "strand", "aa_num", F.upper(F.array_join(F.transform("x", lambda x: x["base"]), "")).alias("codon"), F.transform("x", lambda x: x["coord"]).alias("coords"))
    out = out.withColumns({"aa": F.try_element_at(table, F.col("codon")), "partial": F.length("codon") < 3})
    return with_exons(out.filter("NOT partial") if whole else out)


def with_exons(codons: DataFrame) -> DataFrame:
    """codons with exons: the number of their exon, both for one that is cut in two."""
    along = Window.partitionBy("orf").orderBy("aa_num")
    last = F.element_at("coords", -1)
    jump = F.coalesce((F.abs(F.get("coords", F.lit(0)) - F.lag(last).over(along)) != 1).cast("int"), F.lit(0))
    cut = (F.abs(last - F.get("coords", F.lit(0))) != F.size("coords") - 1).cast("int")
    steps = codons.withColumns({"__j": jump, "__c": cut})
    first = F.lit(1) + F.sum("__j").over(along) + F.sum("__c").over(along) - F.col("__c")
    steps = steps.withColumn("__e", first.cast("int"))
    return steps.withColumn("exons", F.when(F.col("__c") == 1, F.array("__e", F.col("__e") + 1)).otherwise(F.array("__e"))).drop("__j", "__c", "__e")


def stop_counts(codons: DataFrame) -> DataFrame:
    """n_stops of each ORF; other than one is a warning."""
    return codons.groupBy("orf").agg(F.sum(F.col("codon").isin(list(STOPS)).cast("int")).alias("n_stops"))


def synonymous_changes(left: Column, right: Column, pam: Column, strand: Column, cas12a: bool = False) -> Column:
    """to_left and to_right: how many codons beside an edit (from left to right) change, by where the guide
    lies. On the minus strand places are mirrored, so that one rule does for both."""
    sign = F.when(strand == "+", 1).otherwise(-1)
    # mirrored places: near is the side from which the guide comes on the plus strand
    near, far = F.when(strand == "+", left).otherwise(right) * sign, F.when(strand == "+", right).otherwise(left) * sign
    p = pam * sign
    steps = lambda x, more=1: floor_div(x, 3) + more
    up = lambda x: F.greatest(x, F.lit(0))
    if cas12a:
        start, mid, end = p + 4, p + 14, p + 24
        low = F.when(near >= end, steps(near - mid)).when(near >= mid, steps(near - start)).when(far <= start, 0).otherwise(up(steps(near - start, 2)))
        high = F.when((near >= end) | (near >= mid), 0).when(far <= start, steps(start - far, 2)).otherwise(up(steps(mid - far)))
        return F.struct(F.when(strand == "+", low).otherwise(high).cast("int").alias("to_left"), F.when(strand == "+", high).otherwise(low).cast("int").alias("to_right"))
    start, mid, cut = p - 20, p - 10, p - 3
    low = F.when((far <= start) | (far <= mid), 0).when(near >= p, steps(near - cut)).otherwise(up(steps(near - mid)))
    high = F.when(far <= start, steps(mid - far)).when(far <= mid, steps(cut - far)).when(near >= p, 0).otherwise(up(steps(p - far)))
    return F.struct(F.when(strand == "+", low).otherwise(high).cast("int").alias("to_left"), F.when(strand == "+", high).otherwise(low).cast("int").alias("to_right"))
