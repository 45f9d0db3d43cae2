"""Readers of genomic text files, by Spark's own readers, so that any store works.

``ord`` keeps the order of lines where the last (or first) of several counts, or where records span lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locus.functions.sequence import NUMERALS, mito, numeral, reverse_complement, substr0


def lines(spark: SparkSession, path) -> DataFrame:
    """line and ord of files whose order matters. Files are split over tasks; a line's number is its place in
    its split and the number of lines in the splits before, which are counted first. Files follow each other
    in the order of their names, a multiple of 2^40 apart. Empty lines go, but count."""
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"), F.monotonically_increasing_id().alias("__id"))
    splits = rows.groupBy("__file", "__start").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__file").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1))
    files = splits.select("__file").distinct().withColumn("__f", F.dense_rank().over(Window.orderBy("__file")) - 1)
    places = splits.withColumn("__before", F.coalesce(before, F.lit(0))).join(files, "__file")
    ord_ = F.col("__f") * F.lit(1 << 40) + F.col("__before") + F.col("__id") - F.col("__first")
    return rows.join(places, ["__file", "__start"]).select(F.rtrim(F.col("value"), F.lit("\r")).alias("line"), ord_.alias("ord")).filter(F.length("line") > 0)


def _fields(rows: DataFrame, pattern: str = "\t") -> DataFrame:
    return rows.withColumn("f", F.split(F.trim("line") if pattern != "\t" else F.col("line"), pattern))


def _at(i: int) -> Column:
    return F.get("f", F.lit(i))


def genome(spark: SparkSession, path, stop_at_mito: bool = False, upper: bool = True) -> DataFrame:
    """chrom and seq of FASTA records. ``stop_at_mito``: reading ends at the first line, of whatever kind,
    that holds an m or M, and case stays as it is."""
    rows = lines(spark, path)
    if stop_at_mito:
        first = rows.filter(F.col("line").rlike("[mM]")).agg(F.min("ord").alias("__stop"))
        rows = rows.crossJoin(F.broadcast(first)).filter(F.col("__stop").isNull() | (F.col("ord") < F.col("__stop"))).drop("__stop")
    head = F.when(F.col("line").startswith(">"), F.trim(F.substring("line", 2, 1 << 20)))
    named = rows.withColumn("chrom", F.last(head, ignorenulls=True).over(Window.orderBy("ord"))).filter(~F.col("line").startswith(">"))
    seq = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", F.trim("line").alias("s")))), lambda x: x["s"]), "")
    return named.groupBy("chrom").agg((F.upper(seq) if upper and not stop_at_mito else seq).alias("seq"))


def bedgraph(spark: SparkSession, path, strand: str = "+", chroms: list[str] | None = None, include_mito: bool = False) -> DataFrame:
    """Coverage from chrom, start, end, (id,) reads: a row for each base, of a base listed again the last.
    The mitochondrial chromosome is called chrMito."""
    f = _fields(lines(spark, path))
    own = f.filter(F.size("f").between(4, 5)).select(_at(0).alias("chrom"), _at(1).cast("int").alias("s"), _at(2).cast("int").alias("e"), F.element_at("f", -1).cast("double").alias("reads"), "ord")
    own = own if include_mito else own.filter(~mito("chrom", "either"))
    own = own.withColumn("chrom", F.when(F.col("chrom") == "Mito", "chrMito").otherwise(F.col("chrom")))
    own = own.filter(F.col("chrom").isin(chroms)) if chroms else own
    spots = own.filter("e > s").withColumn("pos", F.explode(F.sequence("s", F.col("e") - 1)))
    return spots.groupBy("chrom", F.lit(strand).alias("strand"), "pos").agg(F.max_by("reads", F.struct("ord", "s")).alias("reads"))


def motifs(spark: SparkSession, path) -> DataFrame:
    """chrom, mstart, mend, strand, match and mismatches (as written)."""
    f = _fields(lines(spark, path), r"\s+")
    return f.select(_at(0).alias("chrom"), _at(1).cast("int").alias("mstart"), _at(2).cast("int").alias("mend"), _at(3).alias("strand"), _at(4).alias("match"), _at(5).alias("mismatches"))


def stranded_bed(spark: SparkSession, path, exclude: DataFrame | None = None) -> DataFrame:
    """chrom, start, end, strand and a number of each row whose start isn't excluded (strand, chrom, pos)."""
    f = _fields(lines(spark, path)).select(_at(0).alias("chrom"), _at(1).cast("int").alias("start"), _at(2).cast("int").alias("end"), _at(3).alias("strand"), "ord")
    if exclude is not None:
        f = f.join(exclude.select("chrom", "strand", F.col("pos").alias("start")), ["chrom", "strand", "start"], "left_anti")
    return f.withColumn("id", F.row_number().over(Window.orderBy("ord")))


def cluster_centers(spark: SparkSession, path, exclude: DataFrame | None = None) -> DataFrame:
    """Centres of mass of a cluster table as spans of one base; clusters whose last but one column isn't above
    zero, and excluded ones, go."""
    f = _fields(lines(spark, path)).filter(F.element_at("f", -2).try_cast("double") > 0)
    own = f.select(_at(0).alias("chrom"), _at(3).alias("strand"), _at(2).cast("double").cast("int").alias("start"), "ord")
    if exclude is not None:
        own = own.join(exclude.select("chrom", "strand", F.col("pos").alias("start")), ["chrom", "strand", "start"], "left_anti")
    return own.select("chrom", "strand", "start", (F.col("start") + 1).alias("end"))


def gff(spark: SparkSession, path) -> DataFrame:
    """chrom, source, type, start, end, strand, frame, attributes and ord of GFF or GTF rows; comments go."""
    f = _fields(lines(spark, path).filter(~F.col("line").startswith("#"))).filter(F.size("f") == 9)
    return f.select(_at(0).alias("chrom"), _at(1).alias("source"), _at(2).alias("type"), _at(3).try_cast("int").alias("start"), _at(4).try_cast("int").alias("end"), _at(6).alias("strand"), _at(7).alias("frame"), _at(8).alias("attributes"), "ord").filter("start IS NOT NULL AND end IS NOT NULL")


def cds(rows: DataFrame) -> DataFrame:
    """Exons of coding sequences in the order of the file: orf is the name without its last four characters."""
    name = F.regexp_extract("attributes", "Name=([^;]*)", 1)
    own = rows.filter("type = 'CDS' AND chrom <> 'chrmt'").filter(F.length(name) > 4)
    return own.select(F.left(name, F.length(name) - 4).alias("orf"), "chrom", "start", "end", "strand", F.col("ord").alias("exon_ord"))


def variant_calls(spark: SparkSession, path) -> DataFrame:
    """chrom (in numerals), pos, ref, alt and ord of the first fields of each row; # is a comment."""
    f = _fields(lines(spark, path).filter(~F.col("line").startswith("#")), r"\s+")
    name = F.coalesce(numeral(_at(0), mito=True), numeral(F.concat(F.lit("chr"), _at(0)), mito=True), _at(0))
    return f.select(name.alias("chrom"), _at(1).cast("int").alias("pos"), _at(2).alias("ref"), _at(3).alias("alt"), "ord")


def processed_variants(spark: SparkSession, path) -> DataFrame:
    f = _fields(lines(spark, path)).filter(_at(1).try_cast("int").isNotNull())
    return f.select(_at(0).alias("chrom"), _at(1).cast("int").alias("pos"), _at(2).alias("ref"), _at(3).alias("alt"), _at(4).alias("members"), "ord")


def guide_scores(spark: SparkSession, path) -> DataFrame:
    """pcid, chrom, strand, pos, oseq, aseq, azimuth and mismatch counts m0 to m5; a row with NA gets 20 for
    each count; of a sequence (aseq) that comes again the last row counts."""
    f = _fields(lines(spark, path), r"\s+").filter("ord > 0 AND size(f) >= 10")
    na = F.contains(F.col("line"), F.lit("NA"))
    part = F.split(_at(0), "_")
    counts = [F.when(na, 20).otherwise(_at(4 + i).try_cast("int")).alias(f"m{i}") for i in range(6)]
    rows = f.select(_at(0).alias("pcid"), F.coalesce(numeral(F.get(part, F.lit(0))), F.get(part, F.lit(0))).alias("chrom"), F.get(part, F.lit(1)).alias("strand"), F.get(part, F.lit(2)).try_cast("int").alias("pos"), _at(1).alias("oseq"), _at(2).alias("aseq"), _at(3).try_cast("double").alias("azimuth"), *counts, "ord")
    return rows.groupBy("aseq").agg(F.max_by(F.struct(*[c for c in rows.columns if c not in ("aseq", "ord")]), "ord").alias("x")).select("aseq", "x.*")


def guides(spark: SparkSession, path, pams: list[str], allowed: bool = True) -> DataFrame:
    """Processed guides with an allowed PAM; the header is skipped."""
    f = _fields(lines(spark, path), r"\s+").filter(_at(1).try_cast("int").isNotNull())
    own = f.select(_at(0).alias("chrom"), _at(1).cast("int").alias("pam_coord"), _at(2).alias("pam_strand"), _at(3).alias("guide"), _at(4).alias("pam"), "ord").filter(F.col("pam").isin(pams))
    key = ("chrom", "pam_coord", "pam_strand")
    return own.groupBy(*key).agg(F.max_by(F.struct("guide", "pam"), "ord").alias("x")).select(*key, "x.guide", "x.pam", F.lit(allowed).alias("allowed"))


def merged_guides(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both, the second where a guide is in both."""
    return second.unionByName(first.join(second, ["chrom", "pam_coord", "pam_strand"], "left_anti"))


def circular_guides(records: DataFrame, pams: list[str], length: int = 20, pam_after: bool = True, extra: int = 200, edge: int = 30) -> DataFrame:
    """Distinct guides beside a PAM on either strand of records (chrom, seq) taken as one circular sequence."""
    whole = records.agg(F.upper(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chrom", "seq"))), lambda x: x["seq"]), "")).alias("s"))
    seq = whole.select(F.concat("s", F.left("s", F.lit(extra))).alias("s"))
    spots = seq.filter(F.length("s") > 2 * edge).withColumn("i", F.explode(F.sequence(F.lit(edge), F.length("s") - edge - 1)))
    n = len(pams[0])
    i = F.col("i")
    after, before = substr0("s", i, i + n), substr0("s", i - length, i)
    plus = (after, before) if pam_after else (substr0("s", i - n, i), substr0("s", i, i + length))
    minus = (reverse_complement(substr0("s", i - n, i)), reverse_complement(substr0("s", i, i + length))) if pam_after else (reverse_complement(after), reverse_complement(before))
    both = F.array(*[F.struct(p.alias("pam"), g.alias("guide")) for p, g in (plus, minus)])
    return spots.select(F.explode(both).alias("x")).select("x.guide", "x.pam").filter(F.col("pam").isin(pams) & (F.length("guide") == length)).select("guide").distinct()


def codon_table(spark: SparkSession, path) -> DataFrame:
    f = _fields(lines(spark, path), r"\s+")
    return f.select(F.upper(_at(0)).alias("codon"), _at(1).alias("aa"), F.lit(None).cast("double").alias("fraction"), "ord")


def codon_frequencies(spark: SparkSession, path) -> DataFrame:
    """aa, codon, occurrences, frequency and fraction, one row a line."""
    f = _fields(lines(spark, path), r"\s+").filter(_at(4).try_cast("double").isNotNull())
    return f.select(F.upper(_at(1)).alias("codon"), _at(0).alias("aa"), _at(4).cast("double").alias("fraction"), "ord")


def substitutions(spark: SparkSession, path) -> DataFrame:
    """orf, gene, aa_nums, ref_aas, alt_aas, ref_codons and alt_codons of rows of 3 (L12A,K13A), 5, 7 or 11
    fields; codons are null where they aren't given, and rows of other sizes have an error."""
    f = _fields(lines(spark, path))
    n = F.size("f")
    listed = lambda i: F.split(_at(i), ",")
    short = n == 3
    nums = F.when(short, F.transform(listed(2), lambda x: F.regexp_extract(x, r"^.(\d+).$", 1).try_cast("int"))).otherwise(F.transform(listed(2), lambda x: x.try_cast("int")))
    ref = F.when(short, F.transform(listed(2), lambda x: F.left(x, F.lit(1)))).otherwise(listed(3))
    alt = F.when(short, F.transform(listed(2), lambda x: F.right(x, F.lit(1)))).otherwise(listed(4))
    codons = lambda i: F.when(n.isin(7, 11), listed(i))
    return f.select(_at(0).alias("orf"), _at(1).alias("gene"), nums.alias("aa_nums"), ref.alias("ref_aas"), alt.alias("alt_aas"), codons(5).alias("ref_codons"), codons(6).alias("alt_codons"), F.when(~n.isin(3, 5, 7, 11), F.concat(F.lit("fields: "), n.cast("string"))).alias("error"), "ord")


def fastq(spark: SparkSession, path, sample: str = "") -> DataFrame:
    """seq, qual and ord of records of four lines."""
    rows = lines(spark, path).withColumns({"__r": F.floor(F.col("ord") / 4), "__k": F.col("ord") % 4})
    own = rows.groupBy("__r").agg(F.max(F.when(F.col("__k") == 1, F.col("line"))).alias("seq"), F.max(F.when(F.col("__k") == 3, F.col("line"))).alias("qual"))
    return own.filter("seq IS NOT NULL").select(F.lit(sample).alias("sample"), "seq", "qual", F.col("__r").alias("ord"))


def sam(spark: SparkSession, path, sample: str = "") -> DataFrame:
    """n (the read's name is its count), chrom, pos, cigar, seq and ord; header lines go."""
    f = _fields(lines(spark, path).filter(~F.col("line").startswith("@"))).filter(F.size("f") >= 11)
    return f.select(F.lit(sample).alias("sample"), _at(0).cast("long").alias("n"), _at(2).alias("chrom"), _at(3).cast("int").alias("pos"), _at(5).alias("cigar"), _at(9).alias("seq"), "ord")


def isoforms(spark: SparkSession, path) -> DataFrame:
    """chrom, strand, t5, t3, reads and orf of transcript rows that cover one whole ORF, whose name is what
    begins with the first Y."""
    rows = lines(spark, path).filter(F.contains(F.col("line"), F.lit("Covering one intact ORF")))
    f = _fields(rows, " ")
    return f.select(numeral(F.concat(F.lit("chr"), _at(0))).alias("chrom"), _at(1).alias("strand"), _at(2).cast("int").alias("t5"), _at(3).cast("int").alias("t3"), _at(4).cast("long").alias("reads"), F.regexp_extract("line", "(Y.*)$", 1).alias("orf"))


def primers(spark: SparkSession, path) -> DataFrame:
    """Reverse complements of the sequences of a file, in its order."""
    return lines(spark, path).select(reverse_complement(F.trim("line")).alias("primer"), "ord")


def key_table(spark: SparkSession, path) -> DataFrame:
    """A plate, well or plasmid table: CSV with a header."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def chromosomes(spark: SparkSession) -> DataFrame:
    """The sixteen nuclear chromosomes and both strands, for groups that must show when empty."""
    return spark.range(32).select(F.element_at(F.array(*[F.lit(f"chr{n}") for n in NUMERALS]), (F.floor(F.col("id") / 2) + 1).cast("int")).alias("chrom"), F.when(F.col("id") % 2 == 0, "+").otherwise("-").alias("strand"))
