"""The driver's tables seen as genomic data, in Spark and as the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEX_TO_BASE = ("0123456789abcdef", "ACGTACGTACGTACGT")
LETTER_TO_BASE = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ACGTACGTACGTACGTACGTACGTAC")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _chrom(column):
    return F.concat(F.lit("chr"), (column % 16 + 1).cast("string"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of three samples (R, A, N): line items by supplier, part and status."""
    lines = read(spark, sf_dir, "lineitem")
    strand = F.when(F.col("l_linestatus") == "O", "+").otherwise("-")
    by = lines.groupBy(F.col("l_returnflag").alias("sample"), _chrom(F.col("l_suppkey")).alias("chrom"), strand.alias("strand"), F.col("l_partkey").cast("int").alias("pos"))
    return by.agg(F.sum("l_quantity").alias("reads"))


def coverage(spark: SparkSession, sf_dir: str, flag: str) -> DataFrame:
    return samples(spark, sf_dir).filter(F.col("sample") == flag).drop("sample")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    strand = F.when(F.col("p_partkey") % 2 == 0, "+").otherwise("-")
    key = F.col("p_partkey").cast("int")
    return part.select(_chrom(F.col("p_partkey")).alias("chrom"), strand.alias("strand"), key.alias("fstart"), (key + F.col("p_size")).alias("fend"), F.col("p_partkey").alias("fid"), F.col("p_name").alias("gene"), F.col("p_type").alias("ftype"))


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features as annotations of four lookup types."""
    kind = F.element_at(F.array(*map(F.lit, ("intron", "exon", "5UTR", "CDS"))), (F.col("fid") % 4 + 1).cast("int"))
    return features(spark, sf_dir).select("chrom", "strand", F.col("fstart").alias("astart"), F.col("fend").alias("aend"), F.col("gene").alias("gene_name"), F.col("fid").cast("string").alias("gene_id"), F.col("ftype").alias("region_type"), kind.alias("sequence_type"), F.col("fid").alias("ord"))


def types(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.element_at(F.array(*map(F.lit, ("CDS", "3UTR", "5UTR", "tRNA", "snoRNA"))), (F.col("fid") % 5 + 1).cast("int"))
    return features(spark, sf_dir).select("chrom", "strand", F.col("fstart").alias("tstart"), F.col("fend").alias("tend"), kind.alias("type"))


def dna(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = F.upper(F.regexp_replace(F.col("text"), "[^A-Za-z]", ""))
    return read(spark, sf_dir, "documents").select("doc_id", F.translate(letters, *LETTER_TO_BASE).alias("seq"))


def genome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sequence for each benchmark passage: the whole table."""
    letters = F.upper(F.regexp_replace(F.col("text"), "[^A-Za-z]", ""))
    return read(spark, sf_dir, "benchmark").select(F.concat(F.lit("seq"), F.col("item_id").cast("string")).alias("chrom"), F.translate(letters, *LETTER_TO_BASE).alias("seq"))


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    bases = F.translate(F.md5(F.col("o_orderkey").cast("string")), *HEX_TO_BASE)
    cut = lambda at, n: F.substring(bases, F.lit(at), (F.lit(1) + F.col("o_orderkey") % n).cast("int"))
    return read(spark, sf_dir, "orders").select(_chrom(F.col("o_custkey")).alias("chrom"), F.col("o_orderkey").cast("int").alias("pos"), cut(1, 4).alias("ref"), cut(9, 3).alias("alt"), F.col("o_orderkey").alias("ord"))


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    seq = F.translate(F.md5(F.col("l_partkey").cast("string")), *HEX_TO_BASE)
    return lines.select(F.col("l_returnflag").alias("sample"), seq.alias("seq"), F.concat(F.lit("q"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("qual"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ord"))


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as alignments: matches, mismatches, an insertion or a deletion."""
    lines = read(spark, sf_dir, "lineitem")
    n = F.col("l_quantity").cast("int").cast("string")
    k = F.col("l_linenumber").cast("string")
    tail = F.when(F.col("l_partkey") % 3 == 0, F.concat(k, F.lit("I"), n, F.lit("="))).when(F.col("l_partkey") % 3 == 1, F.concat(k, F.lit("D"), n, F.lit("="))).otherwise(F.concat(k, F.lit("X")))
    bases = F.repeat(F.translate(F.md5(F.col("l_partkey").cast("string")), *HEX_TO_BASE), 5)
    return lines.select(F.col("l_returnflag").alias("sample"), F.when(F.col("l_suppkey") % 10 == 0, "*").otherwise(_chrom(F.col("l_suppkey"))).alias("chrom"), (F.col("l_partkey") % 100).cast("int").alias("pos"), F.concat(n, F.lit("="), tail).alias("cigar"), bases.alias("seq"), F.col("l_linenumber").cast("long").alias("n"), F.lit(120).alias("pam"), F.lit(100).alias("donor_first"), F.lit(140).alias("donor_last"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ord"))


_CHROM = "concat('chr', cast({0} % 16 + 1 AS varchar))"
#: The projections as SQL, for WITH; sql() puts those that a query names before it.
SQL = {
    "samples": f"SELECT l_returnflag AS sample, {_CHROM.format('l_suppkey')} AS chrom, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, cast(l_partkey AS integer) AS pos, sum(l_quantity) AS reads FROM lineitem GROUP BY ALL",
    "cov_r": "SELECT chrom, strand, pos, reads FROM samples WHERE sample = 'R'",
    "cov_a": "SELECT chrom, strand, pos, reads FROM samples WHERE sample = 'A'",
    "cov_n": "SELECT chrom, strand, pos, reads FROM samples WHERE sample = 'N'",
    "feature": f"SELECT {_CHROM.format('p_partkey')} AS chrom, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand, cast(p_partkey AS integer) AS fstart, cast(p_partkey + p_size AS integer) AS fend, p_partkey AS fid, p_name AS gene, p_type AS ftype FROM part",
    "annotation": "SELECT chrom, strand, fstart AS astart, fend AS aend, gene AS gene_name, cast(fid AS varchar) AS gene_id, ftype AS region_type, CASE fid % 4 WHEN 0 THEN 'intron' WHEN 1 THEN 'exon' WHEN 2 THEN '5UTR' ELSE 'CDS' END AS sequence_type, fid AS ord FROM feature",
    "atype": "SELECT chrom, strand, fstart AS tstart, fend AS tend, CASE fid % 5 WHEN 0 THEN 'CDS' WHEN 1 THEN '3UTR' WHEN 2 THEN '5UTR' WHEN 3 THEN 'tRNA' ELSE 'snoRNA' END AS type FROM feature",
    "dna": f"SELECT doc_id, translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), '{LETTER_TO_BASE[0]}', '{LETTER_TO_BASE[1]}') AS seq FROM documents",
    "genome": f"SELECT concat('seq', cast(item_id AS varchar)) AS chrom, translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), '{LETTER_TO_BASE[0]}', '{LETTER_TO_BASE[1]}') AS seq FROM benchmark",
    "vhex": f"SELECT o_custkey, o_orderkey, translate(md5(cast(o_orderkey AS varchar)), '{HEX_TO_BASE[0]}', '{HEX_TO_BASE[1]}') AS hex FROM orders",
    "variant": f"SELECT {_CHROM.format('o_custkey')} AS chrom, cast(o_orderkey AS integer) AS pos, substring(hex, 1, cast(1 + o_orderkey % 4 AS integer)) AS ref, substring(hex, 9, cast(1 + o_orderkey % 3 AS integer)) AS alt, o_orderkey AS ord FROM vhex",
    "reads": f"SELECT l_returnflag AS sample, translate(md5(cast(l_partkey AS varchar)), '{HEX_TO_BASE[0]}', '{HEX_TO_BASE[1]}') AS seq, concat('q', l_orderkey, '-', l_linenumber) AS qual, l_orderkey * 8 + l_linenumber AS ord FROM lineitem",
    "aln": f"SELECT l_returnflag AS sample, CASE WHEN l_suppkey % 10 = 0 THEN '*' ELSE {_CHROM.format('l_suppkey')} END AS chrom, cast(l_partkey % 100 AS integer) AS pos, cast(l_linenumber AS bigint) AS n, concat(cast(l_quantity AS integer), '=', CASE l_partkey % 3 WHEN 0 THEN concat(l_linenumber, 'I', cast(l_quantity AS integer), '=') WHEN 1 THEN concat(l_linenumber, 'D', cast(l_quantity AS integer), '=') ELSE concat(l_linenumber, 'X') END) AS cigar, l_orderkey * 8 + l_linenumber AS ord FROM lineitem",
}
_NEEDS = {"cov_r": ["samples"], "cov_a": ["samples"], "cov_n": ["samples"], "annotation": ["feature"], "atype": ["feature"], "variant": ["vhex"]}


def sql(text: str, *names: str) -> str:
    """text with the projections of these names before it; its own WITH parts go in as more names."""
    order: list[str] = []
    for n in names:
        order += [x for x in (*_NEEDS.get(n, []), n) if x not in order]
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({SQL[n]})" for n in order) + text
