"""Queries through files: a writer's file, read again by its reader, equals SQL over the tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.operators import annotate, reads
from locus.plans import projections as p
from locus.plans.queries import query
from locus.sources import sinks, text


def path_of(spark: SparkSession, name: str) -> str:
    """A new path in the folder that spark.checkpoint.dir names; where it is unset and all runs in one JVM, in
    a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="locus-files-")
    return f"{folder}/locus-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@query(" SELECT chrom, strand, pos, cast(reads AS double) AS reads FROM cov_r WHERE strand = '+'", "cov_r")
def bedgraph_file(spark: SparkSession, d: str) -> DataFrame:
    """One strand's coverage as bedgraph and back."""
    path = path_of(spark, "bedgraph")
    sinks.bedgraph(p.coverage(spark, d, "R").filter("strand = '+'"), path)
    return text.bedgraph(spark, path, "+")


@query(" SELECT * FROM genome", "genome")
def genome_file(spark, d):
    """Sequences as FASTA and back."""
    path = path_of(spark, "fasta")
    sinks.fasta(p.genome(spark, d), path, F.col("chrom"), F.col("seq"), ["chrom"])
    return text.genome(spark, path)


@query(" SELECT chrom, pos, ref, alt, concat('[(', pos, ', ''', ref, ''', ''', alt, ''')]') AS members FROM variant", "variant")
def variant_file(spark, d):
    """Variants as a table and back."""
    path = path_of(spark, "variants")
    sinks.variants(p.variants(spark, d), path)
    return text.processed_variants(spark, path).drop("ord")


@query(" SELECT chrom, pos, strand, pos + 1 AS \"end\", cast(row_number() OVER (ORDER BY chrom, pos, strand) AS integer) AS id FROM cov_r JOIN (SELECT DISTINCT chrom, strand, fstart AS pos FROM feature) USING (chrom, strand, pos)", "cov_r", "feature")
def peak_file(spark, d):
    """Positions with coverage at which a feature starts, as a table and back, numbered in its order."""
    path = path_of(spark, "peaks")
    starts = p.features(spark, d).select("chrom", "strand", F.col("fstart").alias("pos"))
    peaks = p.coverage(spark, d, "R").join(starts, ["chrom", "strand", "pos"], "left_semi")
    sinks.annotated_peaks(peaks, path)
    return text.stranded_bed(spark, path).select("chrom", "strand", F.col("start").alias("pos"), "end", "id")


@query(" SELECT seq, arg_max(qual, ord) AS qual FROM reads GROUP BY seq", "reads")
def fastq_file(spark, d):
    """Collapsed reads as FASTQ and back."""
    path = path_of(spark, "fastq")
    sinks.fastq(reads.collapsed(p.reads(spark, d)), path)
    return text.fastq(spark, path).select("seq", "qual")


@query(" SELECT n, chrom, pos, cigar FROM aln", "aln")
def alignment_file(spark, d):
    """Alignments as SAM rows and back."""
    path = path_of(spark, "sam")
    none = lambda x: F.lit(x)
    own = p.alignments(spark, d).select("n", none(0).alias("flag"), "chrom", "pos", none(60).alias("quality"), "cigar", none("=").alias("next"), none(0).alias("next_pos"), none(0).alias("size"), "seq", none("*").alias("qual"))
    sinks.table(own, path, ["chrom", "pos"], header=False)
    return text.sam(spark, path).select("n", "chrom", "pos", "cigar")


_KINDS = ("gene", "CDS", "intron", "chromosome")


def _gff(spark: SparkSession, d: str) -> DataFrame:
    """Features as a GFF file, read again: every fifth without a strand, every third with a parent in place of
    an ID, every second with a name."""
    path, fid = path_of(spark, "gff"), F.col("fid")
    who = F.concat(F.when(fid % 3 == 0, "Parent=").otherwise("ID="), F.lit("g"), (fid % 50).cast("string"), F.lit(";"))
    name = F.when(fid % 2 == 0, F.concat(F.lit("Name="), F.col("gene"), F.lit(";"))).otherwise("")
    kind = F.element_at(F.array(*map(F.lit, _KINDS)), (fid % 4 + 1).cast("int"))
    strand = F.when(fid % 5 == 0, ".").otherwise(F.col("strand"))
    dot = F.lit(".")
    own = p.features(spark, d).select("chrom", F.lit("own").alias("source"), kind.alias("type"), "fstart", "fend", dot.alias("score"), strand.alias("strand"), dot.alias("frame"), F.concat(who, name).alias("attributes"))
    sinks.table(own, path, ["fstart"], header=False)
    return text.gff(spark, path)


_GFF = """, gff AS (SELECT chrom, CASE WHEN fid % 5 = 0 THEN '.' ELSE strand END AS strand, fstart, fend, concat('g', fid % 50) AS key, CASE WHEN fid % 3 = 0 THEN NULL ELSE concat('g', fid % 50) END AS id,
CASE WHEN fid % 2 = 0 THEN gene END AS name, CASE fid % 4 WHEN 0 THEN 'gene' WHEN 1 THEN 'CDS' WHEN 2 THEN 'intron' ELSE 'chromosome' END AS kind, fid FROM feature)"""


@query(_GFF + """ SELECT chrom, unnest(CASE WHEN strand = '.' THEN ['+', '-'] ELSE [strand] END) AS strand, fstart AS astart, fend AS aend, coalesce(name, key) AS gene_name, key AS gene_id, 'own' AS region_type, kind AS sequence_type
FROM gff WHERE kind <> 'chromosome'""", "feature")
def annotations_of_gff_file(spark, d):
    """All annotations of a GFF file."""
    return annotate.annotations_from_gff(_gff(spark, d)).drop("ord")


@query(_GFF + """ SELECT chrom, CASE WHEN strand = '.' THEN '+' ELSE strand END AS strand, key AS feature_id, arg_min(fstart, fid) AS fstart, max(fend) AS fend FROM gff WHERE kind = 'gene' GROUP BY ALL""", "feature")
def features_of_gff_file(spark, d):
    """Coordinates of one type from a GFF file."""
    return annotate.features_from_gff(_gff(spark, d), "gene")


@query(_GFF + " SELECT id AS systematic, arg_max(coalesce(name, '-'), fid) AS common FROM gff WHERE kind = 'gene' AND id IS NOT NULL GROUP BY id", "feature")
def gene_names_of_gff_file(spark, d):
    """Common names of systematic ones; of one that comes again the last row counts."""
    return annotate.gene_names(_gff(spark, d)).fillna("-", ["common"])


def _gtf(spark: SparkSession, d: str) -> DataFrame:
    """Features as a GTF file, read again."""
    path, fid = path_of(spark, "gtf"), F.col("fid")
    who = F.concat(F.lit('gene_id "g'), (fid % 50).cast("string"), F.lit('";'))
    name = F.when(fid % 2 == 0, F.concat(F.lit(' gene_name "'), F.col("gene"), F.lit('";'))).otherwise("")
    source = F.when(fid % 7 == 0, "snoRNA").otherwise("protein_coding")
    kind = F.element_at(F.array(*map(F.lit, ("exon", "CDS", "start_codon", "chromosome"))), (fid % 4 + 1).cast("int"))
    strand = F.when(fid % 5 == 0, ".").otherwise(F.col("strand"))
    dot = F.lit(".")
    own = p.features(spark, d).select("chrom", source.alias("source"), kind.alias("type"), "fstart", "fend", dot.alias("score"), strand.alias("strand"), dot.alias("frame"), F.concat(who, name).alias("attributes"))
    sinks.table(own, path, ["fstart"], header=False)
    return text.gff(spark, path)


_GTF = """, gtf AS (SELECT chrom, CASE WHEN fid % 5 = 0 THEN '.' ELSE strand END AS strand, fstart, fend, concat('g', fid % 50) AS key, CASE WHEN fid % 2 = 0 THEN gene END AS name,
CASE WHEN fid % 7 = 0 THEN 'snoRNA' ELSE 'protein_coding' END AS region, CASE fid % 4 WHEN 0 THEN 'exon' WHEN 1 THEN 'CDS' WHEN 2 THEN 'start_codon' ELSE 'chromosome' END AS kind, fid FROM feature)"""


@query(_GTF + """ SELECT chrom, unnest(CASE WHEN strand = '.' THEN ['+', '-'] ELSE [strand] END) AS strand, fstart AS astart, fend AS aend, coalesce(name, key) AS gene_name, key AS gene_id, region AS region_type, kind AS sequence_type
FROM gtf WHERE kind <> 'chromosome'""", "feature")
def annotations_of_gtf_file(spark, d):
    """All annotations of a GTF file."""
    return annotate.annotations_from_gtf(_gtf(spark, d)).drop("ord")


@query(_GTF + " SELECT chrom, CASE WHEN strand = '.' THEN '+' ELSE strand END AS strand, key AS feature_id, arg_min(fstart, fid) AS fstart, max(fend) AS fend FROM gtf WHERE region = 'protein_coding' GROUP BY ALL", "feature")
def features_of_gtf_file(spark, d):
    """Coordinates of one region type from a GTF file."""
    return annotate.features_from_gtf(_gtf(spark, d), "protein_coding")


@query("""iso AS (SELECT CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, concat('chr', ['I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX', 'X', 'XI', 'XII', 'XIII', 'XIV', 'XV', 'XVI'][l_partkey % 16 + 1]) AS chrom,
concat('YA', l_partkey % 80) AS orf, l_suppkey AS t5, 1000 + l_partkey AS t3, cast(l_quantity AS bigint) AS reads FROM lineitem),
a AS (SELECT strand, chrom, orf, t5, CASE WHEN strand = '+' THEN -t5 ELSE t5 END AS step, sum(reads) AS r FROM iso GROUP BY ALL), b AS (SELECT strand, chrom, orf, t3, CASE WHEN strand = '-' THEN -t3 ELSE t3 END AS step, sum(reads) AS r FROM iso GROUP BY ALL),
c AS (SELECT *, sum(r) OVER (PARTITION BY strand, chrom, orf ORDER BY step) / sum(r) OVER (PARTITION BY strand, chrom, orf) AS share FROM a), e AS (SELECT *, sum(r) OVER (PARTITION BY strand, chrom, orf ORDER BY step) / sum(r) OVER (PARTITION BY strand, chrom, orf) AS share FROM b)
SELECT * FROM (SELECT strand, chrom, orf, cast(arg_min(t5, step) AS integer) AS five FROM c WHERE share >= 0.95 GROUP BY ALL) JOIN (SELECT strand, chrom, orf, cast(arg_min(t3, step) AS integer) AS three FROM e WHERE share >= 0.95 GROUP BY ALL) USING (strand, chrom, orf)""")
def transcript_ends_of_file(spark, d):
    """Transcript rows from a file, and the ends that hold most reads of each ORF."""
    path, key = path_of(spark, "isoforms"), F.col("l_partkey")
    strand = F.when(F.col("l_linestatus") == "O", "+").otherwise("-")
    row = F.concat_ws(" ", key % 16 + 1, strand, "l_suppkey", key + 1000, F.col("l_quantity").cast("long"), F.lit("Covering one intact ORF"), F.concat(F.lit("YA"), key % 80))
    p.read(spark, d, "lineitem").select(row.alias("value")).write.text(path)
    return annotate.transcript_ends(text.isoforms(spark, path))


@query(' SELECT chrom, strand, fend AS "start", fend + 1 AS "end" FROM feature WHERE fend - fstart > 25', "feature")
def cluster_center_file(spark, d):
    """Centres of mass of a cluster table whose last but one column is above zero."""
    path = path_of(spark, "clusters")
    own = p.features(spark, d).select("chrom", "fstart", F.concat(F.col("fend").cast("string"), F.lit(".4")).alias("centre"), "strand", (F.col("fend") - F.col("fstart") - 25).alias("value"), "fid")
    sinks.table(own, path, ["chrom", "fstart"], header=False)
    return text.cluster_centers(spark, path)


_GUIDES = """, guide AS (SELECT chrom, cast(fid % 200 AS integer) AS pam_coord, strand AS pam_strand, substring(translate(md5(cast(fid AS varchar)), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 20) AS guide, substring('AGGCGGTGGTTT', cast(fid % 4 * 3 + 1 AS integer), 3) AS pam, fid FROM feature),
good AS (SELECT chrom, pam_coord, pam_strand, arg_max(guide, fid) AS guide, arg_max(pam, fid) AS pam, true AS allowed FROM guide WHERE pam IN ('AGG', 'CGG') GROUP BY ALL), other AS (SELECT chrom, pam_coord, pam_strand, arg_max(guide, fid) AS guide, arg_max(pam, fid) AS pam, false AS allowed FROM guide WHERE pam = 'TGG' GROUP BY ALL)"""


@query(_GUIDES + " SELECT * FROM other UNION ALL SELECT * FROM good ANTI JOIN other USING (chrom, pam_coord, pam_strand)", "feature")
def guide_file(spark, d):
    """Guides with an allowed PAM from a file with a header, and those of two lists, the second's
    where both have one."""
    path, fid = path_of(spark, "guides"), F.col("fid")
    bases = F.left(F.translate(F.md5(fid.cast("string")), *p.HEX_TO_BASE), F.lit(20))
    pam = F.substring(F.lit("AGGCGGTGGTTT"), (fid % 4 * 3 + 1).cast("int"), F.lit(3))
    own = p.features(spark, d).select("chrom", (fid % 200).alias("pam_coord"), F.col("strand").alias("pam_strand"), bases.alias("guide"), pam.alias("pam"), "fid")
    sinks.table(own, path, ["fid"])
    return text.merged_guides(text.guides(spark, path, ["AGG", "CGG"]), text.guides(spark, path, ["TGG"], allowed=False))


@query("k AS (SELECT n_nationkey AS sample_number, n_name AS sample FROM nation) SELECT * FROM k WHERE sample_number NOT IN (1, 2) AND sample_number NOT BETWEEN 9 AND 21")
def samples_in_use(spark, d):
    """The key table without samples that aren't used."""
    return reads.samples_to_use(p.read(spark, d, "nation").select(F.col("n_nationkey").alias("sample_number"), F.col("n_name").alias("sample")))


@query(""", x AS (SELECT ord, seq AS r1, concat(substring(seq, cast(1 + ord % 32 AS integer)), 'ACGTTGCAACGTTGCA') AS r2 FROM reads), k AS (SELECT *, list_filter(generate_series(least(length(r1), length(r2)), 12, -1), lambda k: right(r1, k) = left(r2, k))[1] AS k FROM x)
SELECT ord, concat(r1, substring(r2, cast(k + 1 AS integer))) AS merged FROM k WHERE k IS NOT NULL UNION ALL SELECT ord, NULL FROM k WHERE k IS NULL""", "reads")
def merged_read_pairs(spark, d):
    """Pairs of reads merged at their longest exact overlap; null without one."""
    own = p.reads(spark, d)
    tail = F.substring(F.col("seq"), (F.col("ord") % 32 + 1).cast("int"), F.length("seq"))
    pairs = own.select("ord", F.col("seq").alias("r1"), F.concat(tail, F.lit("ACGTTGCAACGTTGCA")).alias("r2"))
    return reads.merged_pairs(pairs).select("ord", "merged")
