"""The graded queries, by name, and the SQL that they equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.functions import alignment as al
from locus.functions import sequence as sq
from locus.operators import annotate, clusters, coverage, donors, guides, metagene, motifs, orfs, reads, variants
from locus.operators.intervals import KEYS, overlaps
from locus.plans import projections as p

QUERIES: dict = {}
SQL: dict[str, str] = {}

PRIORITIES = ["CDS", "3UTR", "5UTR", "tRNA", "snoRNA", "intergenic"]


def query(sql: str | None = None, *names: str):
    """Registers a function (spark, sf_dir) under its name, with its SQL over the projections named."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = p.sql(sql, *names)
        return f

    return add


_ISLANDS = """,
g AS (SELECT *, CASE WHEN pos - lag(pos) OVER w <= 3 THEN 0 ELSE 1 END AS n FROM cov_r WINDOW w AS (PARTITION BY chrom, strand ORDER BY pos)),
i AS (SELECT *, sum(n) OVER (PARTITION BY chrom, strand ORDER BY pos) AS island FROM g),
c AS (SELECT chrom, strand, min(pos) AS cstart, CASE WHEN count(*) = 1 THEN min(pos) + 1 ELSE max(pos) END AS cend, count(*) AS n_sites, sum(reads) AS total_reads,
      arg_max(pos, reads * 1000000 - pos) AS peak_pos, max(reads) AS peak_reads FROM i GROUP BY chrom, strand, island)
"""


@query(_ISLANDS + "SELECT * FROM c", "cov_r")
def islands(spark: SparkSession, d: str) -> DataFrame:
    """Runs of positions with gaps of at most three."""
    return clusters.islands(p.coverage(spark, d, "R"), 3)


@query(_ISLANDS + "SELECT c.*, count(f.fid) AS n_features, min(f.fid) AS first_feature FROM c LEFT JOIN feature f ON f.chrom = c.chrom AND f.strand = c.strand AND f.fstart <= c.cend AND c.cstart <= f.fend GROUP BY ALL", "cov_r", "feature")
def annotated_islands(spark, d):
    """Flagship: clusters with their peaks and the features that they meet."""
    c = clusters.islands(p.coverage(spark, d, "R"), 3)
    f = p.features(spark, d).select(*KEYS, "fstart", "fend", "fid")
    hits = overlaps(c.select(*KEYS, "cstart", "cend"), f, "cstart", "cend", "fstart", "fend").groupBy(*KEYS, "cstart", "cend").agg(F.count("fid").alias("n_features"), F.min("fid").alias("first_feature"))
    return c.join(hits, [*KEYS, "cstart", "cend"], "left").fillna(0, ["n_features"])


_TOTALS = ", t AS (SELECT (SELECT sum(reads) FROM cov_r) AS q, (SELECT sum(reads) FROM cov_a) AS r)"
_CLASSES = _TOTALS + """, s AS (SELECT c.chrom, c.strand, c.pos, c.reads, c.reads * (t.q / t.r) AS scaled, coalesce(a.reads, 0.01) AS ref FROM cov_r c CROSS JOIN t LEFT JOIN cov_a a USING (chrom, strand, pos)),
k AS (SELECT chrom, strand, pos, reads, round(scaled / ref, 6) AS fold, CASE WHEN scaled / ref >= 2 THEN 'up' WHEN scaled / ref <= 1 THEN 'not_up' ELSE 'neither' END AS class FROM s WHERE scaled >= 5)
"""


def _classes(spark, d):
    return coverage.classified(p.coverage(spark, d, "R"), p.coverage(spark, d, "A"), 2, 5)


@query(_CLASSES + "SELECT chrom, strand, pos, reads, fold FROM k WHERE class = 'up'", "cov_r", "cov_a")
def upregulated_point(spark, d):
    return coverage.upregulated(p.coverage(spark, d, "R"), p.coverage(spark, d, "A"), 2, 5).withColumn("fold", F.round("fold", 6))


@query(_CLASSES + "SELECT * FROM k", "cov_r", "cov_a")
def up_not_up_classes(spark, d):
    return _classes(spark, d).withColumn("fold", F.round("fold", 6))


@query(_TOTALS + """, b AS (SELECT chrom, strand, pos, reads AS q, NULL::DOUBLE AS r FROM cov_r UNION ALL SELECT chrom, strand, pos, NULL::DOUBLE, reads FROM cov_a),
w AS (SELECT *, coalesce(sum(q) OVER x, 0) AS qs, coalesce(sum(r) OVER x, 0) AS rs FROM b WINDOW x AS (PARTITION BY chrom, strand ORDER BY pos RANGE BETWEEN 10 PRECEDING AND 9 FOLLOWING))
SELECT chrom, strand, pos, w.q AS reads, round(qs * (t.r / t.q) / greatest(rs, 0.01), 6) AS fold FROM w CROSS JOIN t WHERE w.q >= 5 AND qs * (t.r / t.q) / greatest(rs, 0.01) >= 1.5""", "cov_r", "cov_a")
def upregulated_window(spark, d):
    return coverage.upregulated_in_window(p.coverage(spark, d, "R"), p.coverage(spark, d, "A"), 10, 1.5, 5).withColumn("fold", F.round("fold", 6))


@query(" SELECT * FROM cov_r SEMI JOIN cov_a USING (chrom, strand, pos)", "cov_r", "cov_a")
def intersect_exact(spark, d):
    return coverage.intersect(p.coverage(spark, d, "R"), p.coverage(spark, d, "A"), 5)


@query(" SELECT c.* FROM cov_r c WHERE EXISTS (SELECT 1 FROM cov_a a WHERE a.chrom = c.chrom AND a.strand = c.strand AND a.pos BETWEEN c.pos - 5 AND c.pos + 5)", "cov_r", "cov_a")
def intersect_buffered(spark, d):
    return coverage.intersect(p.coverage(spark, d, "R"), p.coverage(spark, d, "A"), 5, fixed=True)


@query(" SELECT sum(reads) AS total_reads FROM cov_r", "cov_r")
def total_reads(spark, d):
    return coverage.total(p.coverage(spark, d, "R"))


_IN = "c.chrom = f.chrom AND c.strand = f.strand AND c.pos >= f.fstart AND c.pos < f.fend"


@query(f" SELECT f.fid, coalesce(sum(c.reads), 0) AS reads FROM feature f LEFT JOIN cov_r c ON {_IN} GROUP BY f.fid", "feature", "cov_r")
def feature_expression(spark, d):
    return coverage.expression(p.features(spark, d), p.coverage(spark, d, "R")).select("fid", "reads")


@query(f" SELECT f.fid, x.pos - f.fstart AS i, coalesce(c.reads, 0) AS value FROM feature f, unnest(generate_series(f.fstart, f.fend - 1)) AS x(pos) LEFT JOIN cov_r c ON c.chrom = f.chrom AND c.strand = f.strand AND c.pos = x.pos", "feature", "cov_r")
def expression_vector(spark, d):
    return coverage.expression_vector(p.features(spark, d), p.coverage(spark, d, "R"), "fid").select("fid", F.posexplode("values").alias("i", "value")).withColumn("i", F.col("i").cast("long"))


@query(f" SELECT f.fid, arg_max(c.pos, c.reads * 1000000 - c.pos) AS peak_pos, max(c.reads) AS peak_reads FROM feature f LEFT JOIN cov_r c ON {_IN} AND c.reads > 0 GROUP BY f.fid", "feature", "cov_r")
def peak_argmax(spark, d):
    return coverage.peak(p.features(spark, d), p.coverage(spark, d, "R"), "fid").select("fid", "peak_pos", "peak_reads")


@query(" SELECT chrom, strand, pos, CASE WHEN coalesce(a.reads, 0) = 0 OR c.reads / a.reads >= 2 THEN c.reads ELSE 0 END AS value FROM cov_r c LEFT JOIN cov_a a USING (chrom, strand, pos)", "cov_r", "cov_a")
def upregulated_vector(spark, d):
    q, r = p.coverage(spark, d, "R").withColumnRenamed("reads", "q"), p.coverage(spark, d, "A").withColumnRenamed("reads", "r")
    return coverage.upregulated_values(q.join(r, ["chrom", "strand", "pos"], "left").fillna(0.0, ["r"]), 2).select("chrom", "strand", "pos", "value")


@query(f" SELECT f.fid, round(coalesce(sum(c.reads * c.pos) / sum(c.reads), 0), 6) AS center_of_mass FROM feature f LEFT JOIN cov_r c ON {_IN} GROUP BY f.fid", "feature", "cov_r")
def center_of_mass(spark, d):
    return coverage.center_of_mass(p.features(spark, d), p.coverage(spark, d, "R"), "fid").select("fid", F.round("center_of_mass", 6).alias("center_of_mass"))


@query(f", q AS (SELECT f.fid, coalesce(sum(c.reads), 0) AS q FROM feature f LEFT JOIN cov_r c ON {_IN} GROUP BY f.fid), r AS (SELECT f.fid, coalesce(sum(c.reads), 0) AS r FROM feature f LEFT JOIN cov_a c ON {_IN} GROUP BY f.fid) SELECT fid, q AS q_sum, r AS r_sum, round(q / greatest(r, 1), 6) AS fold FROM q JOIN r USING (fid)", "feature", "cov_r", "cov_a")
def fold_check(spark, d):
    return coverage.fold_check(p.features(spark, d), p.coverage(spark, d, "R"), p.coverage(spark, d, "A")).select("fid", "q_sum", "r_sum", F.round("fold", 6).alias("fold"))


@query("""v AS (SELECT p_brand AS gene, CASE WHEN l_returnflag = 'R' THEN 'A' ELSE 'B' END AS side, l_linenumber AS replicate, sum(l_quantity) AS value FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag IN ('R', 'A') AND NOT (p_brand LIKE '%1' AND l_returnflag = 'A') GROUP BY ALL),
s AS (SELECT gene, avg(value) FILTER (side = 'A') AS ma, avg(value) FILTER (side = 'B') AS mb, stddev_pop(value) FILTER (side = 'A') AS sa, stddev_pop(value) FILTER (side = 'B') AS sb FROM v GROUP BY gene)
SELECT gene, CASE WHEN mb IS NULL THEN 'no sample B signal' WHEN ma IS NULL THEN 'no sample A signal' ELSE 'both' END AS status, round(ma / mb, 6) AS ratio, round(ma / 100 - mb / 100, 6) AS difference, round(ma / 100, 6) AS mean_a, round(mb / 100, 6) AS mean_b, round(sa / ma, 6) AS cv_a, round(sb / mb, 6) AS cv_b FROM s""")
def diff_expression(spark, d):
    lines = p.read(spark, d, "lineitem").filter("l_returnflag IN ('R', 'A')").join(p.read(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).filter("NOT (p_brand LIKE '%1' AND l_returnflag = 'A')")
    v = lines.groupBy(F.col("p_brand").alias("gene"), F.when(F.col("l_returnflag") == "R", "A").otherwise("B").alias("side"), F.col("l_linenumber").alias("replicate")).agg(F.sum("l_quantity").alias("value"))
    out = coverage.differential(v, "gene", F.lit(100))
    return out.select("gene", "status", *[F.round(c, 6).alias(c) for c in ("ratio", "difference", "mean_a", "mean_b", "cv_a", "cv_b")])


SQL["diff_expression"] = "WITH " + SQL["diff_expression"].removeprefix("WITH RECURSIVE ")


@query(""", r AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY chrom, strand) AS n, avg(reads) OVER (PARTITION BY chrom, strand ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING) AS m FROM cov_r WINDOW w AS (PARTITION BY chrom, strand ORDER BY pos))
SELECT chrom, strand, pos, round(CASE WHEN i <= 3 OR i > n - 3 THEN reads ELSE m END, 6) AS smooth FROM r""", "cov_r")
def smooth(spark, d):
    out = coverage.smooth(p.coverage(spark, d, "R"), "reads", "pos", 3, ["chrom", "strand"])
    return out.select("chrom", "strand", "pos", F.round("smooth", 6).alias("smooth"))


@query(", x AS (SELECT fid, chrom, CASE WHEN strand = '+' THEN fend ELSE fstart END AS e, strand FROM feature WHERE ftype LIKE 'ECONOMY%') SELECT c.* FROM cov_r c ANTI JOIN (SELECT DISTINCT chrom, strand, pos FROM x, unnest(generate_series(e - 15, e + 14)) AS u(pos)) USING (chrom, strand, pos)", "cov_r", "feature")
def excluding_three_prime_ends(spark, d):
    """A track without the surroundings of some 3' ends."""
    ann = p.features(spark, d).filter("ftype LIKE 'ECONOMY%'").select(*KEYS, F.col("fstart").alias("astart"), F.col("fend").alias("aend"), F.lit("x").alias("sequence_type"))
    return coverage.excluding(p.coverage(spark, d, "R"), annotate.three_prime_flanks(ann, ["x"], 15))


# ---- annotation -------------------------------------------------------------------------------------------

_STAB = """, s AS (SELECT c.chrom, c.strand, c.pos, a.sequence_type, a.gene_name, a.gene_id, row_number() OVER (PARTITION BY c.chrom, c.strand, c.pos ORDER BY a.astart, a.ord DESC) AS k FROM cov_r c JOIN annotation a ON a.chrom = c.chrom AND a.strand {0} c.strand AND a.astart <= c.pos AND c.pos <= a.aend + 1 AND a.astart > c.pos - 20000 AND a.astart > 0 AND a.sequence_type IN ('intron', 'exon', '5UTR', '3UTR'))"""


@query(_STAB.format("=") + _STAB.format("<>").replace(", s AS", ", z AS") + """ SELECT c.chrom, c.strand, c.pos, coalesce(s.sequence_type, z.sequence_type, 'intergenic') AS sequence_type, coalesce(s.gene_name, z.gene_name, 'intergenic') AS gene_name, coalesce(s.gene_id, z.gene_id, 'intergenic') AS gene_id, CASE WHEN s.k IS NULL AND z.k IS NOT NULL THEN 'antisense' ELSE 'sense' END AS sense
FROM cov_r c LEFT JOIN (SELECT * FROM s WHERE k = 1) s USING (chrom, strand, pos) LEFT JOIN (SELECT * FROM z WHERE k = 1) z USING (chrom, strand, pos)""", "cov_r", "annotation")
def coord_annotation(spark, d):
    return annotate.coordinate_annotation(p.coverage(spark, d, "R").drop("reads"), p.annotations(spark, d))


@query(""", o AS (SELECT c.chrom, c.strand, c.pos, a.astart, a.aend, a.gene_name, a.sequence_type, a.region_type, row_number() OVER (PARTITION BY c.chrom, c.strand, c.pos ORDER BY a.astart DESC, a.ord DESC) AS k FROM cov_r c JOIN annotation a ON a.chrom = c.chrom AND a.strand = c.strand AND a.astart <= c.pos + 2 AND a.astart > c.pos - 10000),
b AS (SELECT c.chrom, c.strand, c.pos, max(a.astart) AS astart FROM cov_r c JOIN annotation a ON a.chrom = c.chrom AND a.strand <> c.strand AND a.astart <= c.pos AND a.astart > c.pos - 10000 GROUP BY ALL),
z AS (SELECT b.chrom, b.strand, b.pos, a.gene_name, a.sequence_type, a.region_type, row_number() OVER (PARTITION BY b.chrom, b.strand, b.pos ORDER BY a.ord) AS k FROM b JOIN annotation a ON a.chrom = b.chrom AND a.strand <> b.strand AND a.astart = b.astart WHERE b.pos <= a.aend AND a.sequence_type IN ('intron', 'CDS', '5UTR', '3UTR')),
j AS (SELECT c.chrom, c.strand, c.pos, coalesce(c.pos <= o.aend + 2, false) AS hit, o.*EXCLUDE (chrom, strand, pos, k), z.gene_name AS zn, z.sequence_type AS zs, z.region_type AS zr FROM cov_r c LEFT JOIN (SELECT * FROM o WHERE k = 1) o USING (chrom, strand, pos) LEFT JOIN (SELECT * FROM z WHERE k = 1) z USING (chrom, strand, pos))
SELECT chrom, strand, pos, CASE WHEN contains(sequence_type, 'intron') AND abs(pos - CASE WHEN strand = '+' THEN astart ELSE aend END) < 5 THEN 'annotated splice site' ELSE 'unannotated splice site' END AS splice_site,
CASE WHEN NOT (hit AND sequence_type = 'CDS') AND zn IS NOT NULL OR (astart IS NULL AND zn IS NOT NULL) THEN zr WHEN hit THEN region_type ELSE 'intergenic' END AS region_type, CASE WHEN NOT (hit AND sequence_type = 'CDS') AND zn IS NOT NULL OR (astart IS NULL AND zn IS NOT NULL) THEN zs WHEN hit THEN sequence_type ELSE 'intergenic' END AS sequence_type,
CASE WHEN NOT (hit AND sequence_type = 'CDS') AND zn IS NOT NULL OR (astart IS NULL AND zn IS NOT NULL) THEN zn WHEN hit THEN gene_name ELSE 'intergenic' END AS gene_name, CASE WHEN NOT (hit AND sequence_type = 'CDS') AND zn IS NOT NULL OR (astart IS NULL AND zn IS NOT NULL) THEN 'antisense' WHEN hit THEN 'sense' ELSE 'intergenic' END AS sense FROM j""", "cov_r", "annotation")
def splice_annotation(spark, d):
    return annotate.splice_annotation(p.coverage(spark, d, "R").drop("reads"), p.annotations(spark, d))


_PRIO = """, t AS (SELECT c.chrom, c.strand, c.pos, c.reads, coalesce(min(CASE a.type WHEN 'CDS' THEN 0 WHEN '3UTR' THEN 1 WHEN '5UTR' THEN 2 WHEN 'tRNA' THEN 3 WHEN 'snoRNA' THEN 4 END), 5) AS k FROM cov_r c LEFT JOIN atype a ON a.chrom = c.chrom AND a.strand = c.strand AND a.tstart <= c.pos AND c.pos < a.tend GROUP BY ALL),
k AS (SELECT unnest(['CDS', '3UTR', '5UTR', 'tRNA', 'snoRNA', 'intergenic']) AS type, unnest([0, 1, 2, 3, 4, 5]) AS k)"""


@query(_PRIO + " SELECT chrom, strand, pos, type AS annotation_type FROM t JOIN k USING (k)", "cov_r", "atype")
def priority_annotation(spark, d):
    return annotate.priority_type(p.coverage(spark, d, "R").drop("reads"), p.types(spark, d), PRIORITIES)


@query(_PRIO + " SELECT type, coalesce(sum(reads), 0) AS value FROM k LEFT JOIN t USING (k) GROUP BY type", "cov_r", "atype")
def type_distribution_mass(spark, d):
    return annotate.type_distribution(p.coverage(spark, d, "R"), p.types(spark, d), PRIORITIES)


@query(_PRIO + " SELECT type, cast(count(pos) AS double) AS value FROM k LEFT JOIN t USING (k) GROUP BY type", "cov_r", "atype")
def type_distribution_count(spark, d):
    return annotate.type_distribution(p.coverage(spark, d, "R"), p.types(spark, d), PRIORITIES, by_mass=False)


@query(_PRIO + ", v AS (SELECT type, coalesce(sum(reads), 0) AS value FROM k LEFT JOIN t USING (k) GROUP BY type) SELECT 'coding' AS grp, sum(value) AS value FROM v WHERE type = 'CDS' UNION ALL SELECT 'UTR', sum(value) FROM v WHERE type IN ('3UTR', '5UTR') UNION ALL SELECT 'small', sum(CASE WHEN type = 'tRNA' THEN 2 ELSE 1 END * value) FROM v WHERE type IN ('tRNA', 'snoRNA')", "cov_r", "atype")
def combined_types(spark, d):
    return annotate.combined_types(type_distribution_mass(spark, d), {"coding": ["CDS"], "UTR": ["3UTR", "5UTR"], "small": ["tRNA", "snoRNA", "tRNA"]})


_DOWN = " SELECT c.chrom, c.strand, c.pos FROM cov_r c WHERE {0} EXISTS (SELECT 1 FROM cov_a a WHERE a.chrom = c.chrom AND a.strand = '+' AND a.reads >= 40 AND a.pos >= CASE WHEN c.strand = '+' THEN c.pos ELSE c.pos - 20 END AND a.pos < CASE WHEN c.strand = '+' THEN c.pos + 20 ELSE c.pos END)"


def _footprint(spark, d, having):
    return motifs.downstream_footprint(p.coverage(spark, d, "R").drop("reads"), p.coverage(spark, d, "A").filter("strand = '+' AND reads >= 40"), 20, having)


@query(_DOWN.format(""), "cov_r", "cov_a")
def footprint_semi(spark, d):
    return _footprint(spark, d, True)


@query(_DOWN.format("NOT"), "cov_r", "cov_a")
def footprint_anti(spark, d):
    return _footprint(spark, d, False)


_NEAR_LOOP = """, hl AS (SELECT c.chrom, c.strand, c.pos, a.pos AS l, row_number() OVER (PARTITION BY c.chrom, c.strand, c.pos ORDER BY (a.pos >= c.pos) DESC, abs(a.pos - c.pos) DESC) AS k FROM cov_r c JOIN cov_n a ON a.chrom = c.chrom AND a.strand = c.strand AND a.pos BETWEEN c.pos - 50 AND c.pos + 50)"""


@query(_NEAR_LOOP + " SELECT c.chrom, c.strand, c.pos, h.l AS loop_pos FROM cov_r c LEFT JOIN (SELECT * FROM hl WHERE k = 1) h USING (chrom, strand, pos)", "cov_r", "cov_n")
def nearby_loop(spark, d):
    return motifs.nearby_loop(p.coverage(spark, d, "R").drop("reads"), p.coverage(spark, d, "N"), 50)


# ---- profiles ---------------------------------------------------------------------------------------------

_PLACES = """, h AS (SELECT f.fid, f.fstart, f.fend, CASE WHEN {0} THEN 'sense' ELSE 'antisense' END AS side, CASE WHEN f.strand = '+' THEN c.pos - f.fstart ELSE f.fend - 1 - c.pos END AS i, f.fend - f.fstart AS n, c.reads{1} FROM feature f JOIN {2} c ON c.chrom = f.chrom AND c.pos >= f.fstart - 5 AND c.pos < f.fend + 5),
b AS (SELECT *, CASE WHEN i < 0 THEN i + 5 WHEN i < n THEN 5 + least(cast(floor(i * 10.0::DOUBLE / n) AS integer), 9) ELSE i - n + 15 END AS idx, i >= 0 AND i < n AS body, least(cast(floor((i + 1) * 10.0::DOUBLE / n) AS integer), 9) AS nxt FROM h),
q AS (SELECT fid, side, idx, reads AS v{1} FROM b WHERE NOT body OR i + 1 >= n OR nxt <> idx - 5),
every AS (SELECT idx FROM unnest(generate_series(0, 19)) AS u(idx))
"""


@query(_PLACES.format("c.strand = f.strand", "", "cov_r") + """, m AS (SELECT *, sum(v) OVER w AS s, max(v) OVER w AS mx FROM q WINDOW w AS (PARTITION BY fid)), a AS (SELECT side, idx, sum(v * (1.0 / mx)) AS v FROM m WHERE s >= 50 AND mx > 0 GROUP BY ALL), e AS (SELECT x.side, every.idx, coalesce(a.v, 0) AS v FROM (SELECT DISTINCT side FROM a) x CROSS JOIN every LEFT JOIN a ON a.side = x.side AND a.idx = every.idx)
SELECT side, idx, round(v / max(v) OVER (PARTITION BY side), 6) AS v FROM e""", "feature", "cov_r")
def metagene_stranded(spark, d):
    return metagene.metagene(p.features(spark, d), p.coverage(spark, d, "R"), "fid", 5, 10, 5, min_reads=50).withColumn("v", F.round("v", 6)).withColumn("idx", F.col("idx").cast("long"))


@query(", cov1 AS (SELECT chrom, pos, sum(reads) AS reads FROM cov_r GROUP BY ALL)" + _PLACES.format("true", "", "cov1") + """, a AS (SELECT idx, sum(v) AS v FROM q GROUP BY ALL), e AS (SELECT every.idx, coalesce(a.v, 0) AS v FROM every LEFT JOIN a USING (idx)) SELECT idx, round(v / max(abs(v)) OVER (), 6) AS v FROM e""", "feature", "cov_r")
def metagene_nonstranded(spark, d):
    cov = p.coverage(spark, d, "R").groupBy("chrom", "pos").agg(F.sum("reads").alias("reads"))
    return metagene.metagene_nonstranded(p.features(spark, d), cov, "fid", 5, 10, 5).withColumn("v", F.round("v", 6)).withColumn("idx", F.col("idx").cast("long"))


@query(_PLACES.format("c.strand = f.strand", ", sample", "samples") + """, tot AS (SELECT fid, sum(v) AS total FROM q WHERE side = 'sense' GROUP BY fid HAVING sum(v) > 60), a AS (SELECT sample, side, idx, sum(v * 100 / total) AS v FROM q JOIN tot USING (fid) GROUP BY ALL), e AS (SELECT x.sample, x.side, every.idx, coalesce(a.v, 0) AS v FROM (SELECT DISTINCT sample, side FROM a) x CROSS JOIN every LEFT JOIN a ON a.sample = x.sample AND a.side = x.side AND a.idx = every.idx)
SELECT sample, side, idx, round(v * 100 / max(v) OVER (PARTITION BY side), 4) AS v FROM e""", "feature", "samples")
def metagene_samples(spark, d):
    return metagene.metagene_samples(p.features(spark, d), p.samples(spark, d), "fid", 5, 10, 5, 60).withColumn("v", F.round("v", 4)).withColumn("idx", F.col("idx").cast("long"))


@query(""", v AS (SELECT f.fid, x.pos - f.fstart AS i, f.fend - f.fstart AS n, coalesce(c.reads, 0) AS reads FROM feature f, unnest(generate_series(f.fstart, f.fend - 1)) AS x(pos) LEFT JOIN cov_r c ON c.chrom = f.chrom AND c.strand = f.strand AND c.pos = x.pos), b AS (SELECT fid, least(cast(floor(i * 8.0::DOUBLE / n) AS integer), 7) AS bin, arg_max(reads, i) AS value FROM v GROUP BY ALL)
SELECT f.fid, u.bin, coalesce(b.value, 0) AS value FROM feature f CROSS JOIN unnest(generate_series(0, 7)) AS u(bin) LEFT JOIN b ON b.fid = f.fid AND b.bin = u.bin WHERE f.fend > f.fstart""", "feature", "cov_r")
def binned_body(spark, d):
    v = coverage.expression_vector(p.features(spark, d), p.coverage(spark, d, "R"), "fid")
    return metagene.binned(v, 8).select("fid", F.posexplode("binned").alias("bin", "value")).withColumn("bin", F.col("bin").cast("long"))


# ---- sequences --------------------------------------------------------------------------------------------


@query(" SELECT doc_id, translate(reverse(seq), 'ACGT', 'TGCA') AS rc FROM dna", "dna")
def rev_comp(spark, d):
    return p.dna(spark, d).select("doc_id", sq.reverse_complement("seq").alias("rc"))


_CODES = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in sq.IUPAC.items()) + "}"


@query(f""", l AS (SELECT unnest(string_split('ACGTRYSWKMBDHVN', '')) AS a), x AS (SELECT l.a, m.a AS b FROM l CROSS JOIN l m)
SELECT a, b, a = b OR coalesce(contains(({_CODES})[a], b), false) OR coalesce(contains(({_CODES})[b], a), false) AS fits FROM x""", "genome")
def base_match(spark, d):
    letters = F.explode(F.split(F.lit("ACGTRYSWKMBDHVN"), "")).alias("a")
    one = spark.range(1).select(letters)
    return one.crossJoin(one.select(F.col("a").alias("b"))).select("a", "b", sq.base_match("a", "b").alias("fits"))


@query(", h AS (SELECT doc_id, string_split(seq[1:length(seq) // 2], '') AS a, string_split(seq[length(seq) // 2 + 1:length(seq) // 2 * 2], '') AS b FROM dna) SELECT doc_id, len(list_filter(list_zip(a, b), lambda z: z[1] <> z[2])) AS distance FROM h", "dna")
def hamming_distance(spark, d):
    """the first half of each sequence against the second."""
    half = F.floor(F.length("seq") / 2).cast("int")
    return p.dna(spark, d).select("doc_id", sq.hamming(F.substring("seq", F.lit(1), half), F.substring("seq", half + 1, half)).cast("long").alias("distance"))


@query(" SELECT doc_id, contains(seq, 'TTTT') AS t_run, contains(seq, 'GGATCC') OR contains(seq, 'GAATTC') AS has_site FROM dna", "dna")
def sequence_screens(spark, d):
    return p.dna(spark, d).select("doc_id", sq.has_t_run("seq", 4).alias("t_run"), sq.has_site("seq", ["GGATCC", "GAATTC"]).alias("has_site"))


@query(" SELECT chrom, strand, pos, ['I','II','III','IV','V','VI','VII','VIII','IX','X','XI','XII','XIII','XIV','XV','XVI'][cast(substring(chrom, 4) AS integer)] AS numeral FROM cov_r", "cov_r")
def chromosome_numerals(spark, d):
    return p.coverage(spark, d, "R").select("chrom", "strand", "pos", F.regexp_replace(sq.numeral("chrom"), "^chr", "").alias("numeral"))


@query(", a AS (SELECT p_partkey, concat('ID=', p_brand, ';Name=', p_name, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE ';' END) AS t FROM part) SELECT p_partkey, nullif(regexp_extract(t, 'ID=([^;]*);', 1), '') AS id, nullif(regexp_extract(t, 'Name=([^;]*);', 1), '') AS closed_name, nullif(regexp_extract(t, 'Name=([^;]*)', 1), '') AS open_name FROM a", "genome")
def gff_attributes(spark, d):
    t = F.concat(F.lit("ID="), "p_brand", F.lit(";Name="), "p_name", F.when(F.col("p_partkey") % 3 == 0, "").otherwise(";"))
    return p.read(spark, d, "part").select("p_partkey", sq.gff_attribute(t, "ID").alias("id"), sq.gff_attribute(t, "Name").alias("closed_name"), sq.gff_attribute(t, "Name", closed=False).alias("open_name"))


@query(" SELECT doc_id, length(regexp_extract(substring(seq, length(seq) // 2 + 2), '^A*')) AS forward, length(regexp_extract(substring(seq, 1, length(seq) // 2), 'T*$')) AS backward FROM dna", "dna")
def adenosine_runs(spark, d):
    """from the middle of each sequence."""
    at = F.floor(F.length("seq") / 2).cast("int")
    return p.dna(spark, d).select("doc_id", sq.run_length("seq", at, "A").cast("long").alias("forward"), sq.run_length("seq", at, "T", False).cast("long").alias("backward"))


@query(""", x AS (SELECT DISTINCT cigar FROM aln) SELECT cigar, len(regexp_extract_all(cigar, '[0-9]+[NXIDSM=]')) AS n_ops, coalesce(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)=', 1), lambda z: cast(z AS integer))), 0) AS n_match, coalesce(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)X', 1), lambda z: cast(z AS integer))), 0) AS n_mismatch FROM x""", "aln")
def cigar_ops(spark, d):
    own = p.alignments(spark, d).select("cigar").distinct()
    return own.select("cigar", F.size(sq.cigar_ops("cigar")).cast("long").alias("n_ops"), sq.cigar_bases("cigar", "=").cast("decimal(38,0)").alias("n_match"), sq.cigar_bases("cigar", "X").cast("decimal(38,0)").alias("n_mismatch"))


SQL["cigar_ops"] = SQL["cigar_ops"].replace("0) AS n_match", "0)::DECIMAL(38,0) AS n_match").replace("0) AS n_mismatch", "0)::DECIMAL(38,0) AS n_mismatch")

_SCAN = """, w AS (SELECT chrom, i AS mstart, substring(seq, i + 1, 6) AS k FROM genome, unnest(generate_series(0, length(seq) - 7)) AS u(i) WHERE length(seq) > 6),
m AS (SELECT chrom, mstart, k, {0} AS s, {1} AS a FROM w)"""
_HITS = lambda motif, seq: " + ".join(f"CASE WHEN substring({seq}, {i + 1}, 1) IN ({', '.join(repr(b) for b in (sq.IUPAC.get(c, c)))}) THEN 0 ELSE 1 END" for i, c in enumerate(motif))
_SCAN = _SCAN.format(_HITS("ACRTNG", "k"), _HITS("ACRTNG", "translate(reverse(k), 'ACGT', 'TGCA')"))


@query(_SCAN + " SELECT chrom, mstart, mstart + 6 AS mend, CASE WHEN a <= 1 THEN '-' ELSE '+' END AS strand, k AS match, CASE WHEN a <= 1 THEN a ELSE s END AS mismatches FROM m WHERE s <= 1 OR a <= 1", "genome")
def motif_scan(spark, d):
    out = motifs.motif_scan(p.genome(spark, d), "ACRTNG", 1)
    return out.withColumns({"mstart": F.col("mstart").cast("long"), "mend": F.col("mend").cast("long")})


@query(_SCAN + " SELECT k AS match, count(*) AS n FROM m WHERE a <= 1 OR s <= 1 GROUP BY k", "genome")
def motif_variant_counts(spark, d):
    return motifs.variant_counts(motifs.motif_scan(p.genome(spark, d), "ACRTNG", 1))


def _spans(spark, d):
    return p.genome(spark, d).select("chrom", F.length("seq").alias("__n"), F.explode(F.sequence(F.lit(0), F.greatest(F.length("seq") - 1, F.lit(0)), F.lit(30))).alias("start")).withColumn("end", F.least(F.col("start") + 30, F.col("__n"))).drop("__n")


@query(", sp AS (SELECT chrom, i AS start, least(i + 30, length(seq)) AS stop, substring(seq, i + 1, 30) AS s FROM genome, unnest(generate_series(0, greatest(length(seq) - 1, 0), 30)) AS u(i)), w AS (SELECT chrom, start, stop, o, substring(s, o + 1, 6) AS k FROM sp, unnest(generate_series(0, length(s) - 7)) AS v(o) WHERE length(s) > 6), b AS (SELECT chrom, start, stop, o, 0 AS side, k, "
       + _HITS("ACRTNG", "k") + " AS mm FROM w UNION ALL SELECT chrom, start, stop, o, 1, translate(reverse(k), 'ACGT', 'TGCA'), " + _HITS("ACRTNG", "translate(reverse(k), 'ACGT', 'TGCA')") + """ FROM w), r AS (SELECT *, row_number() OVER (PARTITION BY chrom, start ORDER BY mm, o, side) AS n FROM b)
SELECT chrom, start, stop AS "end", start + o AS mstart, start + o + 6 AS mend, CASE side WHEN 0 THEN '+' ELSE '-' END AS strand, k AS match, mm AS mismatches FROM r WHERE n = 1 AND mm <= 2""", "genome")  # fmt: skip
def best_motif(spark, d):
    out = motifs.best_motif(_spans(spark, d), p.genome(spark, d), "ACRTNG", 2)
    return out.withColumns({c: F.col(c).cast("long") for c in ("start", "end", "mstart", "mend")})


_TWO = _SCAN + ", h1 AS (SELECT chrom, mstart, 'a' AS src FROM m WHERE s <= 1), h2 AS (SELECT chrom, mstart, 'b' AS src FROM m WHERE a <= 1)"


def _two(spark, d):
    scan = lambda motif, src: motifs.motif_scan(p.genome(spark, d), motif, 1, both=False).select("chrom", F.col("mstart").cast("long").alias("mstart"), F.lit(src).alias("src"))
    return scan("ACRTNG", "a"), scan("CNAYGT", "b")


@query(_TWO + " SELECT * FROM h1 UNION ALL SELECT * FROM h2 ANTI JOIN h1 USING (chrom, mstart)", "genome")
def motif_union(spark, d):
    return motifs.combine_motifs(*_two(spark, d), on=("chrom", "mstart"))


@query(_TWO + " SELECT * FROM h1 SEMI JOIN h2 USING (chrom, mstart)", "genome")
def motif_intersection(spark, d):
    return motifs.combine_motifs(*_two(spark, d), union=False, on=("chrom", "mstart"))


@query(", r AS (SELECT *, cast(pos AS bigint) + CASE strand WHEN '-' THEN 10000000000 ELSE 0 END AS ord FROM cov_r) SELECT ord, chrom, pos FROM r a WHERE NOT EXISTS (SELECT 1 FROM r b WHERE b.chrom = a.chrom AND b.ord < a.ord AND b.pos - 2 < a.pos + 3 AND a.pos - 2 < b.pos + 3)", "cov_r")
def suppress_near_motifs(spark, d):
    """K3: in the order of strands and positions."""
    rows = p.coverage(spark, d, "R").withColumn("ord", F.col("pos").cast("long") + F.when(F.col("strand") == "-", F.lit(10_000_000_000)).otherwise(F.lit(0)))
    rows = rows.withColumns({"start": F.col("pos"), "end": F.col("pos") + 1})
    return motifs.suppressed(rows).select(F.col("ord").cast("long").alias("ord"), "chrom", "pos")


@query(" SELECT 'ACGT' AS motif, sum((length(seq) - length(replace(seq, 'ACGT', ''))) / 4) / count(*) AS value FROM dna UNION ALL SELECT 'AA', sum((length(seq) - length(replace(seq, 'AA', ''))) / 2) / count(*) FROM dna", "dna")
def motif_density(spark, d):
    return motifs.motif_counts(p.dna(spark, d), ["ACGT", "AA"])


# ---- variants ---------------------------------------------------------------------------------------------


@query(", t AS (SELECT *, CASE WHEN right(ref, 1) = right(alt, 1) THEN least(length(ref), length(alt)) - 1 ELSE 0 END AS k FROM variant) SELECT chrom, pos + k AS pos, substring(ref, k + 1) AS ref, substring(alt, k + 1) AS alt, ord FROM t", "variant")
def variant_trim(spark, d):
    out = variants.trimmed(p.variants(spark, d))
    return out.withColumn("pos", F.col("pos").cast("long"))


@query(", t AS (SELECT *, CASE WHEN right(ref, 1) = right(alt, 1) THEN least(length(ref), length(alt)) - 1 ELSE 0 END AS k FROM variant) SELECT chrom, pos + k AS pos, substring(ref, k + 1) AS ref, substring(alt, k + 1) AS alt, min(ord) AS ord FROM t GROUP BY ALL", "variant")
def variant_clean(spark, d):
    return variants.cleaned(p.variants(spark, d)).withColumn("pos", F.col("pos").cast("long"))


@query(", u AS (SELECT chrom, pos, ref, alt, 0 AS source_ord, ord FROM variant UNION ALL SELECT chrom, pos, ref, alt, 1, ord FROM variant UNION ALL SELECT chrom, pos, concat(ref, 'A'), alt, 1, ord FROM variant), k AS (SELECT chrom, pos, ref, alt, min(source_ord * 1000000000 + ord) AS x FROM u GROUP BY ALL) SELECT chrom, pos, ref, alt, cast(x // 1000000000 AS integer) AS source_ord, x % 1000000000 AS ord, count(*) OVER (PARTITION BY chrom, pos) AS calls_at_pos FROM k", "variant")
def variant_combine(spark, d):
    """All variants, and a second source of the same and of longer ones."""
    v = p.variants(spark, d)
    return variants.combined([v, v.unionByName(v.withColumn("ref", F.concat("ref", F.lit("A"))))])


@query(""", r AS (SELECT chrom, pos AS first, pos + length(ref) AS stop, pos AS last, [concat(pos, ref, '>', alt)] AS m, 1 AS n FROM variant
UNION ALL SELECT r.chrom, r.first, v.pos + length(v.ref), v.pos, list_append(r.m, concat(v.pos, v.ref, '>', v.alt)), r.n + 1 FROM r JOIN variant v ON v.chrom = r.chrom AND v.pos > r.last AND v.pos - r.stop < 5)
SELECT chrom, first, stop AS "end", array_to_string(m, ',') AS members, n AS n_members FROM r WHERE n > 1""", "variant")
def link_variants(spark, d):
    """V2: chains of any length."""
    chains = variants.linked_chains(p.variants(spark, d))
    members = F.array_join(F.transform("members", lambda m: F.concat(m["pos"].cast("string"), m["ref"], F.lit(">"), m["alt"])), ",")
    return chains.select("chrom", "first", F.col("end").cast("long").alias("end"), members.alias("members"), "n_members")


# ---- reads ------------------------------------------------------------------------------------------------


@query(" SELECT seq, count(*) AS n, arg_max(qual, ord) AS qual, min(ord) AS first_ord FROM reads GROUP BY seq HAVING count(*) >= 2", "reads")
def collapse_reads(spark, d):
    return reads.collapsed(p.reads(spark, d), 2)


@query(" SELECT sample, count(*) + sum(CASE WHEN chrom <> '*' THEN n ELSE 0 END) AS total_counts FROM aln GROUP BY sample", "aln")
def edit_totals(spark, d):
    return reads.totals(p.alignments(spark, d)).withColumn("total_counts", F.col("total_counts").cast("decimal(38,0)"))


SQL["edit_totals"] = SQL["edit_totals"].replace("0 END) AS total_counts", "0 END)::DECIMAL(38,0) AS total_counts")

_EDITS = """, t AS (SELECT sample, count(*) + sum(CASE WHEN chrom <> '*' THEN n ELSE 0 END) AS total FROM aln GROUP BY sample),
o AS (SELECT a.*, regexp_extract(cigar, '^([0-9]+)=', 1)::INTEGER AS q, regexp_extract(cigar, '([0-9]+)([IDX])', 1)::INTEGER AS k, regexp_extract(cigar, '([0-9]+)([IDX])', 2) AS op FROM aln a WHERE chrom <> '*'),
z AS (SELECT *, 120 - (pos + q) AS f FROM o), y AS (SELECT *, CASE WHEN f >= 0 THEN f WHEN f + k - 1 <= 0 THEN 1 - f - k ELSE 0 END AS near FROM z)
SELECT ord, cigar, false AS perfect_match, CASE WHEN op = 'X' THEN 1000 ELSE near END AS indel_distance, CASE WHEN op = 'X' THEN near ELSE 1000 END AS mismatch_distance, greatest(pos + q, 101) <= least(pos + q + k - 1, 139) AS mismatch_in_donor, round(n / total, 9) AS fraction FROM y JOIN t USING (sample)"""


@query(_EDITS, "aln")
def edit_outcomes(spark, d):
    """W14; the fraction's denominator counts lines and mapped reads."""
    a = p.alignments(spark, d).withColumn("seq", F.concat_ws("|", F.col("ord").cast("string"), "seq"))
    out = reads.edit_outcomes(a)
    return out.select(F.split("seq", "[|]")[0].cast("long").alias("ord"), "cigar", "perfect_match", "indel_distance", "mismatch_distance", "mismatch_in_donor", F.round("fraction", 9).alias("fraction"))


@query(" SELECT n_name AS plate_ID, r_name AS well, p_size AS sample_number, count(*) AS n FROM nation CROSS JOIN region JOIN part ON n_nationkey = p_size - 1 GROUP BY ALL", "genome")
def expand_grid_keyfile(spark, d):
    plates = p.read(spark, d, "nation").select(F.col("n_name").alias("plate_ID"), (F.col("n_nationkey") + 1).alias("sample_number"))
    wells = reads.expand_grid([plates.select("plate_ID"), p.read(spark, d, "region").select(F.col("r_name").alias("well"))])
    parts = p.read(spark, d, "part").select(F.col("p_size").alias("sample_number"), "p_partkey")
    return reads.keyfile(wells, plates, parts).groupBy("plate_ID", "well", "sample_number").agg(F.count(F.lit(1)).alias("n"))


@query(", r AS (SELECT ord, concat(seq, 'ACGTACGTAC') AS s FROM reads) SELECT ord, substring(CASE WHEN instr(s, 'GTACGT') > 0 THEN substring(s, 1, instr(s, 'GTACGT') - 1) ELSE s END, 6) AS seq FROM r", "reads")
def trim_reads(spark, d):
    own = p.reads(spark, d).withColumn("seq", F.concat("seq", F.lit("ACGTACGTAC")))
    return reads.trimmed_reads(own, 5, "GTACGT").select("ord", "seq")


# ---- reading frames ---------------------------------------------------------------------------------------

_CODE = "MAP {" + ", ".join(f"'{c}': '{a}'" for c, a in orfs.genetic_code().items()) + "}"


@query(f" SELECT chrom, array_to_string(list_transform(generate_series(0, length(seq) // 3 - 1), lambda i: ({_CODE})[substring(seq, cast(i * 3 + 1 AS integer), 3)]), '') AS protein FROM genome WHERE length(seq) >= 3", "genome")
def codon_translate(spark, d):
    return p.genome(spark, d).filter(F.length("seq") >= 3).select("chrom", orfs.translated(F.col("seq")).alias("protein"))


def _cds(spark, d):
    """Two exons of each sequence, the first of a length that isn't a multiple of three."""
    own = p.genome(spark, d).filter(F.length("seq") >= 60)
    strand = F.when(F.length("seq") % 2 == 0, "+").otherwise("-")
    exon = lambda a, b, o: own.select(F.col("chrom").alias("orf"), "chrom", F.lit(a).alias("start"), F.lit(b).alias("end"), strand.alias("strand"), F.lit(o).alias("exon_ord"))
    return exon(4, 23, 0).unionByName(exon(31, 52, 1))


_ORF = f""", e AS (SELECT chrom, CASE WHEN length(seq) % 2 = 0 THEN '+' ELSE '-' END AS strand, concat(substring(seq, 4, 20), substring(seq, 31, 22)) AS s FROM genome WHERE length(seq) >= 60),
b AS (SELECT chrom, strand, i, CASE WHEN strand = '+' THEN substring(s, cast(i + 1 AS integer), 1) ELSE translate(substring(s, cast(42 - i AS integer), 1), 'ACGT', 'TGCA') END AS base, CASE WHEN strand = '+' THEN CASE WHEN i < 20 THEN i + 3 ELSE i + 10 END ELSE CASE WHEN i < 22 THEN 52 - i ELSE 45 - i END END AS coord FROM e, unnest(generate_series(0, 41)) AS u(i)),
c AS (SELECT chrom AS orf, strand, i // 3 + 1 AS aa_num, string_agg(base, '' ORDER BY i) AS codon, min(coord) AS lo, max(coord) AS hi FROM b GROUP BY ALL)
SELECT orf, strand, aa_num, codon, lo, hi, ({_CODE})[codon] AS aa FROM c"""


@query(_ORF, "genome")
def orf_model(spark, d):
    out = orfs.codons_of(_cds(spark, d), p.genome(spark, d))
    long = lambda c: c.cast("long")
    return out.select("orf", "strand", long(F.col("aa_num")).alias("aa_num"), "codon", long(F.array_min("coords")).alias("lo"), long(F.array_max("coords")).alias("hi"), "aa")


_F = lambda x, more=1: f"cast(floor(({x}) / 3.0) AS integer) + {more}"
_SYN = f""", x AS (SELECT fid, fstart AS l, fstart + 2 AS r, fstart - 30 + cast(fid % 61 AS integer) AS p, strand FROM feature)
SELECT fid, CASE WHEN strand = '+' THEN CASE WHEN r <= p - 20 OR r <= p - 10 THEN 0 WHEN l >= p THEN {_F('l - p + 3')} ELSE greatest({_F('l - p + 10')}, 0) END ELSE CASE WHEN l >= p + 20 THEN {_F('l - p - 10')} WHEN l >= p + 10 THEN {_F('l - p - 3')} WHEN r <= p THEN 0 ELSE greatest({_F('l - p')}, 0) END END AS to_left,
CASE WHEN strand = '+' THEN CASE WHEN r <= p - 20 THEN {_F('p - 10 - r')} WHEN r <= p - 10 THEN {_F('p - 3 - r')} WHEN l >= p THEN 0 ELSE greatest({_F('p - r')}, 0) END ELSE CASE WHEN l >= p + 20 OR l >= p + 10 THEN 0 WHEN r <= p THEN {_F('p + 3 - r')} ELSE greatest({_F('p + 10 - r')}, 0) END END AS to_right FROM x"""


def _syn(spark, d, cas12a):
    f = p.features(spark, d)
    s = orfs.synonymous_changes(F.col("fstart"), F.col("fstart") + 2, F.col("fstart") - 30 + (F.col("fid") % 61).cast("int"), F.col("strand"), cas12a)
    return f.select("fid", s.alias("s")).select("fid", "s.to_left", "s.to_right")


@query(_SYN, "feature")
def syn_changes_cas9(spark, d):
    return _syn(spark, d, False)


_SYN12 = f""", x AS (SELECT fid, fstart AS l, fstart + 2 AS r, fstart - 30 + cast(fid % 61 AS integer) AS p, strand FROM feature)
SELECT fid, CASE WHEN strand = '+' THEN CASE WHEN l >= p + 24 THEN {_F('l - p - 14')} WHEN l >= p + 14 THEN {_F('l - p - 4')} WHEN r <= p + 4 THEN 0 ELSE greatest({_F('l - p - 4', 2)}, 0) END ELSE CASE WHEN r <= p - 24 OR r <= p - 14 THEN 0 WHEN l >= p - 4 THEN {_F('l - p + 4', 2)} ELSE greatest({_F('l - p + 14')}, 0) END END AS to_left,
CASE WHEN strand = '+' THEN CASE WHEN l >= p + 24 OR l >= p + 14 THEN 0 WHEN r <= p + 4 THEN {_F('p + 4 - r', 2)} ELSE greatest({_F('p + 14 - r')}, 0) END ELSE CASE WHEN r <= p - 24 THEN {_F('p - 14 - r')} WHEN r <= p - 14 THEN {_F('p - 4 - r')} WHEN l >= p - 4 THEN 0 ELSE greatest({_F('p - 4 - r', 2)}, 0) END END AS to_right FROM x"""


@query(_SYN12, "feature")
def syn_changes_cas12a(spark, d):
    return _syn(spark, d, True)


# ---- what SQL can't say: order-dependent growth and alignment -----------------------------------------------


#: Width by signal of the clusters in xa (p and v: positions and reads inside), trimmed step by step from the weaker side.
_WIDTH = """,
xs AS (SELECT chrom, strand, seed, p, v, total, 1::BIGINT AS i, len(p) AS j, 0::DOUBLE AS l, 0::DOUBLE AS r, cstart::BIGINT AS lo, cend::BIGINT AS hi, 1::BIGINT AS d FROM xa
UNION ALL SELECT chrom, strand, seed, p, v, total, i2, j2, l2, r2, lo2, hi2, d + CASE WHEN (l2 + r2) / total >= 1::DOUBLE - 0.8::DOUBLE THEN len(list_filter(p, lambda x: x >= lo2 AND x <= hi2)) ELSE 0 END
FROM (SELECT *, CASE WHEN b THEN i ELSE i + 1 END AS i2, CASE WHEN b THEN j - 1 ELSE j END AS j2, CASE WHEN b THEN l ELSE l + v[i] END AS l2, CASE WHEN b THEN r + v[j] ELSE r END AS r2, greatest(lo, p[i]) + CASE WHEN b THEN 0 ELSE 1 END AS lo2, least(hi, p[j]) - CASE WHEN b THEN 1 ELSE 0 END AS hi2
FROM (SELECT *, v[j] + r < v[i] + l AS b FROM xs WHERE i <= j AND (l + r) / total <= 1::DOUBLE - 0.8::DOUBLE))),
xw AS (SELECT chrom, strand, seed, p[list_position(v, list_max(v))] AS peak_pos, list_max(v) AS peak_reads, (hi - lo)::INTEGER AS width, d::INTEGER AS n_distinct FROM xs WHERE NOT (i <= j AND (l + r) / total <= 1::DOUBLE - 0.8::DOUBLE))
"""
_SITES = _ISLANDS + """,
xa AS (SELECT chrom, strand, min(pos) AS seed, list(pos ORDER BY pos) AS p, list(reads ORDER BY pos) AS v, min(pos) AS cstart, CASE WHEN count(*) = 1 THEN min(pos) + 1 ELSE max(pos) END AS cend, sum(reads) AS total, count(*)::INTEGER AS n_sites FROM i GROUP BY chrom, strand, island)""" + _WIDTH + """,
site AS (SELECT chrom, strand, seed, cstart, cend, total AS cluster_reads, n_sites, peak_pos, peak_reads, width, n_distinct FROM xa JOIN xw USING (chrom, strand, seed))
"""
#: Growth from upregulated positions: how far each could grow on its own, then one after another along the island.
_GROWN = _CLASSES.replace(", s AS", ", cs AS").replace("FROM s WHERE", "FROM cs WHERE") + _ISLANDS + """,
n AS (SELECT i.chrom, i.strand, i.island, i.pos, i.reads, row_number() OVER (PARTITION BY i.chrom, i.strand, i.island ORDER BY i.pos) AS x, k.pos IS NOT NULL AS up FROM i LEFT JOIN (SELECT * FROM k WHERE class = 'up') k USING (chrom, strand, pos)),
h AS (SELECT chrom, strand, island, max(pos) FILTER (up) AS last_up, max(x) AS top FROM n GROUP BY ALL HAVING bool_or(up)),
pr AS (SELECT a.chrom, a.strand, a.island, a.x AS sx, a.pos AS seed, b.x AS bx, b.pos AS bpos, least(a.pos, b.pos) AS f, greatest(a.pos, b.pos) AS e FROM n a JOIN n b USING (chrom, strand, island) WHERE a.up AND a.x <> b.x),
qs AS (SELECT pr.*, sum(n.reads) AS q FROM pr JOIN n ON n.chrom = pr.chrom AND n.strand = pr.strand AND n.island = pr.island AND n.pos >= f AND n.pos < e GROUP BY ALL),
rs AS (SELECT qs.*, coalesce(sum(a.reads), 0) AS r FROM qs LEFT JOIN cov_a a ON a.chrom = qs.chrom AND a.strand = qs.strand AND a.pos >= f AND a.pos < e GROUP BY ALL),
en AS (SELECT n.chrom, n.strand, n.island, n.x AS sx, n.pos AS seed, h.top, coalesce(max(rs.bx) FILTER (rs.bx < n.x AND NOT (rs.bpos >= 1 AND rs.q / greatest(rs.r, 0.01) >= 1.5)), 0) AS l, coalesce(min(rs.bx) FILTER (rs.bx > n.x AND NOT (rs.bpos <= h.last_up AND rs.q / greatest(rs.r, 0.01) >= 1.5)), any_value(h.top) + 1) AS r
  FROM n JOIN h USING (chrom, strand, island) LEFT JOIN rs ON rs.chrom = n.chrom AND rs.strand = n.strand AND rs.island = n.island AND rs.sx = n.x WHERE n.up GROUP BY ALL),
fl AS (SELECT chrom, strand, island, list({'sx': sx, 'l': l, 'r': r, 'seed': seed} ORDER BY sx) AS z FROM en GROUP BY ALL),
cl AS (SELECT chrom, strand, island, z, z[1] AS y, z[1].l + 1 AS lo, z[1].r - 1 AS hi FROM fl
UNION ALL SELECT chrom, strand, island, z, y2, greatest(y2.l, hi) + 1, y2.r - 1 FROM (SELECT *, list_filter(z, lambda q: q.sx > hi)[1] AS y2 FROM cl) WHERE y2 IS NOT NULL),
de AS (SELECT cl.chrom, cl.strand, cl.island, cl.y.seed AS seed, min(n.pos) AS cstart, CASE WHEN cl.hi = cl.y.sx THEN cl.y.seed + 1 ELSE max(n.pos) END AS cend, sum(n.reads) AS total, count(*)::INTEGER AS n_sites FROM cl JOIN n ON n.chrom = cl.chrom AND n.strand = cl.strand AND n.island = cl.island AND n.x BETWEEN cl.lo AND cl.hi GROUP BY cl.chrom, cl.strand, cl.island, cl.y, cl.hi),
xa AS (SELECT de.chrom, de.strand, de.seed, de.cstart, de.cend, de.total, de.n_sites, list(n.pos ORDER BY n.pos) AS p, list(n.reads ORDER BY n.pos) AS v, coalesce(sum(n.reads) FILTER (n.pos < cend), 0) AS qf, coalesce(sum(n.pos * n.reads) FILTER (n.up AND n.pos < cend) / sum(n.reads) FILTER (n.up AND n.pos < cend), 0) AS com
  FROM de JOIN n ON n.chrom = de.chrom AND n.strand = de.strand AND n.island = de.island AND n.pos BETWEEN cstart AND cend GROUP BY de.chrom, de.strand, de.seed, de.cstart, de.cend, de.total, de.n_sites)""" + _WIDTH + """,
rf AS (SELECT xa.chrom, xa.strand, xa.seed, coalesce(sum(a.reads), 0) AS rf FROM xa LEFT JOIN cov_a a ON a.chrom = xa.chrom AND a.strand = xa.strand AND a.pos >= cstart AND a.pos < cend GROUP BY ALL),
grown AS (SELECT chrom, strand, seed, cstart, cend, total AS cluster_reads, n_sites, peak_pos, peak_reads, width, n_distinct, round(qf / greatest(rf, 1), 6) AS fold, round(com, 6) AS center_of_mass FROM xa JOIN xw USING (chrom, strand, seed) JOIN rf USING (chrom, strand, seed))
"""


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _grown_clusters(spark, d):
    q, r = p.coverage(spark, d, "R"), p.coverage(spark, d, "A")
    return clusters.upregulated_clusters(q, r, coverage.upregulated(q, r, 2, 5), 3, 1.5)


@query(_GROWN + "SELECT * FROM grown", "cov_r", "cov_a")
def upregulated_clusters(spark, d):
    """W5, W6, W8."""
    return _rounded(_grown_clusters(spark, d), "fold", "center_of_mass")


@query(_GROWN + """, q2 AS (SELECT g.chrom, g.strand, g.seed, coalesce(sum(c.reads), 0) AS q FROM grown g LEFT JOIN cov_n c ON c.chrom = g.chrom AND c.strand = g.strand AND c.pos BETWEEN peak_pos - 20 AND peak_pos + 19 GROUP BY ALL),
r2 AS (SELECT g.chrom, g.strand, g.seed, coalesce(sum(c.reads), 0) AS r FROM grown g LEFT JOIN cov_a c ON c.chrom = g.chrom AND c.strand = g.strand AND c.pos BETWEEN peak_pos - 20 AND peak_pos + 19 GROUP BY ALL)
SELECT grown.*, round(q2.q / greatest(r2.r, 0.1), 6) AS second_fold FROM grown JOIN q2 USING (chrom, strand, seed) JOIN r2 USING (chrom, strand, seed)""", "cov_r", "cov_a", "cov_n")
def two_reference_clusters(spark, d):
    """W9."""
    return _rounded(clusters.with_second_fold(_grown_clusters(spark, d), p.coverage(spark, d, "N"), p.coverage(spark, d, "A")), "fold", "center_of_mass", "second_fold")


@query(_SITES + "SELECT * FROM site", "cov_r")
def site_clusters(spark, d):
    """W7."""
    return clusters.site_clusters(p.coverage(spark, d, "R"), 3)


@query()
def signal_near_motifs(spark, d):
    m = p.features(spark, d).select("chrom", "strand", F.col("fstart").alias("mstart"), (F.col("fstart") + 6).alias("mend"))
    return motifs.signal_near_motifs(m, p.coverage(spark, d, "R"), p.coverage(spark, d, "A"), p.coverage(spark, d, "N"), (2, 12), 10, 20, 1.5)


def _pairs(spark, d):
    """Donors of up to 60 bases that tile each sequence, each with a guide made from its tenth to its thirty-first base."""
    tile = p.genome(spark, d).withColumn("start", F.explode(F.sequence(F.lit(1), F.greatest(F.length("seq"), F.lit(1)), F.lit(60)))).withColumn("donor", F.substring("seq", F.col("start"), F.lit(60)))
    return tile.select("chrom", "start", "donor", F.concat(F.substring("donor", 11, 9), F.lit("A"), F.substring("donor", 21, 13)).alias("guide")).filter(F.length("donor") > 0)


@query()
def fitting_alignment(spark, d):
    return _pairs(spark, d).select("chrom", "start", al.fitting_column(F.col("donor"), F.col("guide")).alias("a")).select("chrom", "start", "a.*")


@query()
def disruption_score(spark, d):
    return _pairs(spark, d).select("chrom", "start", al.disruption_column(F.col("donor"), F.col("guide"), F.lit("NGG")).alias("a")).select("chrom", "start", "a.*")


@query()
def edit_distance(spark, d):
    return _pairs(spark, d).select("chrom", "start", al.edit_distance_column(F.col("donor"), F.col("guide")).alias("distance"))


# ---- guides and donors ------------------------------------------------------------------------------------

_GUIDES = """, w AS (SELECT chrom, i, seq FROM genome, unnest(generate_series(0, length(seq) - 3)) AS u(i)),
g AS (SELECT chrom, i AS pam_first, '+' AS pam_strand, substring(seq, i + 1, 3) AS pam, substring(seq, i - 19, 20) AS guide FROM w WHERE i >= 20 UNION ALL
SELECT chrom, i, '-', translate(reverse(substring(seq, i + 1, 3)), 'ACGT', 'TGCA'), translate(reverse(substring(seq, i + 4, 20)), 'ACGT', 'TGCA') FROM w WHERE i + 23 <= length(seq)) SELECT * FROM g WHERE pam LIKE '_GG'"""


def _guides(spark, d):
    return guides.find_guides(p.genome(spark, d))


@query(_GUIDES, "genome")
def guide_search(spark, d):
    return _guides(spark, d).drop("target").withColumn("pam_first", F.col("pam_first").cast("long"))


@query(_GUIDES + " AND guide NOT LIKE '%TTTT%' AND guide NOT LIKE '%ACAC%'", "genome")
def guide_screens(spark, d):
    return guides.screened(_guides(spark, d), 3, ["ACAC"]).select("chrom", F.col("pam_first").cast("long").alias("pam_first"), "pam_strand", "pam", "guide")


@query()
def scored_guides(spark, d):
    """Each target's score is made from its text."""
    g = _guides(spark, d)
    spans = p.genome(spark, d).select(F.col("chrom").alias("orf"), "chrom", F.lit(60).alias("first"), F.lit(160).alias("last"))
    mm = lambda k: F.pmod(F.xxhash64("target", F.lit(k)), F.lit(2)).alias(f"m{k}")
    return guides.scored_guides(g, spans, g.select(F.col("target").alias("aseq"), mm(0), mm(1), mm(2)).distinct())


def _calls(spark, d):
    """A few variants inside each sequence: a substitution, a deletion and an insertion."""
    own = p.genome(spark, d).filter(F.length("seq") >= 160)
    at = own.withColumn("pos", F.explode(F.sequence(F.lit(60), F.length("seq") - 80, F.lit(37))))
    ref = F.substring("seq", F.col("pos"), 1 + F.col("pos") % 3)
    alt = F.when(F.col("pos") % 2 == 0, F.concat(F.translate(F.left(ref, F.lit(1)), "ACGT", "CATG"), F.lit("A"))).otherwise(F.translate(F.left(ref, F.lit(1)), "ACGT", "GTAC"))
    return at.select("chrom", F.col("pos").cast("long").alias("pos"), ref.alias("ref"), alt.alias("alt"))


@query()
def natural_variant_oligos(spark, d):
    return donors.natural_variant_oligos(_calls(spark, d), p.genome(spark, d))


@query()
def variant_statistics(spark, d):
    return donors.variant_statistics(natural_variant_oligos(spark, d))


def _synonyms():
    code = orfs.genetic_code()
    return {a: [c for c in code if code[c] == a] for a in code.values()}


def _frames(spark, d):
    """An ORF of twenty codons in each sequence, in one exon."""
    own = p.genome(spark, d).filter(F.length("seq") >= 300)
    cds = own.select(F.col("chrom").alias("orf"), "chrom", F.lit(130).alias("start"), F.lit(189).alias("end"), F.when(F.length("seq") % 2 == 0, "+").otherwise("-").alias("strand"), F.lit(0).alias("exon_ord"))
    return cds


def _library(spark, d):
    genome = p.genome(spark, d)
    codons = orfs.codons_of(_frames(spark, d), genome, whole=True)
    spots = codons.withColumn("upstream", F.explode(F.array(F.lit(True), F.lit(False)))).withColumn("coord", F.when(F.col("strand") == "+", F.col("coords")[0]).otherwise(F.col("coords")[2]))
    near = guides.proximal_guides(spots.select(F.concat_ws(":", "orf", "aa_num", "upstream").alias("key"), "chrom", "strand", "coord", "upstream"), _guides(spark, d))
    rows = donors.saturation_rows(codons, near, genome)
    return donors.saturation_library(rows, _synonyms(), {"GCT", "GAT", "AAA"})


@query()
def saturation_library(spark, d):
    return donors.combined_libraries([_library(spark, d)])


@query()
def saturation_oligos(spark, d):
    library = _library(spark, d)
    pools = donors.subpools(library.select("orf", "range_first", "range_last").distinct().withColumn("orf_first", F.lit(129)))
    return donors.library_oligos(library, pools, donors.Layout())


def _substitutions(spark, d):
    """Three edits of each frame: one alanine, two amino acids with others between, and a given codon."""
    orf = _frames(spark, d).select("orf")
    edit = lambda name, nums, aas, codons: orf.select(F.concat(F.col("orf"), F.lit(name)).alias("key"), "orf", F.array(*map(F.lit, nums)).alias("aa_nums"), F.array(*map(F.lit, aas)).alias("alt_aas"), (F.array(*map(F.lit, codons)) if codons else F.lit(None).cast("array<string>")).alias("alt_codons"))
    return edit(":a", [5], ["A"], None).unionByName(edit(":b", [9, 11], ["G", "K"], None)).unionByName(edit(":c", [14], ["L"], ["CTG"]))


_EDITS_SQL = """, k AS (SELECT unnest(['""" + "', '".join(orfs.genetic_code()) + "']) AS codon), t AS (SELECT codon, (" + _CODE + """)[codon] AS aa, row_number() OVER () AS ord FROM k),
g AS (SELECT chrom AS orf, CASE WHEN length(seq) % 2 = 0 THEN substring(seq, 130, 60) ELSE translate(reverse(substring(seq, 130, 60)), 'ACGT', 'TGCA') END AS s FROM genome WHERE length(seq) >= 300),
c AS (SELECT orf, i AS aa_num, substring(s, cast(i * 3 - 2 AS integer), 3) AS codon FROM g, unnest(generate_series(1, 20)) AS u(i)),
e AS (SELECT * FROM (VALUES (':a', 5, 'A', NULL), (':b', 9, 'G', NULL), (':b', 10, NULL, NULL), (':b', 11, 'K', NULL), (':c', 14, 'L', 'CTG')) AS v(name, aa_num, alt, given)),
x AS (SELECT concat(c.orf, e.name) AS key, c.aa_num, c.codon, coalesce(e.alt, r.aa) AS alt, e.given FROM c JOIN e USING (aa_num) JOIN t r ON r.codon = c.codon),
y AS (SELECT x.key, x.aa_num, x.codon, x.alt, coalesce(x.given, arg_max(t.codon, 100 * ((substring(t.codon, 1, 1) <> substring(x.codon, 1, 1))::INTEGER + (substring(t.codon, 2, 1) <> substring(x.codon, 2, 1))::INTEGER + (substring(t.codon, 3, 1) <> substring(x.codon, 3, 1))::INTEGER) - t.ord)) AS new FROM x JOIN t ON t.aa = x.alt GROUP BY x.key, x.aa_num, x.codon, x.alt, x.given)
SELECT key, string_agg(codon, ',' ORDER BY aa_num) AS ref_codons, string_agg(alt, ',' ORDER BY aa_num) AS alt_aas, string_agg(new, ',' ORDER BY aa_num) AS alt_codons FROM y GROUP BY key"""


@query(_EDITS_SQL, "genome")
def substitution_edits(spark, d):
    codons = orfs.codons_of(_frames(spark, d), p.genome(spark, d), one_based=True, whole=True)
    out = donors.substitution_edits(_substitutions(spark, d), codons, _synonyms())
    return out.select("key", *[F.array_join(c, ",").alias(c) for c in ("ref_codons", "alt_aas", "alt_codons")])


@query()
def substitution_oligos(spark, d):
    genome = p.genome(spark, d)
    codons = orfs.codons_of(_frames(spark, d), genome, one_based=True, whole=True)
    lists = codons.groupBy("orf", "chrom", "strand").agg(F.array_sort(F.collect_list(F.struct("aa_num", "codon", "coords"))).alias("x"))
    frames = lists.select("orf", "chrom", "strand", F.transform("x", lambda x: x["codon"]).alias("codons"), F.transform("x", lambda x: x["coords"]).alias("coords"))
    edits = donors.substitution_edits(_substitutions(spark, d), codons, _synonyms())
    near = guides.guides_for_edits(edits.select("key", "chrom", "strand", "left", "right", "mid"), guides.screened(_guides(spark, d), 4).withColumn("pam_coord", F.col("pam_first")))
    near = near.withColumn("s", orfs.synonymous_changes(F.col("left"), F.col("right"), F.col("pam_coord"), F.col("pam_strand")))
    listed = near.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", "guide", "pam", "pam_strand", F.col("pam_coord").cast("int").alias("pam_coord"), F.col("distance").cast("int").alias("distance"), "s.to_left", "s.to_right"))).alias("guides"))
    rows = edits.join(frames, ["orf", "chrom", "strand"]).join(listed, "key", "left")
    rows = guides.flanks(rows, genome, F.col("left") - 800, F.col("right") + 800)
    return donors.substitution_oligos(rows, _synonyms(), donors.Layout())


def _with_pam(seq: str) -> str:
    return "(" + " OR ".join(f"contains({seq}, g || '{b}GG') OR contains(translate(reverse({seq}), 'ACGT', 'TGCA'), g || '{b}GG')" for b in "ACTG") + ")"


@query(""", t AS (SELECT chrom, u.i::INTEGER AS start, substring(seq, u.i, 60) AS donor FROM genome, unnest(generate_series(1, greatest(length(seq), 1), 60)) AS u(i)),
x AS (SELECT chrom, start, donor, substring(donor, 11, 9) || 'A' || substring(donor, 21, 13) AS guide FROM t WHERE donor <> ''), y AS (SELECT *, left(guide, 20) AS g, guide || donor AS target FROM x)
SELECT chrom, start, NOT """ + _with_pam("donor") + " AND " + _with_pam("target") + " AS disrupted FROM y", "genome")
def disrupted_literally(spark, d):
    return _pairs(spark, d).select("chrom", "start", guides.disrupted_literally(F.substring("guide", 1, 20), F.col("donor"), F.concat(F.col("guide"), F.col("donor"))).alias("disrupted"))


@query(", c AS (SELECT unnest(['" + "', '".join(orfs.genetic_code()) + "']) AS codon), k AS (SELECT codon, (" + _CODE + """)[codon] AS aa, row_number() OVER () AS ord FROM c), x AS (SELECT a.codon, b.codon AS other, b.ord, (substring(a.codon, 1, 1) <> substring(b.codon, 1, 1))::INTEGER + (substring(a.codon, 2, 1) <> substring(b.codon, 2, 1))::INTEGER + (substring(a.codon, 3, 1) <> substring(b.codon, 3, 1))::INTEGER AS d FROM k a JOIN k b USING (aa))
SELECT codon, arg_max(other, d * 100 - ord) AS farthest, coalesce(arg_min(other, d * 100 + ord) FILTER (d > 0), codon) AS nearest FROM x GROUP BY codon""", "genome")
def synonym_choice(spark, d):
    """the synonyms that differ most and least."""
    table = orfs.codon_table(spark)
    lists = table.groupBy("aa").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "codon"))), lambda x: x["codon"]).alias("all"))
    return table.join(lists, "aa").select("codon", orfs.farthest(F.col("codon"), F.col("all")).alias("farthest"), orfs.nearest_other(F.col("codon"), F.col("all")).alias("nearest"))


@query(_SCAN + " SELECT chrom, mstart, mstart + 6 AS mend, least(s, a) AS mismatches FROM m WHERE s <= 1", "genome")
def motif_sites(spark, d):
    out = motifs.motif_sites(p.genome(spark, d), "ACRTNG", 1)
    return out.withColumns({c: F.col(c).cast("long") for c in ("mstart", "mend")})


#: Type by priority, gene and sense at each position of cov_r.
_GENE = _STAB.format("=").replace(", s AS", ", gs AS") + _STAB.format("<>").replace(", s AS", ", gz AS") + _PRIO.replace(", t AS", ", gt AS").replace("\nk AS", "\ngk AS") + """, gene AS (SELECT c.chrom, c.strand, c.pos, gk.type AS annotation_type, coalesce(s.gene_name, z.gene_name, 'intergenic') AS gene_name, coalesce(s.gene_id, z.gene_id, 'intergenic') AS gene_id, CASE WHEN s.k IS NULL AND z.k IS NOT NULL THEN 'antisense' ELSE 'sense' END AS sense
FROM gt c JOIN gk ON gk.k = c.k LEFT JOIN (SELECT * FROM gs WHERE k = 1) s ON s.chrom = c.chrom AND s.strand = c.strand AND s.pos = c.pos LEFT JOIN (SELECT * FROM gz WHERE k = 1) z ON z.chrom = c.chrom AND z.strand = c.strand AND z.pos = c.pos)
"""


@query(_GENE + "SELECT * FROM gene", "cov_r", "annotation", "atype")
def type_and_gene(spark, d):
    return annotate.type_and_gene(p.coverage(spark, d, "R").drop("reads"), p.types(spark, d), p.annotations(spark, d), PRIORITIES)



_AT_PEAK = " SELECT c.*, g.annotation_type, g.gene_name, g.gene_id, g.sense FROM {0} c JOIN gene g ON g.chrom = c.chrom AND g.strand = c.strand AND g.pos = c.peak_pos"


@query(_GROWN + _GENE + _AT_PEAK.format("grown"), "cov_r", "cov_a", "annotation", "atype")
def annotated_upregulated_clusters(spark, d):
    return _rounded(clusters.annotated_clusters(_grown_clusters(spark, d), p.types(spark, d), p.annotations(spark, d), PRIORITIES), "fold", "center_of_mass")


@query(_SITES + _GENE + _AT_PEAK.format("site"), "cov_r", "annotation", "atype")
def annotated_site_clusters(spark, d):
    return clusters.annotated_clusters(site_clusters(spark, d), p.types(spark, d), p.annotations(spark, d), PRIORITIES)


@query(_SITES + _GENE + _NEAR_LOOP + " SELECT c.*, g.annotation_type, g.gene_name, g.gene_id, g.sense, hl.l AS loop_pos, hl.l - c.seed AS loop_distance FROM site c JOIN gene g ON g.chrom = c.chrom AND g.strand = c.strand AND g.pos = c.seed LEFT JOIN hl ON hl.chrom = c.chrom AND hl.strand = c.strand AND hl.pos = c.seed AND hl.k = 1", "cov_r", "cov_n", "annotation", "atype")
def loop_clusters(spark, d):
    """W10."""
    return clusters.loop_clusters(p.coverage(spark, d, "R"), p.coverage(spark, d, "N"), p.types(spark, d), p.annotations(spark, d), PRIORITIES, 3, reach=50)
