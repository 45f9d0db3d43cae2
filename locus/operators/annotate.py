"""Annotation lookup, annotation tables from GTF and GFF rows, transcript ends, and sums by type.

Annotations stay intervals: chrom, strand, astart, aend (both within), gene_name, gene_id, region_type,
sequence_type and ord, the order in which the source lists them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locus.functions.sequence import adenosine_range, common_gene_name, gff_attribute, gtf_attribute, letter_numeral, mito
from locus.operators.coverage import positions
from locus.operators.intervals import KEYS, nearest_before, stab

#: The types that a coordinate lookup looks at.
LOOKUP_TYPES = ("intron", "exon", "5UTR", "3UTR")
#: The order in which a splice-site lookup prefers types.
SPLICE_TYPES = ("intron", "CDS", "5UTR", "3UTR")
#: Feature types other than genes that an annotation table takes from GFF.
MISC_TYPES = ("LTR_retrotransposon", "binding_site", "centromere", "ARS", "external_transcribed_spacer_region", "internal_transcribed_spacer_region", "long_terminal_repeat")


def other_strand(strand: Column) -> Column:
    return F.when(strand == "+", "-").when(strand == "-", "+").otherwise(strand)


def coordinate_annotation(sites: DataFrame, annotations: DataFrame, back: int = 20_000, types=LOOKUP_TYPES) -> DataFrame:
    """sites (chrom, strand, pos) with sequence_type, gene_name, gene_id and sense.

    An annotation counts if it starts at most ``back`` before the site and ends at most one before it. Of
    several the one that starts first wins, the last listed of those. Where none is found on the site's
    strand, the other strand is looked at, and sense is ``antisense``; else all are ``intergenic``.
    """
    own = annotations.filter(F.col("sequence_type").isin(list(types)))
    spans = own.select(*KEYS, F.col("astart").alias("__s"), F.least(F.col("aend") + 1, F.col("astart") + back - 1).alias("__e"), F.col("sequence_type").alias("__t"), F.col("gene_name").alias("__n"), F.col("gene_id").alias("__g"), "ord").filter("__s > 0")
    keyed = sites.select(*KEYS, "pos").distinct()
    best = F.max_by(F.struct("__t", "__n", "__g"), F.struct(-F.col("__s"), "ord"))
    sense = stab(keyed, "pos", spans, "__s", "__e").groupBy(*KEYS, "pos").agg(best.alias("x"))
    anti_spans = spans.withColumn("strand", other_strand(F.col("strand")))
    anti = stab(keyed, "pos", anti_spans, "__s", "__e").groupBy(*KEYS, "pos").agg(best.alias("y"))
    found = sites.join(sense, [*KEYS, "pos"], "left").join(anti, [*KEYS, "pos"], "left")
    pick = lambda f: F.when(F.col("x").isNotNull(), F.col(f"x.{f}")).when(F.col("y").isNotNull(), F.col(f"y.{f}")).otherwise("intergenic")
    side = F.when(F.col("x").isNull() & F.col("y").isNotNull(), "antisense").otherwise("sense")
    return found.select(*sites.columns, pick("__t").alias("sequence_type"), pick("__n").alias("gene_name"), pick("__g").alias("gene_id"), side.alias("sense"))


def splice_annotation(sites: DataFrame, annotations: DataFrame, genome: DataFrame | None = None, back: int = 10_000) -> DataFrame:
    """sites with splice_site (annotated or unannotated), region_type, sequence_type, gene_name and sense.

    The nearest annotation that starts up to two after the site, within ``back``, is looked at; of several
    with that start the last listed. A site within five of an intron's start (plus strand) or end is an
    annotated splice site; one up to two beyond the end is within. Without a CDS found so, annotations of
    the other strand follow, the nearest before the site, the first listed that reaches it. With a genome
    (chrom, seq) sites first slide over templated adenosines.
    """
    at = F.col("pos")
    if genome is not None:
        sites = sites.join(genome.select("chrom", "seq"), "chrom", "left")
        slid = adenosine_range("strand", "seq", at)
        sites = sites.withColumn("__at", F.when(F.col("strand") == "+", slid["last"]).otherwise(slid["first"])).drop("seq")
    else:
        sites = sites.withColumn("__at", at)
    keyed = sites.select(*KEYS, "pos", "__at").distinct()
    spans = annotations.select(*KEYS, F.col("astart").alias("__s"), F.col("aend").alias("__e"), "gene_name", "sequence_type", "region_type", "ord")
    entry = F.struct("__s", "__e", "gene_name", "sequence_type", "region_type")
    near = nearest_before(keyed.withColumn("__up", F.col("__at") + 2), "__up", spans, "__s", "__near").filter(F.col("__near") > F.col("__at") - back)
    last = spans.groupBy(*KEYS, F.col("__s").alias("__near")).agg(F.max_by(entry, "ord").alias("o"))
    own = near.join(last, [*KEYS, "__near"]).select(*KEYS, "pos", "__at", "o")
    hit = F.col("o").isNotNull() & (F.col("__at") <= F.col("o.__e") + 2)
    edge = F.when(F.col("strand") == "+", F.col("o.__s")).otherwise(F.col("o.__e"))
    label = F.when(F.contains(F.col("o.sequence_type"), F.lit("intron")) & (F.abs(F.col("__at") - edge) < 5), "annotated splice site").otherwise("unannotated splice site")
    back_spans = spans.withColumn("strand", other_strand(F.col("strand")))
    starts = nearest_before(keyed.select(*KEYS, "pos").distinct(), "pos", back_spans, "__s", "__near").filter(F.col("__near") > F.col("pos") - back)
    reach = starts.withColumnRenamed("__near", "__s").join(back_spans.filter(F.col("sequence_type").isin(list(SPLICE_TYPES))), [*KEYS, "__s"]).filter(F.col("pos") <= F.col("__e"))
    anti = reach.groupBy(*KEYS, "pos").agg(F.min_by(F.struct("gene_name", "sequence_type", "region_type"), "ord").alias("a"))
    out = sites.join(own, [*KEYS, "pos", "__at"], "left").join(anti, [*KEYS, "pos"], "left").withColumn("__hit", hit)
    coding = F.col("__hit") & (F.col("o.sequence_type") == "CDS")
    use_anti = ~F.coalesce(coding, F.lit(False)) & F.col("a").isNotNull()
    pick = lambda f: F.when(use_anti, F.col(f"a.{f}")).when(F.col("__hit"), F.col(f"o.{f}")).otherwise("intergenic")
    sense = F.when(use_anti, "antisense").when(F.col("__hit"), "sense").otherwise("intergenic")
    return out.select(*[c for c in sites.columns if c != "__at"], F.coalesce(label, F.lit("unannotated splice site")).alias("splice_site"), *[pick(f).alias(f) for f in ("region_type", "sequence_type", "gene_name")], sense.alias("sense"))


def priority_type(sites: DataFrame, types: DataFrame, priorities: list[str]) -> DataFrame:
    """sites with annotation_type: the first of ``priorities`` that an interval of types (chrom, strand,
    tstart, tend without its end, type) at the site has; ``intergenic`` where there is none. Priorities may
    repeat; one that is a part of the word intergenic holds for sites without any type."""
    order = {t: i for i, t in reversed(list(enumerate(priorities)))}
    spans = types.filter(F.col("type").isin(list(order))).select(*KEYS, "tstart", (F.col("tend") - 1).alias("__last"), "type")
    rank = F.create_map(*[F.lit(x) for kv in order.items() for x in kv]) if order else F.create_map().cast("map<string,int>")
    keyed = sites.select(*KEYS, "pos").distinct()
    best = stab(keyed, "pos", spans, "tstart", "__last").groupBy(*KEYS, "pos").agg(F.min(F.try_element_at(rank, F.col("type"))).alias("__rank"))
    any_type = stab(keyed, "pos", types.select(*KEYS, "tstart", (F.col("tend") - 1).alias("__last")), "tstart", "__last", how="left_semi").withColumn("__any", F.lit(True))
    part = next((p for p in priorities if p in "intergenic"), "intergenic")
    out = sites.join(best, [*KEYS, "pos"], "left").join(any_type, [*KEYS, "pos"], "left")
    name = F.try_element_at(F.array(*map(F.lit, priorities)), F.col("__rank") + 1) if priorities else F.lit(None).cast("string")
    none = F.when(F.col("__any").isNull(), F.lit(part)).otherwise("intergenic")
    return out.withColumn("annotation_type", F.coalesce(name, none)).drop("__rank", "__any")


def type_and_gene(sites: DataFrame, types: DataFrame, annotations: DataFrame, priorities: list[str]) -> DataFrame:
    """sites with annotation_type, and gene_name, gene_id and sense of the coordinate lookup."""
    named = coordinate_annotation(sites.select(*KEYS, "pos").distinct(), annotations).drop("sequence_type")
    return priority_type(sites, types, priorities).join(named, [*KEYS, "pos"])


def type_distribution(sites: DataFrame, types: DataFrame, priorities: list[str], by_mass: bool = True) -> DataFrame:
    """For each priority the sum of reads (or the number) of sites with that type, zeros too, ascending."""
    spark = sites.sparkSession
    order = list(dict.fromkeys(priorities))
    value = F.sum("reads") if by_mass else F.count(F.lit(1)).cast("double")
    sums = priority_type(sites, types, order).groupBy(F.col("annotation_type").alias("type")).agg(value.alias("v"))
    dim = spark.range(len(order)).select(F.element_at(F.array(*map(F.lit, order)), (F.col("id") + 1).cast("int")).alias("type"), F.col("id").alias("prio"))
    return dim.join(sums, "type", "left").select("type", F.coalesce("v", F.lit(0.0)).alias("value"), "prio").orderBy("value", "prio").drop("prio")


def combined_types(distribution: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """The distribution summed by groups of types; a type in several groups, or twice in one, counts in each."""
    pairs = [(k, t, i) for i, (k, ts) in enumerate(groups.items()) for t in ts]
    dim = distribution.sparkSession.createDataFrame(pairs, "grp string, type string, i int")
    return F.broadcast(dim).join(distribution, "type", "left").groupBy("grp", "i").agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("value")).orderBy("value", "i").drop("i")


def three_prime_flanks(annotations: DataFrame, types: list[str], flank: int = 15) -> DataFrame:
    """The positions within ``flank`` of the 3' end of annotations of some types (plus: end, minus: start)."""
    end = F.when(F.col("strand") == "+", F.col("aend")).otherwise(F.col("astart"))
    spans = annotations.filter(F.col("sequence_type").isin(types)).withColumn("__end", end)
    return positions(spans, F.col("__end") - flank, F.col("__end") + flank).select(*KEYS, "pos").distinct()


# ---- from GTF and GFF rows (chrom, source, type, start, end, score, strand, frame, attributes, ord) --------


def features_from_gtf(rows: DataFrame, region: str, containing: str = "", no_mito: bool = True) -> DataFrame:
    """One feature for each gene_id of rows whose source is ``region``: its first start and greatest end."""
    own = rows.filter((F.col("source") == region) & F.contains(F.col("attributes"), F.lit(containing)))
    own = own.filter(~mito("chrom", "upper")) if no_mito else own
    own = own.withColumn("strand", F.when(F.col("strand") == ".", "+").otherwise(F.col("strand"))).withColumn("feature_id", gtf_attribute("attributes", "gene_id"))
    return own.groupBy(*KEYS, "feature_id").agg(F.min_by("start", "ord").alias("fstart"), F.max("end").alias("fend"))


def features_from_gff(rows: DataFrame, kind: str, containing: str = "") -> DataFrame:
    """The same of GFF rows of a type; named by ID, else by Parent; mitochondrial rows are left out."""
    own = rows.filter((F.col("type") == kind) & F.contains(F.col("attributes"), F.lit(containing)) & (F.col("chrom") != "chrmt"))
    own = own.withColumn("feature_id", F.coalesce(gff_attribute("attributes", "ID"), gff_attribute("attributes", "Parent"))).withColumn("strand", F.when(F.col("strand") == ".", "+").otherwise(F.col("strand")))
    return own.groupBy(*KEYS, "feature_id").agg(F.min_by("start", "ord").alias("fstart"), F.max("end").alias("fend"))


def _on_both(rows: DataFrame) -> DataFrame:
    return rows.withColumn("strand", F.explode(F.when(F.col("strand") == ".", F.array(F.lit("+"), F.lit("-"))).otherwise(F.array("strand"))))


def annotations_from_gtf(rows: DataFrame) -> DataFrame:
    """All rows but chromosomes as annotations; those without a strand on both."""
    own = _on_both(rows.filter("source <> 'chromosome' AND type <> 'chromosome'"))
    name = F.coalesce(gtf_attribute("attributes", "gene_name"), gtf_attribute("attributes", "gene_id"))
    return own.select(*KEYS, F.col("start").alias("astart"), F.col("end").alias("aend"), name.alias("gene_name"), gtf_attribute("attributes", "gene_id").alias("gene_id"), F.col("source").alias("region_type"), F.col("type").alias("sequence_type"), "ord")


def annotations_from_gff(rows: DataFrame) -> DataFrame:
    """The same of GFF rows; named by Name, ID, Parent, or intergenic."""
    own = _on_both(rows.filter("type <> 'chromosome'"))
    key = F.coalesce(gff_attribute("attributes", "ID"), gff_attribute("attributes", "Parent"))
    name = F.coalesce(gff_attribute("attributes", "Name"), key, F.lit("intergenic"))
    return own.select(*KEYS, F.col("start").alias("astart"), F.col("end").alias("aend"), name.alias("gene_name"), key.alias("gene_id"), F.col("source").alias("region_type"), F.col("type").alias("sequence_type"), "ord")


def gene_names(rows: DataFrame, to_common: bool = True, closed: bool = True) -> DataFrame:
    """Systematic and common names of GFF genes; of one that comes again the last row counts."""
    own = rows.filter((F.col("type") == "gene") & ~mito("chrom", "exact"))
    named = own.select(gff_attribute("attributes", "ID", closed).alias("systematic"), common_gene_name("attributes", closed).alias("common"), "ord")
    key, value = ("systematic", "common") if to_common else ("common", "systematic")
    return named.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(value, "ord").alias(value))


# ---- transcript ends --------------------------------------------------------------------------------------


def weighted_end(isoforms: DataFrame, key, end: str, descending: Column, fraction: float, name: str) -> DataFrame:
    """For each key the first end, going outwards from the gene, at which the reads summed so far are
    ``fraction`` of all."""
    step = F.when(descending, -F.col(end)).otherwise(F.col(end))
    sums = isoforms.withColumn("__step", step).groupBy(*key, end, "__step").agg(F.sum("reads").alias("reads"))
    along = Window.partitionBy(*key).orderBy("__step")
    share = F.sum("reads").over(along.rowsBetween(Window.unboundedPreceding, 0)) / F.sum("reads").over(Window.partitionBy(*key))
    return sums.withColumn("__share", share).filter(F.col("__share") >= fraction).groupBy(*key).agg(F.min_by(end, "__step").alias(name))


def misprimed(genome: DataFrame, isoforms: DataFrame, ahead: int = 10, most_g: int = 4, most_ct: int = 1) -> DataFrame:
    """isoforms with misprimed: whether the bases after the 3' end are so rich in A (and G) that the end may
    come from priming within the transcript. Plus: the ahead - 1 bases after; minus: the ahead before."""
    plus = F.col("strand") == "+"
    after = F.substring("seq", F.col("t3") + 2, F.lit(ahead - 1))
    first = F.greatest(F.col("t3") - ahead, F.lit(0))
    bases = F.when(plus, after).otherwise(F.substring("seq", first + 1, F.col("t3") - first))
    a, g = F.when(plus, F.regexp_count(bases, F.lit("A"))).otherwise(F.regexp_count(bases, F.lit("T"))), F.when(plus, F.regexp_count(bases, F.lit("G"))).otherwise(F.regexp_count(bases, F.lit("C")))
    return isoforms.join(genome.select("chrom", "seq"), "chrom").withColumn("misprimed", (g <= most_g) & (F.length(bases) - a - g <= most_ct)).drop("seq")


def transcript_ends(isoforms: DataFrame, fraction: float = 0.95) -> DataFrame:
    """five and three, the transcript ends of each ORF that hold ``fraction`` of its reads."""
    own, key = isoforms.filter("reads > 0"), ["strand", "chrom", "orf"]
    plus = F.col("strand") == "+"
    five = weighted_end(own, key, "t5", plus, fraction, "five")
    three = weighted_end(own, key, "t3", ~plus, fraction, "three")
    return five.join(three, key)


def utr_annotations(ends: DataFrame, codons: DataFrame) -> DataFrame:
    """UTRs as annotations, from transcript ends and the first and last codon of each ORF (strand, orf,
    gene_name, first_codon, last_codon); the chromosome is that of the systematic name's second letter."""
    named = ends.drop("chrom").join(codons, ["strand", "orf"]).withColumn("chrom", letter_numeral(F.substring("orf", 2, 1))).filter("chrom IS NOT NULL")
    plus = F.col("strand") == "+"
    five = F.struct(F.when(plus, F.col("five")).otherwise(F.col("first_codon")).alias("astart"), F.when(plus, F.col("first_codon")).otherwise(F.col("five")).alias("aend"), F.lit("5UTR").alias("sequence_type"))
    three = F.struct(F.when(plus, F.col("last_codon")).otherwise(F.col("three")).alias("astart"), F.when(plus, F.col("three")).otherwise(F.col("last_codon")).alias("aend"), F.lit("3UTR").alias("sequence_type"))
    return named.withColumn("x", F.explode(F.array(five, three))).select("chrom", "strand", "x.astart", "x.aend", "gene_name", F.col("orf").alias("gene_id"), F.lit("protein_coding_gene").alias("region_type"), "x.sequence_type")


def all_annotations(utrs: DataFrame, gff: DataFrame, gtf: DataFrame, pad: int = 50) -> DataFrame:
    """UTRs, introns of GFF and exons of GTF; exons of unstable transcripts are padded on both sides."""
    introns = annotations_from_gff(gff.filter("type = 'intron'")).select(*KEYS, "astart", (F.col("aend") + 1).alias("aend"), "gene_name", "gene_id", "region_type", "sequence_type", (F.col("ord") + (1 << 40)).alias("ord"))
    exons = annotations_from_gtf(gtf.filter("type = 'exon'"))
    loose = F.when(F.col("region_type").isin("CUTs", "SUTs", "XUTs"), pad).otherwise(0)
    exons = exons.select(*KEYS, (F.col("astart") - loose).alias("astart"), (F.col("aend") + 1 + loose).alias("aend"), "gene_name", "gene_id", "region_type", "sequence_type", (F.col("ord") + (1 << 41)).alias("ord"))
    return utrs.withColumn("ord", F.lit(0).cast("long")).unionByName(introns).unionByName(exons)


def annotation_types(gtf: DataFrame, gff: DataFrame, ends: DataFrame, unstable_pad: int = 50, utr_pad: int = 50, misc_pad: int = 100, snorna: int = 300, trna: int = 100, inclusive: bool = True) -> DataFrame:
    """chrom, strand, tstart, tend (without it) and type of everything that a position can be annotated as:
    parts of protein-coding genes with introns between exons, UTR ends corrected by transcript ends (only
    outwards if ``inclusive``) and UTRs made where there are none, stop codons counted to the CDS, 3' UTRs
    padded, CDS on the other strand; other transcripts, with regions up- and downstream of snoRNA and tRNA
    genes; and other features, padded (on the minus strand twice where they have no strand)."""
    rows = gtf.select("chrom", "strand", F.col("source").alias("region"), F.col("type").alias("part"), F.col("start").alias("s"), (F.col("end") + 1).alias("e"), gtf_attribute("attributes", "gene_id").alias("orf"), "ord")
    coding = rows.filter("region = 'protein_coding'")
    plus = F.col("strand") == "+"
    chrom_of = coding.groupBy("strand", "orf").agg(F.min_by("chrom", "ord").alias("chrom"))
    exons = coding.filter(F.contains(F.col("part"), F.lit("exon")))
    after = Window.partitionBy("strand", "orf").orderBy("s", "e")
    introns = exons.withColumn("next", F.lead("s").over(after)).filter("next IS NOT NULL").select("strand", "orf", F.lit("intron").alias("part"), F.col("e").alias("s"), F.col("next").alias("e"))
    parts = coding.select("strand", "orf", "part", "s", "e").unionByName(introns).join(ends.select("strand", "orf", "five", "three"), ["strand", "orf"], "left")
    out3 = lambda old, new, wider: F.when(F.col("three").isNotNull() & (wider if inclusive else F.lit(True)), new).otherwise(old)
    out5 = lambda old, new, wider: F.when(F.col("five").isNotNull() & (wider if inclusive else F.lit(True)), new).otherwise(old)
    is3, is5 = F.contains(F.col("part"), F.lit("3UTR")), F.contains(F.col("part"), F.lit("5UTR"))
    s, e, five, three = (F.col(x) for x in ("s", "e", "five", "three"))
    new_s = F.when(is3 & ~plus, out3(s, three, three < s)).when(is5 & plus, out5(s, five, five < s)).otherwise(s)
    new_e = F.when(is3 & plus, out3(e, three, three > e)).when(is5 & ~plus, out5(e, five, five > e)).otherwise(e)
    corrected = parts.select("strand", "orf", "part", new_s.alias("s"), new_e.alias("e"))
    has = coding.groupBy("strand", "orf").agg(F.max(is3).alias("has3"), F.max(is5).alias("has5"), *[F.max_by(F.when(plus, F.col(a)).otherwise(F.col(b)), F.when(F.contains(F.col("part"), F.lit(p)), F.col("ord"))).alias(n) for n, p, a, b in (("start", "start_codon", "s", "e"), ("stop", "stop_codon", "e", "s"))])
    made = has.join(ends.select("strand", "orf", "five", "three"), ["strand", "orf"])
    made3 = made.filter("NOT has3").select("strand", "orf", F.lit("3UTR").alias("part"), F.when(plus, F.col("stop")).otherwise(three).alias("s"), F.when(plus, three).otherwise(F.col("stop")).alias("e"))
    made5 = made.filter("NOT has5").select("strand", "orf", F.lit("5UTR").alias("part"), F.when(plus, five).otherwise(F.col("start")).alias("s"), F.when(plus, F.col("start")).otherwise(five).alias("e"))
    genes = corrected.unionByName(made3).unionByName(made5).join(chrom_of, ["strand", "orf"])
    more = F.when(F.col("part") == "CDS", 3).when(F.col("part") == "3UTR", utr_pad).otherwise(0)
    genes = genes.select("chrom", "strand", F.when(plus, s).otherwise(s - more).alias("tstart"), F.when(plus, e + more).otherwise(e).alias("tend"), F.col("part").alias("type"))
    anti = genes.filter("type = 'CDS'").withColumns({"strand": other_strand(F.col("strand")), "type": F.lit("antisense_CDS")})

    loose = F.when(F.col("region").isin("CUTs", "SUTs", "XUTs"), unstable_pad).otherwise(0)
    other = rows.filter("region <> 'protein_coding'").select("chrom", "strand", F.col("region").alias("type"), (s - loose).alias("tstart"), (e + loose).alias("tend"))
    beside = F.when(F.col("type") == "snoRNA", snorna).when(F.col("type") == "tRNA", trna)
    near = other.withColumn("n", beside).filter("n IS NOT NULL")
    side = lambda name, low: near.select("chrom", "strand", F.concat_ws("_", "type", "n", F.lit(f"nt_{name}")).alias("type"), F.when(low, F.col("tstart") - F.col("n")).otherwise(F.col("tend")).alias("tstart"), F.when(low, F.col("tstart")).otherwise(F.col("tend") + F.col("n")).alias("tend"))
    kinds = gff.filter(F.col("type").isin(list(MISC_TYPES))).select("chrom", "strand", "type", "start", "end")
    pads = F.when(F.col("strand") == ".", F.array(F.struct(F.lit("+").alias("on"), F.lit(misc_pad).alias("pad")), F.struct(F.lit("-").alias("on"), F.lit(2 * misc_pad).alias("pad")))).otherwise(F.array(F.struct(F.col("strand").alias("on"), F.lit(misc_pad).alias("pad"))))
    misc = kinds.withColumn("x", F.explode(pads)).select("chrom", F.col("x.on").alias("strand"), "type", (F.col("start") - F.col("x.pad")).alias("tstart"), (F.col("end") + 1 + F.col("x.pad")).alias("tend"))
    out = genes.unionByName(anti)
    for part in (other, side("downstream", ~plus), side("upstream", plus), misc):
        out = out.unionByName(part)
    return out.filter("tend > tstart")
