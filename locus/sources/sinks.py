"""Writers of genomic text files. A file's rows are sorted over the whole table, by ranges, so that the parts
in the order of their names are the file; nothing is brought to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locus.functions.sequence import reverse_complement, substr0
from locus.operators.intervals import KEYS


def _tsv(df: DataFrame, path: str, order: list, header: bool = False) -> None:
    df.orderBy(*order).write.mode("overwrite").option("sep", "\t").option("header", header).option("quote", "").option("emptyValue", "").csv(path)


def number(x: Column) -> Column:
    """A number as text: whole ones with .0, no exponent up to sixteen digits."""
    whole = (x == F.floor(x)) & (F.abs(x) < 1e16)
    return F.when(whole, F.concat(x.cast("decimal(20,0)").cast("string"), F.lit(".0"))).otherwise(x.cast("string"))


def bedgraph(cov: DataFrame, path: str, factor: float = 1.0) -> None:
    """A row of one base for each position of one strand, sorted, values times ``factor``."""
    _tsv(cov.select("chrom", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"), number(F.col("reads") * factor).alias("reads")), path, ["chrom", "start"])


def motifs(hits: DataFrame, path: str) -> None:
    _tsv(hits.select("chrom", "mstart", "mend", "strand", "match", "mismatches"), path, ["chrom", "mstart", "mend"])


def annotated_peaks(peaks: DataFrame, path: str) -> None:
    _tsv(peaks.select("chrom", "pos", (F.col("pos") + 1).alias("end"), "strand"), path, ["chrom", "pos"])


def flanked(spans: DataFrame, genome: DataFrame, upstream: int = 100, downstream: int = 0) -> DataFrame:
    """spans (chrom, strand, start, end) with the sequence around: upstream and downstream as strands go."""
    plus = F.col("strand") == "+"
    a = F.col("start") - F.when(plus, upstream).otherwise(downstream)
    b = F.col("end") + F.when(plus, downstream).otherwise(upstream)
    text = substr0("seq", a, b)
    return spans.join(genome.select("chrom", "seq"), "chrom").withColumn("flank", F.when(plus, text).otherwise(reverse_complement(text))).drop("seq")


def fasta(rows: DataFrame, path: str, name: Column, seq: Column, order: list) -> None:
    rows.orderBy(*order).select(F.concat(F.lit(">"), name, F.lit("\n"), seq).alias("value")).write.mode("overwrite").text(path)


def members_text(members: Column) -> Column:
    """Linked variants as text: ((pos, 'REF', 'ALT'), ...)."""
    one = F.transform(members, lambda m: F.concat(F.lit("("), m["pos"].cast("string"), F.lit(", '"), m["ref"], F.lit("', '"), m["alt"], F.lit("')")))
    return F.concat(F.lit("["), F.array_join(one, ", "), F.lit("]"))


def variants(calls: DataFrame, path: str) -> None:
    """chrom, pos, ref, alt and members (those of linked variants, or the call itself)."""
    own = F.array(F.struct("pos", "ref", "alt"))
    members = F.col("members") if "members" in calls.columns else own
    _tsv(calls.select("chrom", "pos", "ref", "alt", members_text(members).alias("members")), path, ["chrom", "pos", "ref", "alt"])


def oligos(library: DataFrame, path: str, controls: int = 10) -> None:
    """A library sorted by amino acid; rows whose name says control come ``controls`` times."""
    n = F.when(F.contains(F.col("name"), F.lit("control")), controls).otherwise(1)
    rows = library.withColumn("__k", F.explode(F.sequence(F.lit(1), n))).drop("__k")
    _tsv(rows, path, ["aa_num", "name"], header=True)


def fastq(collapsed: DataFrame, path: str) -> None:
    """Collapsed reads, most frequent first; a read's name is its count."""
    rows = collapsed.orderBy(F.desc("n"), "first_ord")
    rows.select(F.concat(F.lit("@"), F.col("n").cast("string"), F.lit("\n"), "seq", F.lit("\n+\n"), "qual").alias("value")).write.mode("overwrite").text(path)


def list_text(column: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(column.cast("array<string>"), ", "), F.lit("]"))


def edit_outcomes(outcomes: DataFrame, path: str) -> None:
    """Seventeen columns; inserted bases stand twice."""
    text = lambda c: F.initcap(F.col(c).cast("string"))
    inserted = F.concat(F.lit("["), F.array_join(F.transform("inserted", lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))
    rows = outcomes.select("sample", "n", "chrom", text("perfect_match").alias("perfect"), "cigar", text("indel_in_guide").alias("indel"), "indel_distance", text("mismatch_in_guide").alias("mismatch"), "mismatch_distance", text("mismatch_in_donor").alias("donor"), "fraction", "soft_clipped", inserted.alias("inserted"), inserted.alias("inserted_again"), list_text(F.col("insertion_sites")).alias("insertions"), list_text(F.col("deletion_sites")).alias("deletions"), "seq")
    _tsv(rows, path, ["sample", F.desc("n"), "seq"])


def transcript_ends(ends: DataFrame, path: str) -> None:
    """strand, chrom, ORF, 5' end, first and last codon, 3' end."""
    _tsv(ends.select("strand", "chrom", "orf", "five", "first_codon", "last_codon", "three"), path, [*KEYS, "orf"])


def table(rows: DataFrame, path: str, order: list, header: bool = True) -> None:
    """Any other table: statistics, oligo information, pools, untargetable edits, key files."""
    _tsv(rows, path, order, header)
