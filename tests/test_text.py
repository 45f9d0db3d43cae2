import glob

from pyspark.sql import functions as F

from locus.sources import sinks, text


def put(tmp_path, name, content):
    (path := tmp_path / name).write_text(content)
    return str(path)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def read(path):
    return "".join(open(p).read() for p in sorted(glob.glob(f"{path}/part-*")))


def test_lines_are_numbered_over_splits_and_files(spark, tmp_path):
    for name, n in (("a.txt", 700), ("b.txt", 3)):
        put(tmp_path, name, "".join(f"{name} {i} {'x' * (i % 50)}\r\n" + "\n" * (i % 3 == 0) for i in range(n)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        got = text.lines(spark, [str(tmp_path / "b.txt"), str(tmp_path / "a.txt")]).orderBy("ord").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    want = []
    for f, (name, n) in enumerate((("a.txt", 700), ("b.txt", 3))):
        k = f << 40
        for i in range(n):
            want.append((f"{name} {i} {'x' * (i % 50)}", k))
            k += 1 + (i % 3 == 0)
    assert [tuple(r) for r in got] == want


def test_genomes(spark, tmp_path):
    p = put(tmp_path, "g.fa", ">chrI\nacgt\nAC\n>chrII\nGG\n>chrMito\nTT\n")
    assert rows(text.genome(spark, p), "chrom", "seq") == [("chrI", "ACGTAC"), ("chrII", "GG"), ("chrMito", "TT")]
    assert rows(text.genome(spark, p, stop_at_mito=True), "chrom", "seq") == [("chrI", "acgtAC"), ("chrII", "GG")]


def test_bedgraph(spark, tmp_path):
    p = put(tmp_path, "a.bg", "chrI\t1\t3\t5\nchrI\t2\t4\t7\nchrI\t9\t9\t1\nchrmt\t1\t2\t3\nchrII\t0\t1\tid\t2.5\n")
    assert rows(text.bedgraph(spark, p), "chrom", "pos", "reads") == [("chrI", 1, 5.0), ("chrI", 2, 7.0), ("chrI", 3, 7.0), ("chrII", 0, 2.5)]
    assert text.bedgraph(spark, p, include_mito=True).filter("chrom = 'chrmt'").count() == 1
    assert rows(text.bedgraph(spark, p, "-", chroms=["chrII"]), "strand", "pos") == [("-", 0)]
    sinks.bedgraph(text.bedgraph(spark, p), str(tmp_path / "out"), 2)
    assert read(tmp_path / "out") == "chrI\t1\t2\t10.0\nchrI\t2\t3\t14.0\nchrI\t3\t4\t14.0\nchrII\t0\t1\t5.0\n"


def test_annotation_rows(spark, tmp_path):
    p = put(tmp_path, "a.gff", "# c\nchrI\tSGD\tCDS\t3\t9\t.\t+\t0\tParent=a;Name=YA_CDS;x\nchrI\tSGD\tCDS\t20\t30\t.\t+\t0\tName=YA_CDS;\nchrmt\tSGD\tCDS\t1\t2\t.\t+\t0\tName=Q_CDS;\nbroken line\nchrI\tSGD\tCDS\tx\t2\t.\t+\t0\tName=Z_CDS;\n")
    g = text.gff(spark, p)
    assert g.count() == 3
    got = text.cds(g).orderBy("exon_ord").collect()
    assert [(r.orf, r.start, r.end) for r in got] == [("YA", 3, 9), ("YA", 20, 30)]


def test_variants_and_members(spark, tmp_path):
    p = put(tmp_path, "v.txt", "#CHROM POS\n4 10 A C 1 2 SNP s\nchr17 3 AT A 1 2 INDEL s\n")
    assert rows(text.variant_calls(spark, p), "chrom", "pos", "ref", "alt") == [("chrIV", 10, "A", "C"), ("chrM", 3, "AT", "A")]
    sinks.variants(text.variant_calls(spark, p), str(tmp_path / "out"))
    assert read(tmp_path / "out").splitlines()[0] == "chrIV\t10\tA\tC\t[(10, 'A', 'C')]"
    again = text.processed_variants(spark, str(tmp_path / "out"))
    assert rows(again, "chrom", "pos", "members") == [("chrIV", 10, "[(10, 'A', 'C')]"), ("chrM", 3, "[(3, 'AT', 'A')]")]


def test_guides_and_scores(spark, tmp_path):
    s = put(tmp_path, "s.txt", "pcid oseq aseq azimuth m0 m1 m2 m3 m4 m5\nchr4_+_7 O A 0.5 0 1 2 3 4 5\nchr4_-_8 O A 0.7 NA 1 2 3 4 5\n")
    (r,) = text.guide_scores(spark, s).collect()
    assert (r.aseq, r.chrom, r.strand, r.pos, r.azimuth, r.m0, r.m5) == ("A", "chrIV", "-", 8, 0.7, 20, 20)
    g = put(tmp_path, "g.txt", "chrom PAM_coord PAM_strand guide PAM\nchrI 5 + ACGT AGG\nchrI 6 + ACGT TTT\n")
    ok, no = text.guides(spark, g, ["AGG"]), text.guides(spark, g, ["AGG", "TTT"], allowed=False)
    assert rows(ok, "pam_coord", "allowed") == [(5, True)]
    assert rows(text.merged_guides(ok, no), "pam_coord", "allowed") == [(5, False), (6, False)]
    guide = "ACGATCGATCGATTACGATC"
    rec = spark.createDataFrame([("p", "A" * 40 + guide + "TGG" + "A" * 60)], "chrom string, seq string")
    assert guide in [r.guide for r in text.circular_guides(rec, ["TGG", "AGG"]).collect()]


def test_tables(spark, tmp_path):
    assert rows(text.codon_table(spark, put(tmp_path, "c", "ATG M\ngct A\n")), "codon", "aa") == [("ATG", "M"), ("GCT", "A")]
    assert rows(text.codon_frequencies(spark, put(tmp_path, "f", "aa codon n f x\nA gct 1 2 0.4\n")), "codon", "aa", "fraction") == [("GCT", "A", 0.4)]
    assert rows(text.primers(spark, put(tmp_path, "p", "ACGG\nTT\n")), "primer") == [("AA",), ("CCGT",)]
    assert rows(text.motifs(spark, put(tmp_path, "m", "c 1 4 + ACG 0\n")), "mstart", "match", "mismatches") == [(1, "ACG", "0")]
    s = text.substitutions(spark, put(tmp_path, "s", "Y1\tN\tL12A,K13*\r\nY1\tN\t5\tA\tC\nY1\tN\t5\tA\tC\tGCT\tTGT\nY1\tN\n")).orderBy("ord").collect()
    assert (list(s[0].aa_nums), list(s[0].ref_aas), list(s[0].alt_aas), s[0].alt_codons) == ([12, 13], ["L", "K"], ["A", "*"], None)
    assert list(s[1].aa_nums) == [5] and list(s[2].alt_codons) == ["TGT"] and s[3].error == "fields: 2"
    assert text.chromosomes(spark).count() == 32


def test_reads(spark, tmp_path):
    p = put(tmp_path, "a.fq", "@1\nACG\n+\nIII\n@2\nTT\n+\nJJ\n")
    assert rows(text.fastq(spark, p, "s"), "seq", "qual", "ord") == [("ACG", "III", 0), ("TT", "JJ", 1)]
    q = put(tmp_path, "a.sam", "@HD\n5\t0\tchrI\t7\t9\t3=\t*\t0\t0\tACG\tIII\n2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\n")
    assert rows(text.sam(spark, q), "n", "chrom", "pos", "cigar") == [(2, "*", 0, "*"), (5, "chrI", 7, "3=")]
    i = put(tmp_path, "t.txt", "1 + 10 90 5 7 Covering one intact ORF YAL001C\n1 + 10 90 5 7 other\n")
    assert rows(text.isoforms(spark, i), "chrom", "t5", "t3", "reads", "orf") == [("chrI", 10, 90, 5, "YAL001C")]
    c = spark.createDataFrame([("AC", 2, "II", 0), ("GG", 9, "JJ", 1), ("TT", 2, "KK", 2)], "seq string, n long, qual string, first_ord long")
    sinks.fastq(c, str(tmp_path / "fq"))
    assert read(tmp_path / "fq") == "@9\nGG\n+\nJJ\n@2\nAC\n+\nII\n@2\nTT\n+\nKK\n"


def test_beds_and_clusters(spark, tmp_path):
    p = put(tmp_path, "b.bed", "chrI\t5\t6\t+\nchrI\t9\t10\t-\n")
    out = spark.createDataFrame([("chrI", "+", 5)], "chrom string, strand string, pos int")
    assert rows(text.stranded_bed(spark, p, out), "start", "strand", "id") == [(9, "-", 1)]
    c = put(tmp_path, "c.tsv", "chromosome\tpeak\tcenter\tstrand\tn\tfold\nchrI\t5\t6.7\t+\t3\t2\nchrI\t5\t8.7\t+\t0\t2\n")
    assert rows(text.cluster_centers(spark, c), "start", "end") == [(6, 7)]


def test_flanks_and_libraries(spark, tmp_path):
    g = spark.createDataFrame([("c", "AACCGGTT")], "chrom string, seq string")
    s = spark.createDataFrame([("c", "+", 3, 5), ("c", "-", 3, 5)], "chrom string, strand string, start int, end int")
    f = sinks.flanked(s, g, 2, 1)
    assert rows(f, "strand", "flank") == [("+", "ACCGG"), ("-", "ACCGG")]
    sinks.fasta(f, str(tmp_path / "fa"), F.col("strand"), F.col("flank"), ["strand"])
    assert read(tmp_path / "fa") == ">+\nACCGG\n>-\nACCGG\n"
    lib = spark.createDataFrame([(2, "b_variant"), (1, "a_control")], "aa_num int, name string")
    sinks.oligos(lib, str(tmp_path / "lib"), 3)
    assert [x for x in read(tmp_path / "lib").splitlines() if not x.startswith("aa_num")] == ["1\ta_control"] * 3 + ["2\tb_variant"]
