"""Sources on files written by the tests."""

import gzip
import struct

import pytest
from pyspark.sql import functions as F

from tallyloom.sources import alignments, annotation, fastq, sequences, tables
from tallyloom.streaming.metrics import newest_rows, running_molecules, windowed_metrics


def _fastq(path, names, tag):
    text = "".join(f"@{n}/{tag} extra\nACGT{'A' * i}\n+\n@III{'I' * i}\n" for i, n in enumerate(names))
    path.write_bytes(gzip.compress(text.encode()) if path.suffix == ".gz" else text.encode())
    return str(path)


def test_fastq(spark, tmp_path):
    a = _fastq(tmp_path / "x_S1_L001_R1_001.fastq.gz", ["r1", "r2", "r3"], 1)
    b = _fastq(tmp_path / "x_S1_L001_R2_001.fastq", ["r3", "r1", "r2"], 2)
    pairs = fastq.read_pairs(spark, [a], [b])
    assert {r.read_id: (len(r.r1_seq), len(r.r2_seq)) for r in pairs.collect()} == {"r1": (4, 5), "r2": (5, 6), "r3": (6, 4)}
    out = tmp_path / "out"
    fastq.as_lines(fastq.read_fastq(spark, [a])).coalesce(1).write.text(str(out))
    again = fastq.read_fastq(spark, [str(p) for p in out.glob("part-*")])
    assert sorted(r.seq for r in again.collect()) == ["ACGT", "ACGTA", "ACGTAA"]
    with pytest.raises(Exception, match="without a partner"):
        fastq.read_pairs(spark, [a], [_fastq(tmp_path / "y.fastq", ["r1"], 2)]).collect()
    bad = tmp_path / "bad.fastq"
    bad.write_text("@r\nACGT\n+\nII\n")
    with pytest.raises(Exception, match="damaged"):
        fastq.read_fastq(spark, [str(bad)]).collect()
    files = spark.createDataFrame([("x_S1_L001_R1_001.fastq.gz",), ("x_S1_L001_R2_001.fastq.gz",), ("y_R1.fq",), ("notes.txt",)], "name string")
    assert {(r.library, r.lane, r.r1, r.r2) for r in fastq.paired_files(files).collect()} == {("x", "001", "x_S1_L001_R1_001.fastq.gz", "x_S1_L001_R2_001.fastq.gz"), ("y", "-", "y_R1.fq", None)}


def test_subsample(spark):
    df = spark.range(10_000).withColumnRenamed("id", "read_id")
    assert 2_000 < fastq.subsample(df, 0.25).count() < 3_000
    assert fastq.subsample(df, 0.25).count() == fastq.subsample(df.repartition(7), 2_500, 10_000).count()
    with pytest.raises(ValueError, match="more reads"):
        fastq.subsample(df, 20_000, 10_000)


def _bam(path):
    def record(name, flag, ref, pos, ops, seq, tags):
        packed = bytes((("=ACMGRSVTWYHKDBN".index(seq[i]) << 4) | ("=ACMGRSVTWYHKDBN".index(seq[i + 1]) if i + 1 < len(seq) else 0)) for i in range(0, len(seq), 2))
        body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, 60, 0, len(ops), flag, len(seq), -1, -1, 0) + name.encode() + b"\0"
        body += b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(o)) for n, o in ops) + packed + b"\xff" * len(seq) + tags
        return struct.pack("<i", len(body)) + body

    head = b"BAM\x01" + struct.pack("<i", 4) + b"@HD\t"[:4] + struct.pack("<i", 1) + struct.pack("<i", 5) + b"chr1\0" + struct.pack("<i", 1000)
    rows = record("q1", 0, 0, 9, [(3, "S"), (5, "M")], "ACGTACGTA"[:8], b"CBZ1-2-3\0" + b"NHC\x01" + b"BCBs\x02\x00\x00\x00\x05\x00\xff\xff") + record("q2", 4, -1, -1, [], "ACG", b"XAAx")
    path.write_bytes(gzip.compress(head) + gzip.compress(rows))
    return str(path)


def test_bam(spark, tmp_path):
    got = {r.read_id: r for r in alignments.read_bam(spark, [_bam(tmp_path / "a.bam")]).collect()}
    assert (got["q1"].reference, got["q1"].position, got["q1"].cigar, got["q1"].seq) == ("chr1", 10, "3S5M", "ACGTACGT")
    assert got["q1"].tags == {"CB": "1-2-3", "NH": "1", "BC": "5,-1"}
    assert (got["q2"].reference, got["q2"].position, got["q2"].cigar, got["q2"].tags) == (None, None, None, {"XA": "x"})


def test_sam(spark):
    lines = spark.createDataFrame([("@SQ\tSN:1",), ("q\t16\t*\t0\t0\t*\t*\t0\t0\tACG\t*\tNH:i:1\tCB:Z:a:b",), ("short",), ("",)], "value string")
    r = alignments.parse_sam(lines).collect()
    assert len(r) == 1 and r[0].reference is None and r[0].tags == {"NH": "1", "CB": "a:b"}
    tagged = alignments.with_tag(alignments.with_tag(alignments.parse_sam(lines), "MA", F.lit("X")), "NO", F.lit(None).cast("string"))
    assert tagged.first().tags == {"NH": "1", "CB": "a:b", "MA": "X"}


def test_annotation(spark):
    gtf = '1\tx\texon\t5\t9\t.\t+\t.\tgene_id "g 1"; tag "a"; tag "b"; gene_name "N";'
    lines = spark.createDataFrame([("##species Z",), ("#note",), ("",), (gtf,), (gtf.replace("+", ".").replace("exon", "gene"),)], "value string")
    f = annotation.parse_features(lines)
    assert f.first().attributes == {"gene_id": "g 1", "tag": "b", "gene_name": "N"}
    assert [tuple(r) for r in annotation.metadata(lines).collect()] == [("species", "Z")]
    assert annotation.countable_features(f).first().feature == "N"
    with pytest.raises(Exception, match="no strand"):
        annotation.countable_features(f, "gene").collect()
    back = annotation.parse_features(annotation.as_lines(f))
    assert sorted(map(str, back.collect())) == sorted(map(str, f.collect()))


def test_fasta(spark, tmp_path):
    p = tmp_path / "a.fa"
    p.write_text(">a one\nACG\nT\n>b\n\n>c x>y\nGG\n")
    got = {r.name: r.seq for r in sequences.read_fasta(spark, str(p)).collect()}
    assert got == {"a": "ACGT", "b": "", "c": "GG"}
    s = sequences.completed_reference(sequences.read_fasta(spark, str(p)), "bulk", 3)
    assert {r.name: r.seq for r in s.collect()} == {"a|bulk": "ACGTAAA", "b|bulk": "AAA", "c|bulk": "GGAAA"}


def test_positional_and_matrix(spark, tmp_path):
    p = tmp_path / "a.csv.gz"
    p.write_bytes(gzip.compress(b"x,1\nA,2\n*,3\n"))
    got = tables.read_positional(spark, str(p), "label string, n int", missing=tables.MISSING).collect()
    assert [tuple(r) for r in got] == [(None, 1), ("A", 2), (None, 3)]
    for name, text in (("m.mtx", "%%MatrixMarket\n%c\n2 3 3\n1 1 5\n2 3 7\n2 2 3\n"), ("m.rows", "r1\nr2\n"), ("m.cols", "c1\nc2\nc3\n")):
        (tmp_path / name).write_text(text)
    m = tables.read_matrix_market(spark, *(str(tmp_path / n) for n in ("m.mtx", "m.rows", "m.cols")))
    assert {tuple(r) for r in m.collect()} == {("r1", "c1", 5.0), ("r2", "c3", 7.0), ("r2", "c2", 3.0)}


def test_sectioned_report_and_lists(spark):
    lines = ["####", "## Sample: s", *tables.section_lines("One", ["a", "b"], [[1, None], [2, "x"]]), *tables.section_lines("Two", ["c"], [[3]])]
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "file string, line_no int, value string")
    got = {(r.section, r.row_no, r.metric): r.value for r in tables.section_metrics(tables.parse_sections(df)).collect()}
    assert got == {("One", 1, "a"): "1", ("One", 1, "b"): "NA", ("One", 2, "a"): "2", ("One", 2, "b"): "x", ("Two", 1, "c"): "3"}
    assert tables.run_header(lines) == {"Sample": "s"}
    assert tables.sample_list([{"data_folder": "../x", "use_as_ref": "TRUE"}, {"data_folder": "/y"}], "/a/b") == [{"data_folder": "/a/x", "use_as_ref": True}, {"data_folder": "/y", "use_as_ref": False}]


def test_streams(spark, tmp_path):
    rows = [("k1", "2023-01-01 00:10:00", "l", True), ("k2", "2023-01-01 00:50:00", "l", False), ("k1", "2023-01-01 00:20:00", "l", True), ("k3", "2023-01-01 01:10:00", "l", True)]
    df = spark.createDataFrame(rows, "k string, t string, lib string, ok boolean").withColumn("t", F.to_timestamp("t"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    for name, frame, mode in (("m", windowed_metrics(stream, "t", "lib", {"ok": F.col("ok")}), "complete"), ("n", newest_rows(stream, "k", "t"), "append"), ("r", running_molecules(stream, "lib", "k", "k"), "complete")):
        frame.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination()
    assert sorted((r.window_start.hour, r.reads, r.ok) for r in spark.table("m").collect()) == [(0, 3, 2), (1, 1, 1)]
    assert spark.table("n").count() == 3
    assert sorted(r.raw_reads for r in spark.table("r").collect()) == [1, 1, 2]
