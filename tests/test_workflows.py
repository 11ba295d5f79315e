import gzip
import hashlib
import os

import pytest

from ampliframe.functions.dna import complement_text
from ampliframe.operators.seq_stats import write_fasta_index
from ampliframe.plans import workflows as wf
from ampliframe.sources.files import write_md5_list


def put(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as out:
        out.write(text)
    return path


def test_run_qc(spark, work):
    path = put(
        f"{work}/s.txt",
        "alias\tsequence_length_template\nbarcode02\t1000\nbarcode01\t1200\nbarcode02\t1800\n"
        "unclassified\t2000\n",
    )
    got = wf.run_qc(spark, path, [1, 2], min_read_length=1200, max_read_length=1800)
    assert [(r["sample"], r["Freq"]) for r in got.read_counts.orderBy("level_no").collect()] == [
        ("barcode01", 1), ("barcode02", 1), ("unclassified", 0)]
    assert (got.recovery, got.n_reads_raw, got.n_reads_filtered) == (100, 4, 2)
    assert got.metrics.count() == 9
    seen = wf.run_qc(spark, path, None)
    assert [r["sample"] for r in seen.read_counts.orderBy("level_no").collect()] == [
        "barcode02", "barcode01", "unclassified"]
    assert seen.recovery == 75
    assert seen.length_histogram.agg({"n": "sum"}).first()[0] == 4


def test_trim_fasta(spark, work):
    f, r = "AGAGTTTGATCATGGCTCAG", "TACGGTTACCTTGTTACGACTT"
    amplicon = f + "ACGTACGT" * 10 + complement_text(r)
    path = put(f"{work}/in.fasta", f">s1\nAA{amplicon}TT\n>s2\nGG{complement_text(amplicon)}\n>s3\nACGT\n")
    summary = wf.trim_fasta(spark, path, f"{work}/out", f, r, width=50)
    assert [x["trimmed"] for x in summary.orderBy("seq_name").collect()] == [True, True, False]
    text = "".join(
        open(os.path.join(work, "out", p)).read()
        for p in sorted(os.listdir(f"{work}/out")) if p.startswith("part")
    )
    records = [x.split("\n", 1) for x in text.split(">")[1:]]
    assert records[0][0] == f"s1 trimmed=TRUE;orientation=forward;start=3;end={len(amplicon) + 2}"
    assert records[2][0] == "s3 trimmed=FALSE;orientation=NA;start=NA;end=NA"
    assert [x[1].replace("\n", "") for x in records] == [amplicon, amplicon, "ACGT"]


def test_fastq_delivery(spark, work):
    put(f"{work}/d/barcode01.fastq", "@r\nACGT\n+\n5555\n")
    put(f"{work}/d/x/barcode02.fq.gz", gzip.compress(b"@r\nTGCAGG\n+\nIIIIII\n@s\nAC\n+\nII\n"), "wb")
    got = wf.fastq_delivery(spark, f"{work}/d")
    stats = {os.path.basename(r["file"]): r for r in got.stats.collect()}
    assert (stats["barcode01.fastq"]["num_seqs"], stats["barcode02.fq.gz"]["sum_len"]) == (1, 8)
    samples = {r["sample"]: r["num_seqs"] for r in got.samples.collect()}
    assert samples == {"barcode01": 1, "barcode02": 2, None: 3}
    assert [r["path"] for r in got.checksums.collect()] == ["barcode01.fastq", "x/barcode02.fq.gz"]
    put(f"{work}/d/y/barcode01.fastq", "@r\nA\n+\nI\n")
    with pytest.raises(ValueError, match="duplicate"):
        wf.fastq_delivery(spark, f"{work}/d")


def test_fastq_delivery_refuses(spark, work):
    put(f"{work}/e/readme.txt", "x")
    with pytest.raises(ValueError, match="no FASTQ"):
        wf.fastq_delivery(spark, f"{work}/e")
    put(f"{work}/e/a.fastq.gz", gzip.compress(b"@r\nA\n+\nI\n" * 99)[:-9], "wb")
    with pytest.raises(ValueError, match="broken gzip"):
        wf.fastq_delivery(spark, f"{work}/e")


def test_consensus_delivery(spark, work):
    fasta = put(f"{work}/c.fasta", ">consensus1\nACGTACGT\n")
    notes = put(f"{work}/notes.txt", "note")
    got = wf.consensus_delivery(spark, "P1", {"consensus": fasta, "notes": notes})
    paths = {r["label"]: r["delivery_path"] for r in got.manifest.collect()}
    assert paths["consensus_fasta"] == "01_consensus/consensus.fasta"
    assert paths["notes"] == "00_metadata/notes.txt" and "consensus_stats" in paths
    stats = got.stats.first()
    assert (stats["num_seqs"], stats["sum_len"], stats["format"]) == (1, 8, "FASTA")
    index = got.index.first()
    assert (index["name"], index["length"], index["offset"]) == ("consensus1", 8, 12)
    sums = [tuple(r) for r in got.checksums.collect()]
    assert sums == [
        (hashlib.md5(b"note").hexdigest(), "00_metadata/notes.txt"),
        (hashlib.md5(b">consensus1\nACGTACGT\n").hexdigest(), "01_consensus/consensus.fasta"),
    ]
    write_md5_list(got.checksums, f"{work}/md5")
    assert [r["value"] for r in spark.read.text(f"{work}/md5").collect()] == [
        f"{a}  {b}" for a, b in sums]
    write_fasta_index(got.index, f"{work}/fai")
    assert spark.read.text(f"{work}/fai").first()["value"] == "consensus1\t8\t12\t8\t9"
    put(f"{work}/empty.txt", "")
    with pytest.raises(ValueError, match="empty"):
        wf.consensus_delivery(spark, "P1", {"consensus": fasta, "notes": f"{work}/empty.txt"})
