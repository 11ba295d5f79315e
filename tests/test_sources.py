import gzip
import hashlib
import os
import random

import pytest

from ampliframe.operators import seq_stats as st
from ampliframe.sources import fasta, fastq, files


def put(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as out:
        out.write(text)
    return path


def random_records(rng, n, longest=300):
    return [
        (f"rec{i} note {i}", "".join(rng.choice("ACGT") for _ in range(rng.randrange(1, longest))))
        for i in range(n)
    ]


def folded(seq, width):
    return "\n".join(seq[i : i + width] for i in range(0, len(seq), width))


def test_fasta_round_trip_over_many_splits(spark, work):
    rng = random.Random(1)
    records = random_records(rng, 500)
    text = "".join(f">{n}\n{folded(s, 60)}\n" for n, s in records)
    path = put(f"{work}/in/a.fasta", text)
    put(f"{work}/in/b.fasta", ">x\r\nAC\r\nGT\r\n>y\r\n\r\nTT\r\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = fasta.read_fasta(spark, f"{work}/in").collect()
        index = st.fasta_index(spark, path).orderBy("record_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    by_file = {}
    for r in got:
        by_file.setdefault(os.path.basename(r["file"]), []).append(r)
    rows = sorted(by_file["a.fasta"], key=lambda r: r["record_no"])
    assert [r["record_no"] for r in rows] == list(range(1, 501))
    assert [(r["name"], r["seq"]) for r in rows] == records
    rows = sorted(by_file["b.fasta"], key=lambda r: r["record_no"])
    assert [(r["name"], r["seq"]) for r in rows] == [("x", "ACGT"), ("y", "TT")]

    assert [r["name"] for r in index] == [n.split()[0] for n, _ in records]
    for r, (_, seq) in zip(index, records):
        assert text[r["offset"] : r["offset"] + 1] == seq[0]
        assert r["length"] == len(seq) and r["line_bases"] == min(len(seq), 60)
        assert r["line_bytes"] == r["line_bases"] + 1

    out = f"{work}/out"
    df = fasta.read_fasta(spark, path)
    fasta.write_fasta(df, out, width=80, order_by=["record_no"])
    written = "".join(
        open(os.path.join(out, f)).read() for f in sorted(os.listdir(out)) if f.startswith("part")
    )
    assert written == "".join(f">{n}\n{folded(s, 80)}\n" for n, s in records)


def test_predicted_index_equals_the_written_file(spark, work):
    rng = random.Random(2)
    records = random_records(rng, 40)
    df = spark.createDataFrame(
        [("f", i, n, s) for i, (n, s) in enumerate(records, 1)],
        "file string, record_no bigint, name string, seq string",
    )
    path = put(f"{work}/w/a.fasta", "".join(f">{n}\n{folded(s, 50)}\n" for n, s in records))
    columns = ["record_no", "name", "length", "offset", "line_bases", "line_bytes"]
    want = st.fasta_index(spark, path).select(columns).orderBy("record_no").collect()
    for chunk in (7, 1000):
        got = st.rendered_fasta_index(df, "file", "record_no", "name", "seq", 50, chunk)
        assert got.select(columns).orderBy("record_no").collect() == want


def test_uneven_lines_are_refused(spark, work):
    path = put(f"{work}/u.fasta", ">a\nACGT\nAC\nACGT\n")
    with pytest.raises(Exception, match="uneven line lengths"):
        st.fasta_index(spark, path).collect()


def test_naming_rule_per_file(rows):
    df = rows(
        [("f1", 1, "a", "A"), ("f1", 2, "", "A"), ("f2", 1, "b", "A")],
        "file string, record_no int, name string, seq string",
    )
    got = fasta.name_all_or_number(df).orderBy("file", "record_no").collect()
    assert [r["name"] for r in got] == ["seq1", "seq2", "b"]


def reads(rng, n):
    out = []
    for i in range(n):
        size = rng.randrange(1, 120)
        seq = "".join(rng.choice("ACGT") for _ in range(size))
        # qualities full of '@' and '+' to mislead a naive splitter
        qual = "".join(rng.choice("@+@I5") for _ in range(size))
        out.append((f"r{i}", seq, qual))
    return out


def fastq_text(records):
    return "".join(f"@{n}\n{s}\n+\n{q}\n" for n, s, q in records)


@pytest.mark.parametrize("split", [1, 37, 500, 1 << 20])
def test_fastq_ranges_lose_and_repeat_nothing(work, split):
    records = reads(random.Random(split), 60)
    path = put(f"{work}/fq/a.fastq", fastq_text(records))
    reader = fastq._FastqReader({"path": path, "splitBytes": str(split)})
    got = [
        row
        for part in reader.partitions()
        for batch in reader.read(part)
        for row in zip(*(batch.column(i).to_pylist() for i in (4, 5, 6)))
    ]
    assert got == records


def test_fastq_scan_in_spark(spark, work):
    records = reads(random.Random(9), 60)
    path = put(f"{work}/fq/a.fastq", fastq_text(records))
    got = fastq.scan_fastq(spark, path, 2000).orderBy("record_offset").collect()
    assert [(r["name"], r["seq"], r["qual"]) for r in got] == records


def test_fastq_folder_with_gzip(spark, work):
    one, two = reads(random.Random(3), 50), reads(random.Random(4), 70)
    put(f"{work}/d/s1.fastq", fastq_text(one))
    half = len(two) // 2
    members = gzip.compress(fastq_text(two[:half]).encode()) + gzip.compress(
        fastq_text(two[half:]).encode()
    )
    put(f"{work}/d/sub/s2.fq.gz", members, "wb")
    put(f"{work}/d/readme.txt", "no reads")
    got = fastq.read_fastq(spark, f"{work}/d", 400).orderBy("file", "record_no").collect()
    names = {os.path.basename(r["file"]) for r in got}
    assert names == {"s1.fastq", "s2.fq.gz"}
    assert [(r["name"], r["seq"], r["qual"]) for r in got] == one + two
    assert [r["record_no"] for r in got] == [*range(1, 51), *range(1, 71)]


def test_broken_fastq(spark, work):
    path = put(f"{work}/bad.fastq", "@a\nACGT\n+\nII\n")
    with pytest.raises(Exception, match="differ in length"):
        fastq.scan_fastq(spark, path).collect()


def test_grouped_sink(spark, work):
    data = [("g1", "barcode01", f"n{i}", "ACGT", "IIII") for i in range(90)]
    data += [("g2", "barcode02", "m", "A", "I")]
    df = spark.createDataFrame(
        data, "group string, barcode string, name string, seq string, qual string"
    )
    out = f"{work}/grouped"
    fastq.write_reads_by(df, out, rows_per_file=20)
    hot = os.path.join(out, "group=g1", "barcode=barcode01")
    assert sum(f.endswith(".gz") for f in os.listdir(hot)) > 1
    back = fastq.scan_fastq(spark, [os.path.join(hot, f) for f in os.listdir(hot) if f.endswith(".gz")])
    assert back.count() == 90
    assert os.path.isdir(os.path.join(out, "group=g2", "barcode=barcode02"))


def test_listing_checksums_and_gzip_audit(spark, work):
    root = f"{work}/pkg"
    put(f"{root}/01_fastq/a.fastq", "@a\nA\n+\nI\n")
    good = gzip.compress(b"x" * 100_000)
    put(f"{root}/01_fastq/b.fastq.gz", good, "wb")
    put(f"{root}/01_fastq/c.fastq.gz", good[:-12], "wb")
    put(f"{root}/01_fastq/d.fastq.gz", good + b"\0" * 64, "wb")
    put(f"{root}/01_fastq/e.fastq.gz", b"plain", "wb")
    put(f"{root}/04_md5/md5.txt", "x")
    listed = files.list_files(spark, root)
    sums = files.md5_list(listed, root, exclude="^04_md5/").collect()
    assert [r["path"] for r in sums] == [f"01_fastq/{n}" for n in (
        "a.fastq", "b.fastq.gz", "c.fastq.gz", "d.fastq.gz", "e.fastq.gz")]
    assert sums[1]["md5"] == hashlib.md5(good).hexdigest()
    audit = {os.path.basename(r["path"]): r["ok"] for r in files.gzip_audit(listed).collect()}
    assert audit == {"b.fastq.gz": True, "c.fastq.gz": False, "d.fastq.gz": True, "e.fastq.gz": False}
    dirs = {r["dir"] for r in files.list_directories(listed).collect()}
    assert {root, f"{root}/01_fastq", f"{root}/04_md5"} <= dirs


def test_file_statistics(spark, work):
    put(f"{work}/s/barcode01.fastq", "@r\nACGT\n+\n!!!!\n")
    put(f"{work}/s/barcode02.fastq", "@r\nTGCA\n+\n5555\n@s\nGG\n+\nII\n")
    df = fastq.scan_fastq(spark, f"{work}/s")
    got = st.sequence_stats(df, "file", "seq", "qual").orderBy("file").collect()
    assert [(r["num_seqs"], r["sum_len"], r["n50"]) for r in got] == [(1, 4, 4), (2, 6, 4)]
    assert got[0]["avg_qual"] == pytest.approx(0, abs=1e-9)
    assert got[1]["q20_pct"] == 100 and got[1]["q30_pct"] == pytest.approx(100 / 3)
    assert got[1]["gc_pct"] == pytest.approx(100 * 4 / 6)
    total = st.run_rollup(df, "file").filter("is_total = 1").first()
    assert (total["num_seqs"], total["sum_len"], total["file"]) == (3, 10, None)


def test_blank_labels_stay_and_paths_are_spelt_alike(spark, work):
    from ampliframe.sources.files import list_files
    from ampliframe.sources.tables import read_summary

    folder = f"{work}/a b+c"
    os.makedirs(folder)
    with open(f"{folder}/f.fasta", "w") as out:
        out.write(">x\nACGT\n")
    with open(f"{folder}/s.txt", "w") as out:
        out.write("alias\tsequence_length_template\n\t10\nNA\t20\nb\tNA\nb\t\n")
    got = read_summary(spark, f"{folder}/s.txt").collect()
    assert [tuple(r) for r in got] == [("", 10.0), (None, 20.0), ("b", None), ("b", None)]
    listed = {r["path"] for r in list_files(spark, folder).collect()}
    assert {r["file"] for r in fasta.read_fasta(spark, f"{folder}/f.fasta").collect()} <= listed
