"""Blocked gzip, pushed filters and the committed sink."""

import glob
import gzip
import io
import os
import random
import zlib

import numpy as np
import pytest

from ampliframe.operators.seq_stats import mean_quality
from ampliframe.sources import fastq, ranges
from test_sources import fastq_text, put, reads


def blocked(data, sizes):
    out, at = b"", 0
    while at < len(data):
        n = next(sizes)
        out += ranges.packed_block(data[at : at + n], 6)
        at += n
    return out + ranges.LAST_BLOCK


def rows_of(path, split, columns="name,seq,qual"):
    reader = fastq._FastqReader({"path": path, "splitBytes": str(split), "columns": columns})
    found = []
    for part in reader.partitions():
        rows = [r for b in reader.read(part) for r in zip(*(c.to_pylist() for c in b.columns))]
        found.append(rows)
    return found


def serial(path):
    """The file read as lines from start to end."""
    opened = gzip.open(path, "rt") if path.endswith(".gz") else open(path)
    lines = opened.read().split("\n")
    return [(lines[i][1:], lines[i + 1], lines[i + 3]) for i in range(0, len(lines) - 3, 4)]


@pytest.mark.parametrize("split", [1, 50, 700, 3000, 1 << 20])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_blocks_are_read_from_anywhere(work, split, seed):
    rng = random.Random(seed)
    data = fastq_text(reads(rng, 80)).encode()
    # blocks that end in the middle of lines, at newlines, and with one byte
    sizes = iter(lambda: rng.choice([1, 7, 60, 200, 65_000 if seed == 3 else 333]), 0)
    path = put(f"{work}/a.fastq.gz", blocked(data, sizes), "wb")
    found = rows_of(path, split)
    assert [r for part in found for r in part] == serial(path)
    if split == 700 and seed < 3:
        assert sum(bool(part) for part in found) > 3


def test_blocks_that_end_at_newlines(work):
    records = reads(random.Random(8), 30)
    data = b"".join(ranges.packed_block(fastq_text([r]).encode(), 6) for r in records)
    path = put(f"{work}/a.fq.gz", data, "wb")
    for split in (1, 40, 100):
        assert [r for part in rows_of(path, split) for r in part] == serial(path) == records


def test_headers_inside_blocks_are_not_taken_for_blocks(work):
    fake = ranges.packed_block(b"x" * 50, 6)
    member = ranges.packed_block(os.urandom(100) + fake[:20] + os.urandom(3000), 0)
    size = len(member) + len(ranges.LAST_BLOCK)
    path = put(f"{work}/f.gz", member + ranges.LAST_BLOCK, "wb")
    with open(path, "rb") as raw:
        assert ranges.first_block(raw, 1, size) == len(member)
        assert [o for o, _ in ranges.blocks(raw, 0)] == [0, len(member)]
    assert gzip.open(path).read()[100:104] == ranges.BLOCK_MAGIC


def test_random_data_survives_packing():
    data = os.urandom(ranges.BLOCK_DATA)
    block = ranges.packed_block(data, 6)
    assert ranges.block_bytes(block) == len(block) <= ranges.BLOCK_LIMIT
    assert zlib.decompress(block, wbits=31) == data
    assert gzip.decompress(block + ranges.LAST_BLOCK) == data


@pytest.mark.parametrize(
    "text, want",
    [
        ("@a\nAC\n+\nII", [("a", "AC", "II")]),
        ("@a\r\nAC\r\n+\r\nII\r\n", [("a", "AC", "II")]),
        ("\n@a\nAC\n+\nII\n\n\n@b\nA\n+\n@\n", [("a", "AC", "II"), ("b", "A", "@")]),
        ("@a\n\n+\n\n@b\n\n+\n", [("a", "", ""), ("b", "", "")]),
        ("@é\nA\n+\nI\n", [("é", "A", "I")]),
        ("\n\n", []),
    ],
)
def test_odd_files(work, text, want):
    path = put(f"{work}/o.fastq", text.encode(), "wb")
    for split in (1, 5, 100):
        assert [r for part in rows_of(path, split) for r in part] == want


@pytest.mark.parametrize("text", ["@a\nA\n+\n", "@a\nA\n", "a\nA\n+\nI\n", "@a\nA\n-\nI\n", "@a\nAC\n+\nI\n"])
def test_broken_files(work, text):
    path = put(f"{work}/b.fastq", text)
    with pytest.raises(ValueError, match="FASTQ record|differ in length"):
        rows_of(path, 1000)


def test_broken_blocks(work):
    data = blocked(fastq_text(reads(random.Random(1), 50)).encode(), iter(lambda: 300, 0))
    path = put(f"{work}/b.fastq.gz", data[: len(data) // 2], "wb")
    with pytest.raises(ValueError, match="ends early"):
        rows_of(path, 1 << 20)


def test_filters_are_pushed(spark, work):
    records = reads(random.Random(5), 400) + [("empty", "", "")]
    path = put(f"{work}/p/a.fastq", fastq_text(records))
    columns = ("name", "length", "mean_quality", "row_in_range")
    scan = fastq.scan_fastq(spark, path, 3000, columns)
    chosen = scan.filter("length >= 60 and mean_quality > 16 and name <> 'r7'")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    shown = spark._jvm.PythonSQLUtils.explainString(chosen._jdf.queryExecution(), "formatted")
    pushed = next(x for x in shown.splitlines() if "PushedFilters" in x)
    assert "length" in pushed and "mean_quality" in pushed
    kept = plan[plan.index("Filter") :].split("\n")[0]
    assert "name" in kept and "length" not in kept and "mean_quality" not in kept
    got = {r["name"]: r for r in chosen.collect()}
    whole = spark.createDataFrame(records, "name string, seq string, qual string")
    want = whole.withColumn("q", mean_quality("qual")).filter("length(seq) >= 60 and q > 16 and name <> 'r7'")
    want = {r["name"]: r["q"] for r in want.collect()}
    assert set(got) == set(want) and len(got) > 20
    assert all(got[n]["mean_quality"] == pytest.approx(q, abs=1e-9) for n, q in want.items())
    # refused reads are counted all the same
    one_range = fastq.scan_fastq(spark, path, columns=columns).filter("length > 100")
    numbers = [r["row_in_range"] for r in one_range.collect()]
    assert numbers == [i for i, r in enumerate(records) if len(r[1]) > 100]
    assert scan.filter("mean_quality is null").collect()[0]["name"] == "empty"
    assert scan.filter("mean_quality is not null").count() == 400
    with pytest.raises(ValueError, match="no column"):
        fastq.scan_fastq(spark, path, columns=["nope"])


def test_sessions_that_push_no_filters(spark, work):
    records = reads(random.Random(5), 100) + [("empty", "", "")]
    data = fastq_text(records).encode()
    path = put(f"{work}/n/a.fastq.gz", blocked(data, iter(lambda: 700, 0)), "wb")
    conf = "spark.sql.python.filterPushdown.enabled"
    spark.conf.set(conf, "false")
    try:
        scan = fastq.scan_fastq(spark, path, 2000, ("name", "length", "mean_quality"))
        got = {r["name"] for r in scan.filter("length >= 60 and mean_quality > 0").collect()}
        assert got == {n for n, s, _ in records if len(s) >= 60}
        assert scan.filter("mean_quality is null").collect()[0]["name"] == "empty"
        assert fastq.read_fastq(spark, path, 2000).count() == 101
        blocks = fastq.block_index(spark, path, 2000).filter("data_offset >= 700").count()
        assert blocks == -(-len(data) // 700)
    finally:
        spark.conf.set(conf, "true")


def test_block_index_and_data_offsets(spark, work):
    records = reads(random.Random(6), 300)
    data = fastq_text(records).encode()
    sizes = iter(lambda: 700, 0)
    path = put(f"{work}/i/a.fastq.gz", blocked(data, sizes), "wb")
    put(f"{work}/i/b.fastq.gz", gzip.compress(data), "wb")
    put(f"{work}/i/c.fastq", data, "wb")
    index = fastq.block_index(spark, f"{work}/i", 2000)
    rows = sorted(map(tuple, index.collect()), key=lambda r: r[1])
    assert {r[0] for r in rows} == {path}
    assert [r[3] for r in rows] == [min(700 * i, len(data)) for i in range(len(rows))]
    assert sum(r[2] for r in rows) == os.path.getsize(path)
    placed = fastq.with_data_offset(fastq.scan_fastq(spark, path, 2000), index)
    for r in placed.collect():
        head = f"@{r['name']}\n".encode()
        assert data[r["data_offset"] : r["data_offset"] + len(head)] == head
    numbered = fastq.read_fastq(spark, path, 2000).orderBy("record_no").collect()
    assert [(r["name"], r["seq"], r["qual"]) for r in numbered] == records
    assert [r["record_no"] for r in numbered] == list(range(1, 301))


def arrow_rows(rows):
    import pyarrow as pa

    names = ["group", "name", "seq", "qual"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=names)


def test_a_repeated_task_leaves_nothing_behind(work):
    rows = [("g", f"n{i}", "ACGT", "IIII") for i in range(50)]
    out = f"{work}/k2"
    writer = fastq._FastqWriter({"path": out, "by": "group", "fileBytes": "200"}, False)

    def failing():
        yield arrow_rows(rows[:30])
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        writer.write(failing())
    first = writer.write(iter([arrow_rows(rows[:30]), arrow_rows(rows[30:])]))
    writer.write(iter([arrow_rows(rows)]))  # a speculative copy that is not committed
    writer.commit([first, None])
    assert os.listdir(out) == ["group=g"]
    found = sorted(glob.glob(f"{out}/group=g/*"))
    names = [r[0] for f in found for r in serial(f)]
    assert sorted(names) == sorted(r[1] for r in rows)
    writer.abort([])
    assert len(glob.glob(f"{out}/group=g/*")) == len(found)


def test_sink_modes_and_files(spark, work):
    data = [(None if i % 7 == 0 else "a/b" if i % 2 else "c", f"n{i}", "ACGT" * 50, "I" * 200) for i in range(300)]
    df = spark.createDataFrame(data, "g string, name string, seq string, qual string")
    out = f"{work}/s"
    fastq.write_reads_by(df, out, by=["g"], file_bytes=20_000, compression="none")
    assert set(os.listdir(out)) == {"g=a%2Fb", "g=c", "g=__HIVE_DEFAULT_PARTITION__"}
    assert len(glob.glob(f"{out}/g=c/*.fastq")) > 1
    assert fastq.scan_fastq(spark, out).count() == 300
    with pytest.raises(ValueError, match="already exists"):
        fastq.write_reads_by(df, out, by=["g"])
    fastq.write_reads_by(df, out, by=["g"], mode="append")
    assert fastq.scan_fastq(spark, out).count() == 600
    fastq.write_reads_by(df.limit(10), out, by=[], mode="overwrite")
    assert fastq.scan_fastq(spark, out).count() == 10
    fastq.write_reads_by(df.limit(0), f"{work}/none", by=["g"])
    with pytest.raises(Exception, match="no name, sequence or quality"):
        fastq.write_reads_by(df.selectExpr("g", "name", "seq", "null :: string as qual"), f"{work}/bad", ["g"])
    assert not glob.glob(f"{work}/bad/*")


def test_paths_keep_scheme_and_host(monkeypatch):
    from pyarrow import fs

    class Store:
        def get_file_info(self, what):
            if isinstance(what, fs.FileSelector):
                return [fs.FileInfo(f"{what.base_dir.rstrip(chr(47))}/d/a.fastq", fs.FileType.File, size=7)]
            return fs.FileInfo(what, fs.FileType.Directory)

    monkeypatch.setattr(
        ranges, "open_filesystem", lambda p: (Store(), p.split("://")[1].split("/", 1)[1])
    )
    for uri in ("hdfs://host:8020/runs/x", "abfss://c@account.dfs.core.windows.net/x", "s3a://bucket/x/"):
        assert list(ranges.files_below([uri], (".fastq",))) == [(f"{uri.rstrip('/')}/d/a.fastq", 7)]


def test_short_ranges_share_tasks(spark, work):
    path = put(f"{work}/a.fastq", fastq_text(reads(random.Random(9), 200)))
    want = serial(path)
    found = fastq.scan_fastq(spark, path, 64)
    assert os.path.getsize(path) // 64 > 150
    assert found.rdd.getNumPartitions() <= 2 * ranges.wanted_tasks(spark)
    ordered = found.sort("range_start", "row_in_range").select("name", "seq", "qual")
    assert [tuple(r) for r in ordered.collect()] == want
    numbered = fastq.read_fastq(spark, path, 64).sort("record_no")
    assert [(r["record_no"], r["name"]) for r in numbered.collect()] == [(i + 1, w[0]) for i, w in enumerate(want)]


class Counted(io.BytesIO):
    """A file that counts the bytes it gives."""

    given = 0

    def read(self, size=-1):
        data = super().read(size)
        self.given += len(data)
        return data


@pytest.mark.parametrize("packed", [False, True])
def test_a_short_range_reads_little_more_than_itself(packed):
    rng = random.Random(11)
    data = fastq_text(reads(rng, 40_000)).encode()
    if packed:
        data = blocked(data, iter(lambda: rng.randrange(1, ranges.BLOCK_DATA), None))
    path, size, split = "a.fastq.gz" if packed else "a.fastq", len(data), 1 << 16
    n = 0
    for own in ranges.byte_ranges(iter([(path, size)]), split):
        raw = Counted(data)
        found = ranges.pieces_of(raw, own)
        n += sum(len(x.heads) for x in fastq.records(found[0], path, *found[1:])) if found else 0
        # the blocked file is looked at once for its kind and once for the range's first block
        assert raw.given <= split + 6 * ranges.BLOCK_LIMIT
    assert n == 40_000 and size > 20 * split


def test_a_record_far_longer_than_its_range(work):
    records = [("a", "ACGT" * 5, "I" * 20), ("b", "ACGTT" * 600_000, "@+I" * 1_000_000), ("c", "AC", "@@"), ("d", "", "")]
    text = fastq_text(records)
    for name, data in (("p.fastq", text.encode()), ("p.fastq.gz", blocked(text.encode(), iter(lambda: 60_000, None)))):
        path = put(f"{work}/{name}", data, "wb")
        for split in (1 << 16, 1 << 18):
            assert [r for part in rows_of(path, split) for r in part] == records
