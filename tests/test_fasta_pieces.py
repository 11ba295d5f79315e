"""FASTA records spread over many splits, against a plain loop over the file."""

import random

import pytest

from ampliframe.operators import seq_stats as st
from ampliframe.sources import fasta_pieces, ranges
from test_sources import folded, put, random_records


def plain_index(data: bytes):
    """(name, length, offset, line_bases, line_bytes) by reading line after line; None if uneven."""
    rows, at, lines = [], 0, None
    records = []
    for line in data.splitlines(keepends=True):
        if line.startswith(b">"):
            lines = []
            name = line[1:].strip(b"\r\n").decode()
            records.append((name.split()[0] if name.split() and not name[0].isspace() else "", at + len(line), lines))
        else:
            lines.append(line)
        at += len(line)
    for name, offset, lines in records:
        while lines and not lines[-1].strip(b"\r\n"):
            lines.pop()
        widths = [len(x.rstrip(b"\r\n")) for x in lines]
        if any(w != widths[0] for w in widths[:-1]) or (widths and widths[-1] > widths[0]):
            return None
        ends = 2 if any(x.endswith(b"\r\n") for x in lines[:-1]) else 1
        if any(len(x) - len(x.rstrip(b"\r\n")) != ends for x in lines[:-1]):
            return None
        first = widths[0] if widths else 0
        rows.append((name, sum(widths), offset, first, first + ends if first else 0))
    return rows


def index(spark, path, split):
    columns = ["name", "length", "offset", "line_bases", "line_bytes"]
    rows = fasta_pieces.index_rows(spark, path, split).orderBy("record_no").collect()
    assert [r["record_no"] for r in rows] == list(range(1, len(rows) + 1))
    return [tuple(r[c] for c in columns) for r in rows]


def test_a_record_over_many_splits(spark, work):
    rng = random.Random(1)
    long = "".join(rng.choice("ACGT") for _ in range(6000))
    text = f">short one\nACGT\n>{'h' * 700} long\n{folded(long, 61)}\n>none\n>last\n{folded(long[:200], 50)}"
    path = put(f"{work}/a.fasta", text)
    want = plain_index(text.encode())
    assert want[1][1] == 6000
    for split in (97, 301, 1 << 20):
        assert index(spark, path, split) == want
    assert len(fasta_pieces._PieceReader({"path": path, "splitBytes": "301"}).partitions()) > 20
    chunks = fasta_pieces.scan_fasta_chunks(spark, path, 301).collect()
    built = {}
    for r in sorted(chunks, key=lambda r: (r["record_no"], r["start"])):
        assert len(built.get(r["record_no"], "")) == r["start"] and len(r["bases"]) <= 301
        built[r["record_no"]] = built.get(r["record_no"], "") + r["bases"]
    assert built == {1: "ACGT", 2: long, 3: "", 4: long[:200]}
    assert st.fasta_index(spark, path).count() == 4


def pieces_of(data: bytes, split: int):
    """What the tasks of all ranges tell, without Spark."""
    out = []
    for start in range(0, len(data), split):
        end = min(start + split, len(data))
        found = fasta_pieces.Pieces("f", start, end, lambda a, b: data[a:b], True).columns
        out += [dict(zip(found, row)) for row in zip(*(c.to_pylist() for c in found.values()))]
    return out


def draw_file(rng):
    end, parts = rng.choice([b"\n", b"\r\n"]), []
    for i in range(rng.randint(1, 4)):
        width, n = rng.randint(1, 9), rng.choice([0, 1, 5, 30])
        seq = "".join(rng.choice("ACGT") for _ in range(n)).encode()
        lines = [seq[k : k + width] for k in range(0, n, width)]
        if rng.random() < 0.15 and lines:
            lines[rng.randrange(len(lines))] += b"A"
        if rng.random() < 0.1:
            lines.insert(rng.randint(0, len(lines)), b"")
        lines += [b""] * rng.choice([0, 0, 0, 1, 3])
        parts += [f">r{i} {'x' * rng.choice([0, 3, 40])}".encode(), *lines]
    return end.join(parts) + rng.choice([end, b""])


def test_random_files_equal_the_loop(spark):
    rng = random.Random(2)
    schema = ", ".join(f"{c} {fasta_pieces._SQL[k]}" for c, k in fasta_pieces._FIELDS.items())
    rows, want, bad = [], {}, {}
    for k in range(150):
        data = draw_file(rng)
        index = plain_index(data)
        for split in (1, 2, 3, 10, 1000):
            name = f"{k}/{split}"
            own = [r | {"file": name} for r in pieces_of(data, split)]
            if index is None:
                bad[name] = own
                continue
            want[name] = index
            rows += own
    found = spark.createDataFrame(rows, schema)
    got = {}
    for r in fasta_pieces.index_of(fasta_pieces.numbered(found, found)).orderBy("file", "record_no").collect():
        own = (r["name"], r["length"], r["offset"], r["line_bases"], r["line_bytes"])
        got.setdefault(r["file"], []).append(own)
    assert got == want and len(want) > 200 and len(bad) > 50
    for name in rng.sample(sorted(bad), 6):
        found = spark.createDataFrame(bad[name], schema)
        with pytest.raises(Exception, match="uneven line lengths"):
            fasta_pieces.index_of(fasta_pieces.numbered(found, found)).collect()


def test_refusals(spark, work):
    path = put(f"{work}/x.fa", "ACGT\n>a\nAC\n")
    with pytest.raises(Exception, match="without a header"):
        fasta_pieces.index_rows(spark, path).collect()
    mixed = put(f"{work}/m.fa", ">a\nACGT\r\nACGT\nAC\n")
    with pytest.raises(Exception, match="uneven"):
        fasta_pieces.index_rows(spark, mixed).collect()
    packed = put(f"{work}/p.fa.gz", b"x", "wb")
    with pytest.raises(Exception, match="compressed"):
        fasta_pieces.index_rows(spark, packed).collect()
    empty = put(f"{work}/e/none.fa", "")
    assert fasta_pieces.index_rows(spark, empty).count() == 0
    blank = put(f"{work}/b.fa", "\n\n>a\nAC\n\n\n")
    assert index(spark, blank, 2) == [("a", 2, 5, 2, 3)]


def test_many_short_records(spark, work):
    records = random_records(random.Random(3), 300, 120)
    text = "".join(f">{n}\n{folded(s, 60)}\n" for n, s in records)
    path = put(f"{work}/s.fasta", text)
    assert index(spark, path, 500) == plain_index(text.encode())


def test_short_ranges_share_tasks(spark, work):
    records = random_records(random.Random(4), 300, 120)
    text = "".join(f">{n}\n{folded(s, 60)}\n" for n, s in records)
    path = put(f"{work}/s.fasta", text)
    loaded = fasta_pieces._pieces(spark, path, 64, True)
    assert len(text) // 64 > 200 and loaded.rdd.getNumPartitions() <= 2 * ranges.wanted_tasks(spark)
    assert index(spark, path, 64) == plain_index(text.encode())
    chunks = fasta_pieces.scan_fasta_chunks(spark, path, 64)
    whole = chunks.sort("record_no", "start").collect()
    assert "".join(c["bases"] for c in whole) == "".join(s for _, s in records)
    assert {len(c["bases"]) <= 64 for c in whole} == {True}


def test_groups_hold_every_range_once():
    own = [ranges.ByteRange(f, at, at + 7, 70) for f in "abc" for at in range(0, 70, 7)]
    for tasks in (0, 1, 4, 29, 30, 1000):
        groups = ranges.range_groups(own, tasks)
        assert [r for g in groups for r in g.ranges] == own
        assert len(groups) >= min(tasks, len(own)) and (tasks or len(groups) == len(own))
    large = [ranges.ByteRange("a", at << 20, (at + 8) << 20, 1 << 30) for at in range(0, 1024, 8)]
    groups = ranges.range_groups(large, 2)
    assert max(sum(r.end - r.start for r in g.ranges) for g in groups) <= ranges.TASK_BYTES
    assert [g.ranges for g in ranges.range_groups([], 8)] == [[]]
