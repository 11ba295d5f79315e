"""Listing of folders, and files dealt by size."""

import os
import random

import pytest

from ampliframe.operators import layout as lay
from ampliframe.sources import files
from test_sources import put


def walk(root):
    out = {}
    for folder, names, below in os.walk(root):
        out |= {os.path.join(folder, n): (True, None) for n in names}
        out |= {os.path.join(folder, f): (False, os.path.getsize(os.path.join(folder, f))) for f in below}
    return out


@pytest.mark.parametrize("tasks", [1, 3, 40])
def test_entries_equal_a_walk(spark, work, tasks):
    rng = random.Random(tasks)
    root = f"{work}/tree"
    os.makedirs(root)
    for i in range(40):
        folder = "/".join([root, *[f"d{rng.randrange(3)}" for _ in range(rng.randrange(4))]])
        os.makedirs(folder, exist_ok=True)
        if rng.random() < 0.6:
            put(f"{folder}/f {i}.txt", "x" * i)
    os.makedirs(f"{root}/d0/empty/deeper")
    got = files.list_entries(spark, root, tasks).collect()
    assert {r["path"]: (r["is_dir"], r["size"]) for r in got} == walk(root) and len(got) == len(walk(root))
    r = next(r for r in got if r["path"].endswith("/empty/deeper"))
    assert (r["name"], r["dir"]) == ("deeper", f"{root}/d0/empty")
    dirs = {r["dir"] for r in files.list_directories(files.list_entries(spark, root)).collect()}
    assert {d for d in dirs if d.startswith(f"{root}/")} == {p for p, (d, _) in walk(root).items() if d}
    assert files.list_entries(spark, f"file:{root}/d0/empty/deeper").count() == 0


def test_an_empty_destination_is_a_conflict(spark, rows, work):
    put(f"{work}/barcode01/r.fastq.gz", "x")
    os.makedirs(f"{work}/3500bp/barcode01")
    sheet = rows([("NB-01", "3500bp")], "Barcode_ID string, Expected_Amplicon_Size_bp string")
    assert lay.plan_fastq_layout(sheet, work, files.list_files(spark, work)).count() == 1
    with pytest.raises(ValueError, match="already exist"):
        lay.plan_fastq_layout(sheet, work, files.list_entries(spark, work))


@pytest.mark.parametrize("kind", ["even", "one large", "falling", "empty", "few"])
def test_files_are_dealt_by_size(rows, kind):
    rng = random.Random(len(kind))
    sizes = {
        "even": [rng.randrange(1, 100) for _ in range(400)],
        "one large": [100_000] + [rng.randrange(1, 200) for _ in range(500)],
        "falling": [int(50_000 / (i + 1)) for i in range(300)],
        "empty": [0] * 50 + [None],
        "few": [7, 5],
    }[kind]
    df = rows([(f"/p/{i}", s, "kept") for i, s in enumerate(sizes)], "path string, size bigint, other string")
    tasks = 8
    dealt = files.deal_by_size(df.repartition(3), tasks).collect()
    assert sorted(r["path"] for r in dealt) == sorted(f"/p/{i}" for i in range(len(sizes)))
    assert all(r["other"] == "kept" and 0 <= r["task"] < tasks for r in dealt)
    loads = [0] * tasks
    for r in dealt:
        loads[r["task"]] += (r["size"] or 0) + 1
    share = sum(loads) / tasks
    assert max(loads) <= max(max((s or 0) + 1 for s in sizes), share * 4 / 3) + 1e-6


def test_no_files_are_dealt_to_no_task(rows):
    assert files.deal_by_size(rows([], "path string, size bigint"), 4).count() == 0


def test_tasks_hold_what_they_were_dealt(rows, work):
    data = [(put(f"{work}/m/{i}", "x" * (5000 if i == 0 else 10)), 5000 if i == 0 else 10) for i in range(60)]
    df = rows(data, "path string, size bigint")
    parts = files._spread(df).rdd.glom().map(len).collect()
    assert sum(parts) == 60 and 1 in parts
    assert files.md5_list(df, work).count() == 60
