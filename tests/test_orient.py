import random

import pytest
from plain import plain_best

from ampliframe.functions.dna import complement_text
from ampliframe.operators import alignment as al
from ampliframe.operators import orient

REFERENCE = "ATGCGTACCAAAGGGTTTCCCA"


def ref(rows, *records):
    return rows(list(records), "name string, seq string")


def reads(rows, *records):
    return rows(
        [(i, n, s) for i, (n, s) in enumerate(records, 1)],
        "record_no bigint, name string, seq string",
    )


def test_directions_and_oriented_reads(rows):
    table, stack = orient.align_with_reference(
        ref(rows, ("reference", REFERENCE)),
        reads(rows, ("fwd", "gtacc aaagg"), ("rev", complement_text("AAAGGGTTTC"))),
    )
    got = table.orderBy("record_no").collect()
    assert [r["sample"] for r in got] == ["fwd", "rev"]
    assert [r["direction"] for r in got] == ["forward", "reverse_complement"]
    assert got[1]["oriented_seq"] == "AAAGGGTTTC"
    assert (got[0]["forward_score"], got[0]["reverse_score"]) == (20, 8)
    assert (got[1]["forward_score"], got[1]["reverse_score"]) == (6, 20)
    assert [r["score_delta"] for r in got] == [12, 14]
    names = [r["name"] for r in stack.orderBy("row_no").collect()]
    assert names == ["reference", "fwd", "rev"]


def test_default_names(rows):
    table, stack = orient.align_with_reference(
        ref(rows, (None, REFERENCE)), reads(rows, ("", "GTACCAAAGG"))
    )
    assert [r["name"] for r in stack.orderBy("row_no").collect()] == ["reference", "sanger_1"]
    assert table.first()["sample"] == "sanger_1"


def test_inputs_are_checked(rows):
    two = ref(rows, ("a", "AAA"), ("b", "CCC"))
    one, read = ref(rows, ("a", "ACGT")), reads(rows, ("r", "ACGT"))
    with pytest.raises(ValueError, match="exactly one"):
        orient.align_with_reference(two, read)
    with pytest.raises(ValueError, match="at least one"):
        orient.align_with_reference(one, read.limit(0))
    with pytest.raises(ValueError, match="gap_opening"):
        orient.align_with_reference(one, read, gap_opening=-1)


def test_stack_keeps_every_read(rows):
    rng = random.Random(23)
    reference = "".join(rng.choice("ACGT") for _ in range(80))
    records = []
    for i in range(40):
        start, end = sorted(rng.sample(range(81), 2))
        s = list(reference[start:end] or "A")
        for _ in range(rng.randrange(4)):
            p = rng.randrange(len(s) + 1)
            if rng.random() < 0.5:
                s[p:p] = rng.choice(["A", "GT", "CCC"])
            elif len(s) > 3:
                del s[p : p + 2]
        text = rng.choice(["", "TTGG"]) + "".join(s) + rng.choice(["", "CCAA"])
        records.append((f"r{i}", text if i % 2 else complement_text(text)))
    target = orient.one_reference(ref(rows, ("ref", reference)))
    oriented = orient.orient_reads(target, reads(rows, *records))
    want = {r["sample"]: r["oriented_seq"] for r in oriented.collect()}
    got = orient.read_stack(target, oriented).orderBy("row_no").collect()
    assert got[0]["name"] == "ref" and got[0]["row_no"] == 0
    assert len({len(r["aligned_seq"]) for r in got}) == 1
    assert got[0]["aligned_seq"].replace("-", "") == reference
    assert {r["name"]: r["aligned_seq"].replace("-", "") for r in got[1:]} == want
    # reads cut from the reference stand below it
    plain = orient.orient_reads(target, reads(rows, ("p", reference[20:60])))
    row = orient.read_stack(target, plain).filter("row_no = 1").first()["aligned_seq"]
    assert row == "-" * 20 + reference[20:60] + "-" * 20


def test_scores_equal_a_plain_loop(rows):
    rng = random.Random(31)
    reference = "".join(rng.choice("ACGT") for _ in range(30))
    records = [
        (f"r{i}", "".join(rng.choice("ACGTN" if i % 5 == 0 else "ACGT") for _ in range(rng.randrange(1, 60))))
        for i in range(40)
    ]
    target = orient.one_reference(ref(rows, ("ref", reference)))
    for scores in ((2, -3, 5, 2), (1.5, -1, 2, 0.5)):
        got = orient.orient_reads(target, reads(rows, *records), *scores)
        by_name = {r["sample"]: r for r in got.collect()}
        scoring = al.simple_scoring(*scores)
        for name, seq in records:
            x, y = al.encode(seq), al.encode(reference)
            forward = plain_best(x, y, scoring, "local")[0]
            backward = plain_best(al.complement(x), y, scoring, "local")[0]
            row = by_name[name]
            assert abs(row["forward_score"] - forward) < 1e-6
            assert abs(row["reverse_score"] - backward) < 1e-6
            assert (row["direction"] == "reverse_complement") == (backward > forward + 1e-9)


def test_long_reads_are_scored_whole():
    rng = random.Random(37)
    reference = al.encode("".join(rng.choice("ACGT") for _ in range(60)))
    long = "".join(rng.choice("ACGT") for _ in range(9000))
    hidden = long[:5111] + al.decode(reference) + long[5111:]
    scores = al.optimal_scores(
        [al.encode(long), al.encode(hidden)], [reference] * 2, al.simple_scoring(), "local"
    )
    assert scores[1] == 120 and scores[0] < 120
    coded = al._coded_for(al.simple_scoring(), 10_000, False, True)
    whole = al._best_cells(al._Rows([reference], [al.encode(long)], coded, "local"))[0][0]
    assert whole / coded.scale == scores[0]
