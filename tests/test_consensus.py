import random

import pytest
from plain import plain_best

from ampliframe.operators import alignment as al
from ampliframe.operators import consensus as cons
from ampliframe.sources.fasta import read_fasta


def sset(rows, *records):
    return rows(
        [(n, i, s) for i, (n, s) in enumerate(records, 1)],
        "name string, record_no int, seq string",
    )


def pair(rows, a, b):
    return rows([("A", "B", a, b)], "seq1_name string, seq2_name string, seq1 string, seq2 string")


def test_reverse_complement_differences(rows):
    df = pair(rows, "ATGCCGTAAA", "TTACGGCATAA")
    got = cons.sequence_differences(df).orderBy("aln_pos").collect()
    assert [r["seq1_pos"] for r in got] == [None, None, 10]
    assert [r["seq2_pos"] for r in got] == [11, 10, None]
    assert [r["seq1_base"] for r in got] == ["-", "-", "A"]
    assert [r["seq2_base"] for r in got] == ["T", "T", "-"]
    assert {r["seq2_aligned_as"] for r in got} == {"seq2_reverse_complement"}
    assert {(r["seq1_name"], r["seq2_name"]) for r in got} == {("A", "B")}
    whole = cons.seq_diffs(df).first()
    assert (whole["orientation"], whole["n_diff"]) == ("reverse_complement", 3)
    assert len(whole["differences"]) == 3


def test_forward_and_identical(rows):
    got = cons.sequence_differences(pair(rows, "ATGCCGTAAA", "ATGCCGGTAAAC")).collect()
    assert got and {r["orientation"] for r in got} == {"forward"}
    same = cons.sequence_differences(pair(rows, "ATGCCGTAAA", "ATGCCGTAAA"))
    assert same.collect() == []
    assert same.columns == [
        "aln_pos", "seq1_name", "seq1_pos", "seq1_base", "seq2_name", "seq2_pos", "seq2_base",
        "orientation", "seq2_aligned_as",
    ]


def test_shared_names(rows):
    one = sset(rows, ("barcode01", "ATGCCGTAAA"), ("barcode02", "AACCGGTT"), ("only1", "A"))
    two = sset(rows, ("barcode01", "ATGCCGGTAAAC"), ("barcode02", "AACCGGTT"))
    got = cons.compare_consensus(one, two).orderBy("seq1_name").collect()
    assert [r["seq1_name"] for r in got] == ["barcode01", "barcode02"]
    assert got[0]["distance"] > 0 and got[1]["distance"] == 0
    assert [(r["seq1_len"], r["seq2_len"]) for r in got] == [(10, 12), (8, 8)]
    assert got[0]["aligned_seq1"].replace("-", "") == "ATGCCGTAAA"
    assert len(got[0]["aligned_seq1"]) == len(got[0]["aligned_seq2"])


def test_repeated_name_uses_its_first_record(rows):
    one = sset(rows, ("x", "ACGT"), ("x", "TTTT"))
    two = sset(rows, ("x", "ACGT"), ("x", "GGGG"))
    (r,) = cons.compare_consensus(one, two).collect()
    assert (r["seq1"], r["seq2"], r["distance"]) == ("ACGT", "ACGT", 0)


def test_sample_map(rows):
    one, two = sset(rows, ("A", "ACGT"), ("B", "AAAA")), sset(rows, ("X", "ACGT"), ("Y", "TTTT"))
    for columns in ("seq1_name string, seq2_name string", "first string, second string"):
        m = rows([("A", "X"), ("B", "Y"), ("missing", "X"), (None, "X"), ("A", "")], columns)
        got = cons.compare_consensus(one, two, m).orderBy("seq1_name").collect()
        assert [(r["seq1_name"], r["seq2_name"]) for r in got] == [("A", "X"), ("B", "Y")]
        assert got[0]["distance"] == 0
        assert got[1]["distance"] == 0 and got[1]["seq2_orientation"] == "reverse_complement"
    repeats = rows(
        [("A", "X", 3), ("B", "X", 1), ("A", "X", 2)],
        "seq1_name string, seq2_name string, pair_no int",
    )
    got = cons.compare_consensus(one, two, repeats, keep_order=True).orderBy("pair_no").collect()
    assert [(r["pair_no"], r["seq1_name"]) for r in got] == [(1, "B"), (2, "A"), (3, "A")]
    named = cons.consensus_distances(one, sset(rows, ("B", "A"), ("A", "A")), keep_order=True)
    assert [r["seq1_name"] for r in named.orderBy("pair_no").collect()] == ["A", "B"]
    with pytest.raises(ValueError, match="pair map"):
        cons.compare_consensus(one, two, rows([("A",)], "A string"))


def test_fasta_inputs(spark, work):
    for name, last in (("one", "AAAA"), ("two", "AAAT")):
        with open(f"{work}/{name}.fasta", "w") as out:
            out.write(f">barcode01\nACGT\n>barcode02\n{last}\n")
    got = cons.compare_consensus(
        read_fasta(spark, f"{work}/one.fasta"), read_fasta(spark, f"{work}/two.fasta")
    ).orderBy("seq1_name").collect()
    assert [r["distance"] for r in got] == [0, 1]


def test_no_pairs_and_bad_sets(rows):
    none = cons.compare_consensus(sset(rows, ("A", "ACGT")), sset(rows, ("B", "ACGT")))
    assert none.count() == 0
    assert none.columns == [
        "seq1_name", "seq2_name", "distance", "seq1_len", "seq2_len", "seq2_orientation",
        "seq1", "seq2", "aligned_seq1", "aligned_seq2",
    ]
    with pytest.raises(ValueError, match="at least one"):
        cons.check_consensus_set(sset(rows, ("a", "A")).limit(0), "consensus1")
    with pytest.raises(ValueError, match="non-empty names"):
        cons.compare_consensus(sset(rows, ("", "ACGT")), sset(rows, ("B", "ACGT")))
    with pytest.raises(ValueError, match="type"):
        cons.compare_consensus(sset(rows, ("A", "A")), sset(rows, ("A", "A")), type="odd")


def test_local_comparison(rows):
    got = cons.compare_consensus(
        sset(rows, ("A", "TTTTACGTACGTCC")), sset(rows, ("A", "GACGTACGTG")), type="local",
        scoring=al.simple_scoring(),
    ).first()
    assert got["distance"] == 0 and got["aligned_seq1"] == got["aligned_seq2"]


def test_whole_sets_equal_a_plain_loop(rows):
    rng = random.Random(29)
    one, two = [], []
    for i in range(60):
        a = "".join(rng.choice("ACGT") for _ in range(rng.randrange(1, 50)))
        b = list(a)
        for _ in range(rng.randrange(4)):
            p = rng.randrange(len(b) + 1)
            b[p : p + rng.randrange(2)] = rng.choice(["", "A", "GT"])
        b = "".join(b) or "C"
        turned = al.decode(al.complement(al.encode(b)))
        one.append((f"n{i}", a))
        two.append((f"n{i}", turned if i % 2 else b))
    got = {r["seq1_name"]: r for r in cons.compare_consensus(sset(rows, *one), sset(rows, *two)).collect()}
    assert len(got) == 60
    fast = cons.consensus_distances(sset(rows, *one), sset(rows, *two))
    assert {r["seq1_name"]: r["distance"] for r in fast.collect()} == {
        n: r["distance"] for n, r in got.items()
    }
    for (name, a), (_, b) in zip(one, two):
        x, y = al.encode(a), al.encode(b)
        forward = -plain_best(x, y, al.DEFAULT_SCORING, "global")[1]
        backward = -plain_best(x, al.complement(y), al.DEFAULT_SCORING, "global")[1]
        row = got[name]
        assert row["distance"] == min(forward, backward)
        assert (row["seq2_orientation"] == "reverse_complement") == (backward < forward)
        shown = zip(row["aligned_seq1"], row["aligned_seq2"])
        assert sum(u != v for u, v in shown) == row["distance"]


def test_equal_pairs_are_answered_without_python(spark, rows):
    pairs = rows(
        [("a", "a", "ACGTT", "ACGTT"), ("b", "b", "ACGTT", "AACGT"), ("c", "c", "ACNTT", "ACNTT"),
         ("d", "d", "ACGTT", "ACGTA")],
        "seq1_name string, seq2_name string, seq1 string, seq2 string",
    )
    got = {r["seq1_name"]: r for r in cons.seq_diffs(pairs).collect()}
    assert [(got[n]["n_diff"], got[n]["orientation"]) for n in "abcd"] == [
        (0, "forward"), (0, "reverse_complement"), (0, "forward"), (1, "forward")]
    assert got["b"]["aligned_seq2"] == "ACGTT" and got["a"]["differences"] == []
    assert cons.sequence_differences(pairs).count() == 1
    missing = rows([("e", "e", None, None)], pairs.schema)
    with pytest.raises(Exception, match="missing or empty"):
        cons.seq_diffs(missing).collect()


@pytest.mark.parametrize("scored", [None, "simple"])
def test_an_empty_sequence_is_one_gap(rows, scored):
    from ampliframe.operators import alignment as al

    scoring = al.DEFAULT_SCORING if scored is None else al.simple_scoring()
    pairs = rows(
        [("a", "a", "", "ACG"), ("b", "b", "TT", ""), ("c", "c", "", ""), ("d", "d", "ACGT", "ACGA")],
        "seq1_name string, seq2_name string, seq1 string, seq2 string",
    )
    got = {r["seq1_name"]: r for r in cons.seq_diffs(pairs, scoring=scoring).collect()}
    assert [(got[n]["n_diff"], got[n]["orientation"]) for n in "abc"] == [(3, "forward"), (2, "forward"), (0, "forward")]
    assert (got["a"]["aligned_seq1"], got["a"]["aligned_seq2"]) == ("---", "ACG")
    assert (got["b"]["aligned_seq1"], got["b"]["aligned_seq2"]) == ("TT", "--")
    assert [tuple(d) for d in got["a"]["differences"]] == [
        (1, None, "-", 1, "A"), (2, None, "-", 2, "C"), (3, None, "-", 3, "G")]
    assert [tuple(d) for d in got["b"]["differences"]] == [(1, 1, "T", None, "-"), (2, 2, "T", None, "-")]
    assert got["c"]["differences"] == [] and got["d"]["n_diff"] == 1
    lengths = cons.pair_distances(pairs, scoring=scoring).collect()
    assert {(r["seq1_name"], r["distance"]) for r in lengths} == {("a", 3), ("b", 2), ("c", 0), ("d", 1)}
    missing = rows([("a", "a", None, "A")], "seq1_name string, seq2_name string, seq1 string, seq2 string")
    with pytest.raises(Exception, match="missing or empty"):
        cons.pair_distances(missing).collect()
