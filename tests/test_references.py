"""Minimizers against a plain loop, and reads against several references."""

import random

import numpy as np
import pytest

from ampliframe.functions.dna import complement_text
from ampliframe.operators import orient
from ampliframe.operators import references as rf


def plain_minimizers(seq, k, window):
    kmers = [seq[i : i + k] for i in range(len(seq) - k + 1)]
    least = [min(x, complement_text(x)) if set(x) <= set("ACGT") else None for x in kmers]
    out = set()
    for i in range(max(len(least) - window + 1, 1 if least else 0)):
        own = [x for x in least[i : i + window] if x is not None]
        if own:
            out.add(min(own))
    return out


def number(text):
    n = 0
    for b in text:
        n = 4 * n + "ACGT".index(b)
    return n


@pytest.mark.parametrize("k, window", [(5, 4), (11, 5), (15, 10), (3, 1), (31, 7)])
def test_minimizers_equal_a_plain_loop(k, window):
    rng = random.Random(k)
    seqs = ["".join(rng.choice("ACGT" * 9 + "N-") for _ in range(rng.choice([0, k - 1, k, k + 3, 90]))) for _ in range(80)]
    data = np.frombuffer("".join(seqs).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in seqs])]).astype(np.int64)
    rows, values = rf.sequence_minimizers(data, offsets, k, window)
    got = set(zip(rows.tolist(), values.tolist()))
    assert len(got) == len(rows)
    assert got == {(i, number(m)) for i, s in enumerate(seqs) for m in plain_minimizers(s, k, window)}
    turned = "".join(complement_text(s) for s in seqs)
    again = rf.sequence_minimizers(np.frombuffer(turned.encode(), np.uint8), offsets, k, window)
    assert set(zip(again[0].tolist(), again[1].tolist())) == got


def test_reads_find_their_reference(spark, rows, monkeypatch):
    rng = random.Random(2)
    refs = {f"ref{i}": "".join(rng.choice("ACGT") for _ in range(400)) for i in range(6)}
    refs["ref6"] = refs["ref0"][:200] + refs["ref1"][200:]
    reads, truth = [], {}
    for i in range(60):
        name = rng.choice([n for n in refs if n != "ref6"])
        at = rng.randrange(250)
        text = refs[name][at : at + 150]
        text = "".join(rng.choice("ACGT") if rng.random() < 0.02 else b for b in text)
        reads.append((i, f"r{i}", text if i % 2 else complement_text(text)))
        truth[i] = name
    reads += [(100, "none", "A" * 200), (101, "short", "ACG"), (102, "null", None)]
    targets = rows(list(refs.items()), "name string, seq string")
    df = rows(reads, "record_no int, name string, seq string")
    votes = rf.shared_minimizers(targets, df, ["record_no"])
    best = {r["record_no"]: r["reference"] for r in rf.best_reference(votes, ["record_no"], 3).collect()}
    assert sum(best.get(i) in (n, "ref6") for i, n in truth.items()) >= 58 and 100 not in best
    # the same without sending the references' minimizers
    monkeypatch.setattr(rf, "SENT_MINIMIZERS", 3)
    again = rf.shared_minimizers(targets, df, ["record_no"])
    assert sorted(again.collect()) == sorted(votes.collect())
    named = df.join(rf.best_reference(votes, ["record_no"], 3).select("record_no", "reference"), "record_no")
    got = {r["record_no"]: r for r in rf.orient_to_references(targets, named).collect()}
    assert set(got) == set(best)
    for name, seq in list(refs.items())[:3]:
        one = orient.orient_reads(orient.Reference(name, seq), df.filter("seq is not null")).collect()
        for r in one:
            if best.get(r["record_no"]) == name:
                mine = got[r["record_no"]]
                assert (mine["direction"], mine["forward_score"], mine["reverse_score"]) == (
                    r["direction"], r["forward_score"], r["reverse_score"])
                assert mine["oriented_seq"] == r["oriented_seq"]


def test_references_are_checked(rows):
    for data, what in [
        ([("a", "ACGT"), ("a", "GGTT")], "share a name"),
        ([("", "ACGT")], "need a name"),
        ([("a", " ")], "need a name and a sequence"),
    ]:
        with pytest.raises(ValueError, match=what):
            rf.checked_references(rows(data, "name string, seq string"))
    with pytest.raises(ValueError, match="missing required"):
        rf.orient_to_references(rows([("a", "A")], "name string, seq string"), rows([(1,)], "record_no int"))


def test_reads_are_dealt_over_tasks_before_they_grow(spark, rows):
    targets = rows([("t", "ACGTTGCAAC" * 5)], "name string, seq string")
    reads = rows([(i, "ACGTTGCAAC" * 4) for i in range(64)], "record_no bigint, seq string").coalesce(1)
    votes = rf.shared_minimizers(targets, reads, ["record_no"], 5, 3)
    assert "RoundRobinPartitioning" in votes._jdf.queryExecution().executedPlan().toString()
    assert votes.count() == 64
