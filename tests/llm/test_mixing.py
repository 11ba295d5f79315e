from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ampliframe.llm import mixing, queries
from helpers import DOCS, SF_DIR, WORDS, doc


def brute_seats(wanted, seats, most):
    given = [0] * len(wanted)
    for _ in range(seats):
        free = [i for i in range(len(wanted)) if given[i] < most[i] and wanted[i] > 0]
        if not free:
            break
        given[max(free, key=lambda i: (Fraction(wanted[i]) / (2 * given[i] + 1), -i))] += 1
    return given


@pytest.mark.parametrize(
    "wanted, most",
    [([5, 2, 1], [99] * 3), ([10, 10, 10], [99] * 3), ([7.5, 0, 3], [4, 9, 99]), ([1], [3]),
     ([1000, 1, 1, 1], [600, 9, 9, 9])],
)
def test_seats_go_to_the_highest_quotients(wanted, most):
    for seats in (0, 1, 2, 3, 5, 8, 13, 50):
        assert mixing.apportion(wanted, seats, most).tolist() == brute_seats(wanted, seats, most)


def test_targets_reshare_what_exceeds_twice_the_size():
    s = [mixing.Source(n, size, 1) for n, size in (("a", 10), ("b", 100), ("c", 100), (None, 0))]
    assert mixing.targets(s) == [20.0, pytest.approx(295 * 2 / 3), pytest.approx(295 / 3), 0.0]
    assert mixing.targets([]) == []
    assert mixing.plan([]).quotas.shape == (0, mixing.SHARDS)


def test_shard_quotas_add_up_and_each_prefix_is_an_apportionment():
    s = [mixing.Source(f"s{i}", 10_000 * (i + 1), 10) for i in range(7)]
    p = mixing.plan(s, shards=5)
    total = p.quotas.sum()
    assert total == round(sum(p.targets) / p.block)
    most = [2 * -(-x.size // p.block) for x in s]
    for k in range(1, 6):
        own = p.quotas[:, :k].sum(1).tolist()
        assert own == brute_seats(p.targets, total * k // 5, most)


def test_query(spark):
    rows = queries.QUERIES["op9_source_mix"](spark, SF_DIR).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    sums = {}
    for r in rows:
        d = docs[r["doc_id"]]
        assert r["size"] == len(WORDS.findall(d["text"] or "")) and 0 <= r["taken"] <= 2 * r["size"]
        sums.setdefault(d["source"], [0, 0, r["source_size"], r["target"]])
        sums[d["source"]][0] += r["taken"]
        sums[d["source"]][1] += r["size"]
    for taken, size, source_size, target in sums.values():
        assert size == source_size and abs(taken - target) <= 0.02 * target + 2
    assert sum(x[3] for x in sums.values()) == pytest.approx(1.5 * sum(x[1] for x in sums.values()))
    again = queries.QUERIES["op9_source_mix"](spark, SF_DIR).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_odd_rows_and_texts_as_taken(spark, rows):
    data = [doc(i, " ".join(f"w{i}x{k}" for k in range(i * 3)), source=f"s{i % 3}") for i in range(40)]
    data += [doc(100, None), doc(101, "", source=None), doc(102, "a  b\nc ", source=None)]
    data += [doc(7, "twice the same", source="s1")] * 2 + [doc(None, "no id here", source="s2")]
    df = rows(data, DOCS).selectExpr("*", "1 as Size", "2 as target", "3 as __no")
    mixed = mixing.mix(df).drop("__no")
    got = mixed.collect()
    assert len(got) == len(data) and all(r["taken"] <= 2 * r["size"] for r in got)
    assert sum(r["source_size"] for r in got if r["source"] is None) == 2 * 3
    for r in got:
        assert sum(x["times"] * (x["end"] - x["start"]) for x in r["stretches"]) == r["taken"]
        assert sum(x["end"] - x["start"] for x in r["stretches"]) == r["size"]
    texts = mixing.mixed_texts(mixed).select("doc_id", "text").collect()
    taken, have = {}, {}
    for r in got:
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["taken"]
    for r in texts:
        have[r["doc_id"]] = have.get(r["doc_id"], 0) + len(WORDS.findall(r["text"]))
    assert have == {i: n for i, n in taken.items() if n}
    originals = {}
    for d in data:
        originals.setdefault(d[0], set()).update(WORDS.findall(d[1] or ""))
    assert all(set(WORDS.findall(r["text"])) <= originals[r["doc_id"]] for r in texts)
    assert mixing.mixed_texts(mixing.mix(df.limit(0))).count() == 0
    single = mixing.mix(df.filter(F.col("doc_id") == 102)).collect()
    assert [(r["size"], r["target"]) for r in single] == [(3, 4.5)]


def test_a_tiny_source_does_not_cut_the_texts_of_a_large_one_into_words(spark, rows):
    data = [doc(i, " ".join(f"w{i}x{k}" for k in range(900)), source="large") for i in range(60)]
    data.append(doc(1000, " ".join(f"t{k}" for k in range(100)), source=None))
    mixed = mixing.mix(rows(data, DOCS))
    got = mixed.collect()
    large = [x for r in got if r["source"] == "large" for x in r["stretches"]]
    assert len(large) <= 60 * (900 / 64 + 2)
    sums = {}
    for r in got:
        taken, target = sums.get(r["source"], (0, 0))
        sums[r["source"]] = (taken + r["taken"], r["target"])
    assert all(abs(taken - target) <= 64 for taken, target in sums.values())
    order = {f"w{i}x{k}": (i, k) for i in range(60) for k in range(900)}
    for r in mixing.mixed_texts(mixed).filter("source = 'large'").select("text").collect():
        own = [order[w] for w in WORDS.findall(r["text"])]
        breaks = sum(b != (a[0], a[1] + 1) for a, b in zip(own, own[1:]))
        assert breaks <= len(own) / 64 + 1
