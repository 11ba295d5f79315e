import random

import pytest
from pyspark.sql import functions as F

from ampliframe.functions import scale


def test_join_lookup_is_the_same_on_both_sides_of_the_bound(rows):
    # one key holds most of the rows
    facts = rows([("hot", i) for i in range(300)] + [(f"k{i}", i) for i in range(30)], "k string, v int")
    lookup = rows([("hot", 1), ("k3", 2), ("k4", 3)], "k string, w int")
    for how in ("inner", "left", "left_semi"):
        small = scale.join_lookup(facts, lookup, ["k"], how, max_rows=3)
        large = scale.join_lookup(facts, lookup, ["k"], how, max_rows=2)
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_small_or_none(rows):
    df = rows([(1, "a"), (2, None)], "i int, s string")
    assert scale.small_or_none(df, 1) is None
    assert scale.small_or_none(df, 2).orderBy("i").collect() == df.orderBy("i").collect()
    assert scale.small_or_none(df.filter("i > 5")).collect() == []


def test_running_totals_equal_a_plain_sum(rows):
    rng = random.Random(41)
    data = [(g, i, rng.randrange(100)) for g, n in (("hot", 500), ("b", 7)) for i in range(n)]
    rng.shuffle(data)
    df = rows(data, "g string, i int, v int").repartition(5)
    got = scale.running_totals(
        df, ["g"], [F.floor(F.col("i") / 64)], F.col("i"), {"t": F.col("v"), "n": F.lit(1)}
    ).collect()
    by_group = {}
    for r in sorted(got, key=lambda r: (r["g"], r["i"])):
        so_far = by_group.setdefault(r["g"], [0, 0])
        assert (r["t"], r["n"]) == tuple(so_far)
        so_far[0] += r["v"]
        so_far[1] += 1
    assert {g: n for g, (_, n) in by_group.items()} == {"hot": 500, "b": 7}


@pytest.mark.parametrize("bound", [1, 1000])
def test_numbers_over_slices(rows, monkeypatch, bound):
    monkeypatch.setattr(scale, "SLICE_ROWS", bound)
    data = [("f", s, 1000 + i) for s, n in ((0, 40), (64, 1), (128, 30)) for i in range(n)]
    df = rows(data, "file string, slice int, place bigint").repartition(4)
    got = scale.number_in_slices(df, ["file"], "slice", "place", "no")
    ordered = got.orderBy("slice", "place").collect()
    assert [r["no"] for r in ordered] == list(range(1, 72))


def test_spread_deals_equal_rows_evenly(spark):
    same = spark.range(400).select(F.lit("x").alias("a"), F.lit(1).alias("b"))
    dealt = scale.spread(same)
    sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.count("a").alias("n")).collect()]
    assert sum(sizes) == 400 and max(sizes) <= 110


def test_kernels_see_slices_of_a_batch():
    import pyarrow as pa

    from ampliframe.functions import arrow_text

    seen = []

    def lengths(text, other):
        seen.append((len(text), sum(len(t or "") for t in text.to_pylist())))
        return pa.array([len(t or "") + o for t, o in zip(text.to_pylist(), other.to_pylist())], pa.int64())

    texts = ["A" * 5000] * 5000 + [None, "", "B" * (9 << 20)]
    columns = pa.array(texts, pa.string()), pa.array(range(len(texts)), pa.int64())
    got = arrow_text.in_slices(lengths, *columns)
    assert got.to_pylist() == [len(t or "") + i for i, t in enumerate(texts)]
    assert max(n for n, _ in seen) <= arrow_text.SLICED_ROWS
    assert sorted(b for _, b in seen)[-2] <= arrow_text.SLICED_BYTES and len(seen) >= 4
    assert len(arrow_text.in_slices(lengths, *(c.slice(0, 0) for c in columns))) == 0
