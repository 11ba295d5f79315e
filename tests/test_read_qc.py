import math
import random

import pytest
from pyspark.sql import functions as F

from ampliframe.operators import read_qc as qc
from ampliframe.sources.tables import coerce_summary, read_summary

LENGTH = "sequence_length_template"


def write_summary(work, lines):
    path = f"{work}/summary.txt"
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")
    return path


def counts(df):
    return [(r["sample"], r["Freq"]) for r in df.collect()]


def test_counts_and_recovery(spark, work):
    path = write_summary(
        work,
        ["alias\tsequence_length_template", "barcode01\t1000", "barcode01\t1500",
         "barcode02\t800", "unclassified\t500"],
    )
    df = read_summary(spark, path)
    levels = qc.levels_table(spark, qc.declared_levels([1, 2]))
    table = qc.read_counts(df, levels, "alias", LENGTH)
    assert counts(table) == [("barcode01", 2), ("barcode02", 1), ("unclassified", 1)]
    assert qc.recovery_rate(table).first()["recovery"] == 75
    totals = qc.read_totals(df, "alias", LENGTH).first()
    assert (totals["n_reads_raw"], totals["n_reads_filtered"]) == (4, 4)


def test_length_filter(rows, spark):
    df = rows(
        [("barcode01", 1000.0), ("barcode01", 1200.0), ("barcode02", 1800.0),
         ("unclassified", 2000.0)],
        "alias string, sequence_length_template double",
    )
    levels = qc.levels_table(spark, qc.declared_levels([1, 2]))
    table = qc.read_counts(df, levels, "alias", LENGTH, 1200, 1800)
    assert counts(table) == [("barcode01", 1), ("barcode02", 1), ("unclassified", 0)]
    assert qc.recovery_rate(table).first()["recovery"] == 100
    totals = qc.read_totals(df, "alias", LENGTH, 1200, 1800).first()
    assert (totals["n_reads_raw"], totals["n_reads_filtered"]) == (4, 2)
    metrics = {(r["sample"], r["type"]): r["value"] for r in qc.long_metrics(table).collect()}
    assert metrics["unclassified", "Log10Freq"] is None
    assert metrics["barcode01", "Log10Freq"] == 0
    assert metrics["unclassified", "Recovered"] == 0


def test_recovery_without_reads(rows, spark):
    df = rows([], "alias string, sequence_length_template double")
    levels = qc.levels_table(spark, ["barcode01", "unclassified"])
    assert qc.recovery_rate(qc.read_counts(df, levels, "alias", LENGTH)).first()[0] is None


def test_bad_numbers_and_missing_labels(spark, work):
    path = write_summary(
        work,
        ["alias\tsequence_length_template\tother", "b1\tten\tx", "NA\t5\tx", "b1\tInf\tx",
         "b2\t7\tx", "b1\tNA\tx"],
    )
    df = read_summary(spark, path)
    totals = qc.read_totals(df, "alias", LENGTH).first()
    assert (totals["n_reads_raw"], totals["n_reads_filtered"]) == (4, 2)
    levels = qc.levels_table(spark, ["b1", "b2"])
    hist = {r["sample"]: r["n"] for r in qc.length_histogram(df, levels, "alias", LENGTH).collect()}
    assert hist == {"b1": 0, "b2": 1}


def test_missing_columns(rows):
    with pytest.raises(ValueError, match="sequence_length_template"):
        coerce_summary(rows([("a",)], "alias string"))


def test_bounds_are_checked(rows):
    df = rows([("a", 1.0)], "alias string, sequence_length_template double")
    with pytest.raises(ValueError):
        qc.filter_read_length(df, LENGTH, 10, 5)
    with pytest.raises(ValueError):
        qc.filter_read_length(df, LENGTH, -1)


def test_declared_levels_pad_to_the_widest():
    assert qc.declared_levels([1, 2, 100])[0] == "barcode001"
    assert qc.declared_levels([3], 2) == ["barcode03", "unclassified"]
    with pytest.raises(ValueError):
        qc.declared_levels([-1])


def test_observed_levels_follow_the_file(spark, work):
    labels = ["b7", "b2", "b7", "a1", "b2", "zz"]
    body = [f"{s}\t{100 + i}" for i, s in enumerate(labels * 50)]
    path = write_summary(work, ["alias\tsequence_length_template", *body])
    df = read_summary(spark, path, keep_order=True)
    levels = qc.observed_levels(df, "alias", ["file", "file_block", "row_in_block"])
    got = [r["sample"] for r in levels.orderBy("level_no").collect()]
    assert got == ["b7", "b2", "a1", "zz"]


def test_histogram_matches_a_plain_loop(rows, spark):
    rng = random.Random(3)
    data = [("s1", float(rng.randrange(1, 5000))) for _ in range(400)]
    data += [("s2", 70.0)] * 3 + [("s1", 0.0), ("s1", math.inf)]
    df = rows(data, "alias string, sequence_length_template double")
    levels = qc.levels_table(spark, ["s1", "s2", "s3"])
    got = {}
    for r in qc.length_histogram(df, levels, "alias", LENGTH).collect():
        got[r["sample"], r["bin"]] = r["n"]
    xs = [math.log10(v) for s, v in data if s == "s1" and 0 < v < math.inf]
    lo, hi = min(xs), max(xs)
    width = (hi - lo) / 29
    want = {}
    for x in xs:
        b = min(max(math.ceil((x - (lo - width / 2)) / width), 1), 30)
        want["s1", b] = want.get(("s1", b), 0) + 1
    want["s2", 1] = 3
    want["s3", None] = 0
    assert got == want
    assert sum(n for (s, _), n in got.items() if s == "s1") == len(xs)


def test_eligible_reads_counts_after_the_filters(rows):
    data = [("b1", 100, 20.0)] * 3 + [("b2", 100, 20.0)] * 2 + [("b2", 9, 20.0), ("b2", 100, 1.0)]
    df = rows(data, "barcode string, length int, q double")
    kept = qc.eligible_reads(df, "barcode", "length", "q", 50, 200, 10, 3)
    assert [r["barcode"] for r in kept.collect()] == ["b1"] * 3
    for low, high in ((50, 200), (100, 100), (9, 99), (101, 300)):
        named = qc.eligible_reads(df, "barcode", "length", "q", low, high, 10, 1)
        computed = qc.eligible_reads(df, "barcode", F.col("length") + 0, F.col("q"), low, high, 10, 1)
        assert sorted(map(str, named.collect())) == sorted(map(str, computed.collect()))
    with pytest.raises(ValueError):
        qc.eligible_reads(df, "barcode", "length", "q", 50, 20)


def test_stateless_steps_accept_a_stream(spark, work):
    source = f"{work}/in"
    spark.createDataFrame(
        [("barcode01", "1000"), ("barcode02", "x"), ("barcode01", "30")],
        "alias string, sequence_length_template string",
    ).write.parquet(source)
    schema = "alias string, sequence_length_template string"
    stream = coerce_summary(spark.readStream.schema(schema).parquet(source))
    kept = qc.filter_read_length(stream, LENGTH, 100).groupBy("alias").agg(
        F.count(F.lit(1)).alias("n")
    )
    query = (
        kept.writeStream.outputMode("complete").format("memory").queryName("kept_reads")
        .option("checkpointLocation", f"{work}/cp").start()
    )
    query.processAllAvailable()
    query.stop()
    assert [tuple(r) for r in spark.table("kept_reads").collect()] == [("barcode01", 1)]


def test_one_table_of_frequencies_feeds_all_numbers(spark, rows, work):
    import random

    rng = random.Random(3)
    data = [
        (rng.choice(["a", "b", "c", "unclassified", "other", None]),
         rng.choice([None, float("nan"), float("inf"), 0.0, 100.0, 250.5, 999.0, 5000.0]))
        for _ in range(500)
    ]
    rows(data, "alias string, length double").write.parquet(f"{work}/summary")
    df = spark.read.parquet(f"{work}/summary")
    levels = qc.levels_table(spark, ["a", "b", "empty", "c", "unclassified"])
    table = qc.length_frequencies(df, "alias", "length")
    for low, high in [(None, None), (100, 2000), (None, 250.5)]:
        want = qc.read_counts(df, levels, "alias", "length", low, high)
        assert qc.counts_of(table, levels, low, high).collect() == want.collect()
        rate = qc.recovery_rate(want).first()
        totals = qc.read_totals(df, "alias", "length", low, high).first()
        got = qc.run_numbers(table, levels, low, high)
        assert got.first().asDict() == rate.asDict() | totals.asDict()
        assert qc.totals_of(table, low, high).first() == totals
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1
        histogram = qc.histogram_of(table, levels, low, high)
        assert histogram._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
        kept = qc.filter_read_length(df, "length", low, high)
        one = sorted(map(str, qc.length_histogram(kept, levels, "alias", "length").collect()))
        assert sorted(map(str, histogram.collect())) == one
    none = qc.run_numbers(table.limit(0), levels).first()
    assert tuple(none) == (None, 0, 0, 0)


def test_eligible_reads_are_read_and_measured_once(spark, rows, work):
    data = [("b1" if i % 3 else "b2", "ACGT" * (i % 9), "I" * (4 * (i % 9))) for i in range(200)]
    rows(data, "barcode string, seq string, qual string").write.parquet(f"{work}/reads")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def quality(text):
        seen.add(1)
        return float(len(text))

    # as the kernel of the library, so that a filter on it does not work it out twice
    quality = quality.asNondeterministic()
    reads = spark.read.parquet(f"{work}/reads")
    kept = qc.eligible_reads(reads, "barcode", F.length("seq"), quality("qual"), 8, 100, 4, 60)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 0 and "BatchEvalPython" not in plan
    wanted = [d for d in data if 8 <= len(d[1]) <= 100]
    n = {b: sum(d[0] == b for d in wanted) for b in ("b1", "b2")}
    assert sorted(map(tuple, kept.collect())) == sorted(d for d in wanted if n[d[0]] >= 60)
    assert min(n.values()) < 60 <= max(n.values()) and seen.value == len(wanted)
