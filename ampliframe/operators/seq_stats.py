"""Sequence-file statistics, per-sample roll-ups and FASTA index rows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampliframe.contracts import integer_argument, require_columns
from ampliframe.functions.arrow_text import flat_bytes, slices_by_bytes
from ampliframe.functions.scale import running_totals
from ampliframe.sources.fasta_pieces import SPLIT_BYTES, index_rows

# Fixed value: FASTQ qualities are stored as characters starting at code 33.
PHRED_OFFSET = 33

_QUALITY_TYPE = T.StructType(
    [
        T.StructField("q20", T.LongType()),
        T.StructField("q30", T.LongType()),
        T.StructField("error", T.DoubleType()),
    ]
)


def _quality_sums(qual: pa.Array) -> pa.Array:
    """Bases of at least Q20 and Q30, and the summed error probability, per quality string."""
    scores = np.arange(256) - PHRED_OFFSET
    error_of = np.power(10.0, -scores / 10.0)
    data, offsets = flat_bytes(qual)
    rows = len(offsets) - 1
    q20, q30 = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    error = np.zeros(rows)
    for first, last in slices_by_bytes(offsets, 1 << 20):
        part = data[offsets[first] : offsets[last]]
        bounds = offsets[first : last + 1] - offsets[first]
        filled = np.flatnonzero(np.diff(bounds) > 0)
        if not len(filled):
            continue
        starts = bounds[filled]
        where = first + filled
        q20[where] = np.add.reduceat(part >= PHRED_OFFSET + 20, starts, dtype=np.int64)
        q30[where] = np.add.reduceat(part >= PHRED_OFFSET + 30, starts, dtype=np.int64)
        error[where] = np.add.reduceat(error_of[part], starts)
    return pa.StructArray.from_arrays(
        [pa.array(q20), pa.array(q30), pa.array(error)], names=["q20", "q30", "error"]
    )


# Marked nondeterministic so that a filter on the result does not evaluate it a second time.
quality_sums = F.arrow_udf(_quality_sums, _QUALITY_TYPE).asNondeterministic()


def mean_quality(qual: Column | str) -> Column:
    """Phred value of the mean error probability of one read, NULL for an empty one."""
    qual = F.col(qual) if isinstance(qual, str) else qual
    n = F.length(qual)
    return F.when(n > 0, -10 * F.log10(quality_sums(qual)["error"] / n))


def _without(seq: Column, characters: str) -> Column:
    return F.length(seq) - F.length(F.translate(seq, characters, ""))


def length_table(
    df: DataFrame,
    keys: Sequence[str],
    seq: str = "seq",
    qual: str | None = None,
    with_total: bool = False,
) -> DataFrame:
    """Reads reduced to one row per key and length, with counts and base sums.

    This one shuffle combines map-side, so a file or sample with most of the reads costs no more
    than any other. `with_total` adds the rows over all keys (is_total = 1).
    """
    keys = list(keys)
    require_columns(df, [*keys, seq, *([qual] if qual else [])], "the sequence set")
    sums = {"gc": _without(F.col(seq), "GCgc"), "gap": _without(F.col(seq), "- .")}
    base = df
    if qual:
        base = base.withColumn("__q", quality_sums(F.col(qual)))
        sums |= {c: F.col(f"__q.{c}") for c in ("q20", "q30", "error")}
    base = base.select(
        *keys, F.length(seq).cast("bigint").alias("len"), *[v.alias(n) for n, v in sums.items()]
    )
    # missing sequences are left out by their count: a filter on the sequence itself would have
    # it worked out a second time further down
    measures = [F.count("len").alias("n"), *[F.sum(n).alias(n) for n in sums]]
    lengths = base.groupBy(*keys, "len").agg(*measures).filter("n > 0")
    lengths = lengths.withColumn("is_total", F.lit(0))
    return with_total_rows(lengths, keys) if with_total else lengths


def _measures(lengths: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in lengths.columns if c not in {*keys, "len", "is_total"}]


def with_total_rows(lengths: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Length table with the rows over all keys added."""
    measures = _measures(lengths, keys)
    over_all = lengths.groupBy("len").agg(*[F.sum(m).alias(m) for m in measures])
    kinds = {f.name: f.dataType for f in lengths.schema}
    return lengths.unionByName(
        over_all.select(
            *[F.lit(None).cast(kinds[k]).alias(k) for k in keys],
            "len",
            *measures,
            F.lit(1).alias("is_total"),
        )
    )


def merge_lengths(
    lengths: DataFrame, keys: Sequence[str], with_total: bool = False
) -> DataFrame:
    """Length table brought to fewer keys, for example from files to samples."""
    known = [c for c in ("n", "gc", "gap", "q20", "q30", "error") if c in lengths.columns]
    merged = (
        lengths.groupBy(*keys, "len")
        .agg(*[F.sum(m).alias(m) for m in known])
        .withColumn("is_total", F.lit(0))
    )
    return with_total_rows(merged, keys) if with_total else merged


def stats_of_lengths(lengths: DataFrame, keys: Sequence[str], has_quality: bool) -> DataFrame:
    """Statistics per key from a length table, which is as small as the distinct lengths."""
    keys = [*keys, "is_total"]
    bases = F.col("len") * F.col("n")
    whole = Window.partitionBy(*keys)
    longest_first = whole.orderBy(F.col("len").desc())
    ranked = lengths.withColumn("__total", F.sum(bases).over(whole)).withColumn(
        "__down_to", F.sum(bases).over(longest_first)
    )
    total = F.sum(bases)
    quartiles = F.percentile("len", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n"))
    columns = [
        F.sum("n").alias("num_seqs"),
        total.alias("sum_len"),
        F.min("len").alias("min_len"),
        (total / F.sum("n")).alias("avg_len"),
        F.max("len").alias("max_len"),
        quartiles.alias("__quartiles"),
        F.sum("gap").alias("sum_gap"),
        F.max(F.when(F.col("__down_to") * 2 >= F.col("__total"), F.col("len"))).alias("n50"),
        F.when(total > 0, 100 * F.sum("gc") / total).alias("gc_pct"),
    ]
    if has_quality:
        columns += [
            F.when(total > 0, 100 * F.sum("q20") / total).alias("q20_pct"),
            F.when(total > 0, 100 * F.sum("q30") / total).alias("q30_pct"),
            F.when(total > 0, -10 * F.log10(F.sum("error") / total)).alias("avg_qual"),
        ]
    stats = ranked.groupBy(*keys).agg(*columns)
    for i in range(3):
        stats = stats.withColumn(f"q{i + 1}", F.get("__quartiles", F.lit(i)))
    return stats.drop("__quartiles")


def sequence_stats(
    df: DataFrame,
    file: str = "file",
    seq: str = "seq",
    qual: str | None = None,
    sequence_type: str = "DNA",
) -> DataFrame:
    """One row per file: format, type, counts, lengths, quartiles, N50, GC, gaps, qualities."""
    stats = stats_of_lengths(length_table(df, [file], seq, qual), [file], qual is not None)
    return stats.select(
        file,
        F.lit("FASTQ" if qual else "FASTA").alias("format"),
        F.lit(sequence_type).alias("type"),
        *[c for c in stats.columns if c not in (file, "is_total")],
    )


def n50_by_sample(df: DataFrame, sample: str, seq: str = "seq") -> DataFrame:
    """Largest length whose longer-or-equal reads hold half of a sample's bases."""
    stats = stats_of_lengths(length_table(df, [sample], seq), [sample], False)
    return stats.select(sample, "num_seqs", "sum_len", "n50")


def run_rollup(df: DataFrame, sample: str, seq: str = "seq", qual: str = "qual") -> DataFrame:
    """Statistics per sample plus one row for the run (sample NULL, is_total = 1)."""
    table = length_table(df, [sample], seq, qual, with_total=True)
    return stats_of_lengths(table, [sample], True)


def fasta_index(
    spark: SparkSession, paths: str | Sequence[str], split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """Index rows of FASTA files as stored: file, record_no, name, length, offset, line sizes.

    Raises while running if a record's lines differ in length before its last one. A record may
    be spread over any number of splits.
    """
    return index_rows(spark, paths, split_bytes)


def rendered_fasta_index(
    df: DataFrame,
    file: str,
    record_no: str,
    name: str,
    seq: str,
    width: int = 80,
    chunk_rows: int = 65_536,
) -> DataFrame:
    """Index rows the FASTA sink's text will have when each file is in `record_no` order."""
    width = integer_argument(width, "width", 1)
    length = F.length(seq).cast("bigint")
    slim = df.select(
        file,
        F.col(record_no).alias("record_no"),
        F.regexp_extract(name, r"^(\S*)", 1).alias("name"),
        length.alias("length"),
        (F.octet_length(name) + 2).cast("bigint").alias("header_bytes"),
    )
    # an empty sequence still ends with one newline
    folds = F.greatest(F.ceil(F.col("length") / width), F.lit(1))
    placed = running_totals(
        slim,
        group=[file],
        chunk=[F.floor(F.col("record_no") / chunk_rows)],
        order=F.col("record_no"),
        totals={"start": F.col("header_bytes") + F.col("length") + folds},
    )
    line = F.least(F.col("length"), F.lit(width)).cast("bigint")
    return placed.select(
        file,
        "record_no",
        "name",
        "length",
        (F.col("start") + F.col("header_bytes")).cast("bigint").alias("offset"),
        line.alias("line_bases"),
        F.when(line > 0, line + 1).otherwise(0).cast("bigint").alias("line_bytes"),
    )


def write_fasta_index(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Index rows of one FASTA file as tab-separated text, in record order."""
    columns = ("name", "length", "offset", "line_bases", "line_bytes")
    require_columns(rows, ["file", "record_no", *columns], "the index rows")
    lines = rows.sort("file", "record_no").select(F.concat_ws("\t", *columns).alias("value"))
    lines.write.mode(mode).text(path)
