"""Read counts, recovery and length distributions of a sequencing summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampliframe.contracts import integer_argument, number_argument, require_columns
from ampliframe.functions.scale import join_lookup, local_table
from ampliframe.session import materialise

# Bins of a length histogram, default thresholds of an amplicon run.
BINS = 30
MIN_READ_LENGTH = 2000
MAX_READ_LENGTH = 3300
MIN_READ_QUALITY = 10
MIN_READS_PER_BARCODE = 40

_LEVELS = T.StructType(
    [T.StructField("sample", T.StringType()), T.StructField("level_no", T.IntegerType())]
)


def declared_levels(
    barcodes: Sequence[int] = range(1, 97),
    barcode_digits: int = 2,
    unclassified: str = "unclassified",
) -> list[str]:
    """Barcode labels in the given order, padded to a common width, then the unclassified one."""
    barcodes = [integer_argument(b, "barcodes") for b in barcodes]
    if not barcodes:
        raise ValueError("barcodes must not be empty")
    width = max(barcode_digits, len(str(max(barcodes))))
    return [f"barcode{b:0{width}d}" for b in barcodes] + [unclassified]


def levels_table(spark: SparkSession, labels: Sequence[str]) -> DataFrame:
    """Levels as (sample, level_no); as large as the list the caller passed."""
    rows = [(label, i) for i, label in enumerate(labels, 1)]
    return local_table(spark, rows, _LEVELS)


def observed_levels(df: DataFrame, sample: str, order: Sequence[str]) -> DataFrame:
    """Labels by first appearance as (sample, level_no).

    `order` names the columns giving the row order; the last one must be numeric. Minima are
    taken per label and leading order columns first, which hashes and combines map-side, so only
    labels times blocks remain to be sorted.
    """
    *leading, last = order
    labelled = df.filter(F.col(sample).isNotNull())
    firsts = labelled.groupBy(F.col(sample).alias("sample"), *leading).agg(
        F.min(last).alias("__first")
    )
    place = F.struct(*leading, "__first")
    per_label = firsts.groupBy("sample").agg(F.min(place).alias("__place"))
    numbered = F.row_number().over(Window.orderBy("__place"))
    return per_label.select("sample", numbered.cast("int").alias("level_no"))


def filter_read_length(
    df: DataFrame,
    length: str,
    min_read_length: float | None = None,
    max_read_length: float | None = None,
) -> DataFrame:
    """Rows with a length inside the inclusive bounds; NULL lengths always go."""
    return df.filter(_length_kept(length, min_read_length, max_read_length))


def _length_kept(length: str, low: float | None, high: float | None) -> Column:
    if low is not None:
        number_argument(low, "min_read_length", 0)
    if high is not None:
        number_argument(high, "max_read_length", 0)
    if low is not None and high is not None and low > high:
        raise ValueError("min_read_length must not exceed max_read_length")
    kept = F.col(length).isNotNull()
    if low is not None:
        kept = kept & (F.col(length) >= F.lit(float(low)))
    if high is not None:
        kept = kept & (F.col(length) <= F.lit(float(high)))
    return kept


def length_frequencies(df: DataFrame, sample: str, length: str) -> DataFrame:
    """The summary as (sample, length, n): every count and histogram below follows from it.

    One pass over the reads, combined in each task; missing samples and lengths are kept. With it
    given to `totals_of`, `counts_of`, `run_numbers` and `histogram_of`, the reads are not looked at again.
    """
    require_columns(df, [sample, length], "the summary")
    named = df.select(F.col(sample).alias("sample"), F.col(length).alias("length"))
    return named.groupBy("sample", "length").agg(F.count(F.lit(1)).alias("n"))


def _bounded(low: float | None, high: float | None) -> Column:
    return F.coalesce(_length_kept("length", low, high), F.lit(False))


def totals_of(
    frequencies: DataFrame, min_read_length: float | None = None, max_read_length: float | None = None
) -> DataFrame:
    """`read_totals` from a table of frequencies."""
    return frequencies.filter("sample is not null").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_reads_raw"),
        F.coalesce(
            F.sum(F.when(_bounded(min_read_length, max_read_length), F.col("n"))), F.lit(0)
        ).alias("n_reads_filtered"),
    )


def counts_of(
    frequencies: DataFrame,
    levels: DataFrame,
    min_read_length: float | None = None,
    max_read_length: float | None = None,
) -> DataFrame:
    """`read_counts` from a table of frequencies."""
    kept = frequencies.filter(_bounded(min_read_length, max_read_length))
    counted = kept.filter("sample is not null").groupBy("sample").agg(F.sum("n").alias("__n"))
    return (
        levels.join(counted, "sample", "left")
        .select("sample", "level_no", F.coalesce("__n", F.lit(0)).alias("Freq"))
        .orderBy("level_no")
    )


def run_numbers(
    frequencies: DataFrame,
    levels: DataFrame,
    min_read_length: float | None = None,
    max_read_length: float | None = None,
    unclassified: str = "unclassified",
) -> DataFrame:
    """One row: recovery and n_reads_in_levels, as `recovery_rate`, and the totals of `totals_of`.

    One aggregate over the table of frequencies; levels are joined to its samples.
    """
    kept = F.when(_bounded(min_read_length, max_read_length), F.col("n")).otherwise(0)
    samples = frequencies.filter("sample is not null").groupBy("sample").agg(
        F.sum("n").alias("raw"), F.sum(kept).alias("kept")
    )
    placed = samples.join(levels.select("sample", "level_no"), "sample", "left")
    counted = F.when(F.col("level_no").isNotNull(), F.col("kept"))
    lost = F.coalesce(F.sum(F.when(F.col("sample") == unclassified, counted)), F.lit(0))
    total = F.sum(counted)
    return placed.agg(
        F.when(total > 0, (1 - lost / total) * 100).alias("recovery"),
        F.coalesce(total, F.lit(0)).alias("n_reads_in_levels"),
        F.coalesce(F.sum("raw"), F.lit(0)).alias("n_reads_raw"),
        F.coalesce(F.sum("kept"), F.lit(0)).alias("n_reads_filtered"),
    )


def read_totals(
    df: DataFrame,
    sample: str,
    length: str,
    min_read_length: float | None = None,
    max_read_length: float | None = None,
) -> DataFrame:
    """One row: reads with a sample label, and those of them that pass the length filter."""
    labelled = F.col(sample).isNotNull()
    kept = labelled & _length_kept(length, min_read_length, max_read_length)
    return df.agg(
        F.count_if(labelled).alias("n_reads_raw"), F.count_if(kept).alias("n_reads_filtered")
    )


def read_counts(
    df: DataFrame,
    levels: DataFrame,
    sample: str,
    length: str,
    min_read_length: float | None = None,
    max_read_length: float | None = None,
) -> DataFrame:
    """sample, level_no, Freq for every level, zeros included, in level order.

    Labels outside the levels are not counted.
    """
    counted = (
        filter_read_length(df, length, min_read_length, max_read_length)
        .filter(F.col(sample).isNotNull())
        .groupBy(F.col(sample).alias("sample"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    return (
        levels.join(counted, "sample", "left")
        .select("sample", "level_no", F.coalesce("__n", F.lit(0)).alias("Freq"))
        .orderBy("level_no")
    )


def long_metrics(counts: DataFrame, unclassified: str = "unclassified") -> DataFrame:
    """Counts in long form: Freq, Log10Freq (NULL at zero), Recovered (zero if unclassified)."""
    n = F.col("Freq").cast("double")
    blocks = F.array(
        F.struct(F.lit("Freq").alias("type"), n.alias("value")),
        F.struct(
            F.lit("Log10Freq").alias("type"), F.when(n > 0, F.log10(n)).alias("value")
        ),
        F.struct(
            F.lit("Recovered").alias("type"),
            F.when(F.col("sample") == unclassified, F.lit(0.0)).otherwise(n).alias("value"),
        ),
    )
    return counts.select("sample", "level_no", F.inline(blocks))


def recovery_rate(counts: DataFrame, unclassified: str = "unclassified") -> DataFrame:
    """One row: percentage of counted reads that carry a sample, NULL without reads."""
    total = F.sum("Freq")
    lost = F.sum(F.when(F.col("sample") == unclassified, F.col("Freq")).otherwise(0))
    return counts.agg(
        F.when(total > 0, (1 - lost / total) * 100).alias("recovery"),
        total.alias("n_reads_in_levels"),
    )


def length_histogram(
    df: DataFrame,
    levels: DataFrame,
    sample: str,
    length: str,
    bins: int = BINS,
) -> DataFrame:
    """Counts over equal-width bins of log10(length) per sample: sample, level_no, bin, n.

    The first bin is centred on the shortest read of a sample, the last on its longest. Levels
    without reads keep one row with NULL bin and n = 0. Reads are reduced to distinct lengths
    with counts first; everything after works on that table.
    """
    return histogram_of(length_frequencies(df, sample, length), levels, bins=bins)


def histogram_of(
    frequencies: DataFrame,
    levels: DataFrame,
    min_read_length: float | None = None,
    max_read_length: float | None = None,
    bins: int = BINS,
) -> DataFrame:
    """`length_histogram` from a table of frequencies; the range of a sample comes from its rows there."""
    bins = integer_argument(bins, "bins", 2)
    length = F.col("length").cast("double")
    usable = _bounded(min_read_length, max_read_length) & ~F.isnan(length) & (length > 0)
    usable = usable & (length < F.lit(float("inf"))) & F.col("sample").isNotNull()
    own = Window.partitionBy("sample")
    counted = frequencies.filter(usable).select("sample", "n", F.log10(length).alias("__x"))
    ranged = counted.select(
        "*", F.min("__x").over(own).alias("__lo"), F.max("__x").over(own).alias("__hi")
    )
    width = F.when(F.col("__hi") > F.col("__lo"), (F.col("__hi") - F.col("__lo")) / (bins - 1))
    placed = ranged.withColumn("__width", width.otherwise(F.lit(0.1)))
    edge = F.col("__lo") - F.col("__width") / 2
    place = F.ceil((F.col("__x") - edge) / F.col("__width"))
    bin_ = F.least(F.greatest(place, F.lit(1)), F.lit(bins)).cast("int").alias("bin")
    binned = placed.groupBy("sample", bin_).agg(F.sum("n").alias("n"))
    return levels.join(binned, "sample", "left").select(
        "sample", "level_no", "bin", F.coalesce("n", F.lit(0)).alias("n")
    )


def eligible_reads(
    reads: DataFrame,
    barcode: str,
    length: Column | str,
    quality: Column | str,
    min_read_length: int = MIN_READ_LENGTH,
    max_read_length: int = MAX_READ_LENGTH,
    min_read_qual: float = MIN_READ_QUALITY,
    min_n_reads: int = MIN_READS_PER_BARCODE,
    quality_as: str | None = None,
) -> DataFrame:
    """Reads passing length and mean quality, of barcodes keeping at least `min_n_reads` of them.

    The reads are read and their quality is worked out once: those that pass are stored in the
    checkpoint folder, counted there by a hash aggregate and read again. A barcode holding much of
    the data is never gathered in one task. `quality_as` names a column for the quality compared.
    """
    min_read_length = integer_argument(min_read_length, "min_read_length", 1)
    max_read_length = integer_argument(max_read_length, "max_read_length", 1)
    number_argument(min_read_qual, "min_read_qual", 0)
    min_n_reads = integer_argument(min_n_reads, "min_n_reads", 1)
    if min_read_length > max_read_length:
        raise ValueError("min_read_length must not exceed max_read_length")
    require_columns(reads, [barcode], "the read set")
    if isinstance(length, str):
        length = F.col(length)
    if isinstance(quality, str):
        quality = F.col(quality)
    # only reads of the right length have their quality worked out
    passed = (
        reads.select("*", length.alias("__length"))
        .filter(F.col("__length").between(min_read_length, max_read_length))
        .select(*[F.col(c) for c in reads.columns], quality.alias("__quality"))
        .filter(F.col("__quality") >= min_read_qual)
    )
    passed = materialise(passed)
    enough = (
        passed.groupBy(barcode)
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") >= min_n_reads)
        .select(barcode)
    )
    out = join_lookup(passed, enough, [barcode], "left_semi")
    if quality_as is None:
        return out.drop("__quality")
    return out.withColumnRenamed("__quality", quality_as)
