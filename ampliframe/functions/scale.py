"""Building blocks that keep big groups spread over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: rows a lookup may have to be sent to every executor
LOOKUP_ROWS = 10_000
#: input splits whose row counts may be sent to every executor
SLICE_ROWS = 200_000


def local_table(spark: SparkSession, rows: Sequence[Sequence], schema: StructType) -> DataFrame:
    """Rows held by the driver as a local relation, whose exact size the planner knows."""
    columns = list(zip(*rows)) or [[] for _ in schema.fields]
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


def small_or_none(df: DataFrame, max_rows: int = LOOKUP_ROWS) -> DataFrame | None:
    """`df` as a local relation if it has at most `max_rows` rows, else None.

    The row bound is checked by fetching one row more than allowed, so the driver never holds
    more than that.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return None
    return local_table(df.sparkSession, rows, df.schema)


def join_lookup(
    df: DataFrame, lookup: DataFrame, on: Sequence[str], how: str, max_rows: int = LOOKUP_ROWS
) -> DataFrame:
    """Join to a derived table that is usually small.

    Within the row bound the lookup is broadcast, so a hot key in `df` moves no data. Beyond it a
    plain join is used, where adaptive execution splits skewed partitions.
    """
    small = small_or_none(lookup, max_rows)
    if small is not None:
        return df.join(F.broadcast(small), list(on), how)
    return df.join(lookup, list(on), how)


#: Spark's own number of shuffle partitions, which says nothing about the data at hand
UNSET_PARTITIONS = 200


def spread(df: DataFrame) -> DataFrame:
    """Deal rows evenly over tasks before work that costs far more per byte than a shuffle.

    Rows are dealt in turn, so equal rows do not meet in one task. There are two tasks for each
    core, and more where `spark.sql.shuffle.partitions` has been set to more: bytes are no measure
    of this work, so adaptive execution must not merge tasks that are small in bytes.
    """
    session = df.sparkSession
    tasks = 2 * session.sparkContext.defaultParallelism
    wanted = int(session.conf.get("spark.sql.shuffle.partitions"))
    if wanted != UNSET_PARTITIONS:
        tasks = max(tasks, wanted)
    return df.repartition(tasks)


def number_in_slices(
    df: DataFrame, group: Sequence[str], slice_col: str, index_col: str, name: str
) -> DataFrame:
    """Add a dense 1-based row number per group, given each row's place in an ordered slice.

    `index_col` counts up by one within a slice of the group. Only the small table of slices is
    aggregated; the rows themselves are neither sorted nor, while that table is small, shuffled.
    """
    before = Window.partitionBy(*group).orderBy(slice_col).rowsBetween(
        Window.unboundedPreceding, -1
    )
    slices = (
        df.groupBy(*group, slice_col)
        .agg(F.count(F.lit(1)).alias("__rows"), F.min(index_col).alias("__first"))
        .select(
            *group,
            slice_col,
            "__first",
            F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
        )
    )
    joined = join_lookup(df, slices, [*group, slice_col], "left", SLICE_ROWS)
    number = F.col("__before") + F.col(index_col) - F.col("__first") + 1
    changed = F.raise_error(F.lit("the input was split differently while its rows were counted"))
    return joined.withColumn(
        name,
        F.when(F.col("__before").isNull(), changed.cast("bigint")).otherwise(number),
    ).drop("__before", "__first")


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    chunk: Sequence[Column],
    order: Column,
    totals: dict[str, Column],
) -> DataFrame:
    """Add exclusive running sums per group without putting a whole group into one task.

    `chunk` splits a group into ordered slices of bounded size, `order` orders the rows within a
    slice and `totals` maps a new column to the value it sums. Slice sums are added up over the
    small table of slices; rows are then numbered within their own slice only.
    """
    chunk_cols = [f"__chunk{i}" for i in range(len(chunk))]
    keyed = df.select(
        "*",
        *[c.alias(n) for c, n in zip(chunk, chunk_cols)],
        order.alias("__order"),
        *[v.alias(f"__value_{n}") for n, v in totals.items()],
    )
    keys = [*group, *chunk_cols]
    before_chunk = Window.orderBy(*chunk_cols).rowsBetween(Window.unboundedPreceding, -1)
    if group:
        before_chunk = Window.partitionBy(*group).orderBy(*chunk_cols).rowsBetween(
            Window.unboundedPreceding, -1
        )
    slices = (
        keyed.groupBy(*keys)
        .agg(*[F.sum(f"__value_{n}").alias(f"__sum_{n}") for n in totals])
        .select(
            *keys,
            *[
                F.coalesce(F.sum(f"__sum_{n}").over(before_chunk), F.lit(0)).alias(f"__base_{n}")
                for n in totals
            ],
        )
    )
    before_row = (
        Window.partitionBy(*keys).orderBy("__order").rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = keyed.join(slices, keys, "inner") if keys else keyed.crossJoin(slices)
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[
            (
                F.col(f"__base_{n}")
                + F.coalesce(F.sum(f"__value_{n}").over(before_row), F.lit(0))
            ).alias(n)
            for n in totals
        ],
    )
