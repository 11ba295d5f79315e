"""Scans of sequencing summaries and sample sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampliframe.contracts import require_columns, text_argument
from ampliframe.functions.labels import plain_path


def read_summary(
    spark: SparkSession,
    path: str | list[str],
    sample_col: str = "alias",
    length_col: str = "sequence_length_template",
    keep_order: bool = False,
) -> DataFrame:
    """Tab-separated sequencing summary with a text sample and a numeric length column.

    Everything is read as text, so no inference pass runs; lengths that are not numbers become
    NULL. The literal NA is read as NULL; a blank field stays an empty text. With `keep_order` the columns `file`, `file_block` and
    `row_in_block` tell the rows' order in the file without a sort.
    """
    df = (
        spark.read.option("sep", "\t")
        .option("header", True)
        .option("emptyValue", "")
        .csv(path)
    )
    fields = df.columns
    extra = []
    if keep_order:
        df = df.select("*", "_metadata")
        extra = [
            plain_path("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("file_block"),
            F.monotonically_increasing_id().alias("row_in_block"),
        ]
    # the reader cannot tell a blank field from a NULL: every NULL it gives was blank
    told = {
        c: F.when(F.col(f"`{c}`") == "NA", F.lit(None)).otherwise(
            F.coalesce(F.col(f"`{c}`"), F.lit(""))
        )
        for c in fields
    }
    df = df.select(*[told[c].alias(c) if c in told else c for c in df.columns])
    return coerce_summary(df, sample_col, length_col, extra)


def coerce_summary(
    df: DataFrame,
    sample_col: str = "alias",
    length_col: str = "sequence_length_template",
    extra: list | None = None,
) -> DataFrame:
    """Column contract and types of a summary table from any source."""
    text_argument(sample_col, "sample_col")
    text_argument(length_col, "length_col")
    require_columns(df, [sample_col, length_col], "the sequencing summary")
    typed = {
        sample_col: F.col(sample_col).cast("string"),
        length_col: F.col(length_col).try_cast("double"),
    }
    kept = [
        typed.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns if c != "_metadata"
    ]
    return df.select(*kept, *(extra or []))


def read_sample_info(spark: SparkSession, source: DataFrame | str) -> DataFrame:
    """Sample sheet as given, or read from a CSV with a header."""
    if isinstance(source, DataFrame):
        return source
    if not isinstance(source, str) or source == "":
        raise ValueError("sample_info must be a DataFrame or the path of a CSV file")
    return (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("nullValue", "NA")
        .csv(source)
    )
