"""FASTA scan and sink, record numbering and the name rules of sequence sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampliframe.contracts import integer_argument, require_columns
from ampliframe.functions.labels import is_blank, plain_path
from ampliframe.functions.scale import join_lookup, number_in_slices


def record_header(record: Column | str) -> Column:
    """The first line of a record's text, as it stands."""
    return F.substring_index(record, "\n", 1)


def record_name(record: Column | str) -> Column:
    """The title of a record's text, without its mark and a carriage return."""
    return F.regexp_replace(F.regexp_replace(record_header(record), "\r$", ""), "^>", "")


def record_body(record: Column | str) -> Column:
    text = F.col(record) if isinstance(record, str) else record
    return F.substring(text, F.length(record_header(text)) + 2, F.length(text))


def record_seq(record: Column | str) -> Column:
    """The sequence of a record's text without white space."""
    return F.regexp_replace(record_body(record), r"\s+", "")


def scan_fasta_text(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per record with its raw text: file, file_block, row_in_block, record, header,
    name, body.

    A record separator of newline and '>' lets the splittable text reader cut files into records;
    only the first record of a file still carries its '>'. `file_block` and `row_in_block` order
    the records of a file.
    """
    raw = (
        spark.read.option("lineSep", "\n>")
        .text(list(paths) if not isinstance(paths, str) else paths)
        .select(
            plain_path("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("file_block"),
            F.regexp_replace("value", "^>", "").alias("record"),
        )
        .filter(F.col("record").rlike(r"\S"))
    )
    # numbered after the filter, so that the records of a block count up without holes
    with_header = raw.select(
        "file",
        "file_block",
        F.monotonically_increasing_id().alias("row_in_block"),
        "record",
        record_header("record").alias("header"),
    )
    return with_header.select(
        "*", record_name("record").alias("name"), record_body("record").alias("body")
    )


def scan_fasta(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per record: file, file_block, row_in_block, name, seq."""
    return scan_fasta_text(spark, paths).select(
        "file",
        "file_block",
        "row_in_block",
        "name",
        F.regexp_replace("body", r"\s+", "").alias("seq"),
    )


def number_records(df: DataFrame) -> DataFrame:
    """Replace the scan's order columns by a dense 1-based `record_no` per file."""
    require_columns(df, ["file", "file_block", "row_in_block"], "the scan")
    numbered = number_in_slices(df, ["file"], "file_block", "row_in_block", "record_no")
    rest = [c for c in df.columns if c not in ("file", "file_block", "row_in_block")]
    return numbered.select("file", F.col("record_no").cast("bigint").alias("record_no"), *rest)


def read_fasta(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Records of FASTA files: file, record_no, name, seq."""
    return number_records(scan_fasta(spark, paths))


def name_all_or_number(df: DataFrame, prefix: str = "seq") -> DataFrame:
    """Rename every record of a file to <prefix><record_no> if any name in that file is blank."""
    require_columns(df, ["file", "record_no", "name"], "the sequence set")
    incomplete = df.filter(is_blank("name")).select("file").distinct().withColumn(
        "__renamed", F.lit(True)
    )
    flagged = join_lookup(df, incomplete, ["file"], "left")
    new_name = F.concat(F.lit(prefix), F.col("record_no").cast("string"))
    return flagged.withColumn(
        "name", F.when(F.col("__renamed"), new_name).otherwise(F.col("name"))
    ).select(*df.columns)


def fasta_record(name: str = "name", seq: str = "seq", width: int = 80):
    """Text of one record with the sequence folded at `width` characters."""
    width = integer_argument(width, "width", 1)
    folded = F.regexp_replace(F.col(seq), f"(.{{{width}}})(?=.)", "$1\n")
    return F.concat(F.lit(">"), F.col(name), F.lit("\n"), folded)


def write_fasta(
    df: DataFrame,
    path: str,
    width: int = 80,
    order_by: Sequence[str] = (),
    mode: str = "errorifexists",
) -> None:
    """Write name/seq rows as FASTA text; `order_by` range-sorts the parts."""
    require_columns(df, ["name", "seq"], "the sequence set")
    if order_by:
        df = df.sort(*order_by)
    df.select(fasta_record(width=width).alias("value")).write.mode(mode).text(path)
