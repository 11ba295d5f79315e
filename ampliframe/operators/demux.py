"""Demultiplexing trees and base-call models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampliframe.contracts import refuse_rows, require_columns, text_argument
from ampliframe.functions.labels import base_name, dir_name, fastq_sample_name, is_fastq_path

# In a read-group line, the DS field up to the next two-letter tag and, in it, the
# first basecall_model entry.
_MODEL = (
    r"\sDS:(?:(?!basecall_model=)\S*"
    r"(?:\s+(?![A-Za-z][A-Za-z0-9]:)(?!basecall_model=)\S+)*\s+)?basecall_model=(\S+)"
)


def _bam_pass_roots(folders: DataFrame) -> DataFrame:
    """Folders (`dir`) with one row per bam_pass part: run_dir before it, rel_path after it.

    Splitting at the part's own text keeps the work in plain string functions.
    """
    # the pieces are a column of their own, so that each path is split once
    cut = (
        folders.filter(F.concat("dir", F.lit("/")).contains("/bam_pass/"))
        .select("dir", F.split(F.concat("dir", F.lit("/")), "/bam_pass(?=/)").alias("pieces"))
        .select("dir", "pieces", F.explode(F.sequence(F.lit(1), F.size("pieces") - 1)).alias("k"))
    )
    below = F.slice("pieces", F.col("k") + 1, F.size("pieces") - F.col("k"))
    return cut.select(
        "dir",
        F.array_join(F.slice("pieces", F.lit(1), F.col("k")), "/bam_pass").alias("run_dir"),
        F.trim(F.array_join(below, "/bam_pass"), F.lit("/")).alias("rel_path"),
    )


def demux_tree(files: DataFrame, fastq_out: str = "fastq_pass_trim") -> DataFrame:
    """Read folders below each bam_pass and the FASTQ file each one becomes.

    A folder counts if it directly holds a .bam file. A path with several bam_pass parts belongs
    to each of them. Columns: run_dir, rel_path, bam_dir, output.
    """
    text_argument(fastq_out, "fastq_out")
    folders = (
        files.filter(F.col("path").contains("/bam_pass/") & F.col("path").endswith(".bam"))
        .select(dir_name("path").alias("dir"))
        .distinct()
    )
    rooted = _bam_pass_roots(folders).filter("rel_path <> ''")
    return rooted.select(
        "run_dir",
        "rel_path",
        F.col("dir").alias("bam_dir"),
        F.concat(
            F.concat_ws("/", "run_dir", F.lit(fastq_out), "rel_path", base_name("dir")),
            F.lit(".fastq.gz"),
        ).alias("output"),
    )


def run_directories(files: DataFrame) -> DataFrame:
    """Distinct parents of bam_pass folders, sorted."""
    folders = files.select(dir_name("path").alias("dir")).distinct()
    return _bam_pass_roots(folders).select("run_dir").distinct().orderBy("run_dir")


def fastq_samples(files: DataFrame) -> DataFrame:
    """FASTQ files of a listing and the sample each belongs to: path, sample."""
    return files.filter(is_fastq_path("path")).select(
        "path", fastq_sample_name("path").alias("sample")
    )


def basecall_models(header_lines: DataFrame) -> DataFrame:
    """First base-call model named in the read-group lines of each file: file, model.

    `header_lines` has file, line_no and line (SAM header text). Files without one have no row.
    """
    require_columns(header_lines, ["file", "line_no", "line"], "the header lines")
    named = (
        header_lines.filter(F.col("line").startswith("@RG"))
        .select("file", "line_no", F.regexp_extract("line", _MODEL, 1).alias("model"))
        .filter(F.col("model") != "")
    )
    return named.groupBy("file").agg(F.min_by("model", "line_no").alias("model"))


def require_models(header_lines: DataFrame) -> DataFrame:
    """`basecall_models`, refusing files that name none."""
    models = basecall_models(header_lines)
    lacking = header_lines.select("file").distinct().join(models, "file", "left_anti")
    refuse_rows(lacking, "no basecall_model in the header", "file")
    return models
