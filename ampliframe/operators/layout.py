"""Layout plan of per-barcode read folders."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampliframe.contracts import ProblemRows, flag_argument, require_columns, text_argument
from ampliframe.functions.labels import barcode_label, group_key, is_blank, numbers_as_text
from ampliframe.functions.scale import join_lookup
from ampliframe.sources.files import list_directories


def layout_rows(
    sample_info: DataFrame,
    project_col: str | None = None,
    amplicon_size_col: str = "Expected_Amplicon_Size_bp",
    barcode_col: str = "Barcode_ID",
) -> DataFrame:
    """barcode, project, amplicon_size, group and `valid` for every row of the sample sheet.

    A row is invalid if its barcode, size or (where used) project is missing.
    """
    text_argument(amplicon_size_col, "amplicon_size_col")
    text_argument(barcode_col, "barcode_col")
    needed = [barcode_col, amplicon_size_col]
    if project_col is not None:
        needed.append(text_argument(project_col, "project_col"))
    require_columns(sample_info, needed, "sample_info")
    project = F.col(project_col) if project_col else F.lit(None)
    sample_info = numbers_as_text(sample_info, needed)
    rows = sample_info.select(
        barcode_label(barcode_col).alias("barcode"),
        project.cast("string").alias("project"),
        F.col(amplicon_size_col).cast("string").alias("amplicon_size"),
    )
    invalid = is_blank("barcode") | is_blank("amplicon_size")
    if project_col is not None:
        invalid = invalid | is_blank("project")
    key = group_key("amplicon_size", "project" if project_col else None)
    return rows.select("*", key.alias("group"), (~invalid).alias("valid"))


def flag_present(df: DataFrame, path: str, present: DataFrame, key: str, flag: str) -> DataFrame:
    """Add whether `path` occurs among the distinct values of `present.key`."""
    marks = present.select(F.col(key).alias(path), F.lit(True).alias("__there"))
    joined = df.join(marks, path, "left")
    return joined.select(*df.columns, F.coalesce("__there", F.lit(False)).alias(flag))


def layout_plan(
    sample_info: DataFrame,
    fastq_dir: str,
    directories: DataFrame,
    project_col: str | None = None,
    amplicon_size_col: str = "Expected_Amplicon_Size_bp",
    barcode_col: str = "Barcode_ID",
    dry_run: bool = False,
) -> DataFrame:
    """Where each barcode folder goes, whether source and destination exist, and the status.

    `directories` has the existing ones as `dir` (see `list_directories`). Nothing is moved.
    """
    flag_argument(dry_run, "dry_run")
    root = text_argument(fastq_dir, "fastq_dir").rstrip("/")
    rows = layout_rows(sample_info, project_col, amplicon_size_col, barcode_col).filter("valid")
    planned = rows.select(
        "barcode",
        "project",
        "amplicon_size",
        "group",
        F.concat(F.lit(root + "/"), F.col("barcode")).alias("source"),
        F.concat(F.lit(root + "/"), F.col("group"), F.lit("/"), F.col("barcode")).alias(
            "destination"
        ),
    )
    below = directories.filter(F.col("dir").startswith(root + "/")).select("dir").distinct()
    flagged = flag_present(planned, "source", below, "dir", "source_exists")
    flagged = flag_present(flagged, "destination", below, "dir", "destination_exists")
    ready = "dry_run" if dry_run else "planned"
    return flagged.select(
        "*",
        F.lit(False).alias("moved"),
        F.when(F.col("source_exists"), ready).otherwise("missing_source").alias("status"),
    )


def plan_fastq_layout(
    sample_info: DataFrame,
    fastq_dir: str,
    files: DataFrame,
    project_col: str | None = None,
    amplicon_size_col: str = "Expected_Amplicon_Size_bp",
    barcode_col: str = "Barcode_ID",
    overwrite: bool = False,
    dry_run: bool = False,
) -> DataFrame:
    """`layout_plan` with the checks of a run: warns about dropped rows and missing folders and
    refuses existing destinations unless `overwrite`. `files` is a listing of files; one with
    folders (`list_entries`) also shows the empty ones."""
    flag_argument(overwrite, "overwrite")
    options = (project_col, amplicon_size_col, barcode_col)
    dropped = layout_rows(sample_info, *options).filter("not valid").count()
    if dropped:
        warnings.warn(
            f"dropping {dropped} row(s) with missing barcode, project, or amplicon size",
            stacklevel=2,
        )
    plan = layout_plan(sample_info, fastq_dir, list_directories(files), *options, dry_run=dry_run)
    state = plan.agg(
        F.count_if(~F.col("source_exists")).alias("missing"),
        F.count_if("destination_exists").alias("taken"),
    ).first()
    if state["missing"]:
        lacking = plan.filter("not source_exists").select("barcode").distinct().collect()
        told = ", ".join(sorted(r["barcode"] for r in lacking))
        warnings.warn(
            f"{len(lacking)} barcode folder(s) were not found in fastq_dir: {told}", stacklevel=2
        )
    if state["taken"] and not overwrite:
        # one row per barcode folder that stands in the way: all of them are told
        taken = plan.filter("destination_exists").select("barcode", "destination")
        told = sorted({r["destination"] for r in taken.collect()})
        raise ProblemRows(
            f"{len(told)} destination folder(s) already exist: {', '.join(told)}; "
            "use overwrite=True to replace them",
            taken,
        )
    return plan


def add_groups(
    reads: DataFrame,
    sample_info: DataFrame,
    project_col: str | None = None,
    amplicon_size_col: str = "Expected_Amplicon_Size_bp",
    barcode_col: str = "Barcode_ID",
) -> DataFrame:
    """Reads (with `barcode`) joined to the group folder of their barcode, for the grouped sink."""
    rows = layout_rows(sample_info, project_col, amplicon_size_col, barcode_col)
    groups = rows.filter("valid").select("barcode", "group").distinct()
    return join_lookup(reads, groups, ["barcode"], "inner")
