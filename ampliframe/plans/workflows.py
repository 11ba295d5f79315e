"""Whole tasks of a sequencing lab, put together from the operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampliframe.contracts import refuse_rows
from ampliframe.functions.labels import fastq_sample_name, is_fastq_path
from ampliframe.operators import delivery, primers
from ampliframe.operators import read_qc as qc
from ampliframe.operators import seq_stats as st
from ampliframe.session import materialise
from ampliframe.sources.fasta import name_all_or_number, read_fasta, write_fasta
from ampliframe.sources.fastq import scan_fastq
from ampliframe.sources.files import gzip_audit, list_files, md5_list
from ampliframe.sources.tables import read_summary


@dataclass(frozen=True)
class RunQC:
    """Tables behind the QC figures of a run."""

    read_counts: DataFrame
    metrics: DataFrame
    length_histogram: DataFrame
    recovery: float | None
    n_reads_raw: int
    n_reads_filtered: int


def run_qc(
    spark: SparkSession,
    path: str | list[str],
    barcodes: Sequence[int] | None = range(1, 97),
    barcode_digits: int = 2,
    unclassified: str = "unclassified",
    sample_col: str = "alias",
    length_col: str = "sequence_length_template",
    min_read_length: float | None = None,
    max_read_length: float | None = None,
) -> RunQC:
    """Read QC of a sequencing summary; without `barcodes` the labels seen are the levels."""
    reads = read_summary(spark, path, sample_col, length_col, keep_order=barcodes is None)
    bounds = (min_read_length, max_read_length)
    kept = qc.filter_read_length(reads, length_col, *bounds)
    if barcodes is None:
        order = ["file", "file_block", "row_in_block"]
        levels = materialise(qc.observed_levels(kept, sample_col, order))
    else:
        names = qc.declared_levels(barcodes, barcode_digits, unclassified)
        levels = qc.levels_table(spark, names)
    # the reads are looked at once; what follows works on their frequencies
    table = materialise(qc.length_frequencies(reads, sample_col, length_col))
    counts = materialise(qc.counts_of(table, levels, *bounds))
    numbers = qc.run_numbers(table, levels, *bounds, unclassified=unclassified).first()
    return RunQC(
        counts,
        qc.long_metrics(counts, unclassified),
        qc.histogram_of(table, levels, *bounds),
        numbers["recovery"],
        numbers["n_reads_raw"],
        numbers["n_reads_filtered"],
    )


def trim_fasta(
    spark: SparkSession,
    input_fasta: str,
    output_fasta: str,
    f_primer: str,
    r_primer: str,
    max_mismatch: int = 2,
    orient_to_forward: bool = True,
    width: int = 80,
) -> DataFrame:
    """Trim the records of a FASTA file, write them in file order, return the summary."""
    named = name_all_or_number(read_fasta(spark, input_fasta))
    trimmed = primers.trim_amplicons(named, f_primer, r_primer, max_mismatch, orient_to_forward)
    trimmed = materialise(trimmed)
    if trimmed.limit(1).count() == 0:
        raise ValueError("the FASTA file to trim holds no record")
    summary = primers.trim_summary(trimmed)
    titles = primers.trim_title("name").alias("name")
    records = trimmed.select("file", "record_no", titles, F.col("trimmed_seq").alias("seq"))
    write_fasta(records, output_fasta, width, order_by=["file", "record_no"])
    return summary


@dataclass(frozen=True)
class FastqDelivery:
    """What a FASTQ package states about its reads."""

    files: DataFrame
    stats: DataFrame
    samples: DataFrame
    checksums: DataFrame


def fastq_delivery(spark: SparkSession, root: str) -> FastqDelivery:
    """Check the FASTQ files below a folder and describe them.

    Refuses an empty folder, repeated file names and broken gzip files.
    """
    found = list_files(spark, root).filter(is_fastq_path("path"))
    names = [r["path"] for r in found.select("path").limit(1).collect()]
    if not names:
        raise ValueError(f"no FASTQ files were found in {root}")
    delivery.require_unique_basenames(found)
    refuse_rows(
        gzip_audit(found).filter(~F.col("ok")),
        "broken gzip file(s)",
        F.concat_ws(": ", "path", "error"),
    )
    lengths = materialise(
        st.length_table(
            scan_fastq(spark, root).withColumn("sample", fastq_sample_name("file")),
            ["file", "sample"],
            "seq",
            "qual",
        )
    )
    samples = st.merge_lengths(lengths, ["sample"], with_total=True)
    return FastqDelivery(
        found.orderBy("path"),
        st.stats_of_lengths(st.merge_lengths(lengths, ["file"]), ["file"], True).drop("is_total"),
        st.stats_of_lengths(samples, ["sample"], True),
        md5_list(found, root),
    )


@dataclass(frozen=True)
class ConsensusDelivery:
    """What a consensus package states about its files."""

    manifest: DataFrame
    stats: DataFrame
    index: DataFrame
    checksums: DataFrame


def consensus_delivery(
    spark: SparkSession, project: str, evidence: dict[str, str]
) -> ConsensusDelivery:
    """Manifest, statistics, FASTA index and checksums of one consensus package.

    `evidence` maps roles such as consensus, bam or notes to file paths.
    """
    if "consensus" not in evidence:
        raise ValueError("evidence must name a consensus file")
    rows = spark.createDataFrame(
        [(project, role, path) for role, path in evidence.items()],
        "project string, role string, source string",
    )
    listed = list_files(spark, list(evidence.values()))
    manifest = delivery.checked_manifest(rows, listed)
    consensus = evidence["consensus"]
    sums = md5_list(listed, "/").select("md5", F.concat(F.lit("/"), "path").alias("source"))
    delivered = manifest.join(sums, "source").select("md5", F.col("delivery_path").alias("path"))
    return ConsensusDelivery(
        manifest,
        st.sequence_stats(read_fasta(spark, consensus)),
        st.fasta_index(spark, consensus),
        delivered.orderBy("path"),
    )
