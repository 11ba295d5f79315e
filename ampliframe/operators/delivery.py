"""Inventories, manifests and audits of delivered files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampliframe.contracts import refuse_rows, require_columns
from ampliframe.functions.labels import base_name, dir_name
from ampliframe.functions.scale import local_table
from ampliframe.operators.layout import flag_present
from ampliframe.sources.files import list_directories

# File names, folder pattern and plot pattern of an amplicon result folder.
CONSENSUS_FILE = "all-consensus-seqs.fasta"
TRIMMED_CONSENSUS_FILE = "all-consensus-seqs_trimmed.fasta"
BARCODE_PATTERN = "^barcode[0-9]+$"
LENGTH_PLOT_PATTERN = r"^Distribution_seqLength__.*\.png$"

# Evidence role, manifest label and delivered path of a consensus package; a path
# ending in "/" keeps the file's own name.
DELIVERY_ROLES = [
    ("consensus", "consensus_fasta", "01_consensus/consensus.fasta"),
    ("sample_sheet", "sample_sheet", "00_metadata/"),
    ("notes", "notes", "00_metadata/"),
    ("bam", "final_alignment_bam", "02_evidence/final_alignment.bam"),
    ("bai", "final_alignment_bai", "02_evidence/final_alignment.bam.bai"),
    ("depth", "final_depth", "02_evidence/final_depth.txt"),
    ("variants_vcf", "variants_vcf", "03_qc/variants.vcf.gz"),
    ("variants_vcf_index", "variants_vcf_index", "03_qc/variants.vcf.gz.csi"),
    ("variants_af", "variants_af", "03_qc/variants.af.tsv"),
    ("variants_af_filtered", "variants_af_filtered", "03_qc/variants_gt0.05.af.tsv"),
    ("assembly_info", "flye_assembly_info", "02_evidence/flye_assembly_info.txt"),
    ("flye_log", "flye_log", "02_evidence/flye.log"),
]
# Manifest rows of files the package makes itself.
GENERATED_ROWS = [
    ("consensus_fasta_index", "generated by samtools faidx", "01_consensus/consensus.fasta.fai"),
    ("consensus_stats", "generated by seqkit stats -a -T", "03_qc/consensus_stats.tsv"),
]


def _item(label, source, destination, kind):
    as_column = lambda v: F.lit(v) if isinstance(v, str) else v
    return F.struct(
        as_column(label).alias("label"),
        source.alias("source"),
        destination.alias("destination"),
        F.lit(kind).alias("type"),
    )


def deliverable_inventory(
    runs: DataFrame,
    files: DataFrame,
    consensus_file: str = CONSENSUS_FILE,
    consensus_index_file: str | None = None,
    trimmed_consensus_file: str = TRIMMED_CONSENSUS_FILE,
    barcode_pattern: str = BARCODE_PATTERN,
    length_plot_pattern: str = LENGTH_PLOT_PATTERN,
    readme_name: str = "README.txt",
) -> DataFrame:
    """Expected items of result folders and whether each exists.

    `runs` has result_dir, output_dir and optionally sample_map, fastq_pass_trim_dir (text) and
    include_execution (boolean), one row per run; `files` is a listing with path. Result:
    result_dir, label, source, destination, type, exists. A directory exists if it holds a file.
    """
    require_columns(runs, ["result_dir", "output_dir"], "the runs table")
    require_columns(files, ["path"], "the file listing")
    index_file = consensus_index_file or consensus_file + ".fai"

    def optional(column: str, kind: str):
        return (F.col(column) if column in runs.columns else F.lit(None)).cast(kind)

    runs = runs.select(
        "result_dir",
        "output_dir",
        optional("sample_map", "string").alias("sample_map"),
        optional("fastq_pass_trim_dir", "string").alias("trim_dir"),
        F.coalesce(optional("include_execution", "boolean"), F.lit(False)).alias("execution"),
    )

    def inside(folder: str, name):
        return F.concat(F.col(folder), F.lit("/"), F.lit(name) if isinstance(name, str) else name)

    listed = files.select("path").distinct()
    directories = list_directories(files)
    fixed = [
        _item(label, inside("result_dir", name), inside("output_dir", name), "file")
        for label, name in (
            ("untrimmed_consensus", consensus_file),
            ("consensus_fasta_index", index_file),
            ("trimmed_consensus", trimmed_consensus_file),
        )
    ]
    fixed.append(
        _item(
            "sample_map",
            F.col("sample_map"),
            inside("output_dir", base_name("sample_map")),
            "file",
        )
    )
    file_items = runs.select("result_dir", F.inline(F.array(*fixed))).filter(
        F.col("source").isNotNull()
    )
    file_items = flag_present(file_items, "source", listed, "path", "exists")

    execution = runs.filter("execution").select(
        "result_dir",
        F.inline(
            F.array(
                _item(
                    "execution",
                    inside("result_dir", "execution"),
                    inside("output_dir", "execution"),
                    "directory",
                )
            )
        ),
    )
    execution = flag_present(execution, "source", directories, "dir", "exists")

    named = directories.select(
        "dir", dir_name("dir").alias("result_dir"), base_name("dir").alias("barcode")
    ).filter(F.col("barcode").rlike(barcode_pattern))
    barcodes = named.join(runs, "result_dir")
    barcode_items = barcodes.select(
        "result_dir",
        F.col("barcode").alias("label"),
        F.col("dir").alias("source"),
        inside("output_dir", F.col("barcode")).alias("destination"),
        F.lit("directory").alias("type"),
        F.lit(True).alias("exists"),
    )

    plot_files = listed.select(
        F.col("path").alias("source"),
        dir_name("path").alias("plot_dir"),
        base_name("path").alias("plot"),
    ).filter(F.col("plot").rlike(length_plot_pattern))
    plots = (
        barcodes.filter(F.col("trim_dir").isNotNull())
        .withColumn("plot_dir", inside("trim_dir", F.col("barcode")))
        .join(plot_files, "plot_dir")
        .select(
            "result_dir",
            F.concat("barcode", F.lit(PLOT_SUFFIX)).alias("label"),
            "source",
            F.concat_ws("/", "output_dir", "barcode", "plot").alias("destination"),
            F.lit("file").alias("type"),
            F.lit(True).alias("exists"),
        )
    )

    readme = runs.select(
        "result_dir",
        F.lit("README").alias("label"),
        F.lit(None).cast("string").alias("source"),
        inside("output_dir", readme_name).alias("destination"),
        F.lit("file").alias("type"),
        F.lit(True).alias("exists"),
    )
    out = file_items
    for more in (barcode_items, plots, execution, readme):
        out = out.unionByName(more)
    return out


#: labels of an inventory before and behind those of the barcode folders, in order
LEADING_LABELS = ("untrimmed_consensus", "consensus_fasta_index", "trimmed_consensus", "sample_map")
CLOSING_LABELS = ("execution", "README")
PLOT_SUFFIX = "_read_length_plot"


def ordered_inventory(items: DataFrame) -> DataFrame:
    """An inventory with `item_no`, the place of an item within its result folder (from 1).

    Consensus files and the sample map come first, then the barcode folders by name, each followed
    by its length plots by path, then the execution folder and the README. A folder's items are
    numbered together; folders are spread over the tasks.
    """
    require_columns(items, ["result_dir", "label", "source", "type"], "the inventory")
    label = F.col("label")
    section = F.lit(len(LEADING_LABELS))
    for i, known in enumerate(LEADING_LABELS):
        section = F.when(label == known, i).otherwise(section)
    for i, known in enumerate(CLOSING_LABELS):
        section = F.when(label == known, len(LEADING_LABELS) + 1 + i).otherwise(section)
    folder = F.regexp_replace(label, f"{PLOT_SUFFIX}$", "")
    place = Window.partitionBy("result_dir").orderBy(
        section, folder, F.col("type") != "directory", "source"
    )
    return items.select(*items.columns, F.row_number().over(place).alias("item_no"))


def roles_table(spark: SparkSession) -> DataFrame:
    fields = [T.StructField(name, T.StringType()) for name in ("role", "label", "place")]
    return local_table(spark, DELIVERY_ROLES, T.StructType(fields))


def evidence_problems(evidence: DataFrame, files: DataFrame) -> DataFrame:
    """Supplied evidence whose file is missing or empty: project, role, source, problem."""
    # a path that is listed twice is one file, and unusable if any listing says so
    sizes = files.groupBy(F.col("path").alias("source")).agg(F.min("size").alias("size"))
    return (
        evidence.join(sizes, "source", "left")
        .filter(F.col("size").isNull() | (F.col("size") <= 0))
        .select(
            "project",
            "role",
            "source",
            F.when(F.col("size").isNull(), "missing").otherwise("empty").alias("problem"),
        )
    )


def delivery_manifest(evidence: DataFrame) -> DataFrame:
    """project, label, source, delivery_path of consensus packages.

    `evidence` has project, role and source. Roles map to fixed labels and paths; index and
    statistics rows are added for every project that supplies a consensus.
    """
    require_columns(evidence, ["project", "role", "source"], "the evidence table")
    roles = F.broadcast(roles_table(evidence.sparkSession))
    own_name = F.when(F.col("place").endswith("/"), base_name("source")).otherwise("")
    supplied = evidence.join(roles, "role").select(
        "project", "label", "source", F.concat("place", own_name).alias("delivery_path")
    )
    made = F.array(
        *[
            F.struct(
                F.lit(label).alias("label"),
                F.lit(source).alias("source"),
                F.lit(path).alias("delivery_path"),
            )
            for label, source, path in GENERATED_ROWS
        ]
    )
    generated = (
        evidence.filter(F.col("role") == "consensus")
        .select("project")
        .distinct()
        .select("project", F.inline(made))
    )
    return supplied.unionByName(generated)


def checked_manifest(evidence: DataFrame, files: DataFrame) -> DataFrame:
    """`delivery_manifest` after refusing missing or empty evidence files and unknown roles."""
    known = [r[0] for r in DELIVERY_ROLES]
    unknown = evidence.filter(~F.coalesce(F.col("role").isin(known), F.lit(False)))
    refuse_rows(unknown, "unknown evidence role", F.coalesce("role", F.lit("(none)")))
    refuse_rows(
        evidence_problems(evidence, files),
        "evidence files are not usable",
        F.concat_ws(" ", "role", "source", F.lit("is"), "problem"),
    )
    return delivery_manifest(evidence)


def missing_indexes(
    files: DataFrame,
    fasta_pattern: str = r"(?i)\.(fa|fasta|fna)$",
    bam_pattern: str = r"(?i)\.bam$",
) -> DataFrame:
    """FASTA files without .fai and BAM files without .bam.bai or .bai: path, kind.

    Only paths that hold the ending of an index take part as names, and repeated ones stay: a name
    met twice refuses a file as well as one met once.
    """
    listed = files.select("path")

    def without(candidates: DataFrame, wanted, ending: str) -> DataFrame:
        names = listed.filter(F.col("path").contains(ending))
        return candidates.join(
            names.withColumnRenamed("path", "__index"), wanted == F.col("__index"), "left_anti"
        )

    fasta = without(
        listed.filter(F.col("path").rlike(fasta_pattern)), F.concat("path", F.lit(".fai")), ".fai"
    )
    bam = without(
        listed.filter(F.col("path").rlike(bam_pattern)), F.concat("path", F.lit(".bai")), ".bai"
    )
    bam = without(bam, F.regexp_replace("path", bam_pattern, ".bai"), ".bai")
    return fasta.select("path", F.lit("fasta").alias("kind")).unionByName(
        bam.select("path", F.lit("bam").alias("kind"))
    )


def duplicate_basenames(files: DataFrame) -> DataFrame:
    """File names that occur more than once: name, n_files."""
    return (
        files.groupBy(base_name("path").alias("name"))
        .agg(F.count(F.lit(1)).alias("n_files"))
        .filter("n_files > 1")
    )


def require_unique_basenames(files: DataFrame) -> None:
    """Raise if two files to deliver share a name."""
    refuse_rows(duplicate_basenames(files), "duplicate FASTQ basename(s)", "name")
