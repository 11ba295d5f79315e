"""Column expressions for barcode labels, path parts and record names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

# File name endings that mark a FASTQ file, and those a sample name loses in turn.
FASTQ_SUFFIXES = (".fastq", ".fq", ".fastq.gz", ".fq.gz")
SAMPLE_ENDINGS = (".gz", ".fastq", ".fq")

# The column whose labels come from a kit, and the number at a kit label's end.
KIT_COLUMN = "Barcode_ID"
KIT_NUMBER = r".+-([0-9]+$)"

# White space cut from both ends of a text.
OUTER_SPACE = r"^[ \t\r\n]+|[ \t\r\n]+$"

# Replacements, in order, that make a text fit for one path component.
SAFE_PATH_STEPS = (
    (r"\s+", "_"),
    (r"[/\\:]+", "_"),
    (r"[^A-Za-z0-9_.-]+", "_"),
    (r"_+", "_"),
    (r"^_|_$", ""),
)

# Runs of these characters become one underscore in output labels.
UNSAFE_IN_LABEL = r"[^A-Za-z0-9_.-]+"


#: types whose whole values Spark prints with a decimal point
FRACTIONAL = (DoubleType, FloatType, DecimalType)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    c = _col(c)
    return c.isNull() | (c == "")


def numbers_as_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """`df` with fractional number columns as text; whole values lose their .0 (1600, not 1600.0).

    A sheet's sizes become DOUBLE as soon as one value has a decimal; they still name the same
    groups. Columns of other types are left as they are.
    """
    chosen = set(columns)
    return df.select(
        *[
            number_text(df, c).alias(c)
            if c in chosen and isinstance(df.schema[c].dataType, FRACTIONAL)
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def number_text(df: DataFrame, name: str) -> Column:
    """A column of `df` as text, whole numbers of a fractional type without .0."""
    value = F.col(f"`{name}`")
    text = value.cast("string")
    if not isinstance(df.schema[name].dataType, FRACTIONAL):
        return text
    whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
    return F.when(whole, value.cast("bigint").cast("string")).otherwise(text)


def plain_path(encoded: Column | str) -> Column:
    """A path as listings spell it, from the encoded address of a file's metadata."""
    decoded = F.url_decode(F.replace(_col(encoded), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "/")


def trimmed(c: Column | str) -> Column:
    """Text without white space at its ends."""
    return F.regexp_replace(_col(c).cast("string"), OUTER_SPACE, "")


def barcode_label(column: str) -> Column:
    """Barcode folder name; only a column called Barcode_ID holds kit labels such as NB-07."""
    text = F.col(column).cast("string")
    if column != KIT_COLUMN:
        return text
    return F.concat(F.lit("barcode"), F.regexp_replace(text, KIT_NUMBER, "$1"))


def safe_path_part(c: Column | str) -> Column:
    """Text made fit for one path component."""
    text = trimmed(c)
    for pattern, new in SAFE_PATH_STEPS:
        text = F.regexp_replace(text, pattern, new)
    return text


def group_key(size: Column | str, project: Column | str | None = None) -> Column:
    """Folder of a barcode: its size, after its project where one is given."""
    if project is None:
        return safe_path_part(size)
    return F.concat(safe_path_part(project), F.lit("_"), safe_path_part(size))


def safe_output_label(c: Column | str) -> Column:
    """File label: each run of unsafe characters becomes one underscore."""
    return F.regexp_replace(_col(c), UNSAFE_IN_LABEL, "_")


def base_name(path: Column | str) -> Column:
    return F.substring_index(_col(path), "/", -1)


def dir_name(path: Column | str) -> Column:
    """Path up to its last slash, empty without one. Plain string functions, no regex."""
    path = _col(path)
    return F.substring(path, F.lit(1), F.length(path) - F.length(base_name(path)) - 1)


def is_fastq_path(path: Column | str) -> Column:
    endings = "|".join(s.replace(".", r"\.") for s in FASTQ_SUFFIXES)
    return _col(path).rlike(f"({endings})$")


def fastq_sample_name(path: Column | str) -> Column:
    """File name without .gz, then without .fastq, then without .fq."""
    name = base_name(path)
    for ending in SAMPLE_ENDINGS:
        shorter = F.substring(name, F.lit(1), F.length(name) - len(ending))
        name = F.when(F.endswith(name, F.lit(ending)), shorter).otherwise(name)
    return name


def name_or_numbered(name: Column | str, number: Column | str, prefix: str) -> Column:
    """Given name, or <prefix>_<number> for the records without one."""
    name = _col(name)
    return F.when(
        is_blank(name), F.concat(F.lit(prefix + "_"), _col(number).cast("string"))
    ).otherwise(name)


def name_or_reference(name: Column | str) -> Column:
    name = _col(name)
    return F.when(is_blank(name), F.lit("reference")).otherwise(name)


def r_text(value: Column | str) -> Column:
    """Value as the trim header prints it, NA for NULL."""
    return F.coalesce(_col(value).cast("string"), F.lit("NA"))


def r_logical(value: Column | str) -> Column:
    """TRUE, FALSE or NA."""
    return F.upper(r_text(value))
