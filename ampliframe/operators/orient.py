"""Strand of reads against one reference, and the reference-anchored stack of reads."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampliframe.contracts import number_argument, require_columns
from ampliframe.functions.arrow_text import in_slices
from ampliframe.functions.dna import clean_sequence, reverse_complement
from ampliframe.functions.labels import name_or_numbered, name_or_reference
from ampliframe.functions.scale import spread
from ampliframe.operators import alignment as al
from ampliframe.session import materialise


@dataclass(frozen=True)
class Reference:
    name: str
    seq: str


def one_reference(df: DataFrame) -> Reference:
    """The single cleaned reference of a set; anything but one sequence is an error."""
    require_columns(df, ["seq"], "reference")
    name = F.col("name") if "name" in df.columns else F.lit(None).cast("string")
    rows = df.select(
        name_or_reference(name).alias("name"), clean_sequence("seq").alias("seq")
    ).limit(2).collect()
    if len(rows) != 1:
        raise ValueError("reference must contain exactly one sequence")
    seq = rows[0]["seq"]
    if not seq:
        raise ValueError("reference must not be empty")
    return Reference(rows[0]["name"], seq)


def cleaned_reads(reads: DataFrame, prefix: str = "sanger") -> DataFrame:
    """Reads with whitespace removed, upper case, and <prefix>_<record_no> for missing names."""
    require_columns(reads, ["record_no", "name", "seq"], "the read set")
    return reads.select(
        *[c for c in reads.columns if c not in ("name", "seq")],
        name_or_numbered("name", "record_no", prefix).alias("name"),
        clean_sequence("seq").alias("seq"),
    )


def _strand_udf(reference: str, scoring: al.Scoring):
    @F.arrow_udf("struct<forward_score:double,reverse_score:double>")
    def strand_scores(seq: pa.Array) -> pa.Array:
        distinct = seq.dictionary_encode()
        codes = [al.encode(s) for s in distinct.dictionary.to_pylist()]
        both = codes + [al.complement(c) for c in codes]
        target = [al.encode(reference)] * len(both)
        score = al.optimal_scores(both, target, scoring, "local")
        scores = pa.StructArray.from_arrays(
            [pa.array(score[: len(codes)]), pa.array(score[len(codes) :])],
            names=["forward_score", "reverse_score"],
        )
        return scores.take(distinct.indices)

    return strand_scores


def orient_reads(
    reference: Reference,
    reads: DataFrame,
    match_score: float = 2,
    mismatch_score: float = -3,
    gap_opening: float = 5,
    gap_extension: float = 2,
    keep: tuple[str, ...] = ("record_no",),
) -> DataFrame:
    """Local scores of both strands of every read, and the read on its better strand.

    Columns: `keep`, sample, direction, forward_score, reverse_score, selected_score,
    score_delta, oriented_seq. The strand turns only if its score is strictly greater. The
    reference travels with the function; reads are dealt evenly over the tasks, because scoring
    a read costs its length times the reference's.
    """
    scoring = al.simple_scoring(
        number_argument(match_score, "match_score"),
        number_argument(mismatch_score, "mismatch_score"),
        number_argument(gap_opening, "gap_opening", 0),
        number_argument(gap_extension, "gap_extension", 0),
    )
    strand_scores = _strand_udf(reference.seq, scoring)
    scored = spread(reads.select(*keep, "name", "seq")).withColumn("__s", strand_scores("seq"))
    forward, backward = F.col("__s.forward_score"), F.col("__s.reverse_score")
    turned = backward > forward
    return scored.select(
        *keep,
        F.col("name").alias("sample"),
        F.when(turned, "reverse_complement").otherwise("forward").alias("direction"),
        forward.alias("forward_score"),
        backward.alias("reverse_score"),
        F.greatest(forward, backward).alias("selected_score"),
        F.abs(forward - backward).alias("score_delta"),
        F.when(turned, reverse_complement("seq")).otherwise(F.col("seq")).alias("oriented_seq"),
    )


# ---- stack ----------------------------------------------------------------------------------


def _placement(reference: np.ndarray, reads: list[np.ndarray], scoring: al.Scoring):
    """Base per reference position, and insertions by the position they follow, per read."""
    for read, path in zip(
        reads, al.optimal_paths(reads, [reference] * len(reads), scoring, "overlap")
    ):
        text = np.frombuffer(al.decode(read).encode(), np.uint8)
        used1 = path.start1 + int((path.columns != 2).sum())
        row = np.full(len(reference), ord("-"), np.uint8)
        in_read = path.start1 + np.cumsum(path.columns != 2) - 1
        in_reference = path.start2 + np.cumsum(path.columns != 1) - 1
        both = path.columns == 0
        row[in_reference[both]] = text[in_read[both]]
        inserted: dict[int, bytes] = {}
        extra = path.columns == 1
        for slot in np.unique(in_reference[extra] + 1):
            inserted[int(slot)] = text[in_read[extra & (in_reference + 1 == slot)]].tobytes()
        end = int(in_reference[-1]) + 1 if len(in_reference) else path.start2
        if path.start1:
            head = text[: path.start1].tobytes()
            inserted[path.start2] = head + inserted.get(path.start2, b"")
        if used1 < len(text):
            inserted[end] = inserted.get(end, b"") + text[used1:].tobytes()
        yield row.tobytes().decode(), {k: v.decode() for k, v in inserted.items()}


def _place_udf(reference: str, scoring: al.Scoring):
    def placed_rows(seq: pa.Array) -> pa.Array:
        reads = [al.encode(s) for s in seq.to_pylist()]
        placed, inserted = [], []
        for row, extra in _placement(al.encode(reference), reads, scoring):
            placed.append(row)
            inserted.append([{"slot": k, "bases": v} for k, v in sorted(extra.items())])
        kind = pa.list_(pa.struct([("slot", pa.int32()), ("bases", pa.string())]))
        return pa.StructArray.from_arrays(
            [pa.array(placed, pa.string()), pa.array(inserted, kind)],
            names=["placed", "inserted"],
        )

    @F.arrow_udf("struct<placed:string,inserted:array<struct<slot:int,bases:string>>>")
    def place(seq: pa.Array) -> pa.Array:
        return in_slices(placed_rows, seq)

    return place


def _padded_row(placed: str, inserted: dict[int, str], widths: np.ndarray) -> str:
    """A row over all columns; slot k holds the insertions after reference position k."""
    room = np.cumsum(widths)
    out = np.full(len(placed) + int(room[-1]), ord("-"), np.uint8)
    positions = np.arange(len(placed))
    out[positions + room[positions]] = np.frombuffer(placed.encode(), np.uint8)
    for slot, bases in inserted.items():
        start = slot + int(room[slot]) - int(widths[slot])
        if slot == 0:
            start += int(widths[0]) - len(bases)
        out[start : start + len(bases)] = np.frombuffer(bases.encode(), np.uint8)
    return out.tobytes().decode()


def read_stack(
    reference: Reference,
    oriented: DataFrame,
    match_score: float = 2,
    mismatch_score: float = -3,
    gap_opening: float = 5,
    gap_extension: float = 2,
) -> DataFrame:
    """Equal-width gapped rows, reference first: ref_name, row_no, name, aligned_seq.

    Every read is aligned to the reference with free ends; columns are opened where any read has
    an insertion. Only the widest insertion per reference position goes to the driver, so that
    table is bounded by the reference length. Removing the gaps gives back every read.
    """
    require_columns(oriented, ["record_no", "sample", "oriented_seq"], "the oriented reads")
    scoring = al.simple_scoring(match_score, mismatch_score, gap_opening, gap_extension)
    place = _place_udf(reference.seq, scoring)
    placed = materialise(
        oriented.select(
            "record_no", F.col("sample").alias("name"), place("oriented_seq").alias("p")
        ).select("record_no", "name", "p.*")
    )
    widest = (
        placed.select(F.explode("inserted").alias("i"))
        .groupBy("i.slot")
        .agg(F.max(F.length("i.bases")).alias("width"))
        .collect()
    )
    widths = np.zeros(len(reference.seq) + 1, np.int64)
    for row in widest:
        widths[row["slot"]] = row["width"]

    def padded(rows: pa.Array, inserted: pa.Array) -> pa.Array:
        return pa.array(
            [
                _padded_row(row, {i["slot"]: i["bases"] for i in extra}, widths)
                for row, extra in zip(rows.to_pylist(), inserted.to_pylist())
            ],
            pa.string(),
        )

    @F.arrow_udf("string")
    def pad(rows: pa.Array, inserted: pa.Array) -> pa.Array:
        return in_slices(padded, rows, inserted)

    spark: SparkSession = placed.sparkSession
    top = spark.createDataFrame(
        [(reference.name, 0, reference.name, _padded_row(reference.seq, {}, widths))],
        "ref_name string, row_no bigint, name string, aligned_seq string",
    )
    return top.unionByName(
        placed.select(
            F.lit(reference.name).alias("ref_name"),
            F.col("record_no").cast("bigint").alias("row_no"),
            "name",
            pad("placed", "inserted").alias("aligned_seq"),
        )
    )


def align_with_reference(
    reference: DataFrame, reads: DataFrame, prefix: str = "sanger", **scores: float
) -> tuple[DataFrame, DataFrame]:
    """(orientation table with oriented reads, read stack) of reads against one reference."""
    target = one_reference(reference)
    named = cleaned_reads(reads, prefix)
    if named.limit(1).count() == 0:
        raise ValueError("the read set must hold at least one sequence")
    oriented = materialise(orient_reads(target, named, **scores))
    return oriented, read_stack(target, oriented, **scores)
