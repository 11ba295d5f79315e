"""Comparison of consensus sequence sets in both orientations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampliframe.contracts import require_columns
from ampliframe.functions.arrow_text import in_slices
from ampliframe.functions.dna import reverse_complement
from ampliframe.functions.labels import is_blank
from ampliframe.functions.scale import spread
from ampliframe.operators import alignment as al

_DIFFERENCE = (
    "struct<aln_pos:int,seq1_pos:int,seq1_base:string,seq2_pos:int,seq2_base:string>"
)
_ORIENTATIONS = np.array(["forward", "reverse_complement"])


def check_consensus_set(df: DataFrame, what: str) -> None:
    """A consensus set has sequences, and every one of them a name."""
    require_columns(df, ["name", "seq"], what)
    seen = df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(is_blank("name")).alias("unnamed")
    ).first()
    if seen["rows"] == 0:
        raise ValueError(f"{what} holds no sequence, at least one is needed")
    if seen["unnamed"]:
        raise ValueError(f"{what} sequences must all have non-empty names")


def unnamed_records(df: DataFrame) -> DataFrame:
    """Records that break the contract of a consensus set: record_no, problem."""
    require_columns(df, ["record_no", "name", "seq"], "the consensus set")
    problem = F.when(is_blank("name"), "no name").when(is_blank("seq"), "no sequence")
    return df.select("record_no", problem.alias("problem")).filter("problem is not null")


def shared_names(set1: DataFrame, set2: DataFrame) -> DataFrame:
    """Distinct names found in both sets."""
    return set1.select("name").intersect(set2.select("name"))


def first_per_name(df: DataFrame) -> DataFrame:
    """The first record of each name (by record_no), upper-cased.

    Repeats are combined before the shuffle, and the result is partitioned and sorted by name,
    which the pair join reuses.
    """
    require_columns(df, ["record_no", "name", "seq"], "the consensus set")
    return df.groupBy("name").agg(
        F.upper(F.min_by("seq", "record_no")).alias("seq"), F.min("record_no").alias("__order")
    )


def pairs_by_name(set1: DataFrame, set2: DataFrame) -> DataFrame:
    """Pairs of the sequences sharing a name: seq1_name, seq2_name, seq1, seq2, pair_no."""
    one, two = first_per_name(set1).alias("one"), first_per_name(set2).alias("two")
    return one.join(two, F.col("one.name") == F.col("two.name")).select(
        F.col("one.name").alias("seq1_name"),
        F.col("two.name").alias("seq2_name"),
        F.col("one.seq").alias("seq1"),
        F.col("two.seq").alias("seq2"),
        F.col("one.__order").alias("pair_no"),
    )


def map_entries(sample_map: DataFrame) -> DataFrame:
    """Complete entries of a pair map: seq1_name, seq2_name, pair_no.

    The columns seq1_name and seq2_name are used if both exist, else the first two. A `pair_no`
    column of the map is kept to tell its order.
    """
    columns = sample_map.columns
    if len(columns) < 2:
        raise ValueError("the pair map needs at least two columns")
    named = {"seq1_name", "seq2_name"} <= set(columns)
    left, right = ("seq1_name", "seq2_name") if named else columns[:2]
    pair_no = F.col("pair_no") if "pair_no" in columns else F.lit(None)
    return sample_map.select(
        F.col(left).cast("string").alias("seq1_name"),
        F.col(right).cast("string").alias("seq2_name"),
        pair_no.cast("bigint").alias("pair_no"),
    ).filter(~is_blank("seq1_name") & ~is_blank("seq2_name"))


def pairs_by_map(set1: DataFrame, set2: DataFrame, sample_map: DataFrame) -> DataFrame:
    """Distinct pairs listed in a map whose sequences both exist: names and sequences."""
    wanted = map_entries(sample_map).select("seq1_name", "seq2_name").distinct()
    one = first_per_name(set1).select(F.col("name").alias("seq1_name"), F.col("seq").alias("seq1"))
    two = first_per_name(set2).select(F.col("name").alias("seq2_name"), F.col("seq").alias("seq2"))
    return (
        wanted.join(one, "seq1_name")
        .join(two, "seq2_name")
        .select("seq1_name", "seq2_name", "seq1", "seq2")
    )


def _repeated_as_mapped(
    results: DataFrame, sample_map: DataFrame | None, keep_order: bool
) -> DataFrame:
    """Results of distinct pairs, once per entry of the map. Each pair is aligned only once."""
    if sample_map is None:
        return results
    columns = [*results.columns, *(["pair_no"] if keep_order else [])]
    entries = map_entries(sample_map)
    return entries.join(results, ["seq1_name", "seq2_name"]).select(*columns)


def _distinct_codes(seq1: pa.Array, seq2: pa.Array, needed: pa.Array):
    """Encoded distinct pairs of a batch and the row each input row maps to, null if not needed."""
    rows: dict[tuple[str, str], int] = {}
    which = [
        rows.setdefault((a, b), len(rows)) if n else None
        for a, b, n in zip(seq1.to_pylist(), seq2.to_pylist(), needed.to_pylist())
    ]
    firsts, seconds = [], []
    for a, b in rows:
        if not a or not b:
            raise ValueError("a sequence to align is missing or empty")
        firsts.append(al.encode(a))
        seconds.append(al.encode(b))
    return firsts, seconds, pa.array(which, pa.int32())


def _align_udf(scoring: al.Scoring, kind: str, texts: bool, differences: bool):
    fields = ["orientation:string", "n_diff:int"]
    if texts:
        fields += ["aligned_seq1:string", "aligned_seq2:string"]
    if differences:
        fields += [f"differences:array<{_DIFFERENCE}>"]

    def aligned(seq1: pa.Array, seq2: pa.Array, needed: pa.Array) -> pa.Array:
        firsts, seconds, which = _distinct_codes(seq1, seq2, needed)
        distance, reverse = al.oriented_distances(firsts, seconds, scoring, kind)
        out = {
            "orientation": pa.array(_ORIENTATIONS[reverse.astype(int)], pa.string()),
            "n_diff": pa.array(distance, pa.int32()),
        }
        if texts or differences:
            chosen = [al.complement(b) if r else b for b, r in zip(seconds, reverse)]
            paths = al.optimal_paths(firsts, chosen, scoring, kind)
            shown = [al.aligned_texts(p, a, b) for p, a, b in zip(paths, firsts, chosen)]
            if texts:
                out["aligned_seq1"] = pa.array([s[0] for s in shown], pa.string())
                out["aligned_seq2"] = pa.array([s[1] for s in shown], pa.string())
            if differences:
                out["differences"] = _difference_lists(shown, seconds, reverse)
        table = pa.StructArray.from_arrays(list(out.values()), names=list(out))
        return table.take(which)

    @F.arrow_udf("struct<" + ",".join(fields) + ">")
    def align(seq1: pa.Array, seq2: pa.Array, needed: pa.Array) -> pa.Array:
        return in_slices(aligned, seq1, seq2, needed)

    return align


def _aligned(
    pairs: DataFrame, scoring: al.Scoring, kind: str, texts: bool, differences: bool
) -> DataFrame:
    """`pairs` with the alignment of each in `__a`.

    Two kinds of pairs are answered by expressions, and neither sequence is sent to Python: global
    alignments with an empty sequence, which are one gap, and, under the default scores, sequences
    of plain bases that are equal, as given or after turning the second.
    """
    align = _align_udf(scoring, _kind(kind), texts, differences)
    if differences and not texts:
        # marked nondeterministic so that no filter copies the alignment below the explode
        align = align.asNondeterministic()
    spread_pairs = spread(pairs)
    if kind != "global":
        return spread_pairs.withColumn("__a", align("seq1", "seq2", F.lit(True)))
    if scoring is al.DEFAULT_SCORING:
        plain = F.col("seq1").rlike("^[ACGT]+$")
        same = F.coalesce(plain & (F.col("seq1") == F.col("seq2")), F.lit(False))
        turned = ~same & plain & (F.col("seq1") == reverse_complement("seq2"))
        turned = F.coalesce(turned, F.lit(False))
    else:
        same = turned = F.lit(False)
    both = F.col("seq1").isNotNull() & F.col("seq2").isNotNull()
    hollow = both & ((F.col("seq1") == "") | (F.col("seq2") == ""))

    def answer(orientation: int, n_diff, aligned1, aligned2, listed):
        fields = [
            F.lit(str(_ORIENTATIONS[orientation])).alias("orientation"),
            n_diff.cast("int").alias("n_diff"),
        ]
        if texts:
            fields += [aligned1.alias("aligned_seq1"), aligned2.alias("aligned_seq2")]
        if differences:
            fields += [listed.cast(f"array<{_DIFFERENCE}>").alias("differences")]
        return F.struct(*fields)

    def equal(orientation: int):
        return answer(orientation, F.lit(0), F.col("seq1"), F.col("seq1"), F.array())

    needed = ~(same | turned | hollow)
    found = align(F.when(needed, F.col("seq1")), F.when(needed, F.col("seq2")), needed)
    own = F.concat("seq1", "seq2")
    gap = F.repeat(F.lit("-"), F.length(own))
    rows = F.transform(F.when(own != "", F.split(own, "")).otherwise(F.array()), _gap_row)
    one_gap = answer(
        0,
        F.length(own),
        F.when(F.col("seq1") == "", gap).otherwise(F.col("seq1")),
        F.when(F.col("seq2") == "", gap).otherwise(F.col("seq2")),
        rows,
    )
    return spread_pairs.withColumn("__a", found).withColumn(
        "__a",
        F.when(same, equal(0))
        .when(turned, equal(1))
        .when(hollow, one_gap)
        .otherwise(F.col("__a")),
    )


def _gap_row(base, i):
    """The differing column i (from 0) of a pair of which one sequence is empty."""
    first = F.col("seq1") != ""
    place = (i + 1).cast("int")
    return F.struct(
        place.alias("aln_pos"),
        F.when(first, place).alias("seq1_pos"),
        F.when(first, base).otherwise("-").alias("seq1_base"),
        F.when(~first, place).alias("seq2_pos"),
        F.when(~first, base).otherwise("-").alias("seq2_base"),
    )


def _difference_lists(shown, seconds, reverse) -> pa.Array:
    """Differing columns of each aligned pair as a list array."""
    sizes, parts = [0], []
    for (text1, text2), second, turned in zip(shown, seconds, reverse):
        x = np.frombuffer(text1.encode(), np.uint8)
        y = np.frombuffer(text2.encode(), np.uint8)
        gap = ord("-")
        at = np.flatnonzero(x != y)
        pos1, pos2 = np.cumsum(x != gap)[at], np.cumsum(y != gap)[at]
        if turned:
            pos2 = len(second) - pos2 + 1
        parts.append((at + 1, pos1, x[at], pos2, y[at]))
        sizes.append(sizes[-1] + len(at))
    joined = [np.concatenate(c) if parts else np.zeros(0, int) for c in zip(*parts)] or [
        np.zeros(0, int)
    ] * 5
    aln, pos1, base1, pos2, base2 = joined

    def letters(codes):
        return pa.array([chr(c) for c in codes], pa.string())

    rows = pa.StructArray.from_arrays(
        [
            pa.array(aln, pa.int32()),
            pa.array(pos1, pa.int32(), mask=base1 == ord("-")),
            letters(base1),
            pa.array(pos2, pa.int32(), mask=base2 == ord("-")),
            letters(base2),
        ],
        names=["aln_pos", "seq1_pos", "seq1_base", "seq2_pos", "seq2_base"],
    )
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), rows)


def _kind(kind: str) -> str:
    if kind not in al.FREE_ENDS:
        raise ValueError(f"type must be one of: {', '.join(al.FREE_ENDS)}")
    return kind


def pair_distances(
    pairs: DataFrame, type: str = "global", scoring: al.Scoring = al.DEFAULT_SCORING
) -> DataFrame:
    """Distance and orientation per pair, without a traceback."""
    done = _aligned(pairs, scoring, type, False, False)
    return done.select(
        *_order(pairs),
        "seq1_name",
        "seq2_name",
        F.col("__a.n_diff").alias("distance"),
        F.length("seq1").alias("seq1_len"),
        F.length("seq2").alias("seq2_len"),
        F.col("__a.orientation").alias("seq2_orientation"),
    )


def _order(pairs: DataFrame) -> list[str]:
    return ["pair_no"] if "pair_no" in pairs.columns else []


def _pairs(
    set1: DataFrame, set2: DataFrame, sample_map: DataFrame | None, keep_order: bool
) -> DataFrame:
    if sample_map is not None:
        return pairs_by_map(set1, set2, sample_map)
    pairs = pairs_by_name(set1, set2)
    return pairs if keep_order else pairs.drop("pair_no")


def consensus_distances(
    set1: DataFrame,
    set2: DataFrame,
    sample_map: DataFrame | None = None,
    type: str = "global",
    scoring: al.Scoring = al.DEFAULT_SCORING,
    keep_order: bool = False,
) -> DataFrame:
    """`compare_consensus` without sequences and alignments, which saves the traceback."""
    results = pair_distances(_pairs(set1, set2, sample_map, keep_order), type, scoring)
    return _repeated_as_mapped(results, sample_map, keep_order)


def compare_consensus(
    set1: DataFrame,
    set2: DataFrame,
    sample_map: DataFrame | None = None,
    type: str = "global",
    scoring: al.Scoring = al.DEFAULT_SCORING,
    check: bool = True,
    keep_order: bool = False,
) -> DataFrame:
    """One row per pair: names, distance, lengths, orientation, original and aligned sequences.

    Pairs share a name, or come from `sample_map`. `check=False` skips the pass that verifies
    names, for sets known to have them. `keep_order` adds `pair_no`, the place of the pair in the
    first set or in the map.
    """
    if check:
        check_consensus_set(set1, "consensus1")
        check_consensus_set(set2, "consensus2")
    pairs = _pairs(set1, set2, sample_map, keep_order)
    results = _aligned(pairs, scoring, type, True, False).select(
        *_order(pairs),
        "seq1_name",
        "seq2_name",
        F.col("__a.n_diff").alias("distance"),
        F.length("seq1").alias("seq1_len"),
        F.length("seq2").alias("seq2_len"),
        F.col("__a.orientation").alias("seq2_orientation"),
        "seq1",
        "seq2",
        "__a.aligned_seq1",
        "__a.aligned_seq2",
    )
    return _repeated_as_mapped(results, sample_map, keep_order)


def sequence_differences(
    pairs: DataFrame, type: str = "global", scoring: al.Scoring = al.DEFAULT_SCORING
) -> DataFrame:
    """One row per differing alignment column of every pair.

    Positions are 1-based in the original sequences, NULL on the side of a gap; bases are shown
    as aligned.
    """
    done = _aligned(pairs, scoring, type, False, True)
    label = F.when(
        F.col("__a.orientation") == "forward", F.lit("seq2_original")
    ).otherwise("seq2_reverse_complement")
    return done.select(
        "seq1_name",
        "seq2_name",
        F.col("__a.orientation").alias("orientation"),
        label.alias("seq2_aligned_as"),
        F.inline("__a.differences"),
    ).select(
        "aln_pos",
        "seq1_name",
        "seq1_pos",
        "seq1_base",
        "seq2_name",
        "seq2_pos",
        "seq2_base",
        "orientation",
        "seq2_aligned_as",
    )


def seq_diffs(
    pairs: DataFrame, type: str = "global", scoring: al.Scoring = al.DEFAULT_SCORING
) -> DataFrame:
    """Whole result per pair: orientation, n_diff, aligned strings, differences as an array."""
    done = _aligned(pairs, scoring, type, True, True)
    return done.select("seq1_name", "seq2_name", "__a.*")
