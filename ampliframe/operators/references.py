"""Reads against several references: by a given group, or by the minimizers they share.

A minimizer is the least k-mer of a window of w neighbouring k-mers, each k-mer taken in the
smaller of its two orientations. Two sequences that agree over w + k - 1 bases share one, on
either strand. Reads meet references by an equi join on minimizers; the reference with most
distinct minimizers in common is a read's best one.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampliframe.contracts import integer_argument, number_argument, refuse_rows, require_columns
from ampliframe.functions.arrow_text import flat_bytes, slices_by_bytes
from ampliframe.functions.dna import clean_sequence, reverse_complement
from ampliframe.functions.labels import is_blank
from ampliframe.functions.scale import join_lookup, spread
from ampliframe.operators import alignment as al

K = 15
WINDOW = 10
#: distinct minimizers of references that may be sent to every task
SENT_MINIMIZERS = 200_000


def sequence_minimizers(
    data: np.ndarray, offsets: np.ndarray, k: int = K, window: int = WINDOW
) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, minimizer) of upper-case sequences laid end to end, each pair once.

    A minimizer is a number of k base-4 digits. K-mers with anything but A, C, G or T are left
    out; a window in which none is left has no minimizer. A sequence with fewer than `window`
    k-mers is one window.
    """
    digit = np.full(256, 4, np.int64)
    digit[[ord(b) for b in "ACGT"]] = range(4)
    rows, values = [], []
    none = np.int64(1) << np.int64(2 * k)
    for first, last in slices_by_bytes(offsets, 1 << 20):
        bounds = offsets[first : last + 1] - offsets[first]
        own = digit[data[offsets[first] : offsets[last]]]
        places = len(own) - k + 1
        if places <= 0:
            continue
        ahead, back = np.zeros(places, np.int64), np.zeros(places, np.int64)
        wrong = np.zeros(places, bool)
        for i in range(k):
            part = own[i : i + places]
            ahead = 4 * ahead + part
            back += (3 - part) << np.int64(2 * i)
            wrong |= part > 3
        least = np.minimum(ahead, back)
        owner = np.searchsorted(bounds, np.arange(places), "right") - 1
        wrong |= np.arange(places) + k > bounds[owner + 1]
        least[wrong] = none
        # windows that do not leave their sequence
        kmers = np.maximum(np.diff(bounds) - k + 1, 0)
        width = np.minimum(window, kmers)
        lowest, span = {1: least}, 1
        while span < window:
            step = min(span, window - span)
            lowest[span + step] = np.minimum(lowest[span][: places - span - step + 1], lowest[span][step:][: places - span - step + 1])
            span += step
        starts = bounds[owner]
        full = (np.arange(places) - starts + window <= kmers[owner]) & (np.arange(places) + window <= places)
        at = np.flatnonzero(full)
        pairs = [(owner[at], lowest[window][at])] if len(at) else []
        short = np.flatnonzero((kmers > 0) & (kmers < window))
        for r in short.tolist():
            pairs.append((np.array([r]), least[bounds[r] : bounds[r] + width[r]].min(keepdims=True)))
        if not pairs:
            continue
        r, v = (np.concatenate(c) for c in zip(*pairs))
        there = v < none
        both = np.unique(np.stack([r[there] + first, v[there]], 1), axis=0)
        rows.append(both[:, 0])
        values.append(both[:, 1])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(values)


def minimizers(df: DataFrame, keep: Sequence[str], seq: str = "seq", k: int = K, window: int = WINDOW) -> DataFrame:
    """A row for every distinct minimizer of a sequence: the columns `keep` and `minimizer`."""
    k, window = integer_argument(k, "k", 1), integer_argument(window, "window", 1)
    if k > 31:
        raise ValueError("k must be at most 31")

    @F.arrow_udf("array<bigint>")
    def own(seq: pa.Array) -> pa.Array:
        data, offsets = flat_bytes(seq)
        rows, values = sequence_minimizers(data, offsets, k, window)
        bounds = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(seq)))])
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))

    return df.select(*keep, F.explode(own(F.upper(F.col(seq)))).alias("minimizer"))


def shared_minimizers(
    references: DataFrame, reads: DataFrame, read_keys: Sequence[str], k: int = K, window: int = WINDOW
) -> DataFrame:
    """How many distinct minimizers each read shares with each reference it shares any with.

    Columns: the read's keys, `reference` and `votes`. `references` has name and seq, `reads` the
    keys and seq. A minimizer of few references is sent to the reads; if there are too many they
    are joined, and a frequent one is split by adaptive execution. Reads are dealt over the tasks
    first, because they grow a thousandfold by the bytes they are stored in; votes are counted in
    each task, where all minimizers of a read stand together.
    """
    require_columns(references, ["name", "seq"], "the references")
    require_columns(reads, [*read_keys, "seq"], "the read set")
    of_references = minimizers(references, ["name"], "seq", k, window).distinct()
    of_reads = minimizers(spread(reads.select(*read_keys, "seq")), read_keys, "seq", k, window)
    named = of_references.select(F.col("name").alias("reference"), "minimizer")
    met = join_lookup(of_reads, named, ["minimizer"], "inner", SENT_MINIMIZERS)
    return met.groupBy(*read_keys, "reference").agg(F.count(F.lit(1)).alias("votes"))


def best_reference(votes: DataFrame, read_keys: Sequence[str], least_votes: int = 1) -> DataFrame:
    """The reference with most votes for each read, of equal ones the first by name.

    Reads with fewer than `least_votes` for any reference have no row.
    """
    order = F.struct((-F.col("votes")).alias("v"), "reference")
    best = votes.filter(F.col("votes") >= least_votes).groupBy(*read_keys)
    best = best.agg(F.min(order).alias("__best"))
    return best.select(
        *read_keys, F.col("__best.reference").alias("reference"), (-F.col("__best.v")).alias("votes")
    )


def _pair_scores_udf(scoring: al.Scoring):
    @F.arrow_udf("struct<forward_score:double,reverse_score:double>")
    def strand_scores(seq: pa.Array, target: pa.Array) -> pa.Array:
        pairs = pa.StructArray.from_arrays(
            [seq.dictionary_encode().indices, target.dictionary_encode().indices], names=["a", "b"]
        )
        a, b = (pairs.field(i).to_numpy(zero_copy_only=False) for i in range(2))
        both, first, where = np.unique(
            np.stack([a, b], 1), axis=0, return_index=True, return_inverse=True
        )
        codes = [al.encode(seq[i].as_py()) for i in first.tolist()]
        targets = [al.encode(target[i].as_py()) for i in first.tolist()]
        score = al.optimal_scores(
            codes + [al.complement(c) for c in codes], targets + targets, scoring, "local"
        )
        scores = pa.StructArray.from_arrays(
            [pa.array(score[: len(codes)]), pa.array(score[len(codes) :])],
            names=["forward_score", "reverse_score"],
        )
        return scores.take(pa.array(where.ravel()))

    return strand_scores


def checked_references(references: DataFrame) -> DataFrame:
    """Cleaned references (name, seq); a blank or repeated name or an empty sequence is refused."""
    require_columns(references, ["name", "seq"], "the references")
    cleaned = references.select("name", clean_sequence("seq").alias("seq"))
    refuse_rows(
        cleaned.filter(is_blank("name") | (F.coalesce("seq", F.lit("")) == "")),
        "references need a name and a sequence",
        F.coalesce("name", F.lit("(no name)")),
    )
    repeated = cleaned.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    refuse_rows(repeated, "references share a name", "name")
    return cleaned


def orient_to_references(
    references: DataFrame,
    reads: DataFrame,
    reference: str = "reference",
    match_score: float = 2,
    mismatch_score: float = -3,
    gap_opening: float = 5,
    gap_extension: float = 2,
    keep: Sequence[str] = ("record_no",),
) -> DataFrame:
    """Local scores of both strands of every read against the reference its column names.

    Columns: `keep`, reference, sample, direction, forward_score, reverse_score, selected_score,
    score_delta, oriented_seq; the strand turns only if its score is strictly greater. Reads that
    name no known reference have no row. References are sent to the tasks if there are few.
    """
    require_columns(reads, [*keep, reference, "name", "seq"], "the read set")
    scoring = al.simple_scoring(
        number_argument(match_score, "match_score"),
        number_argument(mismatch_score, "mismatch_score"),
        number_argument(gap_opening, "gap_opening", 0),
        number_argument(gap_extension, "gap_extension", 0),
    )
    targets = checked_references(references).select(
        F.col("name").alias("reference"), F.col("seq").alias("__target")
    )
    given = reads.select(*keep, F.col(reference).alias("reference"), "name", clean_sequence("seq").alias("seq"))
    joined = join_lookup(spread(given), targets, ["reference"], "inner")
    scores = _pair_scores_udf(scoring)(F.col("seq"), F.col("__target"))
    scored = joined.withColumn("__s", scores)
    forward, backward = F.col("__s.forward_score"), F.col("__s.reverse_score")
    turned = backward > forward
    return scored.select(
        *keep,
        "reference",
        F.col("name").alias("sample"),
        F.when(turned, "reverse_complement").otherwise("forward").alias("direction"),
        forward.alias("forward_score"),
        backward.alias("reverse_score"),
        F.greatest(forward, backward).alias("selected_score"),
        F.abs(forward - backward).alias("score_delta"),
        F.when(turned, reverse_complement("seq")).otherwise(F.col("seq")).alias("oriented_seq"),
    )
