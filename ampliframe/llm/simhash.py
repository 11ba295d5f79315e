"""Near-duplicate documents by SimHash fingerprints.

A fingerprint is mapped to the bit counts of its 32 segments of two bits. The Manhattan distance
of two such vectors is a lower bound of the fingerprints' Hamming distance. The vectors are cut
into blocks, each a unit cell of a grid; within a distance of `bits`, at most so many blocks
differ, so a pair in range shares its cell in all but `bits` of the blocks. One equi join for each
choice of those blocks therefore finds every pair in range. Its pairs are cut down by the
Manhattan distance of the whole vectors and then verified exactly. The number of blocks follows
from the number of fingerprints (`blocks_for`).

Cells with more than `CELL_ROWS` fingerprints, as families of edited copies make them, are not
joined with themselves. Fingerprints in such cells are linked through midpoints instead: two of
them are within `bits` exactly if some 64-bit value is within half as many bits of both (the odd
bit counts for one of them). Every fingerprint is sent to the values near it, and all that meet at
a value are linked to the least one. That takes a fixed number of rows for each fingerprint,
however large the family.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ampliframe.llm.common import add_columns, utf8
from ampliframe.llm.components import components
from ampliframe.session import materialise

SHINGLE = 4
SEED = 42
BITS = 4
#: bits of information in a segment's count, if the bits of fingerprints are even
SEGMENT_BITS = 1.5
#: what a pair in a cell costs, in rows of the index: it is stored, moved and compared later on
PAIR_COST = 64
#: fingerprints of a cell that are compared pair by pair
CELL_ROWS = 400
LOW_BITS = 0x5555555555555555


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a whole text, as a signed 64-bit number; 0 for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    hash_of = xxhash.xxh64_digest
    if len(words) <= shingle:
        digests = hash_of(joined, SEED)
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
        ends = ends[shingle - 1 :].tolist()
        digests = b"".join([hash_of(joined[a:b], SEED) for a, b in zip(starts, ends)])
    rows = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for first in range(0, len(rows), 1 << 16):
        counts += np.unpackbits(rows[first : first + (1 << 16)], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(rows)).tobytes(), "big", signed=True)


def with_fingerprint(
    docs: DataFrame, text: str = "text", name: str = "fp", shingle: int = SHINGLE
) -> DataFrame:
    """`docs` with the fingerprint of every whole text; a null text counts as empty."""

    def start():
        return lambda texts: [
            pa.array([fingerprint(t, shingle) for t in utf8(texts)], pa.int64())
        ]

    return add_columns(docs, [text], StructType([StructField(name, LongType(), False)]), start)


def segment_counts(fp: Column) -> Column:
    """The bit counts of all two-bit segments, each in unary (00, 01, 11).

    The number of bits by which two such values differ is the Manhattan distance of the counts.
    """
    high = F.shiftrightunsigned(fp, 1)
    low = F.lit(LOW_BITS)
    both = F.shiftleft(fp.bitwiseAND(high).bitwiseAND(low), 1)
    return both.bitwiseOR(fp.bitwiseOR(high).bitwiseAND(low))


def differing(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def blocks_for(n: int, bits: int) -> int:
    """Blocks to cut the vectors of `n` fingerprints into.

    More blocks make more rows of the index, fewer make more unrelated fingerprints share a cell.
    The number with the least expected cost is taken, so that with more fingerprints cells get
    narrower and the work does not grow with their square. The result does not depend on it.
    """

    def cost(blocks: int) -> float:
        cells = 2.0 ** (SEGMENT_BITS * 32 * (blocks - bits) / blocks)
        return comb(blocks, bits) * (1 + PAIR_COST * n / cells)

    return min(range(bits + 1, 33), key=cost)


def block_masks(blocks: int) -> list[int]:
    edges = [2 * round(32 * i / blocks) for i in range(blocks + 1)]
    return [sum(1 << b for b in range(x, y)) for x, y in zip(edges, edges[1:])]


def _cells(fps: DataFrame, bits: int, blocks: int) -> DataFrame:
    """A row (table, cell) for every choice of blocks and every fingerprint."""
    masks = [sum(own) for own in combinations(block_masks(blocks), blocks - bits)]
    counts = segment_counts(F.col("fp"))
    choices = F.array(
        *[
            F.struct(F.lit(i).alias("t"), F.col("e").bitwiseAND(F.lit(signed(m))).alias("cell"))
            for i, m in enumerate(masks)
        ]
    )
    rows = fps.select("fp", counts.alias("e")).select("fp", "e", F.explode(choices).alias("c"))
    return rows.select("fp", "e", "c.t", "c.cell")


def _shared_before(a: Column, b: Column, table: Column, bits: int, blocks: int) -> Column:
    """Whether two vectors already share a cell in an earlier table."""
    differ = a.bitwiseXOR(b)
    same = [differ.bitwiseAND(F.lit(signed(m))) == 0 for m in block_masks(blocks)]
    first = F.lit(None).cast("int")
    for i, own in reversed(list(enumerate(combinations(range(blocks), blocks - bits)))):
        first = F.when(reduce(lambda x, y: x & y, [same[k] for k in own]), i).otherwise(first)
    return first < table


def links(
    fps: DataFrame, bits: int = BITS, blocks: int | None = None, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp` that differ in at most `bits` bits.

    Every such pair is connected by the links, those in a crowded cell perhaps by way of others.
    """
    blocks = blocks or blocks_for(fps.count(), bits)
    cells = _cells(fps, bits, blocks)
    sizes = cells.groupBy("t", "cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = materialise(sizes)
    shared = cells.join(sizes.filter(F.col("n") <= cell_rows).select("t", "cell"), ["t", "cell"])
    # two reads of one small table: those alone in their cell are gone
    shared = materialise(shared)
    a, b = shared.alias("a"), shared.alias("b")
    in_range = (
        (F.col("a.t") == F.col("b.t"))
        & (F.col("a.cell") == F.col("b.cell"))
        & (F.col("a.fp") < F.col("b.fp"))
        & (differing(F.col("a.e"), F.col("b.e")) <= bits)
        & (differing(F.col("a.fp"), F.col("b.fp")) <= bits)
        & ~_shared_before(F.col("a.e"), F.col("b.e"), F.col("a.t"), bits, blocks)
    )
    near = a.join(b, in_range).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    large = sizes.filter(F.col("n") > cell_rows).select("t", "cell")
    crowded = cells.join(large, ["t", "cell"], "left_semi").select("fp").distinct()
    return near.unionByName(_midpoint_links(crowded, bits))


def _midpoint_links(fps: DataFrame, bits: int) -> DataFrame:
    """Links that connect all fingerprints within `bits` of each other, in linear work."""
    near_side, far_side = bits // 2, bits - bits // 2
    flips = [
        signed(sum(1 << k for k in own))
        for n in range(far_side + 1)
        for own in combinations(range(64), n)
    ]
    masks = F.array(*[F.lit(m) for m in flips])
    met = fps.select("fp", F.explode(masks).alias("m")).select(
        "fp",
        F.col("fp").bitwiseXOR(F.col("m")).alias("middle"),
        (F.bit_count("m") <= near_side).alias("near"),
    )
    # a value within near_side of one and far_side of the other proves the distance
    least = met.filter("near").groupBy("middle").agg(F.min("fp").alias("least"))
    return (
        met.join(least, "middle")
        .filter("fp <> least")
        .select(F.col("least").alias("a"), F.col("fp").alias("b"))
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    bits: int = BITS,
    blocks: int | None = None,
    cell_rows: int = CELL_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
) -> DataFrame:
    """One row (doc_id, fingerprint, component_id) for every row of `docs`.

    The component is the smallest id reachable by links between fingerprints, the document's own
    included. Null and empty texts have fingerprint zero and are linked like others; null ids get
    a component but are never one, unless all of its ids are null. Repeated rows stay repeated.
    """
    given = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    prints = materialise(with_fingerprint(given, shingle=shingle).select("doc_id", "fp"))
    nodes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(links(nodes.select("fp"), bits, blocks, cell_rows))
    labelled = nodes.join(found, nodes["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("label")
    )
    ids = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    by_print = labelled.join(ids, "label").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
