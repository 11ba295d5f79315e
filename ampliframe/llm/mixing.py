"""Mixing sources to target weights in blocks of words.

Targets follow from weights and capacities. Sainte-Laguë apportionment turns them into whole
numbers of blocks: the seats go, one by one, to the source with the highest quotient of its target,
in blocks of its size, and the odd numbers 1, 3, 5, ... All sources have blocks of one size, but
tiny ones smaller blocks of their own. Because a longer list of seats only extends a shorter one, the
first part of the list is itself an apportionment; output shard k takes the k-th part, so every
shard holds all sources in the wanted proportion, as integer quotas.

Each source's documents, in an order drawn from the seed, form one stream of words that is cut
into blocks. Of a source's n blocks, its quota q are taken evenly along the stream from a seeded
start: block j is taken floor(((j + 1) q + r) / n) - floor((j q + r) / n) times. How often any
stretch of the stream is taken thus follows by arithmetic; no block is ever stored.

One row per source reaches the driver, none per document.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, LongType, StructField, StructType,
)

from ampliframe.functions.scale import local_table, running_totals
from ampliframe.llm.common import WORD, without

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_REPEATS = 2
#: words of a block; smaller where a source's target would have fewer than FEWEST_BLOCKS of them,
#: for all sources down to LEAST_WORDS, below that for the source alone
BLOCK_WORDS = 2048
LEAST_WORDS = 64
FEWEST_BLOCKS = 256
SHARDS = 8
#: documents of a source that are put in order within one task
CHUNK_ROWS = 4_000


@dataclass(frozen=True)
class Source:
    name: str | None
    size: int
    rows: int


def targets(
    sources: Sequence[Source], weights: Sequence[int] = WEIGHTS, share: float = SHARE,
    most: float = MOST_REPEATS,
) -> list[float]:
    """Words wanted of each source. What exceeds `most` times a source's size is shared anew."""
    own = [weights[i % len(weights)] for i in range(len(sources))]
    caps = [most * s.size for s in sources]
    left = share * sum(s.size for s in sources)
    out = [0.0] * len(sources)
    open_ = [i for i in range(len(sources)) if caps[i] > 0]
    while open_:
        unit = left / sum(own[i] for i in open_)
        full = [i for i in open_ if own[i] * unit > caps[i]]
        if not full:
            for i in open_:
                out[i] = float(own[i] * unit)
            break
        for i in full:
            out[i] = float(caps[i])
            left -= caps[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def apportion(wanted: Sequence[float], seats: int, most: Sequence[int]) -> np.ndarray:
    """Seats by the highest quotients wanted / 1, 3, 5, ...; at most `most` for each.

    Equal quotients go to the entry that stands first.
    """
    want, cap = np.array(wanted, float), np.array(most, np.int64)
    seats = min(seats, int(cap[want > 0].sum()))

    def at(divisor: float) -> np.ndarray:
        return np.minimum(cap, np.floor(want / divisor + 0.5).astype(np.int64))

    if seats <= 0 or not len(want):
        return np.zeros(len(want), np.int64)
    low, high = want.max() / (2.0 * seats + 2), 4 * want.max()
    while at(low).sum() < seats:
        low /= 2
    for _ in range(200):
        middle = (low + high) / 2
        if at(middle).sum() > seats:
            low = middle
        else:
            high = middle
    given = at(high)
    for _ in range(seats - int(given.sum())):
        quotients = np.where(given < cap, want / (2 * given + 1), -1.0)
        given[int(quotients.argmax())] += 1
    return given


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


@dataclass(frozen=True)
class Plan:
    sources: list[Source]
    targets: list[float]
    #: words of a block, and of each source's own blocks, which are smaller for tiny sources
    block: int
    own: list[int]
    #: a row for each source, a column for each output shard
    quotas: np.ndarray
    starts: list[int]


def plan(sources: Sequence[Source], shards: int = SHARDS, seed: int = 11, **rules) -> Plan:
    """Targets, block size and quotas; sources in the order of their names, null last."""
    ordered = sorted(sources, key=lambda s: (s.name is None, s.name or ""))
    wanted = targets(ordered, **rules)
    least = min([t for t in wanted if t > 0], default=BLOCK_WORDS)
    block = max(LEAST_WORDS, min(BLOCK_WORDS, int(least / FEWEST_BLOCKS)))
    own = [max(1, min(block, int(t / FEWEST_BLOCKS))) for t in wanted]
    in_blocks = [t / b for t, b in zip(wanted, own)]
    seats = round(sum(in_blocks))
    blocks = [math.ceil(s.size / b) for s, b in zip(ordered, own)]
    most = [MOST_REPEATS * n for n in blocks]
    upto = [apportion(in_blocks, seats * k // shards, most) for k in range(shards + 1)]
    quotas = np.array([b - a for a, b in zip(upto, upto[1:])]).reshape(shards, len(ordered)).T
    starts = [zlib.crc32(f"{seed}:{s.name}".encode()) % max(n, 1) for s, n in zip(ordered, blocks)]
    return Plan(ordered, wanted, block, own, quotas, starts)


def mix(
    docs: DataFrame,
    seed: int = 11,
    shards: int = SHARDS,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    size: Column | None = None,
    **rules,
) -> DataFrame:
    """`docs` with size, source_size, target, taken and `stretches` of every document.

    `stretches` lists the document's parts by block: first and last word (from 0, the last one
    excluded), how often the mix takes it, and the output shard its first copy goes to (null if
    not taken). A null text has no words. A null source is one source, last in order. Sources
    without words have target 0. Rows that are repeated are separate documents; ties in the drawn
    order are broken by id and size. Columns named like the new ones are replaced.
    """
    spark = docs.sparkSession
    names = ["size", "source_size", "target", "taken", "stretches"]
    kept = without(docs, names)
    base = docs.select(
        F.struct(*kept).alias("__row"),
        F.col(f"`{source}`").alias("__source"),
        F.struct(
            F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`")).alias("h"), F.col(f"`{doc_id}`").alias("id")
        ).alias("__drawn"),
        (word_count(F.col(f"`{text}`")) if size is None else size).alias("size"),
    )
    found = base.groupBy("__source").agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n"))
    p = plan([Source(r[0], r[1], r[2]) for r in found.collect()], shards, seed, **rules)
    rows = [
        (
            s.name, i, s.size, float(t), b, math.ceil(s.size / b), int(q.sum()), start,
            math.ceil(s.rows / CHUNK_ROWS), [int(x) for x in np.cumsum(q)],
        )
        for i, (s, t, b, q, start) in enumerate(
            zip(p.sources, p.targets, p.own, p.quotas, p.starts)
        )
    ]
    schema = StructType(
        [found.schema["__source"], StructField("__no", IntegerType()),
         StructField("source_size", LongType()), StructField("target", DoubleType()),
         StructField("__block", LongType()), StructField("__blocks", LongType()), StructField("__quota", LongType()),
         StructField("__start", LongType()), StructField("__chunks", IntegerType()),
         StructField("__upto", ArrayType(LongType()))]
    )
    known = local_table(spark, rows, schema).withColumnRenamed("__source", "__name")
    joined = base.join(known, F.col("__source").eqNullSafe(F.col("__name")))
    placed = running_totals(
        joined,
        ["__no"],
        [F.pmod(F.col("__drawn.h"), F.greatest("__chunks", F.lit(1)))],
        F.struct("__drawn", "size"),
        {"__from": F.col("size")},
    )
    block = F.col("__block")

    def before(j: Column) -> Column:
        """Blocks taken, repeats counted, before block j."""
        wide = "decimal(19,0)"
        reached = j.cast(wide) * F.col("__quota").cast(wide) + F.col("__start")
        return F.coalesce(F.floor(reached / F.nullif("__blocks", F.lit(0))), F.lit(0)).cast("long")

    first = F.floor(F.col("__from") / block)
    last = F.floor((F.col("__from") + F.col("size") - 1) / block)
    numbers = F.when(F.col("size") > 0, F.sequence(first, last)).otherwise(
        F.array().cast("array<bigint>")
    )

    def stretch(j: Column) -> Column:
        start = F.greatest(j * block - F.col("__from"), F.lit(0))
        end = F.least((j + 1) * block - F.col("__from"), F.col("size"))
        times = before(j + 1) - before(j)
        shard = F.size(F.filter("__upto", lambda upto: upto <= before(j)))
        return F.struct(
            start.alias("start"), end.alias("end"), times.alias("times"),
            F.when(times > 0, shard).alias("shard"),
        )

    cut = placed.withColumn("stretches", F.transform(numbers, stretch))
    taken = F.aggregate(
        "stretches", F.lit(0).cast("long"), lambda sum_, x: sum_ + x["times"] * (x["end"] - x["start"])
    )
    return cut.select("__row.*", "size", "source_size", "target", taken.alias("taken"), "stretches")


def mixed_texts(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The rows of a mix as it takes them: a row for each copy, cut to the words it takes.

    Copy c holds the stretches taken at least c times; a document taken whole keeps its text as it
    is. White space after the last word of a stretch that is left out goes with it. Documents of
    which nothing is taken are left out, also those without words.
    """
    words = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(rf"({WORD}[\x20\x09-\x0D]*)"), F.lit(1))
    most = F.array_max(F.transform("stretches", lambda x: x["times"]))
    copies = mixed.withColumn(
        "__copy", F.explode(F.when(most > 0, F.sequence(F.lit(1).cast("long"), most)))
    )
    whole = F.forall("stretches", lambda x: x["times"] >= F.col("__copy"))
    parts = F.transform(
        F.filter("stretches", lambda x: x["times"] >= F.col("__copy")),
        lambda x: F.slice("__words", (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int")),
    )
    cut = copies.withColumn("__words", F.when(~whole, words))
    piece = F.when(whole, F.col(f"`{text}`")).otherwise(F.array_join(F.flatten(parts), ""))
    return cut.select(
        *[
            piece.alias(c) if c == text else F.col(f"`{c}`")
            for c in mixed.columns
        ]
    )
