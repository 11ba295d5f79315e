"""Product codes of vectors: every part of a vector becomes the index of its nearest codebook entry.

Vectors are whole numbers, cut into equal consecutive parts. Each part position has a codebook,
which starts from the vectors with the smallest ids; every round assigns all parts to the nearest
entry and moves each entry to the floor of its parts' mean.

Rounds after the first skip work by norm-of-sum bounds. A vector's part keeps, for every group of
entries, a lower bound of its distance to the group's entries other than its own, and the round in
which the bound was measured. Codebooks of all rounds are kept, so what an entry may have come
nearer since then is the length of its true net displacement between these two codebooks, which is
never more, and mostly less, than the sum of the lengths of its single steps. A group whose bound
less the greatest net displacement in it exceeds the distance to the present entry is not looked
at; all others are scanned again, exactly, in whole numbers. Results never depend on the bounds.

Vectors travel in packed blocks with their bounds. A round reads the blocks once, writes the new
ones to the checkpoint folder and sums parts per entry in every task before anything is shuffled.
The driver holds the codebooks only: rounds + 1 times `entries` vectors.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ampliframe.functions.scale import join_lookup
from ampliframe.llm.common import pack_numbers, unpack_numbers, without
from ampliframe.llm.topk import usable, whole_numbers
from ampliframe.session import materialise

PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: entries of a codebook are bounded in so many groups of neighbouring indexes
GROUPS = 8
BLOCK_ROWS = 4096
#: sums of products below this are exact in double precision
EXACT = 1 << 53


@dataclass
class Codes:
    """The coded rows, the final codebooks (part, entry, place) and the group scans of each round."""

    rows: DataFrame
    codebooks: np.ndarray
    scanned: list[int]

    def digest(self) -> str:
        """SHA-256 of all entries' components by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def squared_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of `x` to every entry, as 64-bit integers."""
    reach = int(max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)))
    most = 4 * reach * reach * x.shape[1]
    if most >= 1 << 62:
        raise ValueError("components are too large for distances in 64-bit integers")
    kind = np.float64 if most < EXACT else np.int64
    a, b = x.astype(kind), entries.astype(kind)
    found = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]
    return found.astype(np.int64)


def groups_of(entries: int, groups: int) -> list[np.ndarray]:
    return [g for g in np.array_split(np.arange(entries), groups) if len(g)]


def net_displacements(history: list[np.ndarray], groups: int) -> np.ndarray:
    """By round, part and group: the farthest an entry is from where it was in that round.

    Lengths are rounded up.
    """
    parts = history[0].shape[:2]
    out = []
    for before in history:
        steps = (history[-1] - before).astype(np.float64)
        lengths = np.sqrt((steps * steps).sum(2)) * (1 + 1e-9)
        out.append(
            [[lengths[p, g].max(initial=0) for g in groups_of(parts[1], groups)] for p in range(parts[0])]
        )
    return np.array(out)


class Assigned:
    """Of the vectors of a block, by part: the entry (-1: none yet), bounds and their rounds."""

    def __init__(self, entry: np.ndarray, bound: np.ndarray, stamp: np.ndarray):
        self.entry, self.bound, self.stamp = entry, bound, stamp

    @classmethod
    def none(cls, n: int, parts: int, groups: int) -> Assigned:
        zeros = np.zeros((n, parts, groups), np.int64)
        return cls(np.full((n, parts), -1, np.int64), zeros, zeros.copy())

    def packed(self) -> list[bytes]:
        return [pack_numbers(a) for a in (self.entry, self.bound, self.stamp)]

    @classmethod
    def unpacked(cls, data: list[bytes], n: int, parts: int, groups: int) -> Assigned:
        entry, bound, stamp = (unpack_numbers(d) for d in data)
        shape = (n, parts, groups)
        return cls(entry.reshape(n, parts), bound.reshape(shape), stamp.reshape(shape))

    def again(self, p: int, x: np.ndarray, history: list[np.ndarray], moved: np.ndarray):
        """Assign part `p` of all vectors to the last codebook; `moved` are its net displacements.

        Returns the squared distances and how many groups were scanned for how many vectors. The
        nearest entry is taken, of several the one with the lowest index.
        """
        book, now = history[-1][p], len(history) - 1
        members = groups_of(len(book), self.bound.shape[2])
        entry, bound, stamp = self.entry[:, p], self.bound[:, p], self.stamp[:, p]
        n, own = len(x), entry.copy()
        first = own < 0
        best = np.full(n, np.iinfo(np.int64).max)
        if not first.all():
            step = x - book[own]
            # also checks that the numbers are small enough
            squared_distances(x[:0], book)
            best = np.where(first, best, (step * step).sum(1))
        index = np.where(first, len(book), own)
        # the present entry and group bounds, as they are before anything is scanned
        held, scans = best.copy(), 0
        root = np.sqrt(held.astype(np.float64))
        lower = bound - moved[stamp, p, np.arange(len(members))[None, :]]
        look = first[:, None] | (lower <= (root * (1 + 1e-9) + 1e-6)[:, None])
        seconds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for g, group in enumerate(members):
            rows = np.flatnonzero(look[:, g])
            if not len(rows):
                continue
            scans += len(rows)
            found = squared_distances(x[rows], book[group])
            seconds[g] = rows, found
            near = found.argmin(1)
            value, at = found[np.arange(len(rows)), near], group[near]
            better = (value < best[rows]) | ((value == best[rows]) & (at < index[rows]))
            best[rows[better]], index[rows[better]] = value[better], at[better]
        # an entry that was left is one of the others of its group from now on
        left = np.flatnonzero(~first & (index != own))
        if len(left):
            group_of = np.repeat(np.arange(len(members)), [len(m) for m in members])
            g = group_of[own[left]]
            least = np.minimum(lower[left, g], root[left] * (1 - 1e-9))
            bound[left, g], stamp[left, g] = np.floor(np.maximum(least, 0)).astype(np.int64), now
        for g, (rows, found) in seconds.items():
            group = members[g]
            mine = index[rows] - group[0]
            inside = np.flatnonzero((mine >= 0) & (mine < len(group)))
            found[inside, mine[inside]] = np.iinfo(np.int64).max
            least = np.sqrt(found.min(1).astype(np.float64)) * (1 - 1e-9)
            bound[rows, g], stamp[rows, g] = np.minimum(np.floor(least), 1 << 30).astype(np.int64), now
        entry[:] = index
        return best, scans


STATE = ("entry", "bound", "stamp")


def _blocks(df: DataFrame, kept: list[str], width: int, parts: int, groups: int) -> DataFrame:
    """Packed blocks of the rows of `df` (kept columns, then the vector): n, data, state and rows."""
    rows = ArrayType(StructType(df.schema.fields[: len(kept)]))

    def run(batches):
        held, vectors = [], []

        def block():
            n = sum(len(v) for v in vectors)
            columns = [pa.concat_arrays([h[i] for h in held]) for i in range(len(kept))]
            own = pa.StructArray.from_arrays(columns, names=kept)
            state = Assigned.none(n, parts, groups).packed()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([n], pa.int64()),
                    pa.array([pack_numbers(np.concatenate(vectors))], pa.binary()),
                    *[pa.array([s], pa.binary()) for s in state],
                    pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), own),
                ],
                names=["n", "data", *STATE, "rows"],
            )

        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(first, BLOCK_ROWS)
                lists = part.column(len(kept))
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                matrix = np.zeros((len(lists), width), np.int64)
                at = np.repeat(np.cumsum(sizes) - sizes, sizes)
                place = np.arange(int(sizes.sum())) - at
                matrix[np.repeat(np.arange(len(lists)), sizes), place] = lists.flatten().to_numpy()
                held.append(part.columns[: len(kept)])
                vectors.append(matrix)
                if sum(len(v) for v in vectors) >= BLOCK_ROWS:
                    yield block()
                    held, vectors = [], []
        if vectors:
            yield block()

    schema = StructType().add("n", "long").add("data", "binary")
    for name in STATE:
        schema = schema.add(name, "binary")
    return df.mapInArrow(run, schema.add("rows", rows))


def _assign(blocks: DataFrame, history: list[np.ndarray], groups: int) -> DataFrame:
    """The blocks after assigning all parts to the last codebooks: also `errors` and `scans`."""
    moved = net_displacements(history, groups)
    parts, _, size = history[0].shape
    fields = [f for f in blocks.schema.fields if f.name not in ("errors", "scans")]
    schema = StructType([*fields]).add("errors", "binary").add("scans", "long")
    names = [f.name for f in fields]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                n = row.column("n")[0].as_py()
                data = unpack_numbers(row.column("data")[0].as_py()).reshape(n, parts, size)
                state = Assigned.unpacked([row.column(s)[0].as_py() for s in STATE], n, parts, groups)
                errors, scans = np.zeros(n, np.int64), 0
                for p in range(parts):
                    far, looked = state.again(p, data[:, p], history, moved)
                    errors += far
                    scans += looked
                new = dict(zip(STATE, state.packed())) | {"errors": pack_numbers(errors)}
                columns = [
                    pa.array([new[c]], pa.binary()) if c in new else row.column(c) for c in names
                ]
                columns += [pa.array([new["errors"]], pa.binary()), pa.array([scans], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return blocks.select(*names).mapInArrow(run, schema)


def _moved_codebooks(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Every entry at the floor of the mean of its parts; entries without parts stay."""
    parts, entries, size = books.shape

    def run(batches):
        sums = np.zeros((parts, entries, size), np.int64)
        counts = np.zeros((parts, entries), np.int64)
        for batch in batches:
            for n, data, entry in zip(*(batch.column(c).to_pylist() for c in range(3))):
                x = unpack_numbers(data).reshape(n, parts, size)
                own = unpack_numbers(entry).reshape(n, parts)
                for p in range(parts):
                    np.add.at(sums[p], own[:, p], x[:, p])
                    counts[p] += np.bincount(own[:, p], minlength=entries)
        p, k = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(p.astype(np.int64)), pa.array(k.astype(np.int64)), pa.array(counts[p, k]),
                pa.array(sums[p, k].tolist(), pa.list_(pa.int64())),
            ],
            names=["part", "entry", "n", "total"],
        )

    found = blocks.select("n", "data", "entry").mapInArrow(
        run, "part long, entry long, n long, total array<long>"
    )
    # counted at place -1, so that entries of no width are counted too
    spread = found.select("part", "entry", F.posexplode(F.concat(F.array("n"), "total")))
    out = books.copy()
    counts: dict[tuple[int, int], int] = {}
    rows = spread.groupBy("part", "entry", "pos").agg(F.sum("col").alias("value")).collect()
    for part, entry, pos, value in sorted(map(tuple, rows), key=lambda r: r[2]):
        if pos == 0:
            counts[part, entry] = value
        else:
            out[part, entry, pos - 1] = value // counts[part, entry]
    return out


def compress(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: float = 1024.0,
    groups: int = GROUPS,
) -> Codes:
    """Codes of all vectors that hold finite numbers only, after `rounds` rounds.

    The rows have all columns of `vectors` but the vector, `code` (two hex digits for each part)
    and `error`, the squared distance between the vector and what its code stands for, in whole
    numbers floor(scale * x). Columns of these names are replaced. Null vectors and those with a
    null or non-finite component are left out; repeated rows, and rows without an id, are kept.

    Codebooks start from the `entries` smallest ids, of equal ids the smaller vector, null ids
    last; of fewer vectors, from all. Vectors narrower than the widest one, or than a multiple of
    `parts`, are filled up with zeros. Of equally near entries the first one is taken. An empty
    table has no rows and no codebooks. Components so large that squared distances leave 64-bit
    integers are refused with an error.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    groups = max(1, min(groups, entries))
    kept = [c for c in vectors.columns if c.lower() not in {vector.lower(), "code", "error"}]
    given = vectors.filter(usable(F.col(f"`{vector}`"))).select(
        *[F.col(f"`{c}`") for c in kept],
        whole_numbers(F.col(f"`{vector}`"), scale).alias("__vector"),
    )
    widest = given.agg(F.max(F.size("__vector"))).first()[0] or 0
    size = -(-widest // parts)
    smallest = given.select(F.col(f"`{vec_id}`").alias("id"), F.col("__vector").alias("v")).orderBy(
        F.asc_nulls_last("id"), "v"
    )
    first = np.zeros((parts, 0, size), np.int64)
    found = [r["v"] + [0] * (parts * size - len(r["v"])) for r in smallest.limit(entries).collect()]
    if found:
        first = np.array(found, np.int64).reshape(len(found), parts, size).transpose(1, 0, 2).copy()
    fields = [*given.schema.fields[: len(kept)], StructField("code", StringType(), False)]
    schema = StructType([*fields, StructField("error", LongType(), False)])
    if not found:
        return Codes(vectors.sparkSession.createDataFrame([], schema), first, [])
    groups = len(groups_of(len(found), groups))
    history, scanned = [first], []
    blocks = _blocks(given, kept, parts * size, parts, groups)
    for round_ in range(rounds + 1):
        blocks = materialise(_assign(blocks, history, groups))
        scanned.append(blocks.agg(F.sum("scans")).first()[0])
        if round_ < rounds:
            history.append(_moved_codebooks(blocks, history[-1]))
    hexes = np.array([f"{i:02x}" for i in range(256)])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                entry = unpack_numbers(batch.column(0)[i].as_py()).reshape(-1, parts)
                codes = ["".join(c) for c in hexes[entry].tolist()]
                errors = unpack_numbers(batch.column(1)[i].as_py())
                columns = [*batch.column(2)[i].values.flatten(), pa.array(codes), pa.array(errors)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    rows = blocks.select("entry", "errors", "rows").mapInArrow(run, schema)
    return Codes(rows, history[-1], scanned)


def with_group_error(rows: DataFrame, label: str = "label", name: str = "label_error") -> DataFrame:
    """`rows` with the errors summed over equal labels; rows without a label are one group.

    Errors are summed before they are shuffled. Few labels are sent to every task, many are joined.
    """
    key = F.when(F.col(label).isNull(), "").otherwise(F.concat(F.lit("="), F.col(label).cast("string")))
    keyed = rows.select(*without(rows, [name]), key.alias("__key"))
    sums = keyed.groupBy("__key").agg(F.sum("error").alias(name))
    return join_lookup(keyed, sums, ["__key"], "left").drop("__key")


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = 1024) -> str:
    """The digest query in DuckDB's SQL, for vectors of one width that the parts divide."""
    steps = []
    for t in range(rounds + 1):
        steps.append(f"""
a{t} as materialized (
  select p.r, p.part, min(list_sum(list_transform(range(1, len(p.x) + 1),
    lambda i: (p.x[i] - c.c[i]) * (p.x[i] - c.c[i])))::bigint * 1024 + c.k) as m
  from p join c{t} as c using (part) group by p.r, p.part)""")
        if t < rounds:
            steps.append(f"""
s{t} as (
  select part, m % 1024 as k, i, sum(x[i])::bigint as s, count(*) as n
  from p join a{t} using (r, part), unnest(range(1, len(x) + 1)) as u(i) group by part, k, i),
c{t + 1} as materialized (
  select part, k, coalesce(n.c, o.c) as c from c{t} as o left join (
    select part, k, list((s - (s % n + n) % n) // n order by i) as c from s{t} group by part, k) as n
    using (part, k))""")
    return f"""
with v as materialized (
  select row_number() over (order by vec_id) as r, vec_id, label,
    list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as e from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as materialized (
  select r, vec_id, part, e[part * (len(e) // {parts}) + 1 : (part + 1) * (len(e) // {parts})] as x
  from v, unnest(range({parts})) as u(part)),
c0 as materialized (
  select part, row_number() over (partition by part order by vec_id, r) - 1 as k, x as c from p
  qualify k < {entries}),{",".join(steps)},
books as (
  select sha256(string_agg(c[i]::varchar, ',' order by part, k, i)) as codebooks_sha256
  from c{rounds}, unnest(range(1, len(c) + 1)) as u(i)),
found as (
  select r, string_agg(printf('%02x', m % 1024), '' order by part) as code,
    sum(m // 1024)::bigint as error from a{rounds} group by r)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
  codebooks_sha256
from v join found using (r), books"""
