"""SentencePiece encoding and decoding of whole texts through a table of distinct chunks.

A text is marked (a marker in front, and one for every space) and cut into chunks at seams that no
piece of the vocabulary crosses: before a marker, between a letter and what is no letter, around
characters that no longer piece holds. What merging does to one chunk then never depends on its
neighbours, so a chunk's ids can be looked up.

1. Texts are cut in blocks of about `BLOCK_CHUNKS` chunks. A block is one row: its distinct chunks,
   numbered as they come, and for every place of its texts the number of the chunk there. Blocks
   are stored as a table bucketed by block, so that they need not move again.
2. The distinct chunks of all blocks go to buckets, ranges of their hash, packed by block. A bucket
   segments each of its distinct chunks once, whatever number of blocks holds it, and answers each
   block with the ids of the block's chunks.
3. Every block meets its answers; ids are joined back by position and decoded.

A chunk that every text holds is one entry of every block, so no bucket is larger than others by
its frequent chunks; buckets grow in number with the distinct chunks of all blocks. Segmenting
applies the merges of a chunk in the order of their score. Decoding looks up the bytes of all
tokens of a block in one blob by a table of offsets.
"""

from __future__ import annotations

import codecs
import heapq
import re
import uuid
from array import array
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ampliframe.llm.common import strings
from ampliframe.session import ensure_checkpoint_dir

MARK = "▁"
#: what the library writes for the unknown piece
UNKNOWN = " ⁇ "
#: chunks of a block (a longer text is still one block), and entries of a bucket on average
BLOCK_CHUNKS = 1 << 22
BUCKET_ENTRIES = 250_000
#: tokens of a slice of rows that a task hands on at once
SLICE_TOKENS = 1 << 19

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class PieceVocabulary:
    """Pieces, scores and bytes of a SentencePiece BPE model with byte fallback.

    Refused are models that change characters, that have pieces of other kinds (unused or user
    defined), or whose pieces go on behind a character into a marker.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.end_id = model.eos_id()
        if model.normalize("  Ａ  b\t ") != MARK * 3 + "Ａ" + MARK * 2 + "b\t" + MARK:
            raise ValueError("the model changes texts in ways that are not supported")
        content, pieces, self._byte_ids = [], {}, [-1] * 256
        self._plain = np.zeros(self.size, bool)
        self._marked = np.zeros(self.size, bool)
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_unused(i) or getattr(model, "is_user_defined", lambda _: False)(i):
                raise ValueError(f"piece {i} is of a kind that is not supported")
            if model.is_control(i):
                content.append(b"")
            elif model.is_unknown(i):
                content.append(UNKNOWN.encode())
            elif model.is_byte(i):
                value = int(piece[1:-1], 16)
                content.append(bytes([value]))
                self._byte_ids[value] = i
            else:
                pieces[piece] = i
                content.append(piece.replace(MARK, " ").encode())
                self._marked[i] = piece.startswith(MARK)
            self._plain[i] = not model.is_control(i)
        if min(self._byte_ids) < 0:
            raise ValueError("the model has no byte fallback")
        self._blob = np.frombuffer(b"".join(content), np.uint8)
        self._offsets = np.concatenate([[0], np.cumsum([len(c) for c in content])])
        self._merges(pieces, [model.get_score(i) for i in range(self.size)])
        self.chunks = self._seams(pieces).findall

    def _merges(self, pieces: dict[str, int], scores: list[float]) -> None:
        """Ids of characters, and of every pair of symbols its rank and the id it becomes."""
        inner = sorted({c for p in pieces for c in p if c not in pieces})
        # a character inside pieces that is none itself is a symbol all the same
        symbols = pieces | {c: self.size + i for i, c in enumerate(inner)}
        self._other = self.size + len(inner)
        self._room = self._other + 1
        self._symbols = {c: i for c, i in symbols.items() if len(c) == 1}
        rank = {s: r for r, s in enumerate(sorted({scores[i] for i in pieces.values()}, reverse=True))}
        self._pairs: dict[int, tuple[int, int]] = {}
        for piece, i in pieces.items():
            for cut in range(1, len(piece)):
                a, b = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if a is not None and b is not None:
                    self._pairs[a * self._room + b] = (rank[scores[i]] << 32, i)

    def _seams(self, pieces: dict[str, int]) -> re.Pattern:
        """The pattern of a chunk, from the characters that are neighbours in some piece."""
        beside = {pair for p in pieces for pair in zip(p, p[1:])}
        if any(b == MARK != a for a, b in beside):
            raise ValueError("a piece goes on into a marker")
        joined = {c for pair in beside for c in pair} - {MARK}
        letters = {c for c in joined if c.isalpha()}
        others = joined - letters
        if any(a in letters and b in others for a, b in beside):
            letters, others = joined, set()
        a, b = ("".join(map(re.escape, sorted(s))) for s in (letters, others))
        lead = f"[{b}]*" if b else ""
        parts = [f"{MARK}*{lead}[{a}]+" if a else "", f"{MARK}*[{b}]+" if b else ""]
        return re.compile("|".join([*filter(None, parts), f"{MARK}+", f"[^{a}{b}{MARK}]"]))

    @staticmethod
    def marked(text: str) -> str:
        return MARK + text.replace(" ", MARK) if text else ""

    def segment(self, chunk: str) -> list[int]:
        """The ids of a chunk: the pair with the best score is merged, leftmost first, until none is left."""
        other, room, pairs = self._other, self._room, self._pairs.get
        own = array("i", [self._symbols.get(c, other) for c in chunk])
        n = len(own)
        heap = []
        for i in range(n - 1):
            met = pairs(own[i] * room + own[i + 1])
            if met:
                heap.append(met[0] | i)
        if heap:
            heapq.heapify(heap)
            after, before = array("i", range(1, n + 1)), array("i", range(-1, n - 1))
            while heap:
                top = heapq.heappop(heap)
                i = top & 0xFFFFFFFF
                j = after[i]
                if own[i] < 0 or j >= n:
                    continue
                met = pairs(own[i] * room + own[j])
                # merged or changed since it was noted
                if not met or met[0] != top - i:
                    continue
                own[i], own[j] = met[1], -1
                j = after[i] = after[j]
                if j < n:
                    before[j] = i
                    met = pairs(own[i] * room + own[j])
                    if met:
                        heapq.heappush(heap, met[0] | i)
                h = before[i]
                if h >= 0:
                    met = pairs(own[h] * room + own[i])
                    if met:
                        heapq.heappush(heap, met[0] | h)
        out: list[int] = []
        for i, symbol in enumerate(own):
            if symbol >= self.size:
                out += [self._byte_ids[b] for b in chunk[i].encode()]
            elif symbol >= 0:
                out.append(symbol)
        return out

    def decode_many(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of the id lists ids[bounds[i]:bounds[i + 1]].

        Control pieces stand for nothing and one marker at the start is left out. Bytes that are
        no UTF-8 become U+FFFD each. Ids outside the vocabulary stand for nothing.
        """
        known = (ids >= 0) & (ids < self.size)
        safe = np.where(known, ids, 0)
        shown = known & self._plain[safe]
        starts = self._offsets[safe]
        lengths = np.where(shown, self._offsets[safe + 1] - starts, 0)
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        raw = self._blob[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)].tobytes()
        places = np.concatenate([[0], ends])[bounds]
        # the first id of every list that stands for anything
        visible = np.concatenate([np.flatnonzero(shown), [len(ids)]])
        first = visible[np.searchsorted(visible, bounds[:-1])]
        lead = np.zeros(len(bounds) - 1, np.int64)
        has = first < bounds[1:]
        lead[has] = self._marked[safe[first[has]]]
        texts = [
            raw[a + skip : b].decode("utf-8", "each_byte")
            for a, b, skip in zip(places[:-1].tolist(), places[1:].tolist(), lead.tolist())
        ]
        # bytes on both sides of an id that stands for nothing do not form a character
        silent = np.flatnonzero(~shown)
        lists = np.searchsorted(bounds, silent, "right") - 1
        within = (silent > first[lists]) & (silent + 1 < bounds[lists + 1])
        for k in np.unique(lists[within]).tolist():
            gaps = silent[within & (lists == k)]
            at = [int(places[k] + lead[k]), *ends[gaps].tolist(), int(places[k + 1])]
            texts[k] = "".join(raw[a:b].decode("utf-8", "each_byte") for a, b in zip(at, at[1:]))
        return texts


@lru_cache(maxsize=2)
def vocabulary(path: str) -> PieceVocabulary:
    """One vocabulary per worker process and file."""
    return PieceVocabulary(path)


def _squeezed(text: str) -> bytes:
    raw = text.encode()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _restored(data: bytes) -> str:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True).decode()


def _packed(numbers: Sequence[int] | np.ndarray) -> bytes:
    """Numbers below 2^31, first bytes, second bytes and so on, which compresses best."""
    planes = np.array(numbers, "<i4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _numbers(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").ravel()


def _list_of(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32), pa.int32()), values)


def blocks(df: DataFrame, path: str, keep: Sequence[str], text: str, room: int) -> DataFrame:
    """Blocks of texts: block, n_chunks, the chunks and places (packed), counts and kept rows."""
    given = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    n_kept = len(keep)
    rows = ArrayType(StructType(given.schema.fields[:n_kept]))

    def run(batches):
        own = vocabulary(path)
        made = 0
        numbers: dict[str, int] = {}
        places, counts, held, total = [], [], [], 0

        def block():
            nonlocal made
            found = list(numbers)
            columns = [pa.concat_arrays([h[i] for h in held]) for i in range(n_kept)]
            kept = pa.StructArray.from_arrays(columns, names=list(keep))
            made += 1
            fields = {
                "block": pa.array([(TaskContext.get().partitionId() << 32) + made], pa.int64()),
                "n_chunks": pa.array([len(found)], pa.int64()),
                "sizes": pa.array([_packed([len(c) for c in found])], pa.binary()),
                "chunks": pa.array([_squeezed("".join(found))], pa.binary()),
                "places": pa.array([_packed(np.concatenate(places))], pa.binary()),
                "counts": pa.array([_packed(counts)], pa.binary()),
                "rows": _list_of(np.array([0, len(kept)]), kept),
            }
            return pa.RecordBatch.from_arrays(list(fields.values()), names=list(fields))

        for batch in batches:
            first = 0
            for i, t in enumerate(strings(batch.column(n_kept))):
                cut = own.chunks(own.marked(t))
                places.append(
                    np.fromiter((numbers.setdefault(c, len(numbers)) for c in cut), np.int32, len(cut))
                )
                counts.append(len(cut))
                total += len(cut)
                if total >= room:
                    held.append(batch.slice(first, i + 1 - first).columns[:n_kept])
                    yield block()
                    first = i + 1
                    numbers.clear()
                    places, counts, held, total = [], [], [], 0
            if first < batch.num_rows:
                held.append(batch.slice(first).columns[:n_kept])
        if counts:
            yield block()

    schema = StructType().add("block", "long").add("n_chunks", "long")
    for name in ("sizes", "chunks", "places", "counts"):
        schema = schema.add(name, "binary")
    return given.mapInArrow(run, schema.add("rows", rows))


def stored(cut: DataFrame) -> DataFrame:
    """The blocks as a table in the shared folder, bucketed by block; no row is shuffled."""
    session = cut.sparkSession
    name = f"pieces_{uuid.uuid4().hex}"
    writer = cut.write.bucketBy(int(session.conf.get("spark.sql.shuffle.partitions")), "block")
    path = f"{ensure_checkpoint_dir(session)}/{name}"
    writer.format("parquet").option("path", path).saveAsTable(name)
    return session.table(name)


def _cut_up(chunks: bytes, sizes: bytes) -> list[str]:
    text, ends = _restored(chunks), np.cumsum(_numbers(sizes)).tolist()
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def _packs(cut: DataFrame, buckets: int) -> DataFrame:
    """The distinct chunks of every block by the range of their hash: bucket, block, numbers, chunks.

    `numbers` are the steps from one chunk's number in its block to the next one's.
    """

    def run(batches):
        for batch in batches:
            for block, sizes, chunks in zip(*(batch.column(i).to_pylist() for i in range(3))):
                own = _cut_up(chunks, sizes)
                hashes = np.array([xxhash.xxh32_intdigest(c) for c in own], np.int64)
                bucket = hashes * buckets >> 32
                order = np.argsort(bucket, kind="stable")
                used, first = np.unique(bucket[order], return_index=True)
                packs = np.split(order, first[1:]) if len(own) else []
                held = [[own[i] for i in p.tolist()] for p in packs]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(used.astype(np.int32)),
                        pa.array([block] * len(packs), pa.int64()),
                        pa.array([_packed(np.diff(p, prepend=0)) for p in packs], pa.binary()),
                        pa.array([_packed([len(c) for c in h]) for h in held], pa.binary()),
                        pa.array([_squeezed("".join(h)) for h in held], pa.binary()),
                    ],
                    names=["bucket", "block", "numbers", "sizes", "chunks"],
                )

    return cut.select("block", "sizes", "chunks").mapInArrow(
        run, "bucket int, block long, numbers binary, sizes binary, chunks binary"
    )


def _segmented(packs: DataFrame, path: str) -> DataFrame:
    """The ids of every pack's chunks; rows come by bucket, each chunk of a bucket is segmented once."""

    def run(batches):
        own = vocabulary(path)
        known: dict[str, bytes] = {}
        current = None
        for batch in batches:
            out = []
            for bucket, block, numbers, sizes, chunks in zip(
                *(batch.column(i).to_pylist() for i in range(5))
            ):
                if bucket != current:
                    known, current = {}, bucket
                found = []
                for chunk in _cut_up(chunks, sizes):
                    ids = known.get(chunk)
                    if ids is None:
                        ids = known[chunk] = np.array(own.segment(chunk), "<i4").tobytes()
                    found.append(ids)
                lengths = _packed([len(f) // 4 for f in found])
                out.append((block, numbers, lengths, _packed(np.frombuffer(b"".join(found), "<i4"))))
            columns = zip(*out) if out else [[], [], [], []]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)],
                names=["block", "numbers", "lengths", "ids"],
            )

    return packs.mapInArrow(run, "block long, numbers binary, lengths binary, ids binary")


def _joined(own: PieceVocabulary, places, counts, answers, end: bool, decoded: bool):
    """Slices (first row, last row, id offsets, ids, texts or None) of a block."""
    none = [np.zeros(0, np.int64)]
    numbers, own_lengths = (
        np.concatenate(none + [found(_numbers(a[name])) for a in answers])
        for name, found in (("numbers", np.cumsum), ("lengths", np.asarray))
    )
    ids = np.concatenate(none + [_numbers(a["ids"]) for a in answers]).astype(np.int32)
    lengths, starts = np.zeros((2, len(numbers)), np.int64)
    lengths[numbers] = own_lengths
    starts[numbers] = np.cumsum(own_lengths) - own_lengths
    ends = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.concatenate([[0], np.cumsum(lengths[places])])[ends]
    first, n = 0, len(counts)
    while first < n:
        last = int(np.searchsorted(tokens, tokens[first] + SLICE_TOKENS, "right")) - 1
        last = min(max(last, first + 1), n)
        at = places[ends[first] : ends[last]]
        size = lengths[at]
        upto = np.cumsum(size)
        total = int(upto[-1]) if len(upto) else 0
        found = ids[np.repeat(starts[at] - (upto - size), size) + np.arange(total)]
        bounds = tokens[first : last + 1] - tokens[first]
        if end:
            found = np.insert(found, bounds[1:], own.end_id)
            bounds = bounds + np.arange(len(bounds))
        yield first, last, bounds, found, own.decode_many(found, bounds) if decoded else None
        first = last


def encode(
    df: DataFrame,
    path: str,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
    end: bool = True,
    decoded: bool = True,
    ids: str = "token_ids",
    back: str = "decoded",
    room: int = BLOCK_CHUNKS,
) -> DataFrame:
    """The columns `keep` of `df` with the token ids of every whole text and, decoded from them, its text.

    One row for every row, repeated ones included. A null text has no tokens, like an empty one;
    `end` adds the end id to each. Columns of `keep` named like `ids` or `back` are replaced by
    them (names are not case-sensitive); other columns of `df` do not matter. A very long text, or
    one without a space, is one block or one chunk and is still handled whole.
    """
    made = {ids.lower(), back.lower()} if decoded else {ids.lower()}
    keep = [c for c in keep if c.lower() not in made]
    counter = "__row" if not keep else None
    if counter:
        df, keep = df.withColumn(counter, F.lit(0)), [counter]
    cut = stored(blocks(df, path, keep, text, room))
    entries = cut.agg(F.sum("n_chunks")).first()[0] or 0
    buckets = max(1, -(-entries // BUCKET_ENTRIES), 2 * df.sparkSession.sparkContext.defaultParallelism)
    packs = _packs(cut, buckets).repartitionByRange(buckets, "bucket").sortWithinPartitions("bucket")
    answers = (
        _segmented(packs, path)
        .groupBy("block")
        .agg(F.collect_list(F.struct("numbers", "lengths", "ids")).alias("answers"))
    )
    met = cut.select("block", "places", "counts", "rows").join(answers, "block", "left")
    fields = list(cut.schema["rows"].dataType.elementType.fields)
    fields.append(StructField(ids, ArrayType(IntegerType(), False), False))
    if decoded:
        fields.append(StructField(back, StringType(), False))
    schema = StructType(fields)

    def run(batches):
        own = vocabulary(path)
        for batch in batches:
            for i in range(batch.num_rows):
                places, counts = (_numbers(batch.column(c)[i].as_py()) for c in (0, 1))
                kept = batch.column(2)[i].values
                told = batch.column(3)[i].as_py() or []
                for first, last, bounds, found, texts in _joined(own, places, counts, told, end, decoded):
                    columns = [
                        *kept.slice(first, last - first).flatten(),
                        _list_of(bounds, pa.array(found, pa.int32())),
                    ]
                    if decoded:
                        columns.append(pa.array(texts, pa.string()))
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    out = met.select("places", "counts", "rows", "answers").mapInArrow(run, schema)
    return out.drop(counter) if counter else out


def decode(df: DataFrame, path: str, ids: str = "token_ids", text: str = "text") -> DataFrame:
    """`df` with the text of every list of token ids; null ids give an empty text."""
    from ampliframe.llm.common import add_columns

    def start():
        own = vocabulary(path)

        def step(lists):
            lists = lists.fill_null([]) if lists.null_count else lists
            values = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
            return [pa.array(own.decode_many(values, bounds), pa.string())]

        return step

    return add_columns(df, [ids], StructType([StructField(text, StringType(), False)]), start)
