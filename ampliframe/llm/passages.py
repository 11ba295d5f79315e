"""Passages that recur, exactly or nearly, in different documents, found by runs of equal tokens.

A text's tokens are the hashes of its five-word shingles. A passage counts if two stretches of the
wanted length have a Jaccard similarity of at least `SIMILARITY` of their tokens. Then they share
a certain number of tokens (41 of 46 for 50 words and 0.8), and as a word changed, put in or left
out within a stretch spoils at least four tokens, what they share is one run of tokens, or two
with one changed place between: one run has half of the shared tokens (21) or more.

Candidates are found by the least hash of every stretch of that half's length (winnowing): texts
that share such a run have the same place in it. The place is told by the tokens up to it and by
the tokens from it on, half a run each (15 words), one of which lies in the shared run. In a group
of up to `PAIRED` places with the same tokens every two are linked. A larger group, as a licence
line or a quotation makes it, is looked at more closely, and no pair of it is left out:

- Texts that share all the tokens in one run have a stretch of that length in common. All such
  stretches around places of large groups are hashed whole, and all texts with the same stretch
  are linked to the first of them.
- Texts that share them in two runs differ at the place between: the token before it is followed
  by different words in different texts, the token behind it preceded by different ones. Where
  this is true of texts that no links verified so far join, and enough tokens around stand in such
  texts, the words of both runs are hashed without what stands between, for all places where the
  first run may begin, and all texts with the same words are linked to the first of them.

So two texts with a near repeat are compared with each other, or each with a text that has the very
words they share, or links found before join them. What is not sure to be found are stretches similar only as sets, whose tokens stand in
another order in shorter runs (phrases of four words repeated within a stretch make that possible),
and, where `similarity` is set so low that there may be two changed places, pairs with two of them
all of whose runs lie in large groups.

Groups are read as a sorted stream: a group of any size takes the memory of one batch. Every link
is verified on the whole texts, first token by token at its shift, else by all pairs of stretches
around the shared token as sets.

Documents with the same words are one text, compared with others once. A document with several
texts takes part with each of them.
"""

from __future__ import annotations

import math
import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ampliframe.llm.common import utf8
from ampliframe.llm.components import components
from ampliframe.session import ensure_checkpoint_dir, materialise

SHINGLE = 5
PASSAGE_WORDS = 50
SIMILARITY = 0.8
#: places of a group that are linked pair by pair
PAIRED = 32
#: tokens of texts that are kept for their next comparison
KNOWN_TOKENS = 1 << 21
#: tokens of two texts that are numbered whole for their comparison
NUMBERED_TOKENS = 1 << 13
#: rows of one group that are held until it counts as large
HELD_ROWS = 1 << 16
#: tokens handled at once by numpy; a longer text is still handled whole
BLOCK_TOKENS = 1 << 18
#: tokens around repeated places that are hashed at once
SURROUNDING_TOKENS = 1 << 18
#: more than the kinds of keys; a key tells its kind by its last bits
HASH_ROOM = 64
#: keys of the tokens up to a place and from it on
UPTO, ONWARD = 0, 1
#: bits of a packed hash that hold a token's place in its block
PLACE_BITS = 27
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


#: bytes that are hashed at once; a longer word is hashed by itself
PIECE_BYTES = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n + 1, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


POWERS = _powers(MULTIPLIERS[3] | 1, PIECE_BYTES)
INVERSES = _powers(pow(MULTIPLIERS[3] | 1, -1, 1 << 64), PIECE_BYTES)


def plain_words(text: bytes) -> bytes:
    """The words of a text, A-Z in lower case, with one space between them."""
    return b" ".join(text.lower().split())


def count_words(plain: bytes) -> int:
    return plain.count(b" ") + 1 if plain else 0


def word_hashes(plain: bytes) -> np.ndarray:
    """A 64-bit hash of every word of a text with one space between its words."""
    raw = np.frombuffer(plain, np.uint8)
    spaces = np.flatnonzero(raw == 32)
    starts, ends = np.append(0, spaces + 1), np.append(spaces, len(raw))
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        at = starts[i]
        j = int(np.searchsorted(ends, at + PIECE_BYTES, "right"))
        if j <= i:
            out[i] = xxhash.xxh64_intdigest(plain[at : ends[i]])
            i += 1
            continue
        sums = np.zeros(ends[j - 1] - at + 1, np.uint64)
        np.cumsum(LETTERS[raw[at : ends[j - 1]]] * POWERS[: len(sums) - 1], out=sums[1:])
        first = starts[i:j] - at
        out[i:j] = (sums[ends[i:j] - at] - sums[first]) * INVERSES[first]
        i = j
    out ^= out >> np.uint64(29)
    out *= np.uint64(MULTIPLIERS[1])
    return out ^ (out >> np.uint64(32))


def tokens_of(own: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every shingle of five words, from the hashes of the words."""
    if len(own) < SHINGLE:
        return np.zeros(0, np.uint64)
    n = len(own) - SHINGLE + 1
    key = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        key = key * np.uint64(MULTIPLIERS[0]) + own[i : i + n]
        key ^= key >> np.uint64(31)
    return key


def hashed_texts(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The hashes of words and the tokens of each text with a word, all made at once."""
    words = word_hashes(b" ".join(texts))
    tokens, out, at = tokens_of(words), [], 0
    for text in texts:
        end = at + count_words(text)
        # tokens across the end of a text are left out
        out.append((words[at:end], tokens[at : max(end - SHINGLE + 1, at)]))
        at = end
    return out


def _hashed(tokens: np.ndarray, function: int) -> np.ndarray:
    h = (tokens ^ np.uint64(function + 1)) * np.uint64(MULTIPLIERS[1])
    h ^= h >> np.uint64(29)
    h *= np.uint64(MULTIPLIERS[2])
    return h ^ (h >> np.uint64(32))


LETTERS = _hashed(np.arange(256, dtype=np.uint64), 0)


def run_hashes(values: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """A hash of the `width` values from each start on."""
    total = np.zeros(len(starts), np.uint64)
    for i in range(width):
        total = total * np.uint64(MULTIPLIERS[3] | 1) + values[starts + i]
    total ^= total >> np.uint64(29)
    return total * np.uint64(MULTIPLIERS[2])


def least_places(tokens: np.ndarray, ends: np.ndarray, function: int, width: int):
    """Hashes, the same with places, and starts and least places of all stretches of that width.

    No stretch goes beyond the end of its text. Equal hashes count as smaller the further left
    they stand.
    """
    n = len(tokens)
    hashes = _hashed(tokens, function)
    low = np.uint64((1 << PLACE_BITS) - 1)
    packed = (hashes & ~low) | np.arange(n, dtype=np.uint64)
    least, span = packed, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: n - width + 1], least[width - span : n - span + 1])
    begins = np.concatenate([[0], ends[:-1]])
    inside = np.zeros(n + 1, np.int64)
    has_any = ends - begins >= width
    inside[begins[has_any]] += 1
    inside[ends[has_any] - width + 1] -= 1
    starts = np.flatnonzero(np.cumsum(inside[: n - width + 1]) > 0)
    return hashes, packed, starts, (least[starts] & low).astype(np.int64)


def compact_windows(tokens: np.ndarray, ends: np.ndarray, function: int, width: int):
    """All compact windows at least `width` wide of the texts that end at `ends` in `tokens`.

    Returns the min-hash, l, c and r of each, as places in `tokens`: all stretches from [l, c] to
    [c, r] have their least hash at c.
    """
    hashes, packed, _, least = least_places(tokens, ends, function, width)
    begins = np.concatenate([[0], ends[:-1]])
    # every window of that width has its centre among the least of all stretches of the width
    centres = np.unique(least)
    text_of = np.searchsorted(ends, centres, "right")
    left, right = begins[text_of], ends[text_of] - 1
    values, texts = packed[centres].tolist(), text_of.tolist()
    # the tree's edges: the nearest smaller centre on either side, within the same text
    stack: list[int] = []
    before, after = [-1] * len(values), [-1] * len(values)
    for i, value in enumerate(values):
        if stack and texts[stack[-1]] != texts[i]:
            stack.clear()
        while stack and values[stack[-1]] > value:
            after[stack.pop()] = i
        if stack:
            before[i] = stack[-1]
        stack.append(i)
    before, after = np.array(before, np.int64), np.array(after, np.int64)
    l = np.where(before >= 0, centres[before] + 1, left) if len(centres) else left
    r = np.where(after >= 0, centres[after] - 1, right) if len(centres) else right
    wide = r - l + 1 >= width
    return hashes[centres[wide]], l[wide], centres[wide], r[wide]


def not_repeated(
    tokens: np.ndarray, begins: np.ndarray, ends: np.ndarray, key: np.ndarray, text: np.ndarray,
    c: np.ndarray, width: int,
) -> np.ndarray:
    """Which places to keep: all but those of one text and hash in the same surroundings.

    Words repeated over and over make nearly every token a place, all with one hash. Those with
    the same tokens on both sides, as far as a passage reaches, compare alike.
    """
    order = np.argsort(key ^ text.astype(np.uint64) * np.uint64(MULTIPLIERS[0]), kind="stable")
    same = (key[order[1:]] == key[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    many = np.zeros(len(key), bool)
    many[order[1:]] |= same
    many[order[:-1]] |= same
    places = np.flatnonzero(many)
    around = np.empty(len(places), np.uint64)
    steps = np.arange(1 - width, width)
    factors = _powers(MULTIPLIERS[3] | 1, len(steps) + 4)
    at_once = max(SURROUNDING_TOKENS // len(steps), 1)
    for i in range(0, len(places), at_once):
        own = places[i : i + at_once]
        at, first, end = c[own], begins[text[own]], ends[text[own]]
        spots = at[:, None] + steps
        inside = (spots >= first[:, None]) & (spots < end[:, None])
        values = np.where(inside, tokens[np.clip(spots, 0, len(tokens) - 1)], np.uint64(0))
        # the tokens, how many there are on either side, the hash and the text
        parts = [np.minimum(at - first, width - 1), np.minimum(end - at, width), key[own], text[own]]
        values = np.column_stack([values, *(_hashed(p.astype(np.uint64), 1) for p in parts)])
        around[i : i + at_once] = (values * factors[: values.shape[1]]).sum(axis=1)
    keep = ~many
    keep[places[np.unique(_hashed(around, 0), return_index=True)[1]]] = True
    return keep


WINDOW_SCHEMA = "key long, th long, c int"


def packed_text(plain: bytes) -> bytes:
    """A text, compressed."""
    return len(plain).to_bytes(8, "little") + pa.compress(plain, "zstd", asbytes=True)


def unpacked_text(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, "zstd", asbytes=True)


class Shape(NamedTuple):
    """What two similar stretches of `words` words have in common at least."""

    words: int
    #: tokens of a stretch, and how many of them are shared
    width: int
    shared: int
    #: places within a stretch where one may differ from the other
    gaps: int
    #: tokens of the longest run that is shared
    run: int


def shape_of(words: int, similarity: float) -> Shape:
    width = words - SHINGLE + 1
    shared = max(math.ceil(2 * width * similarity / (1 + similarity) - 1e-9), 1)
    gaps = (width - shared) // (SHINGLE - 1)
    return Shape(words, width, shared, gaps, -(-shared // (gaps + 1)))


class Block(NamedTuple):
    """Some texts laid end to end; places count from the first one's first word or token."""

    #: other columns of each text
    others: list[list]
    hashes: np.ndarray
    tokens: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    #: word hashes, with `SHINGLE - 1` words more than tokens for each text
    words: np.ndarray
    word_begins: np.ndarray


def _block(held) -> Block:
    others, hashes, tokens, words = zip(*held)
    ends = np.cumsum([len(t) for t in tokens])
    word_ends = np.cumsum([len(w) for w in words])
    return Block(
        list(others), np.array(hashes, np.uint64).view(np.int64),
        np.concatenate(tokens), np.append(0, ends[:-1]), ends,
        np.concatenate(words), np.append(0, word_ends[:-1]),
    )


def _pieces(rows, size_of):
    """Lists of rows that hold about `PIECE_BYTES` by `size_of`; a larger row stands alone."""
    held, size = [], 0
    for row in rows:
        own = size_of(row)
        if held and size + own > PIECE_BYTES:
            yield held
            held, size = [], 0
        held.append(row)
        size += own
    if held:
        yield held


def _blocks(batches, words: int, columns: tuple[str, ...] = ()):
    """Texts of a batch that are long enough, some at once."""

    def hashed(rows):
        texts = hashed_texts([text for text, _ in rows])
        for (text, others), (own, tokens) in zip(rows, texts):
            yield others, xxhash.xxh64_intdigest(text), tokens, own

    for batch in batches:
        held, size = [], 0
        if "text" in batch.schema.names:
            texts = map(plain_words, utf8(batch["text"]))
        else:
            texts = map(unpacked_text, batch["packed"].to_pylist())
        rows = zip(texts, *(batch[c].to_pylist() for c in columns))
        rows = ((text, others) for text, *others in rows if count_words(text) >= words)
        for some in _pieces(rows, lambda row: len(row[0])):
            held += hashed(some)
            size += sum(len(own) for *_, own in held[-len(some) :])
            if size >= BLOCK_TOKENS:
                yield _block(held)
                held, size = [], 0
        if held:
            yield _block(held)


def _rows(key: np.ndarray, block: Block, text: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
    """Rows of `WINDOW_SCHEMA`."""
    places = (c - block.begins[text]).astype(np.int32)
    columns = [pa.array(key.view(np.int64)), pa.array(block.hashes[text]), pa.array(places)]
    return pa.RecordBatch.from_arrays(columns, names=["key", "th", "c"])


def windows(docs: DataFrame, shape: Shape) -> DataFrame:
    """The places that stand for all runs of texts: key, the text's hash th, and c.

    Each has a key of the tokens up to it and one of those from it on, half a run each, as far as
    the text has them.
    """
    half = (shape.run + 1) // 2

    def run(batches):
        for block in _blocks(batches, shape.words):
            tokens, begins, ends = block.tokens, block.begins, block.ends
            hashes, _, _, least = least_places(tokens, ends, 0, shape.run)
            # the least of stretches that follow each other comes in groups
            c = np.unique(least)
            text = np.searchsorted(ends, c, "right")
            once = not_repeated(tokens, begins, ends, hashes[c], text, c, shape.width)
            c, text = c[once], text[once]
            for kind, first in ((UPTO, c - half + 1), (ONWARD, c)):
                there = (first >= begins[text]) & (first + half <= ends[text])
                key = run_hashes(tokens, first[there], half)
                key = (key & ~np.uint64(HASH_ROOM - 1)) | np.uint64(kind)
                yield _rows(key, block, text[there], c[there])

    return docs.select("text").mapInArrow(run, WINDOW_SCHEMA)


def _marked(block: Block, column: int, steps: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Marks of n places: those the column lists for each text, and `steps` from them."""
    marks = np.zeros(n, bool)
    for other, at, to in zip(block.others, starts, np.append(starts[1:], n)):
        places = np.array(other[column], np.int64)
        places = (places[:, None] + steps).ravel() + at
        marks[places[(places >= at) & (places < to)]] = True
    return marks


def stretches(crowded: DataFrame, shape: Shape) -> DataFrame:
    """Content hashes of the stretches of shared tokens whose least place is in large groups.

    `crowded` has packed, and upto and onward, the places whose keys are in large groups; rows
    (key, th, c): the hash, the text's and the stretch's start. A stretch with a key in another
    group is found by that.
    """
    half = (shape.run + 1) // 2

    def run(batches):
        for block in _blocks(batches, shape.words, ("upto", "onward")):
            n, own = len(block.tokens), np.zeros(1, np.int64)
            upto, onward = (_marked(block, i, own, block.begins, n) for i in (0, 1))
            _, _, starts, least = least_places(block.tokens, block.ends, 0, shape.shared)
            has_upto = least - starts >= half - 1
            has_onward = starts + shape.shared - least >= half
            starts = starts[(upto[least] | ~has_upto) & (onward[least] | ~has_onward)]
            for at in range(0, len(starts), 1 << 16):
                part = starts[at : at + (1 << 16)]
                key = run_hashes(block.tokens, part, shape.shared)
                yield _rows(key, block, np.searchsorted(block.ends, part, "right"), part)

    return crowded.select("packed", "upto", "onward").mapInArrow(run, WINDOW_SCHEMA)


NEAR_SCHEMA = "token long, th long, least long, c int, before int, after int"


def tokens_around(crowded: DataFrame, shape: Shape) -> DataFrame:
    """The tokens around places of large groups, with hashes of the word before and the word after.

    `crowded` has packed, places and least, which is the same for texts known to be linked.
    """
    steps = np.arange(-shape.words, shape.words + 1)

    def run(batches):
        for block in _blocks(batches, shape.words, ("places", "least")):
            near = _marked(block, 0, steps, block.begins, len(block.tokens))
            c = np.flatnonzero(near)
            text = np.searchsorted(block.ends, c, "right")
            # one end for all texts, on either side
            linked = np.array([other[1] for other in block.others], np.int64)
            words = np.append(block.words, np.uint64(0)).astype(np.uint32).view(np.int32)
            place = c - block.begins[text]
            at = block.word_begins[text] + place
            last = c == block.ends[text] - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block.tokens[c].view(np.int64)),
                    pa.array(block.hashes[text]),
                    pa.array(linked[text]),
                    pa.array(place.astype(np.int32)),
                    pa.array(words[np.where(place > 0, at - 1, -1)]),
                    pa.array(words[np.where(last, -1, at + SHINGLE)]),
                ],
                names=["token", "th", "least", "c", "before", "after"],
            )

    return crowded.select("packed", "places", "least").mapInArrow(run, NEAR_SCHEMA)


def forks(near: DataFrame, shape: Shape) -> DataFrame:
    """By text th: places of tokens that texts not known to be linked share (places), and of those
    that go on (ahead) or begin (behind) differently in some of them."""
    same = Window.partitionBy("token")

    def differ(name: str):
        return F.min(name).over(same) != F.max(name).over(same)

    found = near.select("th", "c", *[differ(c).alias(f"__{c}") for c in ("least", "before", "after")])
    lists = found.filter("__least").groupBy("th").agg(
        F.collect_set("c").alias("places"),
        F.collect_set(F.when(F.col("__after"), F.col("c"))).alias("ahead"),
        F.collect_set(F.when(F.col("__before"), F.col("c"))).alias("behind"),
    )
    return lists.filter(F.size("places") >= shape.shared).filter("size(ahead) > 0 and size(behind) > 0")


def gapped(forked: DataFrame, shape: Shape) -> DataFrame:
    """Hashes of the words of two runs on both sides of a place where texts may differ.

    `forked` has packed, places, ahead and behind. Together the runs have the tokens shared at
    least; between them there is one word of the text, or none. The first one begins where others
    may go on differently to the left, or is as long as it can be beside another. Rows (key, th, c):
    the hash, the text's, and the place of the last token of the first run.
    """
    total, most = shape.shared + 2 * (SHINGLE - 1), shape.shared - 1

    def run(batches):
        for block in _blocks(batches, shape.words, ("places", "ahead", "behind")):
            n, zero = len(block.tokens), np.zeros(1, np.int64)
            held, ahead, behind = (_marked(block, i, zero, block.begins, n) for i in range(3))
            behind[block.begins] = True
            at = np.arange(n)
            text = np.searchsorted(block.ends, at, "right")
            # the shared tokens that end and begin at each place
            upto = at - np.maximum.accumulate(np.where(held, block.begins[text] - 1, at))
            onward = np.where(held, block.ends[text], at)
            onward = np.minimum.accumulate(onward[::-1])[::-1] - at
            behinds = np.append(0, np.cumsum(behind))
            lasts = np.flatnonzero(ahead & held)
            for skipped in (0, 1):
                # the first token of the second run
                first = lasts + SHINGLE + skipped
                own = lasts[first < block.ends[text[lasts]]]
                first = own + SHINGLE + skipped
                own = own[upto[own] + onward[first] >= shape.shared]
                first = own + SHINGLE + skipped
                # it begins differently elsewhere; a word repeated may be counted to either side
                word = first + (SHINGLE - 1) * text[first]
                low = first.copy()
                for _ in range(shape.words):
                    again = block.words[word - 1] == block.words[np.maximum(word - 2, 0)]
                    again &= low > own + 1
                    if not again.any():
                        break
                    low, word = low - again, word - again
                low -= (low < first) | (not skipped)
                own = own[behinds[first + 1] > behinds[low]]
                for begin in range(0, len(own), 1 << 14):
                    last = own[begin : begin + (1 << 14)]
                    first = last + SHINGLE + skipped
                    longest = np.minimum(upto[last], most)
                    shortest = np.maximum(shape.shared - onward[first], 1)
                    size = np.arange(1, most + 1)
                    fits = (size >= shortest[:, None]) & (size <= longest[:, None])
                    starts = np.maximum(last[:, None] - size + 1, 0)
                    i, j = np.nonzero(fits & (behind[starts] | (size == most)))
                    last, left = last[i], j + SHINGLE
                    place = last - (left - SHINGLE) + (SHINGLE - 1) * text[last]
                    key = np.zeros(len(last), np.uint64)
                    for k in range(total):
                        word = block.words[place + k + np.where(k >= left, skipped, 0)]
                        key = key * np.uint64(MULTIPLIERS[3] | 1) + word
                    key ^= key >> np.uint64(29)
                    key *= np.uint64(MULTIPLIERS[2])
                    # words repeated over and over give the same words many times
                    mixed = key ^ text[last].astype(np.uint64) * np.uint64(MULTIPLIERS[0])
                    once = np.unique(mixed, return_index=True)[1]
                    yield _rows(key[once], block, text[last[once]], last[once])

    columns = ("packed", "places", "ahead", "behind")
    return forked.select(*columns).mapInArrow(run, WINDOW_SCHEMA)


LINK_SCHEMA = "large boolean, fn int, a long, b long, ca int, cb int"


def group_links(
    found: DataFrame, paired: int = PAIRED, held_rows: int = HELD_ROWS
) -> DataFrame:
    """Links between the texts of every group of equal keys that has several texts.

    Groups of up to `paired` rows have a link for every two rows of different texts. In larger
    ones (`large`) every row is linked to the first one, the first one and others of its text to
    themselves. Repeated rows count once, but for one that a cut of a large group parts. In a link a
    is never greater than b.
    """

    def links(key, th, c, open_):
        """Links of whole groups; those of the key `open_` holds go on with its first row."""
        again = np.zeros(len(key), bool)
        again[1:] = (key[1:] == key[:-1]) & (th[1:] == th[:-1]) & (c[1:] == c[:-1])
        key, th, c = key[~again], th[~again], c[~again]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(start, len(key)))
        several = th[start] != th[start + size - 1]
        out = []

        def add(large, x, y, a=None, ca=None):
            out.append(
                (np.full(len(y), large), key[y] & (HASH_ROOM - 1), th[x] if a is None else a, th[y],
                 c[x] if ca is None else ca, c[y])
            )

        continued = open_ is not None and len(key) and key[0] == open_[0]
        for n in range(2, paired + 1):
            own = start[several & (size == n)]
            if continued:
                own = own[own > 0]
            x, y = np.triu_indices(n, 1)
            i, j = (own[:, None] + x).ravel(), (own[:, None] + y).ravel()
            apart = th[i] != th[j]
            if apart.any():
                add(False, i[apart], j[apart])
        big = several & (size > paired)
        if continued:
            big[0] = False
            y = np.arange(size[0])
            add(True, y, y, np.full(len(y), open_[1]), np.full(len(y), open_[2]))
        if big.any():
            y = np.repeat(start[big], size[big])
            steps = np.arange(len(y)) - np.repeat(np.cumsum(size[big]) - size[big], size[big])
            add(True, y, y + steps)
        columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 6
        kinds = [pa.bool_(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        arrays = [pa.array(x.astype(k.to_pandas_dtype())) for x, k in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=["large", "fn", "a", "b", "ca", "cb"])

    def run(batches):
        held = [np.zeros(0, np.int64)] * 3
        open_ = None
        for batch in batches:
            new = [batch.column(i).to_numpy().astype(np.int64) for i in range(3)]
            key, th, c = (np.concatenate(x) for x in zip(held, new))
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield links(key[:cut], th[:cut], c[:cut], open_)
                if open_ is not None and open_[0] != key[-1]:
                    open_ = None
            held = [key[cut:], th[cut:], c[cut:]]
            if len(held[0]) > held_rows and (open_ is not None or held[1][0] != held[1][-1]):
                last = (int(held[0][0]), int(held[1][0]), int(held[2][0]))
                yield links(*held, open_)
                open_ = open_ or last
                held = [np.zeros(0, np.int64)] * 3
        if len(held[0]):
            yield links(*held, open_)

    dealt = found.repartition("key").sortWithinPartitions("key", "th", "c")
    return dealt.mapInArrow(run, LINK_SCHEMA)


def stored_texts(docs: DataFrame, words: int = PASSAGE_WORDS) -> DataFrame:
    """(doc_id, th, n_words, packed) of every text that is long enough, as a table bucketed by th.

    th is the hash of the text's words. Texts are moved once; whatever is joined to them by th
    later on comes to them.
    """

    def run(batches):
        for batch in batches:
            found = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), utf8(batch["text"])):
                own = plain_words(text)
                n = count_words(own)
                if n >= words:
                    th = xxhash.xxh64_intdigest(own)
                    th -= (th >> 63) << 64
                    found.append((doc_id, th, n, packed_text(own)))
            columns = zip(*found) if found else [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)],
                names=["doc_id", "th", "n_words", "packed"],
            )

    session = docs.sparkSession
    made = docs.mapInArrow(run, "doc_id long, th long, n_words long, packed binary")
    buckets = int(session.conf.get("spark.sql.shuffle.partitions"))
    name = f"passages_{uuid.uuid4().hex}"
    writer = made.repartition(buckets, "th").write.bucketBy(buckets, "th").sortBy("th")
    path = f"{ensure_checkpoint_dir(session)}/{name}"
    writer.format("parquet").option("path", path).saveAsTable(name)
    return session.table(name)


def window_sums(marks: np.ndarray, width: int) -> np.ndarray:
    """How many marks each window of `width` holds."""
    sums = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=sums[1:])
    return sums[width:] - sums[:-width]


def _alike(
    a: np.ndarray, b: np.ndarray, shift: int, first: int, last: int, width: int, similarity: float
) -> tuple[int, np.ndarray, np.ndarray, np.ndarray] | None:
    """Windows of `width` tokens of a[first] to a[last] that equal those at a distance of -shift in
    `b` closely enough: the first place compared, which tokens agree, how many in each window, and
    the windows. None if there is no such window."""
    low, high = max(first, shift, 0), min(last + 1, len(a), len(b) + shift)
    if high - low < width:
        return None
    same = a[low:high] == b[low - shift : high - shift]
    # so few in all are too few for any window
    if np.count_nonzero(same) * (1 + similarity) < 2 * width * similarity - 1e-6:
        return None
    common = window_sums(same, width)
    good = np.flatnonzero(common >= similarity * (2 * width - common) - 1e-9)
    return (low, same, common, good) if len(good) else None


def similar_stretches(
    a: np.ndarray, b: np.ndarray, shift: int, first: int, last: int, width: int, similarity: float
) -> list[tuple[int, int, float]]:
    """Stretches of tokens [x, y] of `a` that recur in `b` at a distance of -shift, x >= first.

    Each is a union of windows of `width` tokens that are similar enough to their counterpart, cut
    to tokens that agree at its ends where it is wider; the similarity given is that of the best
    window. Tokens at the same place are compared, so it is a lower bound.
    """
    found = _alike(a, b, shift, first, last, width, similarity)
    if found is None:
        return []
    low, same, common, good = found
    cuts = np.flatnonzero(np.diff(good) > width)
    out = []
    for x, y in zip(np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(good) - 1]])):
        start, end = int(good[x]), int(good[y]) + width
        best = int(common[start : end - width + 1].max())
        while end - start > width and not same[start]:
            start += 1
        while end - start > width and not same[end - 1]:
            end -= 1
        out.append((low + start, low + end - 1, best / (2 * width - best)))
    return out


def distinct_counts(tokens: np.ndarray, width: int) -> np.ndarray:
    """How many different tokens each stretch of `width` tokens holds."""
    n = len(tokens)
    order = np.argsort(tokens, kind="stable")
    again = tokens[order[1:]] == tokens[order[:-1]]
    at, before = order[1:][again], order[:-1][again]
    near = at - before < width
    # a token counts less in the stretches that also hold the one before it
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, np.maximum(at[near] - width + 1, 0), 1)
    np.add.at(steps, before[near] + 1, -1)
    return width - np.cumsum(steps)[: n - width + 1]


def _ends(marks: np.ndarray) -> tuple[int, int]:
    """The first and the last place marked."""
    return int(marks.argmax()), len(marks) - 1 - int(marks[::-1].argmax())


class Numbered:
    """The tokens of two texts as numbers from 0, equal ones with the same number."""

    def __init__(self, a: np.ndarray, b: np.ndarray, width: int):
        held, numbers = np.unique(np.concatenate([a, b]), return_inverse=True)
        # short numbers are sorted faster
        numbers = numbers.astype(np.uint16 if len(held) <= 1 << 16 else np.int64)
        self.a, self.b = numbers[: len(a)], numbers[len(a) :]
        #: different tokens of each stretch of `width`
        self.distinct_a, self.distinct_b = (
            distinct_counts(t, width)
            if np.bincount(t).max() > 1
            else np.full(len(t) - width + 1, width)
            for t in (self.a, self.b)
        )
        self._marks = np.zeros(len(held), bool)

    def shared(self, own: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Which of some numbers are among the others."""
        self._marks[other] = True
        found = self._marks[own]
        self._marks[other] = False
        return found


def similar_sets(
    a: np.ndarray, b: np.ndarray, first: int, last: int, shift: int, width: int, similarity: float,
    texts: Numbered | None = None,
) -> tuple[int, int, float] | None:
    """The most similar two stretches of `width` tokens around a[first] to a[last] and the tokens
    of `b` at a distance of -shift, compared as sets.

    Their starts and their Jaccard similarity; None if no two are similar enough. `texts` are the
    whole of both, numbered; without them what is compared is numbered here.
    """
    x, y = max(first - width + 1, 0), max(first - shift - width + 1, 0)
    own, other = a[x : last + width], b[y : last - shift + width]
    if min(len(own), len(other)) < width:
        return None
    at, to = (x, y) if texts else (0, 0)
    texts = texts or Numbered(own, other, width)
    own, other = texts.a[at : at + len(own)], texts.b[to : to + len(other)]
    one = texts.distinct_a[at : at + len(own) - width + 1]
    two = texts.distinct_b[to : to + len(other) - width + 1]
    share = similarity / (1 + similarity)
    # a stretch shares no more than those of its tokens that are anywhere around in the other text
    enough = window_sums(texts.shared(own, other), width) >= share * (one + two.min()) - 1e-6
    if not enough.any():
        return None
    i, k = _ends(enough)
    enough = window_sums(texts.shared(other, own), width) >= share * (two + one.min()) - 1e-6
    if not enough.any():
        return None
    j, l = _ends(enough)
    own, other, one, two = own[i : k + width], other[j : l + width], one[i : k + 1], two[j : l + 1]
    both = np.unique(own[texts.shared(own, other)])
    held = []
    for text in (own, other):
        sums = np.zeros((len(text) + 1, len(both)), np.int32)
        np.cumsum(text[:, None] == both, axis=0, out=sums[1:])
        held.append((sums[width:] > sums[:-width]).astype(np.float32))
    common = held[0] @ held[1].T
    found = common / (one[:, None] + two[None, :] - common)
    k, l = np.unravel_index(int(found.argmax()), found.shape)
    s = float(found[k, l])
    return (x + i + int(k), y + j + int(l), s) if s >= similarity - 1e-9 else None


def _spans(places: list[int], width: int):
    """(first, last) of runs of sorted places; a run is at most `width` long."""
    first = last = None
    for place in places:
        if first is not None and place - first > width:
            yield first, last
            first = None
        first, last = place if first is None else first, place
    if first is not None:
        yield first, last


def verified(
    a: np.ndarray, b: np.ndarray, links: list[tuple[int, int]], width: int, similarity: float
) -> list[tuple[int, int, int, float]]:
    """Passages (start in a, end in a, start in b, similarity) in words, from places (in a, in b)."""
    by_shift: dict[int, list[int]] = {}
    for ca, cb in sorted(links):
        by_shift.setdefault(ca - cb, []).append(ca)
    out: dict[tuple[int, int], tuple[int, int, int, float]] = {}
    # places of either text in a passage found; repeats within a text give no second one
    held_a, held_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    numbered = None
    for shift, own in sorted(by_shift.items(), key=lambda item: -len(item[1])):
        own = [ca for ca in own if not (held_a[ca] and held_b[ca - shift])]
        stretches: list[tuple[int, int, float]] = []
        for first, last in _spans(own, width):
            if _alike(a, b, shift, first - width + 1, last + width - 1, width, similarity):
                # as far as it goes, and what else recurs at this distance
                stretches = similar_stretches(a, b, shift, 0, len(a) - 1, width, similarity)
                break
        for x, y, s in stretches:
            out[x, shift] = (x, y + SHINGLE, x - shift, s)
            held_a[x : y + 1] = held_b[x - shift : y - shift + 1] = True
        # words put in or left out move one part of a passage
        rest = [ca for ca in own if not any(x <= ca <= y for x, y, _ in stretches)]
        for first, last in _spans(rest, width):
            if len(a) + len(b) <= NUMBERED_TOKENS:
                numbered = numbered or Numbered(a, b, width)
            met = similar_sets(a, b, first, last, shift, width, similarity, numbered)
            if met:
                x, y, s = met
                out[x, x - y] = max(
                    out.get((x, x - y), (x, 0, y, 0.0)), (x, x + width + SHINGLE - 1, y, s)
                )
                held_a[x : x + width] = held_b[y : y + width] = True
    return sorted(out.values())


PASSAGE_SCHEMA = (
    "a long, b long, start_a long, end_a long, start_b long, end_b long, similarity double"
)


def _verify(pairs: DataFrame, words: int, similarity: float) -> DataFrame:
    width = words - SHINGLE + 1

    def run(batches):
        # a text that many others are compared with is taken apart once
        known: dict[int, np.ndarray] = {}
        size = 0
        for batch in batches:
            rows = []
            ends = batch["links"].offsets.to_numpy()
            values = batch["links"].values
            places = list(zip(values.field("ca").to_pylist(), values.field("cb").to_pylist()))
            names = list(zip(batch["a"].to_pylist(), batch["b"].to_pylist()))
            packed = batch["packed_a"], batch["packed_b"]

            def size_of(i, names=names, packed=packed):
                """Bytes of the texts of a row that are not known."""
                new = [p for th, p in zip(names[i], packed) if th not in known]
                return sum(int.from_bytes(p[i].as_py()[:8], "little") for p in new)

            for some in _pieces(range(batch.num_rows), size_of):
                new = {th: p[i] for i in some for th, p in zip(names[i], packed) if th not in known}
                made = hashed_texts([unpacked_text(p.as_py()) for p in new.values()]) if new else []
                # a copy, as what was made at once would be held
                known |= {th: tokens.copy() for th, (_, tokens) in zip(new, made)}
                size += sum(len(known[th]) for th in new)
                for i in some:
                    a, b = names[i]
                    links = places[ends[i] : ends[i + 1]]
                    for x, y, z, s in verified(known[a], known[b], links, width, similarity):
                        rows.append((a, b, x, y, z, z + y - x, s))
                if size >= KNOWN_TOKENS:
                    known.clear()
                    size = 0
            columns = zip(*rows) if rows else [[] for _ in range(7)]
            kinds = [pa.int64()] * 6 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)],
                names=["a", "b", "start_a", "end_a", "start_b", "end_b", "similarity"],
            )

    return pairs.select("a", "b", "links", "packed_a", "packed_b").mapInArrow(run, PASSAGE_SCHEMA)


def one_a_shift(links: DataFrame) -> DataFrame:
    """The first link (a, b, ca, cb) for each shift of two different texts."""
    shift = (F.col("ca") - F.col("cb")).alias("shift")
    found = links.filter("a < b").groupBy("a", "b", shift).agg(F.min("ca").alias("ca"))
    return found.select("a", "b", "ca", (F.col("ca") - F.col("shift")).alias("cb"))


def verified_links(links: DataFrame, bodies: DataFrame, words: int, similarity: float) -> DataFrame:
    """The passages (`PASSAGE_SCHEMA`) of linked texts; `bodies` has th and packed."""
    pairs = links.groupBy("a", "b").agg(F.collect_set(F.struct("ca", "cb")).alias("links"))
    pairs = materialise(pairs)
    body_a = bodies.select(F.col("th").alias("a"), F.col("packed").alias("packed_a"))
    body_b = bodies.select(F.col("th").alias("b"), F.col("packed").alias("packed_b"))
    return _verify(pairs.join(body_a, "a").join(body_b, "b"), words, similarity)


def joined(passages: DataFrame) -> DataFrame:
    """(th, least): the least text up to three links away, so texts with the same are connected."""
    ends = passages.select("a", "b").union(passages.select("b", "a")).distinct()
    least = ends.groupBy(F.col("a").alias("th")).agg(F.min("b").alias("b"))
    least = least.select("th", F.least("th", "b").alias("least"))
    for _ in range(2):
        far = ends.join(least.withColumnRenamed("th", "b"), "b")
        least = far.groupBy(F.col("a").alias("th")).agg(F.min("least").alias("least"))
    return least


def recurring_passages(
    docs: DataFrame,
    words: int = PASSAGE_WORDS,
    similarity: float = SIMILARITY,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Passages of at least `words` words that recur in another document.

    Rows (doc_id, other_id, start, end, other_start, other_end, similarity): words start to end
    (from 0, the last one excluded) of a document recur in another one, which stands for all that
    share the passage; together the rows connect them. Documents with the same words are linked to
    the first of them, whole, with similarity 1. Case (A-Z) and white space do not count. Ids are
    whole numbers; rows without one, and null, empty or shorter texts, have no passages. A repeated
    id is one document with several texts: each is compared with those of other documents.
    """
    given = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")
    ).filter("doc_id is not null and text is not null")
    owners = stored_texts(given, words)
    bodies = owners.groupBy("th").agg(F.min("packed").alias("packed"))
    texts = owners.groupBy("th").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    shape = shape_of(words, similarity)
    grouped = materialise(group_links(windows(given, shape)))
    crowded = grouped.filter("large").groupBy(F.col("b").alias("th")).agg(
        F.collect_set(F.when(F.col("fn") == UPTO, F.col("cb"))).alias("upto"),
        F.collect_set(F.when(F.col("fn") == ONWARD, F.col("cb"))).alias("onward"),
        F.collect_set("cb").alias("places"),
    )
    crowded = materialise(crowded)
    same = one_a_shift(group_links(stretches(bodies.join(crowded, "th"), shape), paired=0))
    pairs = grouped.filter("not large").select("a", "b", "ca", "cb").unionByName(same)
    passages = verified_links(pairs, bodies, words, similarity)
    if shape.gaps:
        passages = materialise(passages)
        linked = crowded.join(joined(passages), "th", "left")
        linked = linked.withColumn("least", F.coalesce("least", "th"))
        apart = bodies.join(forks(tokens_around(bodies.join(linked, "th"), shape), shape), "th")
        apart = one_a_shift(group_links(gapped(apart, shape), paired=0))
        apart = apart.join(passages.select("a", "b"), ["a", "b"], "left_anti")
        passages = passages.unionByName(verified_links(apart, bodies, words, similarity))
    one, two = (
        texts.select(F.col("th").alias(n), F.col("least").alias(f"{n}1"), F.col("most").alias(f"{n}2"))
        for n in ("a", "b")
    )
    named = passages.join(one, "a").join(two, "b")
    # two texts may have the same first document
    other = F.when(F.col("a1") != F.col("b1"), F.struct("a1", "b1"))
    other = other.when(F.col("a1") != F.col("b2"), F.struct(F.col("a1"), F.col("b2").alias("b1")))
    other = other.when(F.col("a2") != F.col("b1"), F.struct(F.col("a2").alias("a1"), F.col("b1")))
    named = named.withColumn("d", other).filter("d is not null")
    turned = F.col("d.a1") > F.col("d.b1")

    def side(first: str, second: str, name: str):
        return F.when(turned, F.col(first)).otherwise(F.col(second)).alias(name)

    copies = owners.join(texts, "th").filter("doc_id <> least")
    return named.select(
        F.greatest("d.a1", "d.b1").alias("doc_id"), F.least("d.a1", "d.b1").alias("other_id"),
        side("start_a", "start_b", "start"), side("end_a", "end_b", "end"),
        side("start_b", "start_a", "other_start"), side("end_b", "end_a", "other_end"), "similarity",
    ).unionByName(
        copies.select(
            "doc_id", F.col("least").alias("other_id"), F.lit(0).cast("long").alias("start"),
            F.col("n_words").alias("end"), F.lit(0).cast("long").alias("other_start"),
            F.col("n_words").alias("other_end"), F.lit(1.0).alias("similarity"),
        )
    )


def passage_classes(found: DataFrame) -> DataFrame:
    """One row for every document in `found`: class_id (the smallest id reachable), n_links.

    `passages` lists what recurs of the document itself, with the document that stands for it;
    the passages it stands for are listed with the others.
    """
    found = materialise(found)
    classes = components(found.select("doc_id", "other_id"), "doc_id", "other_id")
    both = found.select("doc_id", "other_id").union(found.select("other_id", "doc_id")).distinct()
    counted = both.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_links"))
    own = found.groupBy("doc_id").agg(
        F.sort_array(
            F.collect_set(
                F.struct("start", "end", "other_id", "other_start", "other_end", "similarity")
            )
        ).alias("passages")
    )
    return (
        classes.select(F.col("node").alias("doc_id"), F.col("component").alias("class_id"))
        .join(counted, "doc_id")
        .join(own, "doc_id", "left")
    )
