"""Runs of words that repeat with a period, found from the suffixes of a text.

A run is a longest stretch of words in which words one period apart are equal, with the smallest
such period. The method is Kruskal's, by descending length of common prefixes: suffixes next to
each other in suffix order are united into classes, those with the longest common prefix first. A
class keeps its positions in order of place. When two classes with a common prefix of n words are
united, positions p < q that become neighbours and are at most n apart seed a run: words p to
q + n repeat with period q - p. That period is the smallest, for a smaller one would have put a
position of the same class between them, and the first seed of a run is its start, as seeds
further right have shorter prefixes.

Runs of at least `min_words` words and `min_exponent` periods begin with a common prefix of a
known length (`least_prefix`). Positions whose words do not recur for that long within the text
are left out before suffixes are sorted, so texts without such repeats cost a few passes of numpy.
Smaller classes are merged into larger ones: n log n steps for n positions left, whatever the text.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ampliframe.llm.common import add_columns, utf8

MIN_WORDS = 24
MIN_EXPONENT = 3
#: words handled at once by numpy; a longer text is still handled whole
BLOCK_WORDS = 1 << 19
#: positions of one piece of an ordered set
PIECE = 2048


def least_prefix(min_words: int, min_exponent: int) -> int:
    """The shortest common prefix of the starts of two periods of a run that is long enough."""
    return min(max(min_words - q, (min_exponent - 1) * q) for q in range(1, min_words + 1))


class Places:
    """Positions in order, in pieces of bounded length, so that adding one moves few others."""

    def __init__(self, first: int):
        self.pieces, self.tops, self.size = [[first]], [first], 1

    def __iter__(self):
        for piece in self.pieces:
            yield from piece

    def around(self, x: int) -> tuple[int | None, int | None]:
        """The nearest positions before and after `x`, which is not in the set."""
        k = bisect_left(self.tops, x)
        if k == len(self.pieces):
            return self.tops[-1], None
        i = bisect_left(self.pieces[k], x)
        before = self.pieces[k][i - 1] if i else (self.tops[k - 1] if k else None)
        return before, self.pieces[k][i]

    def add(self, x: int) -> None:
        k = min(bisect_left(self.tops, x), len(self.pieces) - 1)
        piece = self.pieces[k]
        insort(piece, x)
        self.size += 1
        if len(piece) > PIECE:
            self.pieces[k : k + 1] = [piece[: PIECE // 2], piece[PIECE // 2 :]]
            self.tops[k : k + 1] = [self.pieces[k][-1], self.pieces[k + 1][-1]]
        else:
            self.tops[k] = piece[-1]


def suffix_order(codes: np.ndarray, ends: np.ndarray, prefix: int):
    """Positions that share their next `prefix` words (a power of two) with another of their text.

    `codes` are the words of texts that end at `ends`. Returns the positions in suffix order and,
    for each, the number of the group with the same words. Ranks are refined by doubling the
    words compared; only groups of several positions are sorted again.
    """
    n = len(codes)
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    stop = ends[text]
    key = text * np.int64(codes.max(initial=0) + 1) + codes
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - counts)[inverse]
    active = np.flatnonzero(counts[inverse] > 1)
    known, shared, group = 1, active[:0], active[:0]
    while len(active):
        if known == prefix:
            shared, group = active, rank[active]
        after = active + known
        second = np.where(after < stop[active], rank[np.minimum(after, n - 1)], -1)
        own = rank[active]
        order = np.lexsort((second, own))
        at, own, second = active[order], own[order], second[order]
        new_group = np.concatenate([[True], own[1:] != own[:-1]])
        new = new_group.copy()
        new[1:] |= second[1:] != second[:-1]
        index = np.arange(len(at))
        first = np.maximum.accumulate(np.where(new, index, 0))
        first_own = np.maximum.accumulate(np.where(new_group, index, 0))
        rank[at] = own + first - first_own
        alone = new & np.concatenate([new[1:], [True]])
        active = np.sort(at[~alone])
        known *= 2
    order = np.argsort(rank[shared], kind="stable")
    return shared[order], group[order]


def common_prefixes(codes: list[int], stops: list[int], order: np.ndarray, group: np.ndarray, prefix: int):
    """(length, position, position before it in suffix order), of neighbours in one group."""
    same = np.flatnonzero(group[1:] == group[:-1])
    before = dict(zip(order[same + 1].tolist(), order[same].tolist()))
    out, last, length = [], -2, 0
    for i in sorted(before):
        # one word less than the suffix that starts a word earlier, at least
        length = max(length - 1, prefix) if i == last + 1 else prefix
        j, last = before[i], i
        limit = stops[i] - max(i, j)
        while length < limit and codes[i + length] == codes[j + length]:
            length += 1
        out.append((length, i, j))
    return out


def runs_of(
    codes: np.ndarray, ends: np.ndarray, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT
) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) in the words `codes` of texts that end at `ends`."""
    prefix = 1 << (least_prefix(min_words, min_exponent).bit_length() - 1)
    order, group = suffix_order(codes, ends, prefix)
    if not len(order):
        return []
    stops = np.repeat(ends, np.diff(ends, prepend=0)).tolist()
    links = common_prefixes(codes.tolist(), stops, order, group, prefix)
    links.sort(key=lambda link: -link[0])
    up: dict[int, int] = {}
    classes: dict[int, Places] = {}

    def find(x: int) -> int:
        if x not in up:
            up[x], classes[x] = x, Places(x)
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    found: dict[tuple[int, int], tuple[int, int, int]] = {}

    def seed(p: int, q: int, length: int) -> None:
        period = q - p
        if period <= length:
            found.setdefault((period, q + length), (p, period + length, period))

    for length, i, j in links:
        a, b = find(i), find(j)
        if classes[a].size < classes[b].size:
            a, b = b, a
        large, small = classes[a], list(classes.pop(b))
        up[b] = a
        for k, x in enumerate(small):
            before, after = large.around(x)
            # neighbours in the united class, one from each
            if before is not None and (k == 0 or before > small[k - 1]):
                seed(before, x, length)
            if after is not None and (k + 1 == len(small) or after < small[k + 1]):
                seed(x, after, length)
        for x in small:
            large.add(x)
    return sorted(
        (start, length, period)
        for start, length, period in found.values()
        if length >= max(min_words, min_exponent * period)
    )


RUNS = ArrayType(
    StructType([StructField(f, LongType(), False) for f in ("start", "length", "period")]), False
)


def _runs_array(runs: list[list[tuple[int, int, int]]]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
    flat = np.array([x for r in runs for x in r], np.int64).reshape(-1, 3)
    fields = [pa.array(np.ascontiguousarray(flat[:, i])) for i in range(3)]
    kind = [pa.field(f, pa.int64(), False) for f in ("start", "length", "period")]
    items = pa.StructArray.from_arrays(fields, fields=kind)
    return pa.ListArray.from_arrays(
        pa.array(offsets), items, type=pa.list_(pa.field("element", items.type, False))
    )


def find_runs(
    df: DataFrame,
    text: str = "text",
    min_words: int = MIN_WORDS,
    min_exponent: int = MIN_EXPONENT,
    runs: str = "runs",
    collapsed: str = "collapsed",
) -> DataFrame:
    """`df` with the runs of every whole text, and the text without their repetitions.

    `runs` lists (start, length, period) in words, numbered from 0, by start, then period: every
    longest stretch with a smallest period and at least `min_words` words and `min_exponent` times
    its period. `collapsed` holds the words that no run contains after its first period, joined by
    one space. Words are separated by ASCII white space and compared byte by byte. A null, empty or
    blank text has no runs and collapses to an empty one. Columns of these names are replaced
    (names are not case-sensitive); other columns and repeated rows stay as they are.
    """
    if min_exponent < 2 or min_words < 2:
        raise ValueError("a run has two words and two periods at least")

    def start():
        def block(texts):
            numbers: dict[bytes, int] = {}
            words = [w for t in texts for w in t]
            codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
            ends = np.cumsum([len(t) for t in texts])
            own: list[list] = [[] for _ in texts]
            drop = np.zeros(len(words) + 1, np.int32)
            for first, length, period in runs_of(codes, ends, min_words, min_exponent):
                k = int(np.searchsorted(ends, first, "right"))
                own[k].append((first - int(ends[k]) + len(texts[k]), length, period))
                drop[first + period] += 1
                drop[first + length] -= 1
            kept = np.cumsum(drop[:-1]) == 0
            lines, at = [], 0
            for t, r in zip(texts, own):
                if r:
                    t = [w for w, k in zip(t, kept[at : at + len(t)].tolist()) if k]
                at += len(texts[len(lines)])
                lines.append(b" ".join(t).decode())
            return own, lines

        def step(texts):
            found, lines, held, size = [], [], [], 0
            for t in utf8(texts):
                held.append(t.split())
                size += len(held[-1])
                if size >= BLOCK_WORDS:
                    more = block(held)
                    found, lines, held, size = found + more[0], lines + more[1], [], 0
            if held:
                more = block(held)
                found, lines = found + more[0], lines + more[1]
            return [_runs_array(found), pa.array(lines, pa.string())]

        return step

    fields = StructType([StructField(runs, RUNS, False), StructField(collapsed, StringType(), False)])
    return add_columns(df, [text], fields, start)


def repeated_words(words: list, number: int | None) -> list:
    """The words of document `number`, for every tenth hash with a tail made to repeat.

    With h the CRC-32 of the number in decimal and g = h // 10: if h ends in 0, words from a = g
    mod n on repeat with a period of 1 + (n - a) // (3 + g mod 8).
    """
    h = zlib.crc32(str(number).encode()) if number is not None and words else 1
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def with_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with repeats planted by `repeated_words`; a text without an id stays as it is."""

    def start():
        def step(ids, texts):
            made = [
                b" ".join(repeated_words(t.split(), i)).decode()
                for i, t in zip(ids.to_pylist(), utf8(texts))
            ]
            return [pa.array(made, pa.string())]

        return step

    fields = StructType([StructField(text, StringType(), False)])
    return add_columns(docs, [F.col(f"`{doc_id}`").cast("long"), text], fields, start)
