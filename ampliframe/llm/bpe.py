"""Byte-pair encoding and decoding of whole texts with a published vocabulary.

Encoding cuts a text into the pieces the tokenizer's pattern gives and encodes each piece by
backtracking: an Aho-Corasick automaton over the vocabulary gives the longest token at every
position; a token is accepted if it may stand beside the token before it, else a shorter prefix
is tried, else the token before it is taken back. Which tokens may be neighbours comes from a
table of compatible pairs, worked out from the merges and kept for reuse. Positions that led
nowhere are never tried again, so the work is linear in the piece, and the result equals that of
applying the merges one by one in the order of their rank.

Decoding looks up the bytes of all tokens of a batch in one blob by a table of offsets.
"""

from __future__ import annotations

import json
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ampliframe.llm.common import WordCache, add_columns, strings

#: Fixed values of byte-level vocabularies: the pattern that splits text into pieces, ...
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: ... where \s is Unicode's White_Space, without U+001C to U+001F, ...
WHITE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: ... and the ranges of bytes that a vocabulary file writes as the character of the same number.
PLAIN_BYTES = ((33, 126), (161, 172), (174, 255))

#: characters of the longest word whose ids are kept for the next time
CACHED_CHARACTERS = 64


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a vocabulary file."""
    plain = [b for first, last in PLAIN_BYTES for b in range(first, last + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def piece_pattern() -> regex.Pattern:
    text = PIECES.replace(r"[^\s\p{L}\p{N}]", rf"[^{WHITE}\p{{L}}\p{{N}}]")
    text = text.replace(r"(?!\S)", rf"(?![^{WHITE}])").replace(r"\s+", f"[{WHITE}]+")
    return regex.compile(text)


class BytePairVocabulary:
    """Tokens, merges and added tokens of a tokenizer file; encodes and decodes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        to_byte = byte_characters()
        # tokens and pieces are handled as text with one character per byte
        ids = {"".join(chr(to_byte[c]) for c in t): i for t, i in model["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        size = 1 + max([*ids.values(), *self.added.values()])
        content = [b""] * size
        for token, i in ids.items():
            content[i] = token.encode("latin-1")
        for text, i in self.added.items():
            content[i] = text.encode()
        self.lengths = [len(c) for c in content]
        self._blob = np.frombuffer(b"".join(content), np.uint8)
        self._offsets = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)

        self._automaton = ahocorasick.Automaton()
        for token, i in ids.items():
            self._automaton.add_word(token, i)
        self._automaton.make_automaton()
        #: the longest token that is a proper prefix of each token, or -1
        self._shorter = [-1] * size
        for token, i in ids.items():
            found = (ids.get(token[:n], -1) for n in range(len(token) - 1, 0, -1))
            self._shorter[i] = next((f for f in found if f >= 0), -1)

        self._size = size
        self._rank: dict[int, int] = {}
        self._parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = ("".join(chr(to_byte[c]) for c in part) for part in (left, right))
            self._rank[ids[a] * size + ids[b]] = rank
            self._parts.setdefault(ids[a + b], (ids[a], ids[b], rank))
        # of the tokens that come up
        self._lefts = WordCache(lambda t: self._edge(t, 1), 1 << 17)
        self._rights = WordCache(lambda t: self._edge(t, 0), 1 << 17)
        self._compatible: dict[int, bool] = WordCache(self._may_follow, 300_000)
        self._pattern = piece_pattern()
        self._added = (
            regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len)[::-1]))
            if self.added
            else None
        )
        self._space_twice = regex.compile(f"[{WHITE}] ")
        self._pieces = WordCache(self._packed, 200_000, CACHED_CHARACTERS)
        self._words = WordCache(lambda w: self._by_pieces(" " + w), 200_000, CACHED_CHARACTERS)
        self._marks = {t: np.array([i], "<i4").tobytes() for t, i in self.added.items()}

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The sub-tokens at one edge of `token`, each with the rank of the merge that ends it.

        Those of the left neighbour are given as multiples of the size, so that the sum of a left
        and a right one is the key of their pair.
        """
        chain, ends, unit = [], 1 << 60, self._size if side else 1
        while True:
            chain.append((token * unit, ends))
            parts = self._parts.get(token)
            if parts is None:
                return chain
            ends = parts[2]
            token = parts[side]

    def _may_follow(self, pair: int) -> bool:
        """Whether merging leaves the two tokens of `pair` (first * size + second) side by side.

        It does unless, at some time while the merges run, the sub-tokens at the border could be
        merged with each other before either is merged with its inner neighbour. Equal ranks go
        from left to right.
        """
        first, second = divmod(pair, self._size)
        rank_of, rights = self._rank.get, self._rights[second]
        for left, left_ends in self._lefts[first]:
            for right, right_ends in rights:
                rank = rank_of(left + right)
                if rank is not None and rank < left_ends and rank <= right_ends:
                    return False
        return True

    def encode_piece(self, piece: str) -> list[int]:
        text = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1")
        lengths, n = self.lengths, len(text)
        longest = [-1] * n
        for end, token in self._automaton.iter(text):
            longest[end + 1 - lengths[token]] = token
        shorter, compatible, size = self._shorter, self._compatible, self._size
        closed: set[int] = set()
        taken: list[int] = []
        at, before, token = 0, -1, longest[0] if n else -1
        while at < n:
            while token >= 0:
                end = at + lengths[token]
                if (before < 0 or compatible[before * size + token]) and end not in closed:
                    taken.append(token)
                    before, at = token, end
                    token = longest[at] if at < n else -1
                    break
                token = shorter[token]
            else:
                # no token fits here: never come back to this position, shorten the one before
                if before < 0:
                    raise ValueError("the vocabulary does not cover this text")
                closed.add(at)
                token = shorter[taken.pop()]
                at -= lengths[before]
                before = taken[-1] if taken else -1
        return taken

    def _packed(self, piece: str) -> bytes:
        return np.array(self.encode_piece(piece), "<i4").tobytes()

    def _by_pieces(self, text: str) -> bytes:
        pieces = self._pieces
        return b"".join([pieces[p] for p in self._pattern.findall(text)])

    def _plain(self, text: str) -> bytes:
        # No piece runs from other characters into a space. Where no white space precedes a
        # space, the text can thus be cut before every space, and words seen before reused.
        if self._space_twice.search(text):
            return self._by_pieces(text)
        first, *rest = text.split(" ")
        return self._by_pieces(first) + b"".join(map(self._words.__getitem__, rest))

    def encode(self, text: str) -> np.ndarray:
        if self._added is None or not self._added.search(text):
            return np.frombuffer(self._plain(text), "<i4")
        out, at = [], 0
        for found in self._added.finditer(text):
            out += [self._plain(text[at : found.start()]), self._marks[found.group()]]
            at = found.end()
        out.append(self._plain(text[at:]))
        return np.frombuffer(b"".join(out), "<i4")

    def decode_many(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of the id lists ids[bounds[i]:bounds[i + 1]]; bad UTF-8 becomes U+FFFD.

        Ids outside the vocabulary stand for no bytes.
        """
        known = (ids >= 0) & (ids < self._size)
        safe = np.where(known, ids, 0)
        starts = self._offsets[safe]
        lengths = np.where(known, self._offsets[safe + 1] - starts, 0)
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        source = np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
        raw = self._blob[source].tobytes()
        places = np.concatenate([[0], ends])[bounds]
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(places[:-1], places[1:])]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> BytePairVocabulary:
    """One vocabulary per worker process and file."""
    return BytePairVocabulary(path)


#: tokens or bytes handled at once when a batch is decoded
DECODE_BLOCK = 1 << 20
#: bytes of text whose ids and decoded texts are held at once
SLICE_BYTES = 4 << 20


def _id_lists(lists: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    values = np.concatenate(lists) if lists else np.zeros(0, "<i4")
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.array(values.astype(np.int32), pa.int32())
    )


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """`df` with the token ids of every whole text in a new array column.

    A null text has no tokens, like an empty one. The strings of added tokens in a text become
    those tokens; no token is added around a text. A column of the same name is replaced; other
    columns and repeated rows stay as they are.
    """

    def start():
        own = vocabulary(path)
        return lambda texts: [_id_lists([own.encode(t) for t in strings(texts)])]

    fields = StructType([StructField(ids, ArrayType(IntegerType(), False), False)])
    return add_columns(df, [text], fields, start, SLICE_BYTES)


def decode(df: DataFrame, path: str, ids: str = "token_ids", text: str = "text") -> DataFrame:
    """`df` with the text of every list of token ids; null ids give an empty text."""

    def start():
        own = vocabulary(path)

        def step(lists):
            lists = lists.fill_null([]) if lists.null_count else lists
            values = lists.flatten().to_numpy(zero_copy_only=False)
            bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(
                np.int64
            )
            out: list[str] = []
            first = 0
            while first < len(lists):
                last = int(np.searchsorted(bounds, bounds[first] + DECODE_BLOCK, "right")) - 1
                last = min(max(last, first + 1), len(lists))
                part = values[bounds[first] : bounds[last]]
                out += own.decode_many(part, bounds[first : last + 1] - bounds[first])
                first = last
            return [pa.array(out, pa.string())]

        return step

    return add_columns(df, [ids], StructType([StructField(text, StringType(), False)]), start)


def encode_decode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`df` with `token_ids` and, decoded from them, `decoded`; both in one pass over the rows.

    Same rules as `encode` and `decode`.
    """

    def start():
        own = vocabulary(path)

        def step(texts):
            lists, decoded, held, size = [], [], [], 0

            def flush():
                bounds = np.concatenate([[0], np.cumsum([len(x) for x in held])]).astype(np.int64)
                return own.decode_many(np.concatenate(held), bounds)

            for t in strings(texts):
                held.append(own.encode(t))
                size += len(held[-1])
                if size >= DECODE_BLOCK:
                    decoded += flush()
                    lists += held
                    held, size = [], 0
            if held:
                decoded += flush()
                lists += held
            return [_id_lists(lists), pa.array(decoded, pa.string())]

        return step

    fields = StructType(
        [
            StructField("token_ids", ArrayType(IntegerType(), False), False),
            StructField("decoded", StringType(), False),
        ]
    )
    return add_columns(df, [text], fields, start, SLICE_BYTES)
