"""Quality rules on how public tokenizers take a text apart.

Three measures of a text's words: the characters a token covers on average, the share of tokens
that stand for single bytes because the vocabulary has no piece for them, and the entropy of the
text's tokens as a share of the highest entropy that many tokens, at most 1,024, can have. Text
unlike what a vocabulary was made for (symbols, shouting, machine output) needs many tokens,
repeated text has little entropy. Wide fixed bands per script say which values can pass at all;
within them, the characters per token must not lie far below what is usual in the text's language
(or script, if the language is null), as measured over all texts that pass the base rules.

Words are tokenized one by one, so the measures of a word are worked out once and reused.
"""

from __future__ import annotations

import base64
import math
from array import array
from collections.abc import Mapping
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DoubleType, LongType, StringType, StructField, StructType,
)

from ampliframe.functions.scale import join_lookup
from ampliframe.llm.common import WordCache, add_columns, utf8

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
REPEAT_WINDOW = 5
#: texts with more tokens than this are not expected to have a higher entropy
ENTROPY_TOKENS = 1024
#: room for one count of a whole text in a number that holds several
COUNT_BITS = 40


@dataclass(frozen=True)
class Band:
    """Values that pass, ends included. Entropy is judged from `entropy_tokens` tokens on."""

    min_chars_per_token: float
    max_chars_per_token: float
    max_byte_share: float
    min_entropy_share: float
    entropy_tokens: int = 50


#: by language code or script name; a text's language is looked up first, then its script
BANDS: Mapping[str, Band] = {
    "Latin": Band(1.6, 12.0, 0.05, 0.5),
    "Greek": Band(0.4, 10.0, 0.5, 0.5),
    "Cyrillic": Band(0.4, 10.0, 0.3, 0.5),
    "Han": Band(0.3, 6.0, 0.7, 0.4),
    "other": Band(0.2, 12.0, 0.95, 0.4),
}
SCRIPTS = ("Latin", "Greek", "Cyrillic", "Han")
_SCRIPT = {s: regex.compile(rf"\p{{Script={s}}}") for s in SCRIPTS}


@lru_cache(maxsize=1)
def _tokenizers(piece_path: str, rank_path: str):
    import sentencepiece
    import tiktoken

    with open(rank_path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    # the words given have no white space inside: splitting at it is all the pattern must do
    plain = tiktoken.Encoding(
        "words", pat_str=r" ?\S+|\s+", mergeable_ranks=ranks, special_tokens={}
    )
    return sentencepiece.SentencePieceProcessor(model_file=piece_path), plain


def script_of(word: str) -> int:
    """The index in SCRIPTS of a word's first letter; beyond the end for another or none."""
    if word[:1].isascii() and word[:1].isalpha():
        return 0
    letter = regex.search(r"\p{L}", word)
    if letter:
        for i, s in enumerate(SCRIPTS):
            if _SCRIPT[s].match(letter.group()):
                return i
    return len(SCRIPTS)


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """How many words lie in windows of words that occur twice or more, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    own = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(window):
        key = key * np.uint64(0x9E3779B97F4A7C15) + own[i : i + n]
        key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice)
    change[starts] += 1
    change[starts + window] -= 1
    return int((np.cumsum(change) > 0).sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.split()]
    return len(lines) - len(set(lines))


FIELDS = StructType(
    [StructField(n, LongType(), False) for n in
     ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")]
    + [StructField(n, DoubleType(), False) for n in
       ("chars_per_token", "chars_per_token_bytes", "byte_share", "entropy_share")]
    + [StructField("script", StringType(), False)]
    + [StructField(n, BooleanType(), False) for n in ("base_failed", "in_band")]
)


def measure(
    docs: DataFrame,
    piece_path: str,
    rank_path: str,
    text: str = "text",
    lang: str = "lang",
    bands: Mapping[str, Band] = BANDS,
) -> DataFrame:
    """`docs` with the measures of every whole text and whether base rules and fixed bands hold.

    `chars_per_token` and the other two measures come from the vocabulary of pieces with byte
    fallback (`piece_path`), `chars_per_token_bytes` from one of byte pairs (`rank_path`); both
    must lie in the band. A null text has no words, like an empty one, and fails the base rules;
    its measures are 0, but its entropy share is 1. A null or unknown language falls back to the
    script most words are in. Columns named like the new ones are replaced, others and repeated
    rows stay.
    """
    by_name = dict(bands)

    def start():
        pieces, plain = _tokenizers(piece_path, rank_path)
        single = np.array([pieces.is_byte(i) for i in range(pieces.get_piece_size())])

        def word_tokens(word: bytes) -> tuple[bytes, int]:
            w = word.decode("utf-8", "replace")
            # counts that are summed together, in one number: code points, tokens of the byte-pair
            # vocabulary, and one for the word's script
            counts = len(w) | len(plain.encode_ordinary(" " + w)) << COUNT_BITS
            counts |= 1 << COUNT_BITS * (2 + script_of(w))
            return array("i", pieces.encode(w)).tobytes(), counts

        cache = WordCache(word_tokens, 400_000)

        def row(text: bytes, language: str | None):
            words = text.split()
            found = [cache[w] for w in words]
            ids = np.frombuffer(b"".join([f[0] for f in found]), np.int32)
            sums = sum([f[1] for f in found])
            chars, n_plain, *scripts = (
                sums >> COUNT_BITS * i & (1 << COUNT_BITS) - 1 for i in range(len(SCRIPTS) + 2)
            )
            n = len(words)
            symbols = len(text) - len(text.translate(None, SYMBOLS))
            repeats = repeated_words(words)
            base = n < MIN_WORDS or 100 * repeats > MAX_REPEATED_PERCENT * n
            share = entropy = 1.0
            if len(ids):
                times = np.unique(ids, return_counts=True)[1]
                share = np.count_nonzero(single[ids]) / len(ids)
                if len(ids) > 1:
                    bits = math.log2(len(ids)) - float((times * np.log2(times)).sum()) / len(ids)
                    entropy = min(1.0, bits / math.log2(min(len(ids), ENTROPY_TOKENS)))
            else:
                share = 0.0
            script = SCRIPTS[scripts.index(max(scripts))] if any(scripts) else "other"
            band = by_name.get(language) or by_name.get(script) or by_name["other"]
            per = chars / max(len(ids), 1), chars / max(n_plain, 1)
            good = (
                all(band.min_chars_per_token <= x <= band.max_chars_per_token for x in per)
                and share <= band.max_byte_share
                and (len(ids) < band.entropy_tokens or entropy >= band.min_entropy_share)
            )
            return (
                n, chars, symbols, repeated_lines(text), repeats, len(ids),
                *per, share, entropy, script, base, good,
            )

        def step(texts, languages):
            rows = [row(t, x) for t, x in zip(utf8(texts), languages.to_pylist())]
            columns = zip(*rows) if rows else [[] for _ in FIELDS]
            kinds = [pa.int64()] * 6 + [pa.float64()] * 4 + [pa.string()] + [pa.bool_()] * 2
            return [pa.array(list(c), k) for c, k in zip(columns, kinds)]

        return step

    return add_columns(docs, [text, lang], FIELDS, start)


#: tokens from which on a text helps to set what is usual
USUAL_TOKENS = 200
#: texts a language needs for that; below, only the fixed bands hold
USUAL_TEXTS = 30
#: robust standard deviations below the median that still pass; short texts get wider bands, by
#: the square root of 1 + SHORT_TOKENS / tokens
WIDTH = 5.0
SHORT_TOKENS = 300.0
FERTILITY = ("chars_per_token", "chars_per_token_bytes")


def usual_fertility(measured: DataFrame, lang: str = "lang") -> DataFrame:
    """Median and spread of the characters per token, per language or script."""
    quartiles = [
        F.percentile_approx(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10_000).alias(c)
        for c in FERTILITY
    ]
    return (
        measured.filter(~F.col("base_failed") & (F.col("n_tokens") >= USUAL_TOKENS))
        .groupBy(F.coalesce(F.col(lang), F.col("script")).alias("__group"))
        .agg(F.count(F.lit(1)).alias("__texts"), *quartiles)
        .filter(F.col("__texts") >= USUAL_TEXTS)
        .select(
            "__group",
            *[F.col(c)[1].alias(f"__mid_{c}") for c in FERTILITY],
            # a quartile distance of a normal distribution is 1.349 standard deviations
            *[((F.col(c)[2] - F.col(c)[0]) / 1.349).alias(f"__spread_{c}") for c in FERTILITY],
        )
    )


def judge(measured: DataFrame, lang: str = "lang") -> DataFrame:
    """`measured` with `kept`: base rules, fixed bands and the usual fertility all hold.

    `measured` is read twice; store it first if it is costly. Languages with few texts, and empty
    tables, are judged by the fixed bands alone. A column `kept` is replaced.
    """
    usual = usual_fertility(measured, lang)
    slack = WIDTH * F.sqrt(1 + SHORT_TOKENS / F.greatest(F.col("n_tokens"), F.lit(1)))
    usual_enough = F.lit(True)
    for c in FERTILITY:
        low = F.col(f"__mid_{c}") - slack * F.col(f"__spread_{c}")
        usual_enough &= F.coalesce(F.col(c) >= low, F.lit(True))
    rest = measured.drop("kept")
    grouped = rest.withColumn("__group", F.coalesce(F.col(lang), F.col("script")))
    # one row a language: sent to every task if there are as few as that
    joined = join_lookup(grouped, usual, ["__group"], "left")
    kept = ~F.col("base_failed") & F.col("in_band") & usual_enough
    return joined.select(*[F.col(f"`{c}`") for c in rest.columns], kept.alias("kept"))
