"""Language identification: known words first, shorter and shorter n-grams for unknown ones.

For every language the model holds the log frequencies of its commonest words, and of the
commonest character n-grams of each order in its words. A word of a text that is in the model is
scored by its own log frequencies. An unknown word is scored by its n-grams of the highest order
of which any is known, falling back to lower orders. A text's language is the one with the highest
sum over all its words.

Fitting takes a bounded sample of rows per language (`rows_per_language`, those with the smallest
hashes of their ids); counting runs in Spark. The model sent to the workers is bounded by
`words_kept` and `grams_kept` per language and order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ampliframe.llm.common import SPACES, WordCache, add_columns, strings
from ampliframe.session import materialise

UNKNOWN = "und"
#: a word's letters: what stands before its first and after its last letter is cut off
CORE = r"\p{L}(?:.*\p{L})?"
_CORE = regex.compile(CORE, regex.S)


@dataclass(frozen=True)
class Settings:
    rows_per_language: int = 1500
    #: the languages with most rows are learnt
    languages_kept: int = 1000
    words_kept: int = 20_000
    grams_kept: int = 10_000
    highest_order: int = 4
    #: added to every count
    smoothing: float = 0.1


@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: for order 0 (whole words) and each order of n-grams: the row of each known unit, and the
    #: rows of log frequencies, a column for each language
    tables: dict[int, tuple[dict[str, int], np.ndarray]] = field(default_factory=dict)


def _tables(counts: DataFrame, kept: int) -> DataFrame:
    """The commonest entries of each language and order; ties go to the smaller text."""
    first = Window.partitionBy("lang", "n").orderBy(F.desc("times"), "unit")
    ranked = counts.withColumn("__no", F.row_number().over(first))
    return ranked.filter(F.col("__no") <= kept).drop("__no")


def _grams(word: Column, n: int) -> Column:
    """All n-grams of a word, each with n."""
    last = F.length(word) - (n - 1)
    starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        starts,
        lambda i: F.struct(F.lit(n).alias("n"), F.substring(word, i, F.lit(n)).alias("unit")),
    )


def _log_frequencies(rows: pa.Table, languages: list[str], smoothing: float) -> dict:
    """Units and their log frequency in each language, for each order in `rows`."""
    place = {lang: i for i, lang in enumerate(languages)}
    known: dict[int, dict[str, int]] = {}
    cells: dict[int, list[tuple[int, int, int]]] = {}
    for lang, n, unit, times in zip(*(rows[c].to_pylist() for c in ("lang", "n", "unit", "times"))):
        units = known.setdefault(n, {})
        row = units.setdefault(unit, len(units))
        cells.setdefault(n, []).append((row, place[lang], times))
    tables = {}
    for n, units in known.items():
        counts = np.zeros((len(units), len(languages)))
        row, column, times = np.array(cells[n]).T
        counts[row, column] = times
        counts += smoothing
        tables[n] = units, np.log(counts / counts.sum(0)).astype(np.float32)
    return tables


def fit(
    docs: DataFrame,
    settings: Settings = Settings(),
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    allowed: Column | None = None,
) -> Model:
    """Learn from rows with a language and a text (nulls are left out).

    Repeated rows count as often as they occur. Without any row the model knows no language.
    """
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    if allowed is not None:
        rows = rows.filter(allowed)
    rows = rows.select(
        F.col(lang).alias("lang"),
        F.col(text).alias("text"),
        # a uniform number from 0 to 1 that depends on the id alone
        (F.shiftrightunsigned(F.xxhash64(F.col(doc_id)), 11) / F.lit(float(1 << 53))).alias("u"),
    )
    # one number per language decides which rows are taken, so that no text is moved
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.orderBy(F.desc("n"), "lang").limit(settings.languages_kept).collect()
    if not sizes:
        return Model([])
    share = F.create_map(
        *[x for r in sizes for x in (F.lit(r["lang"]), F.lit(settings.rows_per_language / r["n"]))]
    )
    sample = rows.filter(F.col("u") < F.element_at(share, F.col("lang")))
    words = F.split(F.lower("text"), f"[{SPACES}]+")
    counted = (
        sample.select("lang", F.explode(words).alias("word"))
        .select("lang", F.regexp_extract("word", CORE, 0).alias("unit"))
        .filter("unit != ''")
        .groupBy("lang", "unit")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    counted = materialise(counted)
    marked = F.concat(F.lit("_"), "unit", F.lit("_"))
    grams = F.concat(*[_grams(marked, n) for n in range(1, settings.highest_order + 1)])
    gram_counts = (
        counted.select("lang", "times", F.explode(grams).alias("g"))
        .groupBy("lang", F.col("g.n").alias("n"), F.col("g.unit").alias("unit"))
        .agg(F.sum("times").alias("times"))
    )
    word_rows = _tables(counted.withColumn("n", F.lit(0)), settings.words_kept)
    gram_rows = _tables(gram_counts, settings.grams_kept)
    columns = ("lang", "n", "unit", "times")
    found = word_rows.select(*columns).unionByName(gram_rows.select(*columns)).toArrow()
    languages = sorted(set(found["lang"].to_pylist()))
    return Model(languages, _log_frequencies(found, languages, settings.smoothing))


def core_scores(core: str, model: Model) -> np.ndarray:
    """What a word, in lower case from its first to its last letter, adds for each language."""
    words, rows = model.tables.get(0, ({}, None))
    if core in words:
        return rows[words[core]]
    marked = f"_{core}_"
    for n in range(max(model.tables, default=0), 0, -1):
        known, rows = model.tables.get(n, ({}, None))
        grams = [marked[i : i + n] for i in range(len(marked) - n + 1)]
        found = [known[g] for g in grams if g in known]
        if found:
            return np.add.reduce(rows.take(found, 0)) / np.float32(len(found))
    return np.zeros(len(model.languages), np.float32)


def core_of(word: str) -> str:
    """A lower-case word from its first to its last letter; empty without a letter."""
    if word.isalpha():
        return word
    found = _CORE.search(word)
    return found.group() if found else ""


def word_scores(word: str, model: Model) -> np.ndarray | None:
    """What a word adds to the score of each language; None for a word without a letter."""
    core = core_of(word.lower())
    return core_scores(core, model) if core else None


def identify(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    lang_name: str = "lang_pred",
    score_name: str = "score",
) -> DataFrame:
    """`docs` with the language of every whole text and its share of the probability.

    A text that is null or holds no letter, or any text if the model knows no language, is `und`
    with score 0. Ties go to the language first by name. Columns called like the new ones are
    replaced; all other columns and repeated rows stay.
    """
    languages = model.languages

    def start():
        # rows hold a score for each language and a one that counts words with a letter
        none = np.zeros(len(languages) + 1, np.float32).tobytes()
        one = np.ones(1, np.float32).tobytes()
        limit = max(20_000, 1_000_000 // (len(languages) + 1))
        cores = WordCache(lambda c: core_scores(c, model).tobytes() + one, limit)

        def packed(word: str) -> bytes:
            core = core_of(word)
            return cores[core] if core else none

        cache = WordCache(packed, limit)

        def step(texts):
            names, scores = [], []
            for t in strings(texts):
                words = t.lower().split()
                rows = np.frombuffer(b"".join([cache[w] for w in words]), np.float32)
                total = rows.reshape(-1, len(languages) + 1).sum(0, dtype=np.float64)
                if not languages or total[-1] == 0:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                best = int(np.argmax(total[:-1]))
                names.append(languages[best])
                scores.append(1 / float(np.exp(total[:-1] - total[best]).sum()))
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

        return step

    fields = StructType(
        [
            StructField(lang_name, StringType(), False),
            StructField(score_name, DoubleType(), False),
        ]
    )
    return add_columns(docs, [text], fields, start)
