import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from ampliframe.llm import periodic, queries
from helpers import DOCS, SF_DIR, WORDS, doc


def brute(words, min_words=24, min_exponent=3):
    """Runs by comparing every word with the one q words later, for every q."""
    found = {}
    for q in range(1, len(words) // min_exponent + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(min_words, min_exponent * q):
                # a stretch met before has a smaller period
                found.setdefault((start, length), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def draw_words(draw):
    kinds = draw.choice([1, 2, 3, 50])
    words = [draw.randint(0, kinds) for _ in range(draw.randint(0, 90))]
    for _ in range(draw.randint(0, 3)):
        own = [draw.randint(0, kinds) for _ in range(draw.randint(1, 12))]
        at = draw.randint(0, len(words))
        words[at:at] = (own * 12)[: draw.randint(len(own), len(own) * 8)]
    return words


def test_runs_equal_brute_force():
    draw, n = random.Random(3), 0
    for _ in range(1500):
        words, exponent = draw.choice([(24, 3), (24, 3), (6, 2), (5, 3), (10, 2), (9, 4)])
        texts = [draw_words(draw) for _ in range(draw.randint(1, 3))]
        codes = np.array([w for t in texts for w in t], np.int64)
        ends, want, at = np.cumsum([len(t) for t in texts]), [], 0
        for t in texts:
            want += [(s + at, m, q) for s, m, q in brute(t, words, exponent)]
            at += len(t)
        assert periodic.runs_of(codes, ends, words, exponent) == sorted(want)
        n += len(want)
    assert n > 3000


def test_ordered_places():
    draw = random.Random(4)
    order = draw.sample(range(20_000), 20_000)
    places, held = periodic.Places(order[0]), [order[0]]
    for i, x in enumerate(order[1:]):
        if i % 500 == 0:
            held = sorted(order[: i + 1])
            below, above = [y for y in held if y < x], [y for y in held if y > x]
            assert places.around(x) == (below[-1] if below else None, above[0] if above else None)
        places.add(x)
    assert list(places) == sorted(order) and places.size == len(order)
    assert max(map(len, places.pieces)) <= periodic.PIECE


@pytest.mark.parametrize("words", [[1] * 200_000, list(range(700)) * 300, list(range(200_000))])
def test_long_texts(words):
    got = periodic.runs_of(np.array(words, np.int64), np.array([len(words)]))
    period = len(set(words))
    assert got == ([(0, len(words), period)] if len(words) >= 3 * period else [])


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_rows_and_columns(rows):
    texts = [None, "", " \n ", "a b " * 12, "a\tb\n" * 12 + "c", "x\xa0y " * 24, "z " * 23, "a b " * 12]
    df = rows([doc(i, t) for i, t in enumerate(texts)] + [doc(3, texts[3]), doc(None, "q " * 30)], DOCS)
    df = df.selectExpr("*", "lang as Runs", "7 as collapsed")
    got = periodic.find_runs(df)
    assert [c.lower() for c in got.columns].count("runs") == 1 and got.count() == df.count()
    for r in got.collect():
        words = WORDS.findall(r["text"] or "")
        assert [tuple(x) for x in r["runs"]] == brute(words)
        assert r["collapsed"] == collapsed(words, brute(words))
    assert periodic.find_runs(df.limit(0)).count() == 0
    short = periodic.find_runs(df, min_words=4, min_exponent=2).filter("doc_id = 6").collect()[0]
    assert [tuple(x) for x in short["runs"]] == [(0, 23, 1)] and short["collapsed"] == "z"
    with pytest.raises(ValueError):
        periodic.find_runs(df, min_exponent=1)


def test_planted_repeats_leave_rows_without_id(rows):
    df = rows([doc(i, "a b c d e f g") for i in range(40)] + [doc(None, "a b"), doc(5, None)], DOCS)
    for r in periodic.with_repeats(df).collect():
        h = zlib.crc32(str(r["doc_id"]).encode())
        words, a = "a b c d e f g".split(), h // 10 % 7
        p = 1 + (7 - a) // (3 + h // 10 % 8)
        if r["doc_id"] is not None and r["text"]:
            want = [words[a + (i - a) % p] if i >= a and h % 10 == 0 else words[i] for i in range(7)]
            assert r["text"].split() == want
        else:
            assert r["text"] in ("a b", "")


def test_query_equals_brute_force(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op12_periodic_runs"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(got) == len(docs)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    periods = 0
    for d in docs:
        words = periodic.repeated_words(WORDS.findall(d["text"] or ""), d["doc_id"])
        runs, r = brute(words), got[d["doc_id"]]
        assert r["n_runs"] == len(runs)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        assert (r["start"], r["length"], r["period"]) == best
        milli = 1000 * best[1] // best[2] if runs else None
        assert r["exponent_milli"] == milli
        assert r["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r["collapsed_sha256"] == sha(collapsed(words, runs))
        periods += bool(runs)
    assert periods > 10
