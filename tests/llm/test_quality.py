import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ampliframe.llm import language_id, quality_classifier, quality_rules, queries
from helpers import DOCS, SF_DIR, WORDS, doc

BIG = "/root/testdata/sf0.01"


def brute(text):
    words = WORDS.findall(text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {
        i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1
        for k in range(5)
    }
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    n, repeats = len(words), len(covered)
    return (
        n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)), repeats, n < 10 or 100 * repeats > 20 * n,
    )


NUMBERS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_rules_equal_brute_force(spark):
    rows = queries.QUERIES["op6_tokenizer_fertility"](spark, BIG).collect()
    texts = dict(map(tuple, spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "text").collect()))
    assert len(rows) == len(texts)
    assert {r["doc_id"]: tuple(r[n] for n in NUMBERS) for r in rows} == {
        i: brute(t) for i, t in texts.items()}
    labels = dict(spark.read.parquet(f"{BIG}/labels.parquet").select("doc_id", "quality").rdd.map(tuple).collect())
    good = [r["kept"] for r in rows if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in rows if labels.get(r["doc_id"]) == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.6 * len(bad)


def test_rules_on_odd_texts(spark, rows):
    texts = [
        None, "", " \n\t", "a b c d e " * 4, "word\nword\n\nWord", "x" * 30_000 + " y",
        "один два три четыре пять шесть семь восемь девять десять", "中文 " * 12, "  \x1c é",
    ]
    df = rows([doc(i, t, None if i % 2 else "xx") for i, t in enumerate(texts)], DOCS)
    df = df.union(df.limit(1)).selectExpr("*", "1 as kept", "2 as N_words")
    measured = quality_rules.measure(
        df, queries.tokenizer_path("piece_bpe_32k.model"),
        queries.tokenizer_path("byte_bpe_50k.tiktoken"),
    )
    got = quality_rules.judge(measured).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        assert tuple(r[n] for n in NUMBERS) == brute(r["text"])
        assert r["kept"] is False or not r["base_failed"]
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[6]["script"] == "Cyrillic" and by_id[6]["kept"]
    assert by_id[7]["script"] == "Han" and by_id[0]["entropy_share"] == 1.0
    assert quality_rules.judge(measured.limit(0)).count() == 0


def test_classifier_on_held_out_labels(spark):
    rows = queries.QUERIES["op7_quality_classifier"](spark, BIG).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    labels = dict(spark.read.parquet(f"{BIG}/labels.parquet").select("doc_id", "quality").rdd.map(tuple).collect())
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 50 and sum(a == b for a, b in held) >= 0.9 * len(held)


def test_classifier_on_odd_rows(spark, rows):
    docs = rows(
        [doc(i, f"good plain text {i}") for i in range(1, 20)]
        + [doc(100 + i, f"bad*** text### {i}") for i in range(20)]
        + [doc(None, None), doc(300, ""), doc(300, ""), doc(301, "z" * 50_000)],
        DOCS,
    ).selectExpr("*", "'x' as Score", "5 as label")
    labels = rows(
        [(i, 1) for i in range(1, 20)] + [(100 + i, 0) for i in range(20)] + [(1, 1), (None, 1), (2, None)],
        "doc_id long, quality int",
    )
    got = quality_classifier.classify(docs, labels).collect()
    assert len(got) == 43 and all(0 <= r["score"] <= 1 for r in got)
    right = [r["predicted"] == (r["doc_id"] < 100) for r in got if r["doc_id"] and r["doc_id"] < 200]
    assert all(right)
    none = quality_classifier.fit(docs, labels.limit(0))
    assert {r["score"] for r in quality_classifier.score(docs, none).collect()} == {0.5}
    assert quality_classifier.score(docs.limit(0), none).count() == 0
    again = quality_classifier.classify(docs, labels).collect()
    assert sorted(r["score"] for r in again) == sorted(r["score"] for r in got)


def test_language_on_held_out_rows(spark):
    rows = queries.QUERIES["op8_language_id"](spark, BIG).collect()
    langs = dict(spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang").rdd.map(tuple).collect())
    held = [r["lang_pred"] == langs[r["doc_id"]] for r in rows if r["held_out"]]
    assert len(rows) == len(langs) and sum(held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame(
        [doc(i, "the cat and the other thing", "en") for i in range(5)]
        + [doc(9 + i, "die katze und das andere ding", "de") for i in range(5)]
        + [doc(99, None, "fr"), doc(98, "texte", None)],
        DOCS,
    )
    return language_id.fit(docs)


def test_words_come_first_and_shorter_grams_follow(model):
    assert model.languages == ["de", "en"]
    words, table = model.tables[0]
    assert list(language_id.word_scores("THE,", model)) == list(table[words["the"]])
    known = model.tables[4][0]
    assert "xthex" not in words and "the_" in known
    grams, values = model.tables[4]
    assert list(language_id.word_scores("bathe", model)) == list(
        values[[grams[g] for g in ("athe", "the_") if g in grams]].mean(0))
    assert language_id.word_scores("123", model) is None
    # nothing of the word is known: no language gains
    assert list(language_id.word_scores("жж", model)) == list(
        model.tables[1][1][[model.tables[1][0]["_"]] * 2].mean(0))


def test_language_of_odd_texts(spark, rows, model):
    texts = [None, "", "123 !!", "the cat", "das ding", "cat " * 20_000, "und"]
    df = rows([doc(i, t) for i, t in enumerate(texts)], DOCS).selectExpr("*", "1 as Lang_Pred")
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(df, model).collect()}
    assert got == {0: "und", 1: "und", 2: "und", 3: "en", 4: "de", 5: "en", 6: "de"}
    nothing = language_id.fit(df.limit(0))
    assert {r["lang_pred"] for r in language_id.identify(df, nothing).collect()} == {"und"}
    assert language_id.identify(df.limit(0), model).count() == 0
