import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from ampliframe.llm import bpe, queries
from helpers import DOCS, SF_DIR, doc

PATH = queries.tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def own():
    return bpe.vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def same(own, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    got = own.encode(text)
    assert got.tolist() == ids, text
    back = own.decode_many(got, np.array([0, len(got)]))
    assert back == [library.decode(ids, skip_special_tokens=False)]


def test_random_texts_equal_the_library(own, library):
    draw = random.Random(5)
    letters = [chr(c) for c in range(256)] + list("aabcdeehinrstt  \n\n'") * 6
    letters += list("中文ñéü😀́​ 　\x1c<|")
    for _ in range(3000):
        same(own, library, "".join(draw.choices(letters, k=draw.randint(0, 40))))


@pytest.mark.parametrize(
    "text",
    ["", " ", "a" * 500, "\n \n  x", "<|endoftext|>", "a<|endoftext|> <|endoftext|><|endoftext",
     " lead", "trail ", "tab\tx  y", "don't we'll I'm", "--------====!!!!"],
)
def test_odd_texts_equal_the_library(own, library, text):
    same(own, library, text)


def test_broken_ids_decode_to_replacement_characters(own):
    token = own.encode("é")[0]
    half = next(i for i in range(len(own.lengths)) if own.lengths[i] == 1 and i > 127)
    ids = np.array([half, token, -1, 10**7], np.int64)
    assert own.decode_many(ids, np.array([0, 1, 4])) == ["�", "é"]


def test_round_trip_keeps_rows_and_replaces_clashing_columns(spark, rows):
    df = rows([doc(1, "ab c"), doc(1, "ab c"), doc(2, None), doc(None, "")], DOCS)
    df = df.selectExpr("*", "7 as Token_Ids", "lang as decoded")
    got = bpe.encode_decode(df, PATH)
    assert [c.lower() for c in got.columns].count("token_ids") == 1
    out = sorted((r["doc_id"] or 0, r["decoded"], len(r["token_ids"])) for r in got.collect())
    assert out == [(0, "", 0), (1, "ab c", 2), (1, "ab c", 2), (2, "", 0)]
    coded = bpe.encode(df, PATH, ids="ids")
    assert sorted(r["t"] for r in bpe.decode(coded, PATH, "ids", "t").collect()) == [
        "", "", "ab c", "ab c"]
    assert bpe.encode_decode(df.limit(0), PATH).count() == 0
    nulls = rows([(None,), ([],)], "ids array<int>")
    assert [r["text"] for r in bpe.decode(nulls, PATH, "ids").collect()] == ["", ""]


def test_query_equals_the_library(spark, library):
    got = {r["doc_id"]: r for r in queries.QUERIES["op4_bpe_round_trip"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
