import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from ampliframe.llm import pieces, queries
from helpers import DOCS, SF_DIR, doc

PATH = queries.tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def own():
    return pieces.vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def coded(own, text):
    cut = own.chunks(own.marked(text))
    assert "".join(cut) == own.marked(text)
    return [i for c in cut for i in own.segment(c)]


def back(own, ids):
    return own.decode_many(np.array(ids, np.int64), np.array([0, len(ids)]))[0]


def test_random_texts_equal_the_library(own, library):
    draw = random.Random(5)
    letters = [chr(c) for c in range(1000)] + list("aabcdeehinrstt    \n\n'.,-_()") * 30
    letters += list("中文ñéü😀́​ 　▁<|>²") * 4
    for _ in range(4000):
        text = "".join(draw.choices(letters, k=draw.randint(0, 40)))
        ids = library.encode(text)
        assert coded(own, text) == ids, text
        assert back(own, ids) == library.decode(ids)


@pytest.mark.parametrize(
    "text",
    ["", " ", "  a", "a  b ", "▁", "▁ x", "a▁b", "\n", "<s></s><unk><0x0A>", "a" * 3000, " " * 99,
     "x\x00y", "éＡ　b\t\nc", "12,345.67", "ab" * 2000],
)
def test_odd_texts_equal_the_library(own, library, text):
    assert coded(own, text) == library.encode(text)
    assert back(own, library.encode(text)) == library.decode(library.encode(text))


def test_any_ids_decode_like_the_library(own, library):
    draw = random.Random(6)
    for _ in range(4000):
        top = draw.choice([31_999, 400, 262])
        ids = [draw.randint(0, top) for _ in range(draw.randint(0, 8))]
        assert back(own, ids) == library.decode(ids), ids
    assert back(own, [-1, 10**7]) == ""


def check(got, library, text):
    ids = library.encode(text or "", add_eos=True)
    assert list(got["token_ids"]) == ids and got["decoded"] == library.decode(ids)


def test_rows_blocks_and_columns(spark, rows, library):
    texts = ["ab c", "ab c", None, "", "x " * 3000, "nospace" * 500, "ab\nc ab", "é ab"]
    df = rows([doc(i // 2, t) for i, t in enumerate(texts)] + [doc(None, "q r")], DOCS)
    df = df.selectExpr("*", "lang as Token_Ids", "7 as block", "'z' as chunks", "3 as rows")
    # blocks of a few chunks, so that every chunk is asked for by several blocks
    got = pieces.encode(df.coalesce(1), PATH, ["doc_id", "text", "block", "chunks", "rows", "Token_Ids"], room=3)
    assert got.columns == ["doc_id", "text", "block", "chunks", "rows", "token_ids", "decoded"]
    out = got.collect()
    assert sorted(map(str, [*texts, "q r"])) == sorted(str(r["text"]) for r in out)
    for r in out:
        check(r, library, r["text"])
        assert (r["block"], r["chunks"], r["rows"]) == (7, "z", 3)
    assert pieces.encode(df.limit(0), PATH).count() == 0
    assert pieces.encode(df.filter("text is null"), PATH).collect()[0]["token_ids"] == [2]
    assert pieces.encode(df, PATH, keep=[], end=False, decoded=False).columns == ["token_ids"]
    again = pieces.decode(got.select("doc_id", "token_ids"), PATH)
    assert sorted(r["text"] for r in again.collect()) == sorted(r["decoded"] for r in out)


def test_each_distinct_chunk_is_segmented_once(rows):
    df = rows([doc(i, f"a b c{i % 7} a") for i in range(60)], DOCS)
    cut = pieces.blocks(df.repartition(4), PATH, ["doc_id"], "text", 8)
    held = pieces._packs(cut, 5).collect()
    seen = {}
    for p in held:
        for chunk in pieces._cut_up(bytes(p["chunks"]), bytes(p["sizes"])):
            seen.setdefault(chunk, set()).add(p["bucket"])
    assert all(len(b) == 1 for b in seen.values()) and len(held) > len(seen)


def test_query_equals_the_library(spark, library):
    got = {r["doc_id"]: r for r in queries.QUERIES["op11_piece_round_trip"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d["text"] or "", add_eos=True)
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
