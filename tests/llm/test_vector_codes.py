import hashlib
import math

import numpy as np
import pytest

from ampliframe.llm import queries, vector_codes
from ampliframe.llm.common import pack_numbers, unpack_numbers
from helpers import SF_DIR


def plain(vectors, parts=4, entries=256, rounds=4, scale=1024):
    """Codes, errors and codebooks of (id, vector) rows, by whole scans in every round."""
    kept = [
        (i, [math.floor(scale * float(x)) for x in v]) for i, v in vectors
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    size = -(-max((len(v) for _, v in kept), default=0) // parts)
    rows = [(i, v + [0] * (parts * size - len(v))) for i, v in kept]
    first = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    cut = lambda v, p: np.array(v[p * size : (p + 1) * size], np.int64)
    books = [np.array([cut(v, p) for _, v in first]).reshape(-1, size) for p in range(parts)]
    x = [np.array([cut(v, p) for _, v in rows]).reshape(-1, size) for p in range(parts)]
    for t in range(rounds + 1):
        far = [((x[p][:, None] - books[p][None]) ** 2).sum(2) for p in range(parts)]
        own = [f.argmin(1) for f in far]
        if t < rounds:
            for p in range(parts):
                for k in np.unique(own[p]):
                    books[p][k] = x[p][own[p] == k].sum(0) // (own[p] == k).sum()
    errors = sum(f.min(1) for f in far)
    codes = ["".join(f"{own[p][i]:02x}" for p in range(parts)) for i in range(len(rows))]
    return [r[0] for r in rows], codes, errors.tolist(), np.array(books)


def clustered(n, width, seed=1, spread=0.02):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    return (centres[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, width))).tolist()


@pytest.mark.parametrize("n, width, entries, groups", [(300, 8, 16, 4), (90, 12, 256, 8), (400, 4, 5, 1)])
def test_codes_equal_whole_scans(rows, n, width, entries, groups):
    vectors = [(i, [round(x, 2) for x in v]) for i, v in enumerate(clustered(n, width))]
    vectors += vectors[:20]
    df = rows(vectors, "vec_id long, embedding array<double>").repartition(3)
    got = vector_codes.compress(df, entries=entries, groups=groups)
    ids, codes, errors, books = plain(vectors, entries=entries)
    assert np.array_equal(got.codebooks, books)
    assert sorted(map(tuple, got.rows.collect())) == sorted(zip(ids, codes, errors))


def test_bounds_save_scans_and_change_nothing():
    rng = np.random.default_rng(5)
    x = np.floor(1024 * np.array(clustered(3000, 8))).astype(np.int64)
    history = [x[rng.choice(3000, 64, replace=False)][None]]
    state, scans = vector_codes.Assigned.none(3000, 1, 8), []
    for _ in range(6):
        far, looked = state.again(0, x, history, vector_codes.net_displacements(history, 8))
        all_ = ((x[:, None] - history[-1][0][None]) ** 2).sum(2)
        assert np.array_equal(state.entry[:, 0], all_.argmin(1)) and np.array_equal(far, all_.min(1))
        scans.append(looked)
        book = history[-1].copy()
        for k in np.unique(state.entry[:, 0]):
            own = x[state.entry[:, 0] == k]
            book[0, k] = own.sum(0) // len(own)
        history.append(book)
    assert scans[0] == 3000 * 8 and scans[-1] < 0.5 * scans[0]


def test_net_displacement_forgets_the_way_back():
    a, b = np.zeros((1, 2, 2), np.int64), np.full((1, 2, 2), 100)
    moved = vector_codes.net_displacements([a, b, a + 1], 1)
    assert moved[0, 0, 0] < 2 < 139 < moved[1, 0, 0] and moved[2, 0, 0] == 0


def test_odd_rows(rows):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (1, [0.5, -0.5, 1.0]), (1, [0.5, -0.5, 1.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]),
        (5, [None, 1.0]), (6, []), (None, [0.25, 0.5, 0.75, 1.0, 1.25]), (7, [-0.0001]), (8, [3e4]),
    ]
    schema = "vec_id long, embedding array<double>, code string, Error int, label string"
    df = rows([(i, v, "x", 1, str(i % 2) if i else None) for i, v in vectors], schema)
    got = vector_codes.compress(df, entries=3)
    assert got.rows.columns == ["vec_id", "label", "code", "error"]
    ids, codes, errors, books = plain(vectors, entries=3)
    assert np.array_equal(got.codebooks, books)
    key = lambda r: (r[0] is None, r)
    out = [(r["vec_id"], r["code"], r["error"]) for r in got.rows.collect()]
    assert sorted(out, key=key) == sorted(zip(ids, codes, errors), key=key)
    labelled = vector_codes.with_group_error(got.rows).collect()
    for r in labelled:
        assert r["label_error"] == sum(o["error"] for o in labelled if o["label"] == r["label"])
    empty = vector_codes.compress(df.limit(0))
    assert empty.rows.count() == 0 and empty.rows.columns == got.rows.columns
    assert empty.digest() == hashlib.sha256(b"").hexdigest()
    nothing = vector_codes.compress(rows([(1, [])], "vec_id long, embedding array<float>"))
    assert nothing.rows.collect()[0]["code"] == "00000000"
    with pytest.raises(Exception, match="too large"):
        vector_codes.compress(rows([(1, [1e12] * 4)], "vec_id long, embedding array<double>"))


def test_packed_numbers():
    for numbers in ([], [0], [127, -128], [128], [1 << 40, -5], [-(1 << 63), (1 << 63) - 1]):
        assert unpack_numbers(pack_numbers(np.array(numbers, np.int64))).tolist() == numbers


def test_query_equals_whole_scans(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    got = queries.QUERIES["op13_vector_codes"](spark, SF_DIR).collect()
    ids, codes, errors, books = plain([(r["vec_id"], r["embedding"]) for r in table])
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in got) == sorted(zip(ids, codes, errors))
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    assert {r["codebooks_sha256"] for r in got} == {hashlib.sha256(text.encode()).hexdigest()}
    labels = {r["vec_id"]: r["label"] for r in table}
    for r in got:
        own = sum(e for i, e in zip(ids, errors) if labels[i] == labels[r["vec_id"]])
        assert r["label_error"] == own
