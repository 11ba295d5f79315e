import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa

from ampliframe.llm import passages, queries
from helpers import DOCS, SF_DIR, WORDS, doc, lowered


def test_windows_equal_their_definition():
    draw = np.random.default_rng(3)
    for _ in range(100):
        lengths = draw.integers(1, 40, size=draw.integers(1, 5))
        tokens = draw.integers(0, 30, size=lengths.sum()).astype(np.uint64)
        ends, width = np.cumsum(lengths), int(draw.integers(2, 9))
        if len(tokens) < width:
            continue
        got = zip(*[x.tolist() for x in passages.compact_windows(tokens, ends, 0, width)[1:]])
        hashes = passages._hashed(tokens, 0).tolist()
        rank = [(h >> passages.PLACE_BITS, i) for i, h in enumerate(hashes)]
        want, begin = [], 0
        for end in ends.tolist():
            for c in range(begin, end):
                l = r = c
                while l > begin and rank[l - 1] > rank[c]:
                    l -= 1
                while r < end - 1 and rank[r + 1] > rank[c]:
                    r += 1
                if r - l + 1 >= width:
                    want.append((l, c, r))
            begin = end
        assert sorted(got) == sorted(want)


def words(seed, n):
    draw = np.random.default_rng(seed)
    return ["".join(draw.choice(list("abcdefghij"), 6)) for _ in range(n)]


def test_planted_passages(spark, rows):
    shared = words(1, 60)
    edited = list(shared)
    edited[30] = "changed"
    near_copy = words(50, 300)
    other = list(near_copy)
    other[100:100] = ["put", "in"]
    data = [
        doc(1, " ".join(words(2, 80) + shared + words(3, 40))),
        doc(2, " ".join(words(4, 10) + [w.upper() for w in shared] + words(5, 90))),
        doc(3, "\n".join(edited + words(6, 70))),
        doc(4, " ".join(words(7, 200))),
        doc(5, " ".join(words(8, 60) + shared[:30] + words(9, 60))),
        doc(6, " ".join(near_copy)), doc(7, " ".join(other)),
        doc(8, " ".join(near_copy)), doc(9, " ".join(near_copy)),
        doc(10, None), doc(11, ""), doc(12, "short text"), doc(13, "short text"),
        doc(None, " ".join(shared)), doc(14, " ".join(["again"] * 400)), doc(15, " ".join(words(7, 200)[:49])),
    ]
    df = rows(data, DOCS).selectExpr("*", "1 as key", "2 as th", "3 as A")
    found = passages.recurring_passages(df)
    classes = {r["doc_id"]: r for r in passages.passage_classes(found).collect()}
    assert set(classes) == {1, 2, 3, 6, 7, 8, 9}
    assert {classes[i]["class_id"] for i in (1, 2, 3)} == {1}
    assert {classes[i]["class_id"] for i in (6, 7, 8, 9)} == {6}
    for r in found.collect():
        assert r["end"] - r["start"] >= 50 and r["similarity"] >= 0.8
        if (r["doc_id"], r["other_id"]) == (2, 1):
            assert (r["start"], r["end"], r["other_start"]) == (10, 70, 80)
    assert passages.recurring_passages(df.limit(0)).count() == 0


def test_every_recurring_passage_is_connected(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.QUERIES["op10_recurring_passages"](spark, SF_DIR).collect()
    classes = {r["doc_id"]: r["class_id"] for r in rows}
    where = defaultdict(set)
    for i, text in docs:
        own = WORDS.findall(lowered(text))
        for k in range(len(own) - 49):
            where[tuple(own[k : k + 50])].add(i)
    shared = [s for s in where.values() if len(s) > 1]
    assert shared and all(len({classes.get(i, -i) for i in s}) == 1 for s in shared)
    assert all(r["n_links"] >= 1 for r in rows) and len(rows) == len(classes)


def linked(spark, rows, data):
    df = rows([doc(i, " ".join(t)) for i, t in data.items()], DOCS)
    found = passages.recurring_passages(df).collect()
    for r in found:
        assert r["similarity"] >= 0.8 and r["end"] - r["start"] >= 50
    return found


def class_of(found, i):
    group, size = {i}, 0
    while size != len(group):
        size = len(group)
        for r in found:
            if {r["doc_id"], r["other_id"]} & group:
                group |= {r["doc_id"], r["other_id"]}
    return group


def test_a_word_put_in_or_left_out_of_a_short_passage(spark, rows):
    data = {}
    for k, n in enumerate((50, 60, 75, 90)):
        own = words(10 + k, n)
        extra = words(50 + k, 80)
        data[10 * k + 1] = words(100 + k, 90) + own + words(200 + k, 90) + extra
        data[10 * k + 2] = words(300 + k, 70) + own[: n // 2] + ["put"] + own[n // 2 :] + words(400 + k, 80)
        data[10 * k + 3] = words(500 + k, 30) + own[: n // 2] + own[n // 2 + 1 :] + words(600 + k, 80) + extra
    found = linked(spark, rows, data)
    for k in range(4):
        assert class_of(found, 10 * k + 1) == {10 * k + 1, 10 * k + 2, 10 * k + 3}
    # also where the pair has another passage
    assert all(
        any((r["doc_id"], r["other_id"]) == (10 * k + 3, 10 * k + 1) and 90 <= r["other_start"] < 180 for r in found)
        for k in range(1, 4)
    )


def test_a_text_with_a_recurring_phrase_keeps_its_later_passages(spark, rows):
    line = words(1, 8)

    def table(seed, n):
        return [w for k in range(n) for w in line + words(seed * 1000 + k, 12)]

    shared = table(1, 4)
    data = {1: table(2, 12) + shared + table(3, 2), 2: table(4, 7) + shared + table(5, 9)}
    data |= {3: table(6, 20), 4: ["again"] * 400, 5: ["again"] * 300 + words(7, 50)}
    found = linked(spark, rows, data)
    assert class_of(found, 1) == {1, 2}
    assert any(r["other_start"] - r["start"] == 5 * 20 for r in found if r["doc_id"] == 2)


def test_near_passages_against_brute_force(spark, rows):
    data = {}
    for k in range(60):
        own = words(k, 50)
        near = list(own)
        near[25] = "changed"
        data[2 * k] = words(5000 + k, 80) + own + words(6000 + k, 40)
        data[2 * k + 1] = near + words(7000 + k, 70)
    found = linked(spark, rows, data)
    assert {(r["other_id"], r["doc_id"]) for r in found} == {(2 * k, 2 * k + 1) for k in range(60)}


def test_a_frequent_phrase_at_both_id_ends_does_not_hide_a_passage(spark, rows):
    phrase = words(2, 30)
    data = {i: words(1000 + i, 60) + phrase + words(2000 + i, 60) for i in [*range(20), *range(80, 100)]}
    for i in range(20, 40):
        both = words(i, 10) + phrase + words(50 + i, 10)
        data |= {k: words(3000 + k, 40) + both + words(4000 + k, 40) for k in (i, i + 30)}
    found = linked(spark, rows, data)
    assert {(r["other_id"], r["doc_id"]) for r in found} == {(i, i + 30) for i in range(20, 40)}


def boilerplate(pairs=100, others=20, shared=44):
    """Texts that all hold `shared` words, pairs of which hold the same six more behind them."""
    common = words(1, shared)
    data = {}
    for k in range(pairs):
        own = words(100 + k, 50 - shared)
        for i in (1000, 1100):
            data[i + k] = words(i + k + 9000, 50) + common + own + words(i + k + 20_000, 50)
    for i in [*range(others // 2), *range(9000, 9000 + others // 2)]:
        data[i] = words(i + 40_000, 50) + common + words(i + 60_000, 50)
    return data


def test_exact_repeats_within_boilerplate_are_all_found(spark, rows):
    found = linked(spark, rows, boilerplate())
    assert {(r["other_id"], r["doc_id"]) for r in found} == {(1000 + k, 1100 + k) for k in range(100)}


def test_near_repeats_within_boilerplate_are_all_found(spark, rows):
    # each text of a pair has a word of its own in the middle of what all hold, or none
    for changed in ((1, 1), (0, 1)):
        data = boilerplate()
        for k in range(100):
            for i, put in zip((1000 + k, 1100 + k), changed):
                cut = data[i][70:71] if changed == (0, 1) else []
                data[i][70:71] = [f"own{i}"] * put + cut
        found = linked(spark, rows, data)
        assert {(r["other_id"], r["doc_id"]) for r in found} == {(1000 + k, 1100 + k) for k in range(100)}


def test_hashes_of_words_do_not_depend_on_their_place(monkeypatch):
    texts = [" ".join(words(k, n)).encode() for k, n in ((1, 1), (2, 7), (3, 400))]
    texts.append(b"x" * 90 + b" a " + b"y" * 50 + b" " + b"x" * 90)
    monkeypatch.setattr(passages, "PIECE_BYTES", 60)
    for text in texts:
        alone = [passages.word_hashes(w)[0] for w in text.split()]
        assert passages.word_hashes(text).tolist() == alone
        assert len(set(alone)) == len(set(text.split()))


def test_a_document_takes_part_with_all_its_texts(spark, rows):
    one, two = words(1, 60), words(2, 60)
    data = [
        doc(5, " ".join(words(3, 60) + one)), doc(5, " ".join(two + words(4, 60))),
        doc(9, " ".join(one + words(5, 70))), doc(11, " ".join(words(6, 70) + two)),
        # only with itself
        doc(20, " ".join(words(7, 60) + words(8, 60))), doc(20, " ".join(words(7, 60) + words(9, 60))),
        # the two texts of 30 are alike, and 31 has one of them
        doc(30, " ".join(words(10, 90))), doc(30, " ".join(words(10, 90) + words(11, 20))),
        doc(31, " ".join(words(10, 90))),
    ]
    for order in (data, data[::-1]):
        found = passages.recurring_passages(rows(order, DOCS)).collect()
        pairs = {(r["other_id"], r["doc_id"]) for r in found}
        assert pairs == {(5, 9), (5, 11), (30, 31)}


def test_groups_are_streamed(rows):
    draw = np.random.default_rng(4)
    data = [(int(k), int(t), int(c)) for k, t, c in draw.integers(0, [40, 6, 3], (3000, 3))]
    data += [(64 * 7, t, 1) for t in range(500)] + [(64 * 9, 5, c) for c in range(300)]
    groups = defaultdict(set)
    for k, t, c in data:
        groups[k].add((t, c))
    for paired, held in [(8, 1 << 16), (8, 100), (0, 50), (3, 7)]:
        want = set()
        for k, own in groups.items():
            own = sorted(own)
            if len({t for t, _ in own}) < 2:
                continue
            if len(own) <= paired:
                want |= {(False, k % 64, a[0], b[0], a[1], b[1]) for a in own for b in own if a[0] < b[0]}
            else:
                want |= {(True, k % 64, own[0][0], b[0], own[0][1], b[1]) for b in own}
        found = rows(data, passages.WINDOW_SCHEMA).repartition(5)
        got = [tuple(r) for r in passages.group_links(found, paired, held).collect()]
        assert set(got) == want
        # only a row repeated where a large group is cut may come twice
        assert len(got) <= len(want) + len(data) // held


def test_texts_are_hashed_together_in_pieces(monkeypatch):
    texts = [" ".join(words(k, n)) for k, n in enumerate([60, 3, 50, 49, 700, 51] * 40)]
    sizes, own = [], passages.word_hashes
    monkeypatch.setattr(passages, "PIECE_BYTES", 4000)
    monkeypatch.setattr(passages, "word_hashes", lambda text: sizes.append(len(text)) or own(text))
    batch = pa.RecordBatch.from_pydict({"text": texts, "no": list(range(len(texts)))})
    (block,) = passages._blocks([batch], 50, ("no",))
    # a text of 700 words stands alone
    long = [t for t in texts if len(t) > 4000]
    assert len(sizes) <= 2 * len(long) + 1 and sorted(sizes)[-len(long)] == len(long[0])
    want = [(i, t.encode()) for i, t in enumerate(texts) if len(t.split()) >= 50]
    assert block.others == [[i] for i, _ in want]
    for (_, text), begin, end, at in zip(want, block.begins, block.ends, block.word_begins):
        hashes = own(text)
        assert (block.words[at : at + len(hashes)] == hashes).all()
        assert block.tokens[begin:end].tolist() == passages.tokens_of(hashes).tolist()


def test_similar_sets_equal_their_definition(monkeypatch):
    draw = np.random.default_rng(5)
    numbered, found, width = [], 0, 12
    made = passages.Numbered
    monkeypatch.setattr(passages, "Numbered", lambda *x: numbered.append(1) or made(*x))
    for _ in range(150):
        kinds = int(draw.choice([8, 40, 1000]))
        a, b = (draw.integers(0, kinds, n).astype(np.uint64) for n in draw.integers(60, 90, 2))
        at, to, k = (int(x) for x in draw.integers([10, 10, 3], [40, 40, 20]))
        b[to : to + k] = a[at : at + k]
        b[to + k // 2] = 2000
        b = np.insert(b, to + k // 3, 3000)
        first, last, shift = at, at + int(draw.integers(0, 8)), at - to
        best = (0.0,)
        for i in range(max(first - width + 1, 0), min(last, len(a) - width) + 1):
            for j in range(max(first - shift - width + 1, 0), min(last - shift, len(b) - width) + 1):
                x, y = set(a[i : i + width].tolist()), set(b[j : j + width].tolist())
                s = len(x & y) / len(x | y)
                best = max(best, (s, i, j), key=lambda found: found[0])
        want = (*best[1:], best[0]) if best[0] >= 0.6 else None
        for whole in (None, made(a, b, width)):
            assert passages.similar_sets(a, b, first, last, shift, width, 0.6, whole) == want
        found += want is not None
        # many places of one pair: its tokens are numbered once, those of long texts in parts
        links = [(i, j) for i in range(0, 50, 3) for j in range(0, 50, 3)]
        numbered.clear()
        once = passages.verified(a, b, links, width, 0.6)
        assert len(numbered) <= 1
        with monkeypatch.context() as limit:
            limit.setattr(passages, "NUMBERED_TOKENS", 0)
            assert passages.verified(a, b, links, width, 0.6) == once
    assert 20 < found < 130


def test_repeated_places_are_told_by_what_is_around():
    draw = np.random.default_rng(6)
    left_out = 0
    for _ in range(100):
        ends = np.cumsum(draw.integers(1, 200, size=draw.integers(1, 5)))
        begins = np.append(0, ends[:-1])
        tokens = np.resize(draw.integers(0, 9, draw.integers(1, 40)).astype(np.uint64), ends[-1])
        tokens[draw.integers(0, len(tokens), 3)] = 10
        c = np.unique(draw.integers(0, len(tokens), 100))
        text, width, seen, want = np.searchsorted(ends, c, "right"), 10, set(), []
        for t, at in zip(text, c):
            first, last = max(begins[t], at - width + 1), min(ends[t], at + width)
            want.append((t, at - first, *tokens[first:last].tolist()) not in seen)
            seen.add((t, at - first, *tokens[first:last].tolist()))
        key = passages._hashed(tokens, 0)[c]
        with np.errstate(all="raise"):
            assert passages.not_repeated(tokens, begins, ends, key, text, c, width).tolist() == want
        left_out += want.count(False)
    assert left_out > 100


def test_a_batch_of_many_texts_is_worked_on_in_small_blocks():
    draw = np.random.default_rng(8)
    texts = [" ".join(map(str, draw.integers(0, 1 << 30, 300).tolist())) for _ in range(4000)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    made = []

    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            made.append(run)

    passages.windows(Docs(), passages.shape_of(50, 0.8))
    tracemalloc.start()
    n = sum(part.num_rows for part in made[0]([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 1,184,000 tokens of 8 bytes, of each of which there are several arrays
    assert n > 100_000 and peak < 70e6
