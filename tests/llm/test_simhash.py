import random

import xxhash

from ampliframe.llm import components, queries, simhash
from helpers import DOCS, SF_DIR, WORDS, Groups, doc, lowered


def brute_print(text):
    words = WORDS.findall(lowered(text))
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(docs):
    prints = {i: brute_print(t) for i, t in docs}
    groups = Groups(prints)
    ids = sorted(prints)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                groups.join(i, j)
    return [(i, format(prints[i], "016x"), groups.find(i)) for i in ids]


def test_query_equals_brute_force(spark):
    got = queries.QUERIES["op2_simhash_components"](spark, SF_DIR).orderBy("doc_id").collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert [tuple(r) for r in got] == brute([tuple(r) for r in docs])


def chain():
    draw = random.Random(1)
    prints = [draw.getrandbits(64) for _ in range(6)]
    for start in list(prints):
        for _ in range(12):
            start ^= sum(1 << draw.randrange(64) for _ in range(draw.randint(1, 5)))
            prints.append(start % (1 << 64))
    return sorted(set(prints))


def test_links_connect_what_is_in_range_with_and_without_crowded_cells(spark, rows):
    prints = chain()
    want = Groups(prints)
    for n, i in enumerate(prints):
        for j in prints[:n]:
            if (i ^ j).bit_count() <= 4:
                want.join(i, j)
    df = rows([(simhash.signed(p),) for p in prints], "fp long")
    for cell_rows in (400, 1):
        got = Groups(prints)
        for a, b in simhash.links(df, cell_rows=cell_rows).collect():
            a, b = a % (1 << 64), b % (1 << 64)
            assert (a ^ b).bit_count() <= 4 or cell_rows == 1
            got.join(a, b)
        assert [got.find(p) for p in prints] == [want.find(p) for p in prints]


def test_odd_rows(spark, rows):
    long = " ".join(f"w{i}" for i in range(70_000))
    data = [
        doc(7, None), doc(3, ""), doc(9, " \t\n"), doc(None, "a b c d e"), doc(5, "A b\nc  d e"),
        doc(5, "a b c d e"), doc(8, "one"), doc(10, long), doc(11, long + " end"),
    ]
    df = rows(data, DOCS).selectExpr("*", "1 as FP", "2 as component_id")
    got = sorted(map(tuple, simhash.near_duplicates(df).collect()), key=repr)
    zero, same = "0" * 16, format(brute_print("a b c d e"), "016x")
    assert [g for g in got if g[1] == zero] == [(3, zero, 3), (7, zero, 3), (9, zero, 3)]
    assert [g for g in got if g[1] == same] == [(5, same, 5), (5, same, 5), (None, same, 5)]
    assert {g[2] for g in got if g[0] in (10, 11)} == {10}
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_components(spark, rows):
    draw = random.Random(2)
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(50)]
    pairs += [(draw.randrange(200, 300), draw.randrange(200, 300)) for _ in range(60)]
    pairs += [(5, 4), (5, 5), (None, 3)]
    groups = Groups({x for p in pairs for x in p if x is not None})
    for a, b in pairs:
        if a is not None:
            groups.join(a, b)
    got = dict(map(tuple, components.components(rows(pairs, "a long, b long")).collect()))
    assert got == {x: groups.find(x) for x in got}
    single = {x for x in groups.up if all(groups.find(y) != groups.find(x) for y in groups.up if y != x)}
    assert set(got) == set(groups.up) - single
    assert components.components(rows([], "a long, b long")).count() == 0
