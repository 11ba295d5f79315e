import corpus_pipeline
import __spark_entry__ as entry
from ampliframe.llm import queries
from ampliframe.llm.common import DOCUMENT_COLUMNS
from helpers import DOCS, SF_DIR, WORDS, doc


def test_registered():
    names = entry.queries()
    assert set(queries.QUERIES) < set(names) and "pipeline" in names
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_each_stage_keeps_the_columns_and_acts_on_what_it_gets(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    given, sizes, kept = docs, [docs.count()], []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, given, SF_DIR)
        assert tuple(made.columns) == DOCUMENT_COLUMNS
        kept.append(spark.createDataFrame(made.collect(), docs.schema))
        given = kept[-1]
        sizes.append(given.count())
    labels = dict(map(tuple, spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "quality").collect()))
    first = {r["doc_id"] for r in kept[0].collect()}
    good = [i in first for i, q in labels.items() if q == 1]
    assert sum(good) >= 0.97 * len(good)
    assert sizes[2] == sizes[1] and sizes[3] < sizes[2]
    assert all(r["n_chars"] == len(r["text"]) for r in given.collect())
    mixed = sum(len(WORDS.findall(r["text"])) for r in given.collect())
    before = sum(len(WORDS.findall(r["text"] or "")) for r in kept[2].collect())
    assert abs(mixed - 1.5 * before) <= 0.03 * before
    last = corpus_pipeline.STAGES[-1][1](spark, given, SF_DIR).collect()
    assert len(last) == sizes[4] and all(r["round_trip"] for r in last)


def test_run_and_empty_input(spark, rows):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.filter("not round_trip").count() == 0 and out.count() > 100
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0


def kept(spark, rows, data):
    stage = dict(corpus_pipeline.STAGES)["SimHash near-dedup"]
    made = stage(spark, rows(data, DOCS), SF_DIR)
    return sorted(((r["doc_id"], r["text"]) for r in made.collect()), key=str)


def test_near_dedup_goes_by_rows_not_by_ids(spark, rows):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    # (5, A) is a copy of (1, A), (5, B) is not; the two rows of id 7 are equal
    data = [doc(1, a), doc(5, a), doc(5, b), doc(7, c), doc(7, c)]
    assert kept(spark, rows, data) == [(1, a), (5, b), (7, c)]
    other = doc(1, a, lang="fr")
    assert len(kept(spark, rows, [doc(1, a), other])) == 1
    assert kept(spark, rows, [doc(None, a), doc(3, a), doc(None, b), doc(None, b)]) == [(3, a), (None, b)]
    blank = [doc(2, None), doc(1, ""), doc(4, " \n"), doc(None, None)]
    assert kept(spark, rows, blank) == [(1, "")]
    assert kept(spark, rows, []) == []
    near = a.replace("a30", "changed", 1) + " more"
    far = b + " " + " ".join(f"z{i}" for i in range(40))
    got = kept(spark, rows, [doc(9, far), doc(8, b), doc(2, a * 3), doc(4, near)])
    assert {i for i, _ in got} >= {8, 9}


def test_stages_on_odd_rows(spark, rows):
    """Nulls in any column, ties, repeated rows and clashing column names crash no stage."""
    word = " ".join(f"w{i}" for i in range(30))
    data = [
        (None, None, None, None, None), (1, word, None, "s", 5), (1, word, None, "s", 5),
        (2, "", "en", None, 0), (3, "x" * 50_000, "en", "s", 50_000), (4, word + " end", "fr", None, 9),
    ]
    # the text of 4 differs from that of 1 by one shingle
    docs = rows(data, DOCS).selectExpr("*", "1 as fp", "'q' as Kept_Text", "2 as score", "3 as h1", "4 as row")
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF_DIR).collect()
        if name in ("line dedup", "BPE encoding and decoding"):
            assert len(made) == len(data)
        if name == "SimHash near-dedup":
            assert sorted((r["doc_id"] for r in made), key=str) == [1, 2, 3]


def test_near_dedup_recall_by_similarity(spark):
    """Against all pairs by brute force: what the stage's fingerprints catch of near copies."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    made = dict(corpus_pipeline.STAGES)["SimHash near-dedup"](
        spark, spark.read.parquet(f"{SF_DIR}/documents.parquet"), SF_DIR
    )
    stay = {r["doc_id"] for r in made.collect()}

    def shingles(text):
        words = (text or "").encode().lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}

    sets = {d["doc_id"]: shingles(d["text"]) for d in docs}
    ids = sorted(sets)
    alike = {}
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            s = len(sets[i] & sets[j]) / max(len(sets[i] | sets[j]), 1)
            if s >= 0.5:
                alike[i, j] = s
    exact = [p for p, s in alike.items() if s == 1]
    assert exact and not any(i in stay and j in stay for i, j in exact)
    # whatever goes has something alike, so clean documents are left alone
    assert all(any(i in p for p in alike) for i in ids if i not in stay)
