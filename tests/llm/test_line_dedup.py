from collections import defaultdict

from ampliframe.llm import line_dedup
from helpers import DOCS, doc, lowered

SPACES = " \t\n\x0b\f\r"


def brute(docs, least):
    found = defaultdict(set)
    for row, (_, text) in enumerate(docs):
        for line in (text or "").split("\n"):
            found[lowered(line.strip(SPACES))].add(row)
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if not (k := lowered(x.strip(SPACES))) or len(found[k]) < least
        ]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_equals_brute_force_over_many_batches(spark, rows):
    texts = [
        None, "", "\n", "a\nB\n\na", " b \t\nÉ\ne", "x" * 5000 + "\na", "A \nb", "É\r\nb\n",
        "only here", "b", "\n \n\t\n",
    ]
    docs = [(i if i != 4 else None, texts[i % len(texts)]) for i in range(44)]
    docs += [(3, texts[3]), (3, "other b"), (3, "b")]
    df = rows([doc(i, t) for i, t in docs], DOCS).selectExpr("*", "1 as N_Lines", "2 as h1")
    for least, batches in ((5, 4), (1, 2), (100, 7)):
        got = line_dedup.dedup_lines(df, least, batches)
        assert [c.lower() for c in got.columns].count("n_lines") == 1 and "h1" in got.columns
        got = [
            (r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got.collect()
        ]
        assert sorted(got, key=repr) == brute(docs, least)


def test_empty_table(spark, rows):
    assert line_dedup.dedup_lines(rows([], DOCS)).count() == 0


def test_runs_are_merged_in_binary_levels(spark, rows):
    runs = line_dedup.LineRuns(spark, min_docs=2)
    for i in range(5):
        runs.add(rows([(f"x\nline {i}",)], "text string"))
    assert [bool(n) for n in runs.levels] == [True, False, True]
    counts = sorted(r["n_docs"] for r in spark.table(runs.levels[2]).collect())
    # the first two documents settle "x"; later ones no longer count it
    assert counts == [1, 1, 1, 1, 2]
    assert spark.table(runs.levels[0]).count() == 1
    assert runs.frequent().count() == 1
    assert line_dedup.LineRuns(spark).frequent().count() == 0
