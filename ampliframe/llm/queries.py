"""The registered corpus queries: each applies one operator to a whole table."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import functions as F

from ampliframe.llm import (
    bpe, language_id, line_dedup, mixing, passages, periodic, pieces, quality_classifier,
    quality_rules, revisits, simhash, topk, vector_codes,
)
from ampliframe.llm.common import table
from ampliframe.session import materialise, ship_package


def tokenizer_path(name: str) -> str:
    """The place of an installed vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_resolve_revisits(spark, sf_dir):
    found = revisits.resolve(revisits.captures(table(spark, sf_dir, "pages")))
    lines = F.transform(
        F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"])
    )
    return found.withColumn("headers", F.array_join(lines, "\n"))


def op2_simhash_components(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), bits=4)


def op3_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = line_dedup.dedup_lines(docs, min_docs=10)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_bpe_round_trip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_decode(docs, tokenizer_path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_exact_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op6_tokenizer_fertility(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    measured = quality_rules.measure(
        docs, tokenizer_path("piece_bpe_32k.model"), tokenizer_path("byte_bpe_50k.tiktoken")
    )
    # numbers only, so that texts are tokenized once
    return quality_rules.judge(materialise(measured.drop("text"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "lang", "script", *quality_rules.FERTILITY, "byte_share",
        "entropy_share",
    )


def op7_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_classifier.classify(docs, table(spark, sf_dir, "labels"), threshold=0.3)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op8_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = quality_classifier.held_out(F.col("doc_id"))
    model = language_id.fit(docs, allowed=~held_out)
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_source_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    sized = materialise(docs.select("doc_id", "source", mixing.word_count("text").alias("words")))
    mixed = mixing.mix(sized, size=F.col("words"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_recurring_passages(spark, sf_dir):
    found = passages.recurring_passages(table(spark, sf_dir, "documents"))
    return passages.passage_classes(found)


def op11_piece_round_trip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    coded = pieces.encode(docs, tokenizer_path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic.find_runs(periodic.with_repeats(docs))
    # lengths in periods are compared as fractions
    first = F.expr("""array_sort(runs, (x, y) -> case
        when x.length * y.period <> y.length * x.period
          then if(x.length * y.period > y.length * x.period, -1, 1)
        when x.start <> y.start then if(x.start < y.start, -1, 1)
        else sign(x.period - y.period) :: int end)""")
    found = found.withColumn("best", F.get(first, F.lit(0)))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.*",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias(
            "runs_sha256"
        ),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_vector_codes(spark, sf_dir):
    coded = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    rows = vector_codes.with_group_error(coded.rows)
    return rows.select(
        "vec_id", "code", "error", "label_error", F.lit(coded.digest()).alias("codebooks_sha256")
    )


def _shipped(query):
    """The query, after making the package importable in the session's workers."""

    @wraps(query)
    def run(spark, sf_dir):
        return query(ship_package(spark), sf_dir)

    return run


QUERIES = {
    f.__name__: _shipped(f)
    for f in (
        op1_resolve_revisits,
        op2_simhash_components,
        op3_line_dedup,
        op4_bpe_round_trip,
        op5_exact_top_k,
        op6_tokenizer_fertility,
        op7_quality_classifier,
        op8_language_id,
        op9_source_mix,
        op10_recurring_passages,
        op11_piece_round_trip,
        op12_periodic_runs,
        op13_vector_codes,
    )
}
ORACLES: dict[str, str] = {
    "op1_resolve_revisits": revisits.oracle(),
    "op3_line_dedup": line_dedup.oracle(10),
    "op5_exact_top_k": topk.oracle(50, 5),
    "op13_vector_codes": vector_codes.oracle(),
}
