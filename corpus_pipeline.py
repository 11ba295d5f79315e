"""A training-data pipeline over the documents table, as stages that can run one by one.

Each stage takes (spark, docs, sf_dir) and works on all rows the stage before it kept. All but the
last return the columns of documents; the last returns token ids.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampliframe.llm import bpe, line_dedup, mixing, quality_classifier, simhash
from ampliframe.llm.common import DOCUMENT_COLUMNS, table
from ampliframe.llm.queries import tokenizer_path
from ampliframe.session import ensure_checkpoint_dir, materialise, ship_package


def _with_text(docs: DataFrame, text: str) -> DataFrame:
    """The columns of documents, with the text taken from another column and n_chars counted."""
    new = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return docs.select(*[new[c].alias(c) if c in new else c for c in DOCUMENT_COLUMNS])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, does not reject."""
    labels = table(ship_package(spark), sf_dir, "labels")
    scored = quality_classifier.classify(docs, labels, threshold=0.3)
    return scored.filter("predicted = 1").select(*DOCUMENT_COLUMNS)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share."""
    return _with_text(line_dedup.dedup_lines(docs, min_docs=10), "kept_text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that with the smallest id, of these by its hash.

    Rows are told apart by all their columns, so a repeated id loses none of its texts; equal rows
    become one. Rows without an id stay only where their whole group has none. Texts that are null
    or hold no word are copies of each other. Fingerprints are of five-word shingles and link at
    four bits or fewer, which is closer than a similarity of 0.8.
    """
    ship_package(spark)
    columns = [c for name in DOCUMENT_COLUMNS for c in (F.col(name), F.col(name).isNull())]
    keyed = docs.select(
        *DOCUMENT_COLUMNS,
        F.xxhash64(*columns).alias("h1"),
        F.xxhash64(F.lit(1), *columns).alias("h2"),
    )
    row = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "h1", "h2").alias("row")
    groups = simhash.near_duplicates(keyed.select(row, "text"), doc_id="row", shingle=5)
    rows = groups.groupBy(
        F.col("doc_id.h1").alias("h1"), F.col("doc_id.h2").alias("h2"),
        F.col("component_id.h1").alias("c1"), F.col("component_id.h2").alias("c2"),
    ).agg(F.count(F.lit(1)).alias("n"))
    stays = (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2"))
    rows = materialise(rows.filter(~stays | (F.col("n") > 1)).select("h1", "h2", stays.alias("stays")))
    repeated = keyed.join(rows.filter("stays"), ["h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"])
    others = keyed.join(rows.select("h1", "h2"), ["h1", "h2"], "left_anti")
    return others.unionByName(repeated).select(*DOCUMENT_COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often and as far as the mix of their sources takes them."""
    mixed = mixing.mixed_texts(mixing.mix(docs))
    return _with_text(mixed, "text")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether decoding them gives the text back."""
    ship_package(spark)
    coded = bpe.encode_decode(docs, tokenizer_path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id", "lang", "source", "n_chars",
        F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_shared_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: A classifier's training and a tokenizer's merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each stored in the shared checkpoint folder before the next one reads it."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = f"{folder}/{number}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
