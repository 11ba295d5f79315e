"""Removal of lines that many documents share, with an index of line hashes kept as sorted runs.

The index is a set of runs: tables of (line hash, number of documents), bucketed and sorted by the
hash, in levels. Documents arrive in batches. A batch's line hashes are counted, merged against
the runs, and those already known to be frequent are dropped (anti-join). The rest become a new
run of the lowest level. Two runs of one level are merged into one of the next, so each row is
rewritten once per level. As all runs are bucketed and sorted alike, neither the anti-joins nor
the merges shuffle a run.

Everything runs as DataFrame operations. Runs are written to the shared checkpoint folder, so lost
executors cost no more than the tasks they ran.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampliframe.llm.common import SPACES, ascii_lower
from ampliframe.session import ensure_checkpoint_dir

HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def line_hash(key: Column) -> Column:
    """128 bits: two hashes with different seeds."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def key_hashes(text: Column) -> Column:
    """The distinct hashes of a text's line keys; empty keys have none."""
    keys = F.filter(F.transform(lines_of(text), line_key), lambda k: k != "")
    return F.array_distinct(F.transform(keys, line_hash))


class LineRuns:
    """The levelled runs of one corpus; level k holds at most one run, of 2 ** k batches."""

    def __init__(self, spark: SparkSession, min_docs: int = 10, buckets: int | None = None):
        self.spark, self.min_docs = spark, min_docs
        # as many buckets as shuffle partitions: what is shuffled by hash is written as it lies
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.folder = f"{ensure_checkpoint_dir(spark)}/{self.name}"
        self.levels: list[str | None] = []
        self.written = 0

    def _write(self, counts: DataFrame) -> str:
        name = f"{self.name}_{self.written}"
        writer = counts.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).format("parquet")
        writer.option("path", f"{self.folder}/{self.written}").saveAsTable(name)
        self.written += 1
        return name

    def _merge(self, one: str, other: str) -> str:
        """Two runs as one. Both are bucketed and sorted by the hash: no row is shuffled."""
        a, b = (self.spark.table(n).hint("merge") for n in (one, other))
        a = a.withColumnRenamed("n_docs", "__a")
        b = b.withColumnRenamed("n_docs", "__b")
        summed = F.coalesce("__a", F.lit(0)) + F.coalesce("__b", F.lit(0))
        merged = self._write(a.join(b, HASH, "full").select(*HASH, summed.alias("n_docs")))
        for name in (one, other):
            self.spark.sql(f"drop table {name}")
        return merged

    def add(self, docs: DataFrame, text: str = "text") -> None:
        """Count the lines of a batch; each row is a document."""
        keys = docs.select(F.explode(key_hashes(F.col(text))).alias("h")).select("h.h1", "h.h2")
        counts = keys.groupBy(*HASH).agg(F.count(F.lit(1)).alias("n_docs"))
        for name in filter(None, self.levels):
            known = self.spark.table(name).filter(F.col("n_docs") >= self.min_docs)
            counts = counts.join(known.select(*HASH).hint("merge"), HASH, "left_anti")
        run, level = self._write(counts), 0
        while level < len(self.levels) and self.levels[level]:
            run = self._merge(self.levels[level], run)
            self.levels[level] = None
            level += 1
        self.levels[level : level + 1] = [run]

    def frequent(self) -> DataFrame:
        """Hashes of the keys found in at least `min_docs` documents, as a stored table."""
        runs = [n for n in self.levels if n]
        while len(runs) > 1:
            runs[:2] = [self._merge(runs[0], runs[1])]
        path = f"{self.folder}/frequent"
        if runs:
            rows = self.spark.table(runs[0]).filter(F.col("n_docs") >= self.min_docs)
        else:
            rows = self.spark.range(0).select(F.col("id").alias("h1"), F.col("id").alias("h2"))
        rows.select(*HASH).write.parquet(path)
        for name in runs:
            self.spark.sql(f"drop table {name}")
        self.levels = []
        return self.spark.read.parquet(path)


def drop_lines(
    docs: DataFrame, frequent: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`docs` with n_lines, n_dropped and kept_text: the text without lines of frequent keys.

    Only numbers of lines are joined; a text is moved once, to meet the numbers of its own lines.
    """
    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped", "kept_text")]
    row = {
        "__id": F.col(f"`{doc_id}`"),
        "__size": F.coalesce(F.length(text), F.lit(-1)),
        "__hash": F.xxhash64(F.col(f"`{text}`")),
    }
    lines = docs.select(
        *[c.alias(n) for n, c in row.items()], F.posexplode(lines_of(F.col(text))).alias("pos", "line")
    )
    keyed = lines.select(*row, "pos", line_key(F.col("line")).alias("key")).filter("key != ''")
    hashed = keyed.select(*row, "pos", line_hash(F.col("key")).alias("h"))
    found = hashed.select(*row, "pos", "h.h1", "h.h2").join(frequent, HASH, "left_semi")
    dropped = found.groupBy(*row).agg(F.collect_set("pos").alias("__dropped"))
    # the numbers of dropped lines are the small side, a hash table of which needs no sorting
    dropped = dropped.select(*[F.col(n).alias(f"{n}_r") for n in row], "__dropped")
    same = [F.col(n).eqNullSafe(F.col(f"{n}_r")) for n in row]
    rows = docs.select(F.struct("*").alias("__row"), *[c.alias(n) for n, c in row.items()])
    joined = rows.join(dropped.hint("shuffle_hash"), same, "left")
    own_text = F.col("__row").getField(text)
    whole = F.coalesce(own_text, F.lit(""))
    all_lines = lines_of(own_text)
    kept_places = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), "__dropped")
    rest = F.array_join(F.transform(kept_places, lambda i: F.get(all_lines, i)), "\n")
    return joined.select(
        *[F.col("__row").getField(c).alias(c) for c in kept],
        F.size(all_lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("__dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("__dropped").isNull(), whole).otherwise(rest).alias("kept_text"),
    )


def dedup_lines(
    docs: DataFrame,
    min_docs: int = 10,
    batches: int = 4,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """`docs` without the lines whose key is found in at least `min_docs` rows.

    Adds n_lines (before), n_dropped and kept_text; columns of these names are replaced. A null or
    empty text is one empty line, which is never dropped; neither are lines of white space. Every
    row is a document, repeated rows too; rows are put into batches by the hash of their id.
    """
    runs = LineRuns(docs.sparkSession, min_docs)
    for batch in range(batches):
        own = docs.filter(F.pmod(F.xxhash64(F.col(f"`{doc_id}`")), F.lit(batches)) == batch)
        runs.add(own.select(F.col(f"`{text}`").alias("text")))
    return drop_lines(docs, runs.frequent(), doc_id, text)


def oracle(min_docs: int = 10) -> str:
    """The digest query in DuckDB's SQL."""
    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
with parts as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
lines as (
  select doc_id, unnest(ls) as line, unnest(range(len(ls))) as pos from parts),
keyed as (
  select *, translate(trim(line, {blank}), '{upper}', '{upper.lower()}') as k from lines),
often as (
  select k from keyed where k <> '' group by k having count(distinct doc_id) >= {min_docs})
select doc_id, count(*)::bigint as n_lines,
  count(*) filter (k in (select k from often))::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos)
    filter (k not in (select k from often)), '')) as kept_sha256
from keyed group by doc_id"""
