"""File listings as tables, and whole-file jobs over them."""

from __future__ import annotations

import hashlib
import heapq
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ampliframe.contracts import integer_argument, require_columns
from ampliframe.functions.labels import base_name, dir_name
from ampliframe.functions.scale import local_table, running_totals
from ampliframe.sources.ranges import open_filesystem, plain_name

_CHUNK = 4 << 20


def list_files(spark: SparkSession, root: str | list[str], glob: str | None = None) -> DataFrame:
    """Files below `root`: path, name, dir, size. Contents are never read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    listed = reader.load(root).select(
        F.regexp_replace("path", "^file:/+", "/").alias("path"), "length"
    )
    return listed.select(
        "path",
        base_name("path").alias("name"),
        dir_name("path").alias("dir"),
        F.col("length").alias("size"),
    )


class _Subtree(InputPartition):
    """Folders whose entries a task lists, with all below them or without."""

    def __init__(self, paths: list[str], deep: bool):
        self.paths, self.deep = paths, deep


class _ListingReader(DataSourceReader):
    def __init__(self, options):
        self._roots = [p for p in options.get("path", "").split("\n") if p]
        self._tasks = int(options.get("tasks", 32))

    def partitions(self):
        """Folders are opened level by level until there are enough of them to list in parallel."""
        done, level = [], [plain_name(p).rstrip("/") for p in self._roots]
        while level and len(level) < self._tasks:
            done += level
            level = [d["path"] for folder in level for d in _entries(folder, False) if d["is_dir"]]
        tasks = min(self._tasks, len(level))
        dealt = [_Subtree(level[i::tasks], True) for i in range(tasks)]
        return [_Subtree(done, False), *dealt]

    def read(self, partition: _Subtree):
        for path in partition.paths:
            rows = list(_entries(path, partition.deep))
            yield pa.RecordBatch.from_pylist(rows, schema=_ENTRY)


_ENTRY = pa.schema([("path", pa.string()), ("size", pa.int64()), ("is_dir", pa.bool_())])


def _entries(folder: str, deep: bool) -> Iterator[dict]:
    from pyarrow import fs

    filesystem, inner = open_filesystem(folder)
    for item in filesystem.get_file_info(fs.FileSelector(inner, recursive=deep)):
        is_dir = item.type == fs.FileType.Directory
        name = folder + item.path[len(inner.rstrip("/")) :]
        yield {"path": name, "size": None if is_dir else item.size, "is_dir": is_dir}


class ListingDataSource(DataSource):
    """`spark.read.format("listing")`: files and folders below some folders, one task a subtree."""

    @classmethod
    def name(cls):
        return "listing"

    def schema(self):
        return "path string, size bigint, is_dir boolean"

    def reader(self, schema):
        return _ListingReader(self.options)


def list_entries(
    spark: SparkSession, root: str | Sequence[str], tasks: int | None = None
) -> DataFrame:
    """Files and folders below `root`, empty folders too: path, name, dir, size, is_dir.

    The first levels of folders are opened while the job is planned, until there are `tasks` of
    them (four a core, unless given); they are dealt over as many tasks, which list all below. Takes every file
    system Arrow opens and keeps the scheme and host of the root. The root itself has no row.
    """
    spark.dataSource.register(ListingDataSource)
    wanted = tasks or 4 * spark.sparkContext.defaultParallelism
    reader = spark.read.format("listing").option("tasks", integer_argument(wanted, "tasks", 1))
    listed = reader.load(root if isinstance(root, str) else "\n".join(root))
    return listed.select(
        "path", base_name("path").alias("name"), dir_name("path").alias("dir"), "size", "is_dir"
    )


def list_directories(files: DataFrame, path: str = "path") -> DataFrame:
    """Every directory holding a file at any depth, as `dir`; of `list_entries`, all of them.

    Files are first reduced to their own directories, map-side, so a folder with much of the
    listing is expanded to its few ancestors only once per task.
    """
    place = dir_name(path)
    if "is_dir" in files.columns:
        place = F.when(F.col("is_dir"), F.col(path)).otherwise(place)
    own = files.filter(F.col(path).contains("/")).select(place.alias("dir")).distinct()
    ancestors = F.expr(
        "transform(sequence(1, length(dir) - length(replace(dir, '/', '')) + 1), "
        "k -> substring_index(dir, '/', k))"
    )
    return own.select(F.explode(ancestors).alias("dir")).filter("dir <> ''").distinct()


def _open(path: str):
    filesystem, inner = open_filesystem(path)
    return filesystem.open_input_stream(inner, compression=None)


def _chunks(path: str) -> Iterator[bytes]:
    with _open(path) as stream:
        while True:
            block = stream.read(_CHUNK)
            if not block:
                return
            yield block


def _md5(path: str) -> str:
    digest = hashlib.md5()
    for block in _chunks(path):
        digest.update(block)
    return digest.hexdigest()


def gzip_problem(blocks: Iterator[bytes]) -> str | None:
    """Why a gzip stream does not inflate to its end, None if it does."""
    inflater = zlib.decompressobj(wbits=31)
    seen = False
    try:
        for block in blocks:
            while block:
                if inflater.eof:
                    if not block.strip(b"\0"):
                        break
                    inflater = zlib.decompressobj(wbits=31)
                seen = True
                inflater.decompress(block, _CHUNK)
                block = inflater.unconsumed_tail or inflater.unused_data
    except zlib.error as exc:
        return str(exc)
    if not seen:
        return "empty file"
    return None if inflater.eof else "unexpected end of file"


def deal_by_size(files: DataFrame, tasks: int, path: str = "path", size: str = "size") -> DataFrame:
    """`files` with `task` (0 to tasks - 1), so that no task gets much more than its share of bytes.

    A share is the total over the tasks. The few files above a third of a share (three a task at
    most) are placed longest first, each into the task with least so far. All others are laid end
    to end, in an order of no meaning, and cut where the room that is left in the tasks ends, so
    none of these is ever sorted or brought to the driver. A task gets at most a third of a share
    more than a share, or than its large files. Missing sizes count as zero.
    """
    tasks = integer_argument(tasks, "tasks", 1)
    require_columns(files, [path, size], "the listing")
    bytes_ = F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("bigint")
    # an empty file costs a little too
    costed = files.withColumn("__cost", bytes_ + 1)
    total = costed.agg(F.sum("__cost")).first()[0] or 0
    share = total / tasks
    large = costed.filter(F.col("__cost") > share / 3).select(path, "__cost")
    load = [(0, t) for t in range(tasks)]
    placed = []
    for name, cost in sorted(map(tuple, large.collect()), key=lambda r: (-r[1], r[0])):
        least, t = heapq.heappop(load)
        placed.append((name, t))
        heapq.heappush(load, (least + cost, t))
    # the room of each task, one behind the other
    ends, at = [], 0.0
    for held, t in sorted(load, key=lambda x: x[1]):
        at += max(share - held, 0.0)
        ends.append(at)
    schema = T.StructType([T.StructField("__path", T.StringType()), T.StructField("__task", T.IntegerType())])
    spark = files.sparkSession
    # at most three rows a task
    own = costed.filter(F.col("__cost") > share / 3).join(
        F.broadcast(local_table(spark, placed, schema)), F.col(path) == F.col("__path")
    )
    small = running_totals(
        costed.filter(F.col("__cost") <= share / 3),
        group=[],
        chunk=[F.pmod(F.xxhash64(path), F.lit(256))],
        order=F.col(path),
        totals={"__before": F.col("__cost")},
    )
    cuts = F.array(*[F.lit(float(e)) for e in ends])
    behind = F.size(F.filter(cuts, lambda e: e <= F.col("__before")))
    dealt = small.withColumn("task", F.least(behind, F.lit(tasks - 1)))
    return dealt.select(*files.columns, "task").unionByName(
        own.select(*files.columns, F.col("__task").alias("task"))
    )


def _spread(files: DataFrame) -> DataFrame:
    """Paths by task, as many tasks as three a core, each with its share of the bytes."""
    tasks = 3 * files.sparkSession.sparkContext.defaultParallelism
    dealt = deal_by_size(files.select("path", "size"), tasks)
    return dealt.repartitionById(tasks, F.col("task")).select("path")


def md5_list(files: DataFrame, root: str, exclude: str | None = None) -> DataFrame:
    """md5 and path relative to `root` per file, in path order.

    Files are streamed in blocks by the tasks, so their size is not limited by memory; the digest
    of one file is sequential by nature. `exclude` is a regex on the relative path.
    """
    prefix = plain_name(root).rstrip("/") + "/"

    def digest(batches):
        for batch in batches:
            paths = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([_md5(p) for p in paths], pa.string()), pa.array(paths, pa.string())],
                names=["md5", "path"],
            )

    relative = F.substring("path", F.lit(len(prefix) + 1), F.length("path"))
    wanted = files.filter(F.col("path").startswith(prefix))
    if exclude:
        wanted = wanted.filter(~relative.rlike(exclude))
    return (
        _spread(wanted)
        .mapInArrow(digest, "md5 string, path string")
        .select("md5", relative.alias("path"))
        .orderBy("path")
    )


def write_md5_list(sums: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """md5 and path rows as text lines, two spaces between, in path order."""
    lines = sums.orderBy("path").select(F.concat_ws("  ", "md5", "path").alias("value"))
    lines.write.mode(mode).text(path)


def gzip_audit(files: DataFrame) -> DataFrame:
    """path, ok, error for every .gz file."""

    def check(batches):
        for batch in batches:
            paths = batch.column(0).to_pylist()
            problems = [gzip_problem(_chunks(p)) for p in paths]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(paths, pa.string()),
                    pa.array([p is None for p in problems], pa.bool_()),
                    pa.array(problems, pa.string()),
                ],
                names=["path", "ok", "error"],
            )

    compressed = files.filter(F.col("path").endswith(".gz"))
    return _spread(compressed).mapInArrow(check, "path string, ok boolean, error string")
