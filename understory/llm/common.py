"""Shared pieces of the training-data operators: columns from texts, saved tables, components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Bytes of an Arrow batch of texts: what a Python worker and its executor buffer.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded(spark: SparkSession) -> SparkSession:
    """The session, with Arrow batches of BATCH_BYTES at most from here on (rows over that come alone)."""
    if _bytes(spark.conf.get(_BATCH)) > BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    return spark


def _bytes(size: str) -> int:
    units = {"b": 0, "k": 10, "kb": 10, "m": 20, "mb": 20, "g": 30, "gb": 30}
    number = size.rstrip("bkmgBKMG")
    value = int(number) << units.get(size[len(number) :].lower() or "b", 0)
    return value if value > 0 else 1 << 62


_held: dict = {}


def held(key: object, make: Callable[[], object]) -> object:
    """A large object that a Python worker keeps between tasks: the last one asked for only."""
    if key not in _held:
        _held.clear()
        release()
        _held[key] = make()
    return _held[key]


def release() -> None:
    """Give memory that is free in this process back to the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of a task, with release() at its end."""
    try:
        yield from batches
    finally:
        release()


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """df.mapInArrow with bounded batches and memory given back at a task's end."""
    bounded(df.sparkSession)
    return df.mapInArrow(lambda batches: trimmed(function(batches)), schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Only where that is unset on one machine (tests) a folder is made and set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        made = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not made.isDefined() and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = made.get() if made.isDefined() else "file://" + tempfile.mkdtemp(prefix="understory-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as make it a new one for df."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
        taken.add(name.lower())
    return out


def keyed(docs: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, str]:
    """docs with a number for each row, and that column's name: the id where all are there and differ, else one by storage."""
    (key,) = fresh(docs, "_key")
    counts = docs.select(F.col(id_col).cast("long").alias("i")).groupBy("i").count()
    counts = counts.agg(F.max("count"), F.max(F.col("i").isNull().cast("int"))).first()
    if (counts[0] or 1) == 1 and not counts[1]:
        return docs.withColumn(key, F.col(id_col).cast("long")), key
    return saved(docs.withColumn(key, F.monotonically_increasing_id()), "numbered"), key


#: Narrow rows that a file of a table holds where their number is known beforehand.
FILE_ROWS = 200_000


def saved(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """df written as Parquet in the shared folder and read again: lineage ends there.

    The files outlive executors; a lost task reads them again; they go when the driver
    ends.  rows: a bound of the number of (narrow) rows, for no more files than they need.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // FILE_ROWS)))
    path = f"{shared_folder(spark)}/understory/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _folder(spark, path, lambda files, place: files.deleteOnExit(place))
    return spark.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str, act: Callable) -> None:
    """Call act with a folder's file system and place."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    act(place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place)


def drop_saved(df: DataFrame) -> None:
    """Delete the files of a table from saved() that nothing reads any more."""
    for file in df.inputFiles()[:1]:
        _folder(df.sparkSession, file.rsplit("/", 1)[0], lambda files, place: files.delete(place, True))


def with_text_columns(
    docs: DataFrame,
    text_col: str,
    fields: Sequence[T.StructField],
    kernel: Callable[[], Callable[[pa.Array], list[pa.Array]]],
    where: str | None = None,
) -> DataFrame:
    """docs and the columns that a kernel makes from whole Arrow arrays of texts.

    kernel() is called once a task and gives the function for batches.  Input columns
    that have the name of a made column are left out.  where: a made boolean column
    that rows must hold true in; it is not returned.
    """
    made = {f.name for f in fields}
    kept = [f for f in docs.schema.fields if f.name not in made]
    out = [*kept, *(f for f in fields if f.name != where)]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = kernel()
        for batch in batches:
            if not batch.num_rows:
                continue
            new = dict(zip([f.name for f in fields], function(batch.column(text_col)), strict=True))
            table = pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), *(a for n, a in new.items() if n != where)],
                names=[*names, *(n for n in new if n != where)],
            )
            yield table.filter(new[where]) if where else table

    return map_arrow(docs, run, T.StructType(out))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over undirected edges, for every node of an edge.

    Alternating large-star and small-star rounds in DataFrame operations; each round
    is written to the shared folder.  Nothing but two counters reaches the driver.
    Edges with a null end are left out; an edge to itself names a lone node.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current = saved(pairs, "edges")
    alone = current.where("u = v").select(F.col("u").alias("node"), F.col("v").alias("component"))
    first = current
    current = current.where("u <> v")
    state, before = _state(current), None
    while state[0]:
        both = current.select("u", "v").unionAll(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        # small star: every node has only smaller neighbours now
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = small.unionAll(least.select("u", F.col("m").alias("v"))).distinct()
        previous, current = before, saved(small, "edges", state[0])
        if previous is not None:
            drop_saved(previous)
        before, now = current, _state(current)
        if now == state:
            break
        state = now
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    lone = alone.join(first.where("u <> v").select(F.explode(F.array("u", "v")).alias("node")).distinct(), "node", "left_anti")
    return stars.unionAll(centres).unionAll(lone)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
