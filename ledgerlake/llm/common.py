"""Helpers shared by the operators: scratch tables, safe input columns, fold expressions."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the session's ``spark.checkpoint.dir``.

    Only where none is set and the master is local (tests) a temporary folder takes its place.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="scratch-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def settle(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written once to the shared folder and read back: a cut of the lineage.

    Later readers get the same rows even when executors are lost, and nothing is computed twice.
    The files go with the session, or earlier by ``discard``.
    """
    spark = frame.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    files, where = _file_system(spark, path)
    files.deleteOnExit(where)
    settled = spark.read.schema(frame.schema).parquet(path)
    settled._scratch_path = path
    return settled


def discard(frame: DataFrame | None) -> None:
    """Removes what ``settle`` wrote for ``frame``; no plan may read it afterwards."""
    path = getattr(frame, "_scratch_path", None)
    if path is not None:
        files, where = _file_system(frame.sparkSession, path)
        files.delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, an empty one for null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fold(column: str, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


#: Words of 64 bits in an id filter: the bound on what it broadcasts, 2^18 rows of two numbers.
FILTER_WORDS = 1 << 18


def _with_filter(rows: DataFrame, ids: DataFrame, column: str) -> tuple[DataFrame, Column]:
    """``rows`` with two columns more, and whether a row's id may be in ``ids(column)``.

    The ids become bits of a table of a fixed size, which is broadcast: whatever is not listed
    is told apart, but for a few, without shuffling the rows. A null id is never listed.
    """
    hashed = f"xxhash64(cast(`{column}` as string))"  # whatever kind of integer the id is
    word = F.expr(f"pmod({hashed}, {FILTER_WORDS})")
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned({hashed}, 58) as int))")
    bits = ids.groupBy(word.alias("__word")).agg(F.bit_or(bit).alias("__bits"))
    held = rows.join(F.broadcast(bits), word == F.col("__word"), "left")
    listed = F.coalesce(F.col("__bits").bitwiseAND(bit) != 0, F.lit(False)) & F.col(column).isNotNull()
    return held, listed


def with_ids(rows: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """The rows whose id is in ``ids(column)``; of the others few are shuffled.

    The exact join is none that Spark would move below the filter, as it does with a semi-join.
    """
    held, listed = _with_filter(rows, ids, column)
    return held.where(listed).select(*rows.columns).join(ids.distinct(), column).select(*rows.columns)


def without_ids(rows: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """The rows whose id is not in ``ids(column)``, null ids included; few are shuffled."""
    held, listed = _with_filter(rows, ids, column)
    marked = ids.distinct().withColumn("__listed", F.lit(True))
    rest = held.where(listed).select(*rows.columns).join(marked, column, "left").where("__listed is null")
    return held.where(~listed).select(*rows.columns).unionAll(rest.select(*rows.columns))


#: Rows in a batch that a task hands to Python, where the session allows more.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bounds the memory of batches: rows are whole documents here, not a few numbers."""
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def hand_back() -> None:
    """Gives what this process has freed back to the system: workers outlive their tasks.

    Arrow's pool and the C library keep freed memory for later; the next stage's tables would come on top of it.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim is not None:
        trim(0)


def map_arrow(
    frame: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` for a function of one batch that yields batches."""
    small_batches(frame.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)
        hand_back()

    return frame.mapInArrow(run, schema)


def spans_of_texts(texts: list[str], most_chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of ``texts`` of at most ``most_chars`` characters, or one text alone."""
    begin, size = 0, 0
    for k, text in enumerate(texts):
        if k > begin and size + len(text) > most_chars:
            yield begin, k
            begin, size = k, 0
        size += len(text)
    if texts:
        yield begin, len(texts)


def empty_frame(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
