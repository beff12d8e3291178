"""Shared helpers of the training-data operators: table readers, Arrow streaming, staged tables."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskline.session import checkpoint_dir

#: White space of the contracts, as a regular-expression class body.
SPACE_CLASS = r"\x20\x09-\x0D"
#: Spark's setting that removes a query's shuffle files when it ends; a staged table is never computed again.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of a batch that Spark hands to a Python task; rows and text bytes that a task handles at once.
ARROW_BYTES = 8 << 20
SLICE_ROWS = 2_000
SLICE_BYTES = 2 << 20


def bound_batches(spark: SparkSession) -> None:
    """Let Spark hand texts to Python tasks in batches of at most ARROW_BYTES (its default is eight times as much)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("bB")) > ARROW_BYTES:
        spark.conf.set(key, str(ARROW_BYTES))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the data set; only Spark opens the path."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: str, rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds at most ``rows`` rows and about ``size`` bytes of ``column``.

    A single longer text is a slice of its own; texts are never cut.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and (held + n > size or i - start >= rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def give_back() -> None:
    """Return freed memory to the system: Spark keeps idle Python workers beside the executor's JVM."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other systems have no malloc_trim
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that gives freed memory back when its task ends."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return wrapped


def stream(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, text: str = "text") -> DataFrame:
    """``mapInArrow`` in bounded slices; ``work`` maps one slice to one record batch."""

    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            yield work(part)

    return df.mapInArrow(tidy(run), schema)


class Scratch:
    """Staged Parquet tables in the shared checkpoint folder: cut lineage, read back pruned, dropped when consumed."""

    def __init__(self, spark: SparkSession, name: str):
        bound_batches(spark)
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def _path(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def write(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Write ``df`` once and return a reader of the written table (empty tables keep their schema)."""
        self.n += 1
        path = f"{self.root}/{self.n:03d}-{name}"
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.mode("overwrite").parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        if self.n == 1:
            fs, p = self._path(self.root)
            fs.deleteOnExit(p)
        out = self.spark.read.schema(schema).parquet(path)
        out.staged_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete staged tables that nothing reads any more."""
        for t in tables:
            fs, p = self._path(t.staged_path)
            fs.delete(p, True)


def hex_digest(column) -> F.Column:
    return F.lower(F.hex(column))
