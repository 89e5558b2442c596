"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Words are maximal runs of anything but space and the control characters tab to carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables; only Spark opens the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def no_cycle_collection() -> Iterator[None]:
    """For tasks that hold millions of strings: they form no cycles, and looking for some costs a seventh of the time."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``max_bytes`` of ``column`` (one row at least).

    Spark sizes Arrow batches by rows; texts vary from nothing to megabytes, and
    the arrays a task builds over a batch are several times its bytes.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = max(1, batch.column(batch.schema.get_field_index(column)).nbytes)
        step = max(1, min(batch.num_rows, batch.num_rows * max_bytes // size))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def map_text(
    df: DataFrame,
    keep: list[str],
    text: str,
    make: Callable[[], Callable[[list[str] | pa.Array], dict[str, pa.Array]]],
    schema: str,
    max_bytes: int = 4_000_000,
    as_array: bool = False,
    after: Callable[[], None] | None = None,
) -> DataFrame:
    """Run ``make()(texts)`` over slices of ``text`` and return ``keep`` plus its columns.

    ``make`` is called once per task, so tables a task needs are built there. Null
    texts arrive as empty strings; with ``as_array`` texts are an Arrow array as it came.
    ``after`` is called at a task's end: workers are reused, and what they keep adds to other stages' memory.
    """
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with no_cycle_collection():
            work = make()
            for part in slices(batches, text, max_bytes):
                texts = part.column(part.schema.get_field_index(text))
                made = work(texts if as_array else [t or "" for t in texts.to_pylist()])
                kept = [part.column(part.schema.get_field_index(k)) for k in keep]
                yield pa.RecordBatch.from_arrays([*kept, *(made[n] for n in names)], names=[*keep, *names])
            if after is not None:
                after()

    kinds = dict(df.dtypes)
    full = ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), schema])
    return df.select(*dict.fromkeys([*keep, text])).mapInArrow(run, full)


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; local sessions without it get one of their own."""
    set_before = spark.sparkContext._jsc.sc().getCheckpointDir()
    shared = spark.conf.get("spark.checkpoint.dir", None) or (set_before.get() if set_before.isDefined() else None)
    if not shared:
        import tempfile

        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")

        shared = tempfile.mkdtemp(prefix="bedside-checkpoint-")
        spark.sparkContext.setCheckpointDir(shared)
    return shared


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later reads don't recompute it."""
    import uuid

    spark = df.sparkSession
    at = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def remove_written(*frames: DataFrame) -> None:
    """Delete what ``written`` made for each frame once nothing reads it any more."""
    for df in frames:
        _remove(df)


def _remove(df: DataFrame) -> None:
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

