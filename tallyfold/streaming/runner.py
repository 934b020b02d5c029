"""Sinks for streaming frames.

Each runner processes what is available and stops; a service passes another
trigger. A runner given a folder keeps its checkpoint and its results there, so the
next start goes on where the last one stopped; without one it uses a new folder below
the shared one. Batch sinks write to a folder named by the batch id, so a batch run
again after a failure replaces its own output and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tallyfold.session import release, scratch_path

Transform = Callable[[DataFrame], DataFrame]
BATCH = "batch"


def _start(writer: DataStreamWriter, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        writer.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def batch_folder(root: str, batch_id: int) -> str:
    return f"{root}/{BATCH}={batch_id:012d}"


def written_batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batch folders below ``path``, in order."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BATCH}="))


def run_append(
    df: DataFrame, label: str, fmt: str = "parquet", trigger: dict | None = None,
    root: str | None = None, path: str | None = None, **options
) -> DataFrame:
    """Append rows to files and read all of them back.

    ``path`` is where the files go (default: ``out`` below ``root``), ``options`` those of
    the format: a separator for CSV, ``maxRecordsPerFile`` for files of bounded length.
    """
    spark = df.sparkSession
    root = root or scratch_path(spark, label)
    path = path or f"{root}/out"
    writer = df.writeStream.outputMode("append").format(fmt).options(**options)
    _start(writer.option("path", path), f"{root}/checkpoint", trigger).awaitTermination()
    return spark.read.schema(df.schema).format(fmt).options(**options).load(path)


def run_console(
    df: DataFrame, output_mode: str = "append", trigger: dict | None = None, root: str | None = None
) -> None:
    """Print each batch."""
    root = root or scratch_path(df.sparkSession, "console")
    _start(df.writeStream.outputMode(output_mode).format("console"), root, trigger).awaitTermination()


def run_batches(
    df: DataFrame, label: str, output_mode: str, each: Callable[[DataFrame, int, str], None],
    trigger: dict | None = None, root: str | None = None,
) -> str:
    """Call ``each(batch, batch_id, root)`` per micro-batch; returns root."""
    root = root or scratch_path(df.sparkSession, label)

    def step(batch: DataFrame, batch_id: int) -> None:
        each(batch, batch_id, root)

    writer = df.writeStream.outputMode(output_mode).foreachBatch(step)
    _start(writer, f"{root}/checkpoint", trigger).awaitTermination()
    return root


def _write_batch(batch: DataFrame, batch_id: int, root: str) -> None:
    batch.write.mode("overwrite").parquet(batch_folder(f"{root}/out", batch_id))


def read_batches(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", **options
) -> DataFrame:
    """Rows of all batch folders, beside their batch number."""
    schema = StructType([*schema.fields, StructField(BATCH, LongType())])
    if not written_batches(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).options(**options).load(path)


def run_changelog(
    df: DataFrame, label: str, trigger: dict | None = None, root: str | None = None
) -> DataFrame:
    """Every update of every micro-batch, beside its batch number."""
    root = run_batches(df, label, "update", _write_batch, trigger, root)
    return read_batches(df.sparkSession, f"{root}/out", df.schema)


def run_complete(
    df: DataFrame, label: str, trigger: dict | None = None, root: str | None = None
) -> DataFrame:
    """The last full result of a complete-mode query; that and the one before are kept."""
    spark = df.sparkSession

    def each(batch: DataFrame, batch_id: int, root: str) -> None:
        _write_batch(batch, batch_id, root)
        for old in written_batches(spark, f"{root}/out"):
            if old < batch_id - 1:
                release(spark, batch_folder(f"{root}/out", old))

    root = run_batches(df, label, "complete", each, trigger, root)
    done = written_batches(spark, f"{root}/out")
    if not done:
        return spark.createDataFrame([], df.schema)
    return spark.read.schema(df.schema).parquet(batch_folder(f"{root}/out", done[-1]))


@dataclass(frozen=True)
class Sink:
    """A named result of each micro-batch: its rows, and how and where they are written."""

    name: str
    transform: Transform
    fmt: str = "parquet"
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)


def multi_sink(
    df: DataFrame, sinks: Sequence[Sink | tuple[str, Transform]], label: str = "sinks",
    trigger: dict | None = None, root: str | None = None,
) -> dict[str, DataFrame]:
    """One scan of the source feeding several named results.

    The micro-batch is kept, on disk if need be, while all transforms read it, so the source
    is read once per batch; its size is set by the limits of the source (files or
    offsets per trigger). Windows over the stream have a state of their own and go
    beside it: see ``run_all``.
    """
    sinks = [s if isinstance(s, Sink) else Sink(*s) for s in sinks]

    def target(sink: Sink, root: str) -> str:
        return sink.path or f"{root}/{sink.name}"

    def write(batch: DataFrame, batch_id: int, root: str) -> None:
        batch.persist()
        try:
            for sink in sinks:
                rows = sink.transform(batch).write.mode("overwrite").format(sink.fmt).options(**sink.options)
                rows.save(batch_folder(target(sink, root), batch_id))
        finally:
            batch.unpersist()

    spark = df.sparkSession
    empty = spark.createDataFrame([], df.schema)
    root = run_batches(df, label, "append", write, trigger, root)
    return {
        s.name: read_batches(
            spark, target(s, root), s.transform(empty).schema, s.fmt, **s.options).drop(BATCH)
        for s in sinks
    }


@dataclass(frozen=True)
class Branch:
    """A streaming frame of its own, such as a window, with its sink."""

    name: str
    frame: DataFrame
    output_mode: str = "append"
    fmt: str = "parquet"
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)


class BranchFailed(RuntimeError):
    """A running branch ended with an error; ``branch`` names it, ``__cause__`` is the error."""

    def __init__(self, branch: str, cause: Exception | None) -> None:
        super().__init__(f"branch {branch!r} failed: {cause}")
        self.branch = branch


def supervise(running: Mapping[str, StreamingQuery], poll: float = 1.0) -> None:
    """Wait until all queries have ended; as soon as one fails, stop the others.

    Under a trigger without an end a query waited for alone would hide the failure of the
    next, so all are looked at every ``poll`` seconds. Raises ``BranchFailed`` after the
    others have been stopped; they go on from their checkpoints when started again.
    """
    waiting = dict(running)
    try:
        while waiting:
            for name, query in list(waiting.items()):
                if not query.isActive:
                    error = query.exception()
                    if error is not None:
                        raise BranchFailed(name, error) from error
                    del waiting[name]
            if waiting:
                try:
                    next(iter(waiting.values())).awaitTermination(poll)
                except StreamingQueryException:
                    pass  # named by the next look
    finally:
        stop_all(waiting.values())


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


def run_all(
    branches: Sequence[Branch], label: str = "branches", trigger: dict | None = None,
    root: str | None = None,
) -> dict[str, DataFrame]:
    """Start several branches of a source in one submission and watch all of them.

    If one cannot start or fails, the others are stopped (see ``supervise``). Each has its checkpoint below ``root``. Returns what the file sinks hold; the console
    format shows its rows and has no result.
    """
    if len({b.name for b in branches}) < len(branches):
        raise ValueError("branches need names of their own")
    spark = branches[0].frame.sparkSession
    root = root or scratch_path(spark, label)
    started = {}
    try:
        for b in branches:
            writer = b.frame.writeStream.outputMode(b.output_mode).format(b.fmt).options(**b.options)
            if b.fmt != "console":
                writer = writer.option("path", b.path or f"{root}/{b.name}")
            started[b.name] = _start(writer, f"{root}/checkpoint-{b.name}", trigger)
    except Exception:
        stop_all(started.values())
        raise
    supervise(started)
    return {
        b.name: spark.read.schema(b.frame.schema).format(b.fmt).options(**b.options).load(
            b.path or f"{root}/{b.name}")
        for b in branches if b.fmt != "console"
    }
