"""Batch readers. A schema is explicit unless the caller asks for inference."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType


#: Bytes of files up to which ``spread`` deals rows out anew.
SPREAD_BYTES = 64 << 20


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per text line, in column ``value``."""
    return spark.read.text(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows of a small file scan over as many tasks as run at once.

    One small file, which may hold a single row group, would leave the heavy work on each
    row to one task. Above ``SPREAD_BYTES`` a scan is left as it is: it has splits
    enough, so a large table is never shuffled for this.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks) if size <= SPREAD_BYTES else df


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    header: bool = False,
    sep: str = ",",
) -> DataFrame:
    """Delimited files. Without a schema the types are inferred in an extra pass.

    For a file without a header the schema also names the columns by position.
    """
    reader = spark.read.option("sep", sep).option("header", header)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_jsonl(spark: SparkSession, path: str | list[str], schema: StructType | str) -> DataFrame:
    """One JSON object per line."""
    return spark.read.schema(schema).json(path)


def read_json_array(
    spark: SparkSession, path: str | list[str], schema: StructType | str
) -> DataFrame:
    """Files that each hold one JSON array of objects.

    Such a file cannot be split, so one task parses a whole file: cut a large
    export into many files, or convert it to JSON lines at its origin.
    """
    return spark.read.schema(schema).option("multiLine", True).json(path)


def from_collection(spark: SparkSession, rows: Iterable, schema: StructType | str) -> DataFrame:
    """A small default input held by the program itself."""
    return spark.createDataFrame(list(rows), schema)


def read_years(spark: SparkSession, paths: list[str], schema: StructType | str) -> DataFrame:
    """Yearly CSV files with a header as one frame, in a single scan."""
    return read_csv(spark, paths, schema, header=True)


def folder_values(spark: SparkSession, root: str, column: str) -> list[str]:
    """Values of a partition column, from the names of the folders below ``root``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def _as_schema(spark: SparkSession, schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema


def read_year_folders(
    spark: SparkSession, root: str, schema: StructType | str, years: Sequence[int] | None = None,
    column: str = "year",
) -> DataFrame:
    """Parquet files in a folder per year as one frame, in a single scan.

    Columns are matched by name: one that the files of a year lack is null there, one that
    ``schema`` lacks is not read. ``years`` leaves the other folders unlisted; a year
    without a folder has no rows, and no folder at all gives an empty frame.
    """
    full = StructType([*_as_schema(spark, schema).fields]).add(column, IntegerType())
    found = [y for y in folder_values(spark, root, column) if years is None or int(y) in years]
    if not found:
        return spark.createDataFrame([], full)
    paths = [f"{root}/{column}={y}" for y in found]
    return spark.read.schema(full).option("basePath", root).parquet(*paths)


def read_drifting_csv(
    spark: SparkSession, paths: Sequence[str], schema: StructType | str, sep: str = ",",
    base: str | None = None,
) -> DataFrame:
    """CSV files or folders whose headers differ from path to path, as one frame.

    Spark matches CSV columns by position, so the header of each path is read first (one
    line), paths of equal headers are read in one scan, and the scans are united by
    name. Columns missing in a header are null, those that ``schema`` lacks are left out,
    and a path without a line has no rows. All files of one path have its first
    header. Below ``base`` partition columns are found in the names of folders.
    """
    wanted = _as_schema(spark, schema)
    kinds = {f.name: f.dataType for f in wanted}
    layouts: dict[str, list[str]] = defaultdict(list)
    for path in paths:
        first = spark.read.text(path).select("value").first()
        if first is not None:
            layouts[first["value"].removeprefix("\ufeff")].append(path)
    frames = []
    for header, group in layouts.items():
        names = [n.strip().strip('"') for n in header.split(sep)]
        found = StructType([StructField(n, kinds.get(n, StringType())) for n in names])
        reader = spark.read.option("header", True).option("sep", sep)
        frame = (reader.option("basePath", base) if base else reader).schema(found).csv(group)
        frames.append(frame.drop(*[n for n in names if n not in kinds]))
    empty = spark.createDataFrame([], wanted)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames, empty)


def first_n_in_files(
    spark: SparkSession, folder: str, n: int, schema: StructType | str | None = None
) -> DataFrame:
    """First ``n`` rows of the Parquet files below ``folder``, by file name and row within the file.

    Rows are counted from the footers, over groups of files that double in size until ``n``
    is reached. Files before the crossing one are read whole, that one is cut by its row
    index, and those behind it are not opened. The result is not sorted; with fewer rows
    than ``n`` it is the whole table, and without rows or with ``n`` = 0 it is empty.
    """
    path, uri = spark._jvm.org.apache.hadoop.fs.Path, spark._jvm.java.net.URI
    table = (spark.read if schema is None else spark.read.schema(schema)).parquet(folder)

    def read(files: list[str]) -> DataFrame:
        return spark.read.schema(table.schema).option("basePath", folder).parquet(*files)

    def plain(name: str) -> str:
        return path(uri(name)).toString()

    files, whole, parts = sorted(table.inputFiles()), [], []
    left, at, step = n, 0, spark.sparkContext.defaultParallelism
    while left > 0 and at < len(files):
        group = [plain(f) for f in files[at : at + step]]
        counts = read(group).groupBy(F.col("_metadata.file_path").alias("file")).count().collect()
        rows = {plain(r["file"]): r["count"] for r in counts}
        for file in group:
            if rows.get(file, 0) > left:
                parts.append(read([file]).filter(F.col("_metadata.row_index") < left))
                left = 0
            if left == 0:
                break
            whole.append(file)
            left -= rows.get(file, 0)
        at, step = at + step, step * 2
    if whole:
        parts.insert(0, read(whole))
    return reduce(DataFrame.unionByName, parts) if parts else table.limit(0)


def parse_json_records(
    df: DataFrame, schema: StructType | str, column: str = "value"
) -> DataFrame:
    """JSON text to typed columns beside the other columns of ``df``.

    A field of the wrong type becomes null on its own. A text that is no JSON
    object is dropped.
    """
    keep = [c for c in df.columns if c != column]
    return (
        df.filter(F.json_object_keys(column).isNotNull())
        .withColumn("_record", F.from_json(column, schema, {"mode": "PERMISSIVE"}))
        .select(*keep, "_record.*")
    )
