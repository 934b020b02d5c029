"""Tables in versions, each a manifest of data files with the least and greatest value of one column.

A change writes new files beside the old ones and a new manifest; a file that it does not touch is named again.
Old versions stay readable. A reader or a failed change never sees half of one: the manifest is written last.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyfold.session import scratch_path, until_end

#: Rows of a data file, about.
FILE_ROWS = 1_000_000
#: File name, rows, least and greatest value, and rows without a value.
MANIFEST = ["file", "rows", "least", "greatest", "unknown"]


@dataclass(frozen=True)
class Version:
    """One version of a table below ``root``, whose files are known by their values of ``column``."""

    spark: SparkSession
    root: str
    column: str
    schema: StructType
    number: int

    def manifest(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/manifest/v={self.number:08d}")

    def files(self) -> list[str]:
        """The names of the data files; as Spark's own file index, one string a file on the driver."""
        return [r["file"] for r in self.manifest().select("file").collect()]

    def rows(self) -> DataFrame:
        files = self.files()
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*files)


def _listed(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Manifest rows of the files just written below ``path``; reads one column."""
    return spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), F.min(column).alias("least"), F.max(column).alias("greatest"),
        F.count_if(F.col(column).isNull()).alias("unknown"))


def _published(version: Version, manifest: DataFrame) -> Version:
    manifest.select(*MANIFEST).coalesce(1).write.mode("error").parquet(f"{version.root}/manifest/v={version.number:08d}")
    return version


def create(df: DataFrame, column: str, root: str | None = None, file_rows: int = FILE_ROWS) -> Version:
    """The first version of a table: ``df`` in files along ``column``.

    Rows are dealt by ranges of the column, so few files hold rows at both sides of a later cut. Without ``root`` the
    table lies in the scratch folder until the application ends.
    """
    spark = df.sparkSession
    path = root or scratch_path(spark, "versions")
    version = Version(spark, path, column, df.schema, 0)
    data = f"{path}/data/{uuid.uuid4().hex}"
    df.repartitionByRange(column).write.option("maxRecordsPerFile", file_rows).parquet(data)
    if root is None:
        until_end(spark, path)
    return _published(version, _listed(spark, data, column))


def delete_before(version: Version, bound) -> tuple[Version, int]:
    """A new version without the rows whose column is below ``bound``, and how many these were.

    Rows without a value stay. Files with no such row are not read; those of nothing else are dropped, counted by the
    manifest; only those in between are read, once. The rows that went are those of the old manifest but not of the new.
    """
    spark, column, limit = version.spark, version.column, F.lit(bound).cast(version.schema[version.column].dataType)
    old = version.manifest()
    doomed = F.coalesce(F.col("least") < limit, F.lit(False))
    whole = doomed & (F.col("greatest") < limit) & (F.col("unknown") == 0)
    cut = [r["file"] for r in old.filter(doomed & ~whole).select("file").collect()]
    manifest = old.filter(~doomed)
    if cut:
        data = f"{version.root}/data/{uuid.uuid4().hex}"
        gone = F.coalesce(F.col(column) < limit, F.lit(False))
        spark.read.schema(version.schema).parquet(*cut).filter(~gone).write.parquet(data)
        manifest = manifest.unionByName(_listed(spark, data, column))
    new = _published(replace(version, number=version.number + 1), manifest)
    before, after = (m.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0] for m in (old, new.manifest()))
    return new, before - after
