"""Result tables: written by a job, read back by the next, and replaced as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from cartspark.sources.versions import new_version, version_folder

# A null is written as a mark of its own, so that an empty text stays one.
CSV_OPTIONS = {"header": True, "nullValue": "\\N"}


def write_result(df: DataFrame, base: str, name: str, fmt: str = "parquet", *, tiny: bool = False) -> str:
    """Replace the result table ``base/name`` and return the folder of its files.

    Readers have the old table until the new one is complete, and keep it if the write fails. ``tiny`` is for results of
    a few rows, which get one file.
    """
    with new_version(df.sparkSession, f"{base.rstrip('/')}/{name}") as version:
        return write_table(df, version.folder, fmt, tiny=tiny)


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", *, tiny: bool = False, partition_by: tuple[str, ...] = ()
) -> str:
    """Overwrite a table that nobody else reads meanwhile."""
    out = df.coalesce(1) if tiny else df
    if fmt == "csv":
        # CSV has no arrays or maps: those columns become JSON text.
        nested = (T.ArrayType, T.MapType, T.StructType)
        out = out.select(
            *(
                F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
                for f in out.schema
            )
        )
    writer = out.write.mode("overwrite").partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    writer.format(fmt).save(path)
    return path


def read_result(
    spark: SparkSession, base: str, name: str, fmt: str = "parquet", schema: str | T.StructType | None = None
) -> DataFrame:
    """The table ``base/name`` as it is now. A missing one raises ``FileNotFoundError``, an empty one is an empty frame.

    A table of plain files, without versions, is read as it is.
    """
    path = f"{base.rstrip('/')}/{name}"
    try:
        path = version_folder(spark, path)
    except FileNotFoundError:
        pass
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS, emptyValue="")
    try:
        return reader.load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(path) from error
        raise
