"""Rows of text files that a scan can not read as they are: found, named and counted.

A reader of events turns a cell that it can not read into a null and goes on. Here the same lines are read with their
faults: which lines, which cells, and why. A CSV line is cut by the CSV reader itself, so quotes count as they do there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartspark.functions import to_long
from cartspark.sources.events import EVENT_SCHEMA, TEXT_SCHEMA, require_columns

# Reasons, in the order in which a row's are listed.
NO_OBJECT, SURPLUS, MISSING = "no json object", "surplus cells", "missing cells"
BROKEN = "_broken"


def not_a_number(name: str) -> str:
    return f"{name} is no whole number"


def scan_rows(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Every row of a csv or json scan: file, the event columns as text, ``faults`` (a list) and the broken ``line``.

    ``line`` is the line itself where its shape is wrong; a row with readable cells has none. One pass, no shuffle.
    """
    if fmt == "csv":
        header = spark.read.option("header", True).csv(path).schema
        require_columns(spark.createDataFrame([], header))
        schema = T.StructType([*header.fields, T.StructField(BROKEN, T.StringType())])
        raw = (
            # All cells are parsed whichever are used, or the shape of a line would go unseen.
            spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("columnPruning", False)
            .option("columnNameOfCorruptRecord", BROKEN).option("mode", "PERMISSIVE").csv(path)
        )
        # The reader keeps a line whose cells are too few or too many; commas outside of quotes tell which.
        cells = F.regexp_count(F.regexp_replace(BROKEN, r'"(?:[^"\\]|\\.|"")*"', ""), F.lit(",")) + 1
        wrong = F.when(cells > len(header.fields), F.lit(SURPLUS)).otherwise(F.lit(MISSING))
        shape = F.when(F.col(BROKEN).isNotNull(), wrong)
    elif fmt == "json":
        schema = T.StructType([*TEXT_SCHEMA.fields, T.StructField(BROKEN, T.StringType())])
        raw = spark.read.schema(schema).option("columnNameOfCorruptRecord", BROKEN).json(path)
        shape = F.when(F.col(BROKEN).isNotNull(), F.lit(NO_OBJECT))
    else:
        raise ValueError("only csv and json rows can be broken")
    names = [name for name in EVENT_SCHEMA.names if name in raw.columns]
    numbers = [name for name in names if name != "event"]
    faults = F.array_compact(F.array(shape, *(F.when(_unread(name), F.lit(not_a_number(name))) for name in numbers)))
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        *names,
        F.when(shape == NO_OBJECT, F.array(F.lit(NO_OBJECT))).otherwise(faults).alias("faults"),
        F.col(BROKEN).alias("line"),
    )


def _unread(name: str) -> Column:
    """A cell that has text, and no whole number in it."""
    return F.col(name).isNotNull() & to_long(F.col(name), T.StringType()).isNull()


def rejected_rows(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The rows with a fault: file, cells as text, faults and the broken line."""
    return scan_rows(spark, path, fmt).filter(F.size("faults") > 0)


def fault_counts(rows: DataFrame) -> DataFrame:
    """Rows per fault, and all rows under the fault null; a row with two faults is counted under both."""
    each = F.explode_outer(F.concat(F.array(F.lit(None).cast("string")), F.col("faults"))).alias("fault")
    return rows.select(each).groupBy("fault").agg(F.count(F.lit(1)).alias("row_count"))
