import os

import pytest
from pyspark.sql import functions as F

from cartspark import plans
from cartspark.plans.jobs import SUMMARY
from cartspark.sources import (
    canonical_events,
    new_version,
    read_pointer,
    read_result,
    version_folder,
    write_pointer,
    write_result,
    write_table,
)

LOG = "/root/testdata/sf0.001/events.parquet"


def values(df):
    return sorted(row[0] for row in df.collect())


def numbers(spark, *n):
    return spark.createDataFrame([(i,) for i in n], "n long")


def failing(spark):
    """Some tasks write rows before one fails."""
    return spark.range(0, 100, 1, 4).select(F.when(F.col("id") < 75, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("n"))


def test_reader_has_the_old_table_until_the_new_one_is_complete(spark, folder):
    write_result(numbers(spark, 1, 2), folder, "r")
    with new_version(spark, f"{folder}/r") as version:
        write_table(numbers(spark, 3), version.folder)
        assert values(read_result(spark, folder, "r")) == [1, 2]
    assert values(read_result(spark, folder, "r")) == [3]


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_failed_write_leaves_the_old_table(spark, folder, fmt):
    write_result(numbers(spark, 1, 2), folder, "r", fmt)
    with pytest.raises(Exception, match="lost"):
        write_result(failing(spark), folder, "r", fmt)
    assert values(read_result(spark, folder, "r", fmt, "n long")) == [1, 2]
    write_result(numbers(spark, 5), folder, "r", fmt)
    assert values(read_result(spark, folder, "r", fmt, "n long")) == [5]


def test_a_reader_that_has_begun_can_finish(spark, folder):
    write_result(numbers(spark, 1, 2), folder, "r")
    begun = read_result(spark, folder, "r")
    write_result(numbers(spark, 3), folder, "r")
    assert values(begun) == [1, 2]


def test_what_a_crashed_writer_left_is_removed(spark, folder):
    write_result(numbers(spark, 1), folder, "r")
    # A crash: files are there, the pointer is not.
    write_table(numbers(spark, 9), f"{folder}/r/_version-000000000002-crashed")
    assert values(read_result(spark, folder, "r")) == [1]
    for n in (2, 3, 4):
        write_result(numbers(spark, n), folder, "r")
    assert values(read_result(spark, folder, "r")) == [4]
    assert len([name for name in os.listdir(f"{folder}/r") if name.startswith("_version")]) == 2
    assert len([name for name in os.listdir(f"{folder}/r/_pointers") if name.endswith(".json") and name[0] != "."]) == 2


def test_second_writer_is_refused(spark, folder):
    with pytest.raises(FileExistsError):
        with new_version(spark, f"{folder}/r") as slow:
            write_table(numbers(spark, 1), slow.folder)
            with new_version(spark, f"{folder}/r") as fast:
                write_table(numbers(spark, 2), fast.folder)
    assert values(spark.read.parquet(version_folder(spark, f"{folder}/r"))) == [2]


def test_pointer_has_content(spark, folder):
    assert read_pointer(spark, folder) is None
    write_pointer(spark, folder, 1, {"ä": [1, None]})
    write_pointer(spark, folder, 2, {"b": 2})
    assert read_pointer(spark, folder) == (2, {"b": 2})
    with pytest.raises(FileExistsError):
        write_pointer(spark, folder, 2, {})
    with pytest.raises(FileNotFoundError):
        version_folder(spark, f"{folder}/absent")


def test_plain_table_is_read_as_it_is(spark, folder):
    write_table(numbers(spark, 7), f"{folder}/r")
    assert values(read_result(spark, folder, "r")) == [7]


def test_serving_while_the_batch_job_writes(spark, folder):
    events = canonical_events(spark.read.parquet(LOG))
    plans.batch_report(spark, events, folder)
    plans.speed_report(spark, events, folder)
    before = plans.serving_report(spark, folder)[0].collect()
    broken = events.withColumn("event", F.when(F.col("itemid") < 90, F.col("event")).otherwise(F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        plans.batch_report(spark, broken, folder)
    assert plans.serving_report(spark, folder)[0].collect() == before
    plans.batch_report(spark, events.limit(10), folder)
    assert read_result(spark, folder, SUMMARY).first()["total_rows"] == 10
