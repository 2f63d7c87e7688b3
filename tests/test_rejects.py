"""Rows of text files that a scan can not read."""

import os

import pytest

from cartspark import plans
from cartspark.sources import fault_counts, read_events, rejected_rows, scan_rows
from tests.test_sources import rows

HEADER = "timestamp,visitorid,event,itemid,transactionid\n"


def write(folder, name, text):
    os.makedirs(f"{folder}/in", exist_ok=True)
    with open(f"{folder}/in/{name}", "w") as out:
        out.write(text)
    return f"{folder}/in"


CASES = {
    "1,2,view,3,": [],
    "1,2,view,3": ["missing cells"],
    "1,2,view,3,4,5": ["surplus cells"],
    "1,2,view,3,,": ["surplus cells"],
    "": None,
    "7": ["missing cells"],
    'x,2,"vi,ew",3.0,117.0': ["timestamp is no whole number"],
    ",,,,": [],
    '1,2,"a""b",y,z': ["itemid is no whole number", "transactionid is no whole number"],
    "1,2,view,,x,y": ["surplus cells", "transactionid is no whole number"],
    '1,2,"a,b",3': ["missing cells"],
    r'1,2,"a\",b",3': ["missing cells"],
}


def test_faults_of_csv_lines(spark, folder):
    path = write(folder, "a.csv", HEADER + "".join(f"{line}\n" for line in CASES))
    found = scan_rows(spark, path)
    assert [r["faults"] for r in found.collect()] == [faults for faults in CASES.values() if faults is not None]
    bad = rejected_rows(spark, path).collect()
    assert len(bad) == 9 and all(r["file"].endswith("a.csv") for r in bad)
    lines = [r["line"] for r in bad if "cells" in r["faults"][0]]
    assert lines == [line for line, faults in CASES.items() if faults and "cells" in faults[0]]
    counts = {r["fault"]: r["row_count"] for r in fault_counts(found).collect()}
    assert counts == {
        None: 11, "missing cells": 4, "surplus cells": 3, "timestamp is no whole number": 1,
        "itemid is no whole number": 1, "transactionid is no whole number": 2,
    }
    # The same rows as events: what can not be read is null there.
    assert read_events(spark, path).count() == 11


def test_faults_of_json_lines(spark, folder):
    path = write(folder, "a.json", '{"timestamp":1,"event":"view"}\n[1]\nnope\n\n{"timestamp":"x","itemid":{"a":1}}\n{"itemid":"5"}\n')
    found = [(r["faults"], r["line"]) for r in scan_rows(spark, path, "json").collect()]
    assert found == [
        ([], None), (["no json object"], "[1]"), (["no json object"], "nope"),
        (["timestamp is no whole number", "itemid is no whole number"], None), ([], None),
    ]


def test_columns_in_another_order_and_extra_ones(spark, folder):
    path = write(folder, "a.csv", "note,itemid,event,visitorid,timestamp\nhm,1,view,2,3\nhm,1,view,2\n,,,b,\n")
    found = scan_rows(spark, path)
    assert [r["faults"] for r in found.collect()] == [[], ["missing cells"], ["visitorid is no whole number"]]
    assert "transactionid" not in found.columns


def test_files_without_rows_and_other_formats(spark, folder):
    path = write(folder, "a.csv", HEADER)
    assert scan_rows(spark, path).collect() == [] and rejected_rows(spark, path).collect() == []
    assert fault_counts(scan_rows(spark, path)).collect() == []
    with pytest.raises(ValueError, match="csv and json"):
        scan_rows(spark, path, "parquet")
    with pytest.raises(ValueError, match="missing required columns"):
        scan_rows(spark, write(f"{folder}/b", "a.csv", "a,b\n1,2\n"))


def test_report(spark, folder):
    path = write(folder, "a.csv", HEADER + "1,2,view,3\nx,2,view,3,\n1,2,view,3,\n")
    report = plans.scan_report(spark, path, "csv")
    assert rows(report["fault_counts"]) == [("missing cells", 1), ("timestamp is no whole number", 1), (None, 3)]
    assert report["rejected_rows"].count() == 2
    assert "Exchange" not in scan_rows(spark, path)._jdf.queryExecution().toString()
