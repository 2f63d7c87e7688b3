"""Archives of records: limited runs that go on, parts that are written again, and folders by date."""

import os

import pytest

from cartspark import plans
from cartspark import streaming as st
from cartspark.sources import names_in, read_pointer
from cartspark.streaming import archive as module

DAY = 86_400_000


def land(folder, name, *values):
    os.makedirs(f"{folder}/in", exist_ok=True)
    with open(f"{folder}/in/{name}.json", "w") as out:
        out.writelines(f"{v}\n" for v in values)
    # Files are taken by age.
    os.utime(f"{folder}/in/{name}.json", (1_700_000_000 + len(os.listdir(f"{folder}/in")),) * 2)


def event(item, timestamp=0):
    return '{"timestamp":%d,"visitorid":1,"event":"view","itemid":%d}' % (timestamp, item)


def run(spark, folder, **options):
    return plans.archive(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", **options)


def items(spark, folder, **options):
    return sorted(row["itemid"] for row in st.read_archive(spark, f"{folder}/out", **options).collect())


def test_limited_runs_go_on_where_the_last_one_ended(spark, folder):
    for index in range(3):
        land(folder, index, *(event(3 * index + i) for i in range(2)), "no record" if index == 1 else event(3 * index + 2))
    assert run(spark, folder, limit=2) == (2, 0)
    assert run(spark, folder, limit=0) == (0, 0)
    # What is left of the first file goes first; one record of the second file is none.
    assert run(spark, folder, limit=3) == (3, 0)
    assert items(spark, folder) == [0, 1, 2, 3, 4]
    assert run(spark, folder, limit=100) == (3, 1)
    assert run(spark, folder, limit=100) == (0, 0)
    assert items(spark, folder) == [0, 1, 2, 3, 4, 6, 7, 8]
    assert names_in(spark, f"{folder}/out/pending") == []


def test_run_without_limit_takes_what_was_set_aside(spark, folder):
    for index in range(4):
        land(folder, index, *(event(5 * index + i) for i in range(5)))
    assert run(spark, folder, limit=3) == (3, 0)
    assert run(spark, folder, max_files=2) == (17, 0)
    assert items(spark, folder) == list(range(20))


def test_small_limit_reads_little(spark, folder):
    for index in range(6):
        land(folder, index, *(event(10 * index + i) for i in range(10)))
    assert run(spark, folder, limit=4) == (4, 0)
    [pending] = names_in(spark, f"{folder}/out/pending")
    assert spark.read.parquet(f"{folder}/out/pending/{pending}").count() == 6
    # The micro-batch after the limit was offered, and not taken.
    assert names_in(spark, f"{folder}/checkpoint/commits") == ["0"]
    assert spark.read.text(f"{folder}/out/records").count() == 4


@pytest.mark.parametrize("limit", [None, 4])
@pytest.mark.parametrize("by_date", [False, True])
@pytest.mark.parametrize("cut", ["write", "publish"])
def test_run_that_is_cut_off(spark, folder, monkeypatch, limit, by_date, cut):
    for index in range(3):
        land(folder, index, *(event(3 * index + i, index * DAY) for i in range(3)))
    calls, whole = [], getattr(module._Archive, cut)

    def once(self, *args):
        result = whole(self, *args)
        calls.append(1)
        if len(calls) == 2:
            raise OSError("executor lost")
        return result

    monkeypatch.setattr(module._Archive, cut, once)
    with pytest.raises(Exception, match="executor lost"):
        run(spark, folder, limit=limit, by_date=by_date, max_files=1)
    monkeypatch.undo()
    run(spark, folder, limit=2, by_date=by_date)
    run(spark, folder, by_date=by_date, max_files=1)
    assert items(spark, folder) == list(range(9))
    assert sum(n for n, _ in st.archived_counts(spark, f"{folder}/out").values()) == 9


def test_micro_batch_that_runs_again_after_the_pointer(spark, folder):
    land(folder, 0, event(1), event(2))
    run(spark, folder)
    # The checkpoint lost its note of the last micro-batch: the stream offers it again.
    for name in ("0", ".0.crc"):
        os.remove(f"{folder}/checkpoint/commits/{name}")
    assert run(spark, folder) == (0, 0)
    assert items(spark, folder) == [1, 2]


def test_archive_by_date(spark, folder):
    land(folder, 0, event(1, 0), event(2, DAY), event(3, 10 * DAY), '{"event":"view","itemid":4}', '{"timestamp":"soon","itemid":5}')
    assert run(spark, folder, by_date=True) == (5, 0)
    land(folder, 1, event(6, DAY + 5), "none")
    assert run(spark, folder, by_date=True) == (1, 1)
    assert items(spark, folder) == [1, 2, 3, 4, 5, 6]
    assert items(spark, folder, dates=("1970-01-02", "1970-01-10")) == [2, 6]
    assert items(spark, folder, parts=range(1, 2)) == [6]
    assert items(spark, folder, parts=range(2, 2)) == []
    plan = st.read_archive(spark, f"{folder}/out", dates=("1970-01-02", "1970-01-10"))
    assert "PartitionFilters: [isnotnull(event_date" in plan._jdf.queryExecution().toString()
    assert len(plan.inputFiles()) >= 2
    with pytest.raises(ValueError, match="divided by date"):
        run(spark, folder)


def test_part_by_date_replaces_its_own_rows_alone(spark, folder):
    archive = module._Archive(spark, f"{folder}/out", True)
    values = lambda *v: spark.createDataFrame([(x,) for x in v], "value string")
    archive.write(values(event(1, 0), event(2, DAY)), 0)
    archive.write(values(event(3, 0), event(4, 2 * DAY)), 1)
    archive.write(values(event(5, DAY)), 1)
    archive.publish({**archive.state(), "by_date": True})
    assert items(spark, folder) == [1, 2, 5]


def test_dates_need_an_archive_by_date(spark, folder):
    land(folder, 0, event(1))
    run(spark, folder)
    with pytest.raises(ValueError, match="not divided"):
        st.read_archive(spark, f"{folder}/out", dates=("1970-01-01", "1970-01-02"))


def test_first_records_replace_no_archive_that_a_checkpoint_feeds(spark, folder):
    land(folder, 0, event(1), event(2))
    run(spark, folder)
    with pytest.raises(ValueError, match="checkpoint"):
        plans.archive(spark, f"{folder}/in", f"{folder}/out", limit=1)
    assert items(spark, folder) == [1, 2]
    assert plans.archive(spark, f"{folder}/in", f"{folder}/first", limit=1) == (1, 0)
    with pytest.raises(ValueError, match="first records"):
        plans.archive(spark, f"{folder}/in", f"{folder}/first", f"{folder}/c2")


def test_archive_without_pointer_is_added_to(spark, folder):
    for part in (0, 1):
        os.makedirs(f"{folder}/out/records/batch_id={part}")
        os.makedirs(f"{folder}/out/counts/batch_id={part}")
        with open(f"{folder}/out/records/batch_id={part}/a.txt", "w") as out:
            out.write(event(part) + "\n")
    land(folder, 0, event(7))
    assert run(spark, folder) == (1, 0)
    assert items(spark, folder) == [0, 1, 7]


def test_null_values_are_no_records(spark, folder):
    archive = module._Archive(spark, f"{folder}/out")
    assert archive.write(spark.createDataFrame([(None,), ("{}",)], "value string"), 0) == (1, 1)
    assert read_pointer(spark, f"{folder}/out") is None and st.archived_parts(spark, f"{folder}/out") == 1
    assert spark.read.schema("value string").json(f"{folder}/out/rejected").collect()[0]["value"] is None


def test_limit_must_not_be_negative(spark, folder):
    land(folder, 0, event(1))
    with pytest.raises(ValueError, match="negative"):
        run(spark, folder, limit=-1)
