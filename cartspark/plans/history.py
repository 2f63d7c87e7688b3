"""The history of an archive that grows: each part of the archive is read once.

A run rolls the new parts of the archive up, with the same operators as the batch job, and stores that as a part of the
history. Four parts of one tier are merged into one of the next, so every row is rewritten a logarithmic number of times
and a reader merges a logarithmic number of parts. One pointer names the parts of the history and how many parts of the
archive they hold; it is replaced last, so a run that is cut off, or repeated, changes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from cartspark import operators as ops
from cartspark.sources import names_in, read_pointer, remove_table, write_pointer, write_table
from cartspark.streaming.archive import archive_identity, archived_parts, read_archive

# Parts of one tier that are merged into one part of the next.
FAN_IN = 4
PARTS, ROLLUP, SKETCHES = "parts", "rollup", "sketches"
KINDS = {ROLLUP: ops.merge_rollups, SKETCHES: ops.merge_sketches}
# Named, since a part may be empty.
SCHEMAS = {
    ROLLUP: "hour timestamp, visitorid bigint, itemid bigint, cart_visitorid bigint, cart_itemid bigint, level string, "
    "event_count bigint, view_count bigint, addtocart_count bigint, transaction_count bigint, "
    "first_add_timestamp bigint, last_add_timestamp bigint, last_transaction_timestamp bigint",
    SKETCHES: "hour timestamp, event_count bigint, visitorid_sketch binary, itemid_sketch binary",
}


def _state(spark: SparkSession, path: str) -> tuple[int, dict]:
    found = read_pointer(spark, path)
    return found or (0, {"archive": None, "counted": 0, "written": 0, "parts": [], "retired": []})


def _write_part(tables: dict[str, DataFrame], path: str) -> None:
    write_table(tables[ROLLUP], f"{path}/{ROLLUP}", partition_by=("level",))
    write_table(tables[SKETCHES], f"{path}/{SKETCHES}")


def _union(spark: SparkSession, path: str, parts: list[str], kind: str) -> DataFrame:
    tables = [spark.read.schema(SCHEMAS[kind]).parquet(f"{path}/{PARTS}/{name}/{kind}") for name in parts]
    whole = reduce(DataFrame.unionByName, tables)
    return KINDS[kind](whole) if len(tables) > 1 else whole


def update_history(spark: SparkSession, archive: str, history: str, max_parts: int | None = None) -> int:
    """Count the archive's new parts, or at most ``max_parts`` of them, into the history; returns how many."""
    history = history.rstrip("/")
    number, state = _state(spark, history)
    identity = archive_identity(spark, archive)
    if state["archive"] not in (None, identity):
        raise ValueError(f"{history} is the history of another archive than {archive}")
    first, last = state["counted"], archived_parts(spark, archive)
    if max_parts is not None:
        last = min(last, first + max_parts)
    if last <= first:
        return 0
    events = read_archive(spark, archive, range(first, last))
    written = state["written"]

    def new_name() -> str:
        nonlocal written
        written += 1
        # A run that was cut off may have left files under this name; they are written over.
        return f"{written:012d}"

    name = new_name()
    _write_part({ROLLUP: ops.history_rollup(events), SKETCHES: ops.hourly_sketches(events)}, f"{history}/{PARTS}/{name}")
    parts, retired = [*state["parts"], [0, name]], []
    while len(same := [n for tier, n in parts if tier == parts[-1][0]]) >= FAN_IN:
        tier, name = parts[-1][0], new_name()
        _write_part({kind: _union(spark, history, same, kind) for kind in KINDS}, f"{history}/{PARTS}/{name}")
        retired += same
        parts = [*(p for p in parts if p[1] not in same), [tier + 1, name]]
    new = {"archive": identity, "counted": last, "written": written, "parts": parts, "retired": retired}
    write_pointer(spark, history, number + 1, new)
    # Parts that the pointer before this one named may still be read; what no pointer names any more goes.
    named = {n for _, n in parts} | set(retired)
    for found in names_in(spark, f"{history}/{PARTS}"):
        if found not in named:
            remove_table(spark, f"{history}/{PARTS}/{found}")
    return last - first


def counted_parts(spark: SparkSession, history: str) -> int:
    """How many parts of the archive the history holds."""
    return _state(spark, history.rstrip("/"))[1]["counted"]


def _read(spark: SparkSession, history: str, kind: str) -> DataFrame:
    parts = [name for _, name in _state(spark, history.rstrip("/"))[1]["parts"]]
    if not parts:
        raise FileNotFoundError(history)
    return _union(spark, history.rstrip("/"), parts, kind)


def read_history(spark: SparkSession, history: str) -> DataFrame:
    """The rollup of all that was counted, as ``history_rollup`` gives it for all events."""
    return _read(spark, history, ROLLUP).select(*ops.ROLLUP_COLUMNS)


def read_sketches(spark: SparkSession, history: str) -> DataFrame:
    """The hourly sketches of all that was counted, as ``hourly_sketches`` gives them for all events."""
    return _read(spark, history, SKETCHES)
