"""Folders that change from one whole version to the next.

A version is a folder of its own. It counts from the moment a small file that names it, the pointer, is there, and that
file appears by one rename. Until then, and after a write that failed half-way, readers see the version before. The last
versions are kept for readers that have begun; older ones are removed. One writer at a time: a second one that would
publish the same version is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# Names that begin with an underscore are skipped by readers of the folder above.
POINTERS = "_pointers"
KEPT = 2


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table, wherever it is stored."""
    place, files = _file_system(spark, path)
    files.delete(place, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is not there."""
    place, files = _file_system(spark, path)
    return sorted(status.getPath().getName() for status in files.listStatus(place)) if files.exists(place) else []


def paths_like(spark: SparkSession, pattern: str) -> list[str]:
    """Existing files and folders that a pattern names."""
    place, files = _file_system(spark, pattern)
    return sorted(status.getPath().toString() for status in files.globStatus(place) or [])


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, or None if it is not there."""
    place, files = _file_system(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file over what is there."""
    place, files = _file_system(spark, path)
    stream = files.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; the target must not be there."""
    place, files = _file_system(spark, target)
    files.mkdirs(place.getParent())
    if files.exists(place) or not files.rename(spark._jvm.org.apache.hadoop.fs.Path(source), place):
        raise FileExistsError(f"{source} can not be moved to {target}")


def read_pointer(spark: SparkSession, path: str) -> tuple[int, dict] | None:
    """Number and content of the newest pointer of a versioned folder."""
    while True:
        numbers = [int(name.removesuffix(".json")) for name in names_in(spark, f"{path}/{POINTERS}") if name.endswith(".json")]
        if not numbers:
            return None
        text = read_text(spark, f"{path}/{POINTERS}/{max(numbers):012d}.json")
        if text is not None:
            return max(numbers), json.loads(text)
        # A writer replaced it since it was listed.


def write_pointer(spark: SparkSession, path: str, number: int, content: dict) -> None:
    """Make ``content`` the newest pointer, at once and as a whole."""
    final, draft = f"{path}/{POINTERS}/{number:012d}.json", f"{path}/{POINTERS}/.{uuid.uuid4().hex}"
    write_text(spark, draft, json.dumps(content))
    try:
        move(spark, draft, final)
    except FileExistsError:
        remove_table(spark, draft)
        raise FileExistsError(f"version {number} of {path} was published by another writer") from None
    for name in names_in(spark, f"{path}/{POINTERS}"):
        if name.endswith(".json") and int(name.removesuffix(".json")) <= number - KEPT:
            remove_table(spark, f"{path}/{POINTERS}/{name}")


@dataclass
class Version:
    """A version that is being written: its folder, its number, and what its pointer will say."""

    folder: str
    number: int
    content: dict = field(default_factory=dict)


@contextmanager
def new_version(spark: SparkSession, path: str) -> Iterator[Version]:
    """Write below the folder of the version that is handed out; it is published when the block ends without an error."""
    path = path.rstrip("/")
    before = read_pointer(spark, path)
    number = before[0] + 1 if before else 1
    name = f"_version-{number:012d}-{uuid.uuid4().hex[:8]}"
    version = Version(f"{path}/{name}", number)
    try:
        yield version
    except BaseException:
        remove_table(spark, version.folder)
        raise
    kept = [name, *(before[1].get("kept", []) if before else [])][:KEPT]
    write_pointer(spark, path, number, {**version.content, "version": name, "kept": kept})
    for found in names_in(spark, path):
        # What a failed writer left is older than this version, too.
        if found.startswith("_version-") and found not in kept:
            remove_table(spark, f"{path}/{found}")


def version_folder(spark: SparkSession, path: str) -> str:
    """Folder of the version that counts now. ``FileNotFoundError`` if there is none."""
    found = read_pointer(spark, path.rstrip("/"))
    if found is None:
        raise FileNotFoundError(path)
    return f"{path.rstrip('/')}/{found[1]['version']}"
