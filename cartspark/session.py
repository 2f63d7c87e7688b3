"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Set only where a session is built here; a session handed in by a cluster keeps its own values.
DEFAULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def use_disk_state(spark: SparkSession) -> None:
    """Keep the state of streams on disk also in a session that was handed in, unless it names a store itself."""
    if "HDFSBackedStateStoreProvider" in spark.conf.get(STATE_PROVIDER):
        for key, value in DEFAULT_SETTINGS.items():
            if ".stateStore." in key:
                spark.conf.set(key, value)


def build_session(
    app_name: str = "cartspark", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, purpose: str, base: str | None = None) -> str:
    """A new folder that every executor can reach, for an intermediate table.

    It lies below ``base`` if the caller names one, else below ``spark.checkpoint.dir``, else below the warehouse.
    """
    shared = base or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{shared.rstrip('/')}/cartspark/{purpose}-{uuid.uuid4().hex}"
