"""Datasets of several folders that appear together, by a manifest written last.

A run writes its folders under names of its own, and then one small file that lists them. A
reader goes by the newest complete manifest, so that it sees all folders of a run or none, and a
run that dies leaves nothing that is read. Folders are reached through the file systems that
Spark itself uses.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

MANIFESTS = "_manifests"


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote; an absent one is fine."""
    files, place = _path(spark, path)
    files.delete(place, True)


def is_local(spark: SparkSession, path: str) -> bool:
    return _path(spark, path)[0].getScheme() == "file"


def new_run() -> str:
    """A name for a run; later runs have later names."""
    return f"run-{time.time_ns() // 1_000_000:015d}-{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, folder: str, run: str, entries: dict) -> None:
    """Make the entries of a run the current ones of ``folder``."""
    files, place = _path(spark, f"{folder}/{MANIFESTS}/{run}.json")
    out = files.create(place, False)
    try:
        out.write(json.dumps(entries | {"run": run}).encode())
    finally:
        out.close()


def published(spark: SparkSession, folder: str) -> dict | None:
    """The entries of the newest complete manifest, if there is one."""
    files, place = _path(spark, f"{folder}/{MANIFESTS}")
    if not files.exists(place):
        return None
    names = sorted((str(s.getPath().toString()) for s in files.listStatus(place)), reverse=True)
    for name in names:
        text = "".join(r[0] for r in spark.read.text(name, wholetext=True).collect())
        try:
            return json.loads(text)
        except ValueError:  # a run died while writing it
            continue
    return None


def read_published(spark: SparkSession, folder: str, entry: str, **options) -> DataFrame:
    """A dataset of the newest run of ``folder``."""
    entries = published(spark, folder)
    if entries is None:
        raise FileNotFoundError(f"nothing is published in {folder}")
    return spark.read.options(**options).format(entries["format"]).load(entries[entry])


def remove_older_runs(spark: SparkSession, folder: str) -> list[str]:
    """Delete the folders and manifests of all runs before the newest one; gives their names."""
    current = published(spark, folder)
    if current is None:
        return []
    gone = []
    for base in {folder, current["invalid_folder"]}:
        files, place = _path(spark, base)
        for status in files.listStatus(place):
            name = status.getPath().getName()
            if name.startswith("run-") and name < current["run"]:
                files.delete(status.getPath(), True)
                gone.append(name)
    files, place = _path(spark, f"{folder}/{MANIFESTS}")
    for status in files.listStatus(place):
        if status.getPath().getName() < f"{current['run']}.json":
            files.delete(status.getPath(), False)
    return sorted(set(gone))
