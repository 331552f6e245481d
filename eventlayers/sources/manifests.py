"""Levelled snapshots of append-only logs.

A log is many small parts. Compaction writes parts as one folder of level 1; `FAN` folders of a level are merged to one of
the next, so a log of n parts is about log(n) folders, and a part is rewritten once for each level. A manifest
`<root>/_manifests/<number>.json` names the folders; readers take the one with the highest number, which appears as a whole,
after they have listed the parts that are still there. Parts and folders that a switch replaces are deleted with the
next one, so that a reader that began before keeps its files; a part may be seen twice, never not at all, and readers
drop what they see twice.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from eventlayers.sources import files

FAN = 8
_FOLDER = "_manifests"


def _manifest(spark: SparkSession, root: str, number: int) -> dict:
    return json.loads(files.read_text(spark, f"{root}/{_FOLDER}/{number}.json"))


def current(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and content of the newest manifest; (0, no folders) before the first."""
    numbers = [int(n[:-5]) for n in files.names(spark, f"{root}/{_FOLDER}") if n.endswith(".json") and n[0].isdecimal()]
    if not numbers:
        return 0, {"levels": [], "stale": []}
    return max(numbers), _manifest(spark, root, max(numbers))


def read(spark: SparkSession, root: str, row: T.StructType) -> DataFrame | None:
    """The rows of all folders of the newest manifest; None if there is none."""
    _, manifest = current(spark, root.rstrip("/"))
    folders = [f"{root.rstrip('/')}/{f}" for _, f in manifest["levels"]]
    return spark.read.schema(row).parquet(*folders) if folders else None


def add(
    root: str,
    fresh: DataFrame,
    parts: list[str],
    merge: Callable[[DataFrame], DataFrame],
    check: Callable[[], None] = lambda: None,
) -> None:
    """Make `fresh`, the rows of the log's `parts`, part of its snapshot, merging levels that are full, and switch to it.

    `merge` reduces the rows of a level to those that count. `check` may refuse just before the switch.
    """
    spark, root, row = fresh.sparkSession, root.rstrip("/"), fresh.schema
    number, manifest = current(spark, root)
    levels = [(level, folder) for level, folder in manifest["levels"]]
    made: list[str] = []

    def write(rows: DataFrame, level: int) -> None:
        folder = f"{_FOLDER}/level={level}/{uuid.uuid4().hex}"
        merge(rows).write.parquet(f"{root}/{folder}")
        levels.append((level, folder))
        made.append(folder)

    write(fresh, 1)
    level = 1
    while len(full := [f for k, f in levels if k == level]) >= FAN:
        levels = [(k, f) for k, f in levels if k != level]
        write(spark.read.schema(row).parquet(*(f"{root}/{f}" for f in full)), level + 1)
        level += 1
    gone = [f for _, f in manifest["levels"] if f not in {f for _, f in levels}]
    gone += [f for f in made if f not in {f for _, f in levels}]
    check()
    content = json.dumps({"levels": levels, "stale": gone + parts})
    if not files.create_once(spark, f"{root}/{_FOLDER}/{number + 1}.json", content):
        raise RuntimeError(f"another compaction of {root} was quicker")
    for path in manifest["stale"]:
        files.delete(spark, f"{root}/{path}")
    files.delete(spark, f"{root}/{_FOLDER}/{number - 1}.json")
