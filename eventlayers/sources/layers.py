"""Layer folders: `<layer>/writer=<query id>/batch_id=<n>/route=<output>/<date>=.../part-*.parquet`.

A batch owns its folder and is written straight to it. The last step puts one small entry into `<layer>/_commits`;
only what has an entry counts. It lists the files with their rows, bytes and times, and the entries of the layer before
that the batch has read; Spark writes and reads it as a table, so no list of files passes through the driver. Readers
leave folders without entry out, the next hop follows the entries and reads the folders they name, and a replay
writes a folder without entry again and leaves one with entry alone. Under a lease a folder carries the lease's number, so
a run that was taken over never writes where its successor does. Entries that every reader has passed are kept in
levelled snapshots. All outputs of a batch (good rows, quarantine, the two marts) are routes of one write.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlayers.functions import key_part
from eventlayers.schemas import names, plus
from eventlayers.sources import files, manifests

# More route x date outputs than this per task and Spark sorts the task's rows instead.
_OPEN_FILES = "32"

# A line of an entry: a file of the batch (with the first and last event time as texts, and in marts the parts of the
# lookup keys that it holds, of which there are `functions.KEY_PARTS` at most), or in `source` the name of an entry
# that the batch has read.
COMMIT = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("route", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("first_time", T.StringType()),
        T.StructField("last_time", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("parts", T.ArrayType(T.IntegerType())),
    ]
)
ENTRY = plus(COMMIT, entry=T.StringType())

# How much older than the newest an entry may be for the file source: more milliseconds than any clock shows.
_ENTRY_MEMORY = "100000000000d"


def layer_schema(row: T.StructType, date: str | None) -> T.StructType:
    tags: dict[str, T.DataType] = {
        "source_file": T.StringType(),
        "writer": T.StringType(),
        "batch_id": T.LongType(),
        "route": T.StringType(),
    }
    if date:
        tags[date] = T.DateType()
    return plus(row, **tags)


def read_layer(
    spark: SparkSession, path: str, row: T.StructType, route: str, date: str | None = None
) -> DataFrame:
    """One route of a layer's committed batches; other folders are pruned. A file that cannot be read fails.

    A layer that is not there yet has no rows.
    """
    return read_all_routes(spark, path, row, date).filter(F.col("route") == route)


def read_all_routes(spark: SparkSession, path: str, row: T.StructType, date: str | None = None) -> DataFrame:
    """All routes of a layer's committed batches, with the route as a column."""
    if not exists(spark, path):
        return spark.createDataFrame([], layer_schema(row, date))
    found = (
        spark.read.schema(layer_schema(row, date))
        .option("ignoreCorruptFiles", "false")
        .parquet(path)
    )
    # At most one per writer that is at work or has crashed.
    for writer, batch_id in uncommitted(spark, path):
        found = found.filter(~((F.col("writer") == writer) & (F.col("batch_id") == batch_id)))
    return found


def _named(rows: DataFrame) -> DataFrame:
    return rows.select(*names(COMMIT), F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("entry"))


def stream_commits(spark: SparkSession, path: str, max_batches: int | None = None) -> DataFrame:
    """The entries of a layer as a stream: the lines of each committed batch, once, with the entry's name."""
    reader = spark.readStream.schema(COMMIT).option("maxFileAge", _ENTRY_MEMORY)
    if max_batches:
        reader = reader.option("maxFilesPerTrigger", max_batches)
    return _named(reader.json(f"{commit_folder(path)}/*.json"))


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all entries of a layer with the entry's name, of its snapshots first and then those not in them."""
    # Files first: what goes from here to a snapshot meanwhile is seen twice, not never.
    small = None
    if any(n.endswith(".json") for n in files.names(spark, commit_folder(path))):
        small = _named(spark.read.schema(COMMIT).json(f"{commit_folder(path)}/*.json"))
    kept = manifests.read(spark, path, ENTRY)
    if kept is None:
        return small if small is not None else spark.createDataFrame([], ENTRY)
    if small is None:
        return kept
    # Between the switch to a snapshot and the removal of its entries, both have them.
    return kept.unionByName(small.join(kept.select("entry").distinct(), "entry", "left_anti").select(*names(ENTRY)))


def read_entry(spark: SparkSession, root: str, entry: str) -> DataFrame:
    return spark.read.schema(COMMIT).json(f"{commit_folder(root)}/{entry}.json")


def read_routes(spark: SparkSession, path: str, row: T.StructType, lines: DataFrame, route: str) -> DataFrame:
    """The rows of one route of the batches that the lines of their entries name, with the name of the file each came from.

    One folder for each batch, as many as a hop takes at once, is all that the driver is told. A file that cannot be
    read, or a folder that is not there, fails.
    """
    folder = F.regexp_extract("file", r"\A(writer=[^/]+/batch_id=[^/]+/route=[^/]+)/", 1).alias("folder")
    folders = [r["folder"] for r in lines.filter(F.col("route") == route).select(folder).distinct().collect()]
    if not folders:
        return spark.createDataFrame([], plus(row, source_file=T.StringType()))
    return (
        spark.read.schema(row)
        .option("ignoreCorruptFiles", "false")
        .option("basePath", path)
        .parquet(*(f"{path.rstrip('/')}/{f}" for f in folders))
        .select(*names(row), relative_name(F.col("_metadata.file_path"), path).alias("source_file"))
    )


def read_files(
    spark: SparkSession, path: str, row: T.StructType, lines: DataFrame, date: str | None = None
) -> DataFrame:
    """The rows of the files that the lines name; other files are neither listed nor opened.

    The names pass through the driver: choose few by what the lines say of the files.
    """
    found = [r["file"] for r in lines.select("file").distinct().collect()]
    if not found:
        return spark.createDataFrame([], layer_schema(row, date))
    return (
        spark.read.schema(layer_schema(row, date))
        .option("ignoreCorruptFiles", "false")
        .option("basePath", path)
        .parquet(*(f"{path.rstrip('/')}/{f}" for f in found))
    )


def relative_name(file_path: Column, root: str) -> Column:
    """The object name of a file: its path below the layer's folder."""
    folder = root.rstrip("/").split("://")[-1]
    return F.substring_index(file_path, folder + "/", -1)


def scan_files(
    spark: SparkSession, path: str, row: T.StructType, legacy: bool = False, key: Column | None = None
) -> DataFrame:
    """Every Parquet file below a folder, with its object name and base name; `key` is added as `event_key`.

    `legacy` reads imported files whose all-null columns carry Parquet's null type, which the
    vectorized reader refuses; it is off for this scan only.
    """
    session = spark
    if legacy:
        session = spark.newSession()
        session.conf.set("spark.sql.parquet.enableVectorizedReader", "false")
    return (
        session.read.schema(row)
        .option("recursiveFileLookup", "true")
        .option("ignoreCorruptFiles", "false")
        .parquet(path)
        .select(
            *names(row),
            relative_name(F.col("_metadata.file_path"), path).alias("object_name"),
            F.col("_metadata.file_name").alias("filename"),
            *([key.alias("event_key")] if key is not None else []),
        )
    )


def list_files(spark: SparkSession, path: str, root: str | None = None) -> DataFrame:
    """Object name below `root`, size and time of the Parquet files of a folder; contents are not read.

    A folder that does not exist has no files.
    """
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
    )
    if exists(spark, path):
        found = reader.load(path)
    else:
        found = spark.createDataFrame([], "path string, modificationTime timestamp, length long")
    return found.select(
        relative_name(F.col("path"), root or path).alias("object_name"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified_at"),
    )


def read_log(spark: SparkSession, path: str, row: T.StructType) -> DataFrame:
    """All rows of an append-only log, with the batch that wrote them (null for snapshots). No folder, no rows."""
    schema = plus(row, writer=T.StringType(), batch_id=T.LongType())
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(path)
    kept = manifests.read(spark, path, row)
    return rows if kept is None else rows.unionByName(kept, allowMissingColumns=True)


def batch_folder(root: str, writer: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/writer={writer}/batch_id={batch_id}"


def exists(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, path)


def commit_folder(root: str) -> str:
    return f"{root.rstrip('/')}/_commits"


def tag(writer: str, lease: int | None) -> str:
    """How the folder of a batch names its writer: with the lease it was written under."""
    return writer if lease is None else f"{writer}.{lease}"


def published(spark: SparkSession, root: str, writer: str, batch_id: int) -> str | None:
    """The name of the entry of a batch, whichever lease it was written under."""
    fs, pattern = files.file_system(spark, f"{commit_folder(root)}/{writer}*-{batch_id}.json")
    found = sorted(f.getPath().getName().removesuffix(".json") for f in fs.globStatus(pattern) or [])
    return found[0] if found else None


def uncommitted(spark: SparkSession, root: str) -> list[tuple[str, int]]:
    """(writer, batch) of the folders that have no entry; folder names are listed, not files."""
    fs, pattern = files.file_system(spark, f"{root.rstrip('/')}/writer=*/batch_id=*")
    committed = {n.removesuffix(".json") for n in files.names(spark, commit_folder(root))}
    found = [
        (f.getPath().getParent().getName().split("=", 1)[1], int(f.getPath().getName().split("=", 1)[1]))
        for f in fs.globStatus(pattern) or []
    ]
    left = [(w, b) for w, b in found if f"{w}-{b}" not in committed]
    kept = manifests.read(spark, root, ENTRY) if left else None
    if kept is not None:
        asked = spark.createDataFrame([(f"{w}-{b}",) for w, b in left], "entry string")
        old = {r["entry"] for r in asked.join(kept, "entry", "left_semi").collect()}
        left = [(w, b) for w, b in left if f"{w}-{b}" not in old]
    return left


def lookup_options(column: str, most_bytes: int = 8 << 20) -> dict[str, str]:
    """Writer options that let a reader looking for one value skip files which do not have it.

    The writer picks the smallest of several filters that suits the values a file turns out to have.
    """
    return {
        f"parquet.bloom.filter.enabled#{column}": "true",
        f"parquet.bloom.filter.adaptive.enabled#{column}": "true",
        "parquet.bloom.filter.max.bytes": str(most_bytes),
    }


def publish_batch(
    rows: DataFrame,
    root: str,
    writer: str,
    batch_id: int,
    partition_by: list[str],
    sources: DataFrame | None = None,
    timed: bool = False,
    check: Callable[[], None] = lambda: None,
    key: str | None = None,
    **options: str,
) -> str:
    """Write a batch to its folder, over what a crash may have left there, and commit it; the name of its entry.

    `sources` has the names of the entries read (column `entry`). `timed` says that the rows have an event time, whose
    bounds the entry keeps. `check` may refuse, before the write and before the commit. `key` is a column by which rows
    are looked up: the entry keeps which parts of it each file has, and the rows are sorted by `partition_by` and it.
    """
    session = rows.sparkSession
    # Rows with a lookup key come sorted by folder, so a task needs one open file, with its key filters, at a time.
    session.conf.set("spark.sql.maxConcurrentOutputFileWriters", "0" if key else _OPEN_FILES)
    folder = batch_folder(root, writer, batch_id)
    check()
    rows.write.mode("overwrite").options(**options).partitionBy(*partition_by).parquet(folder)
    return commit(session, root, writer, batch_id, sources, timed, check, key)


def batch_lines(
    spark: SparkSession, root: str, writer: str, batch_id: int, timed: bool, key: str | None = None
) -> DataFrame:
    """The lines of a written batch's files: counts come from their footers, times and parts of keys from a column each."""
    kept = "route string" + (", event_time timestamp_ntz" if timed else "") + (f", {key} string" if key else "")
    found = spark.read.schema(kept).parquet(batch_folder(root, writer, batch_id))
    time = F.col("event_time") if timed else F.lit(None).cast("timestamp_ntz")
    part = key_part(key) if key else F.lit(None).cast("int")
    of_file = found.select("route", time.alias("t"), part.alias("p"), "_metadata.file_path", "_metadata.file_size")
    parts = F.sort_array(F.collect_set("p")) if key else F.lit(None).cast("array<int>")
    return of_file.groupBy("file_path", "file_size", "route").agg(
        F.count("*").alias("rows"), F.min("t").cast("string").alias("first_time"), F.max("t").cast("string").alias("last_time"),
        parts.alias("parts"),
    ).select(
        relative_name(F.col("file_path"), root).alias("file"), F.col("file_size").alias("bytes"), "route", "rows",
        "first_time", "last_time", F.lit(None).cast("string").alias("source"), "parts",
    )


def commit(
    spark: SparkSession,
    root: str,
    writer: str,
    batch_id: int,
    sources: DataFrame | None = None,
    timed: bool = False,
    check: Callable[[], None] = lambda: None,
    key: str | None = None,
) -> str:
    """Make a written batch count, by one object that appears as a whole."""
    entry = f"{writer}-{batch_id}"
    nothing = {n: F.lit(None).cast(COMMIT[n].dataType) for n in names(COMMIT)}
    # An entry has a line even if its batch has no file.
    lines = spark.range(1).select(*(c.alias(n) for n, c in nothing.items()))
    if sources is not None:
        read = {**nothing, "source": F.col("entry")}
        lines = sources.select("entry").distinct().select(*(c.alias(n) for n, c in read.items())).unionByName(lines)
    lines = batch_lines(spark, root, writer, batch_id, timed, key).unionByName(lines)
    hidden = f"{commit_folder(root)}/.{entry}"
    lines.coalesce(1).write.mode("overwrite").json(hidden)
    part = next(n for n in files.names(spark, hidden) if n.startswith("part-"))
    check()
    if not files.rename_once(spark, f"{hidden}/{part}", f"{commit_folder(root)}/{entry}.json"):
        raise OSError(f"{entry} is committed already")
    files.delete(spark, hidden)
    return entry


def write_layer(rows: DataFrame, path: str, partition_by: list[str]) -> None:
    """Plain append for batch callers that bring their own idempotence."""
    rows.write.mode("append").partitionBy(*partition_by).parquet(path)


def flatten_batches(batches: DataFrame, rows: str) -> DataFrame:
    """Rows of a column of type array<array<struct>>, one frame row each."""
    return batches.select(F.inline(F.flatten(rows)))
