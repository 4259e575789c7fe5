"""The article lake: one base URI, a folder per layer.

The base may be ``file:``, ``hdfs:``, ``s3a:`` or any other scheme Spark knows;
no code depends on which.  Tables are Parquet, one folder per run.  A snapshot
is written once. After all tables of a run are in place a marker is added to
``_published`` of its layer, an empty file whose name holds a number and the run; the
highest number is the current run. Markers are only ever added, so at every moment, and after
a failure at any point, readers find a whole snapshot. JSON array files of other producers
can be read as well.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.settings import staged

PUBLISHED = "_published"


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; no job is started."""
    files, location = _file_system(spark, path)
    return [s.getPath().getName() for s in files.listStatus(location)] if files.exists(location) else []


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there; nothing below it is listed."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all that is in it."""
    files, location = _file_system(spark, path)
    files.delete(location, True)


def _is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or no rows of its schema when it was never written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if _is_missing(error):
            return spark.createDataFrame([], schema)
        raise


def read_article_files(
    spark: SparkSession, folder: str, schema: str, pattern: str = "*.json"
) -> DataFrame:
    """JSON array files under a folder, at any depth.

    Adds ``file_name`` and ``pos``. A multi-line file is read by one task in
    order, so the row id rises with the place in the array.
    """
    rows = (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .json(folder)
    )
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias("file_name"),
        F.monotonically_increasing_id().alias("pos"),
    )


def list_files(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """Path, size and modification time of files; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", "length", F.col("modificationTime").alias("modified_at"))
    )


def newest_file(files: DataFrame) -> DataFrame:
    """One row: the newest file (by path among equals) of a file list."""
    return files.agg(F.max(F.struct("modified_at", "path")).alias("newest")).select("newest.*")


def read_latest_file(spark: SparkSession, folder: str, latest: str, schema: str) -> DataFrame:
    """Rows of the JSON file named ``latest`` in a folder, else of its newest
    JSON file, else none: the snapshot of a lake kept as JSON arrays."""
    path = f"{folder.rstrip('/')}/{latest}"
    if not exists(spark, path):
        newest = newest_file(list_files(spark, folder)).first() if exists(spark, folder) else None
        path = newest.path if newest is not None else None
    if path is None:
        return spark.createDataFrame([], schema + ", file_name string, pos bigint")
    return read_article_files(spark, path, schema)


def audit_article_files(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """Per JSON file: ``ok``, ``format_error`` (no array) or ``file_error``.

    Files of zero bytes are not listed: Spark's readers skip them.
    """
    files = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .text(folder, wholetext=True)
        .select(F.col("_metadata.file_path").alias("file_name"), "value")
    )
    # The parser stops after one value; in brackets, text left over is an error.
    values = F.json_array_length(F.concat(F.lit("["), "value", F.lit("]")))
    status = (
        F.when(F.coalesce(values, F.lit(0)) != 1, "file_error")
        .when(F.json_array_length("value").isNull(), "format_error")
        .otherwise("ok")
    )
    return files.select("file_name", status.alias("status"))


# Files whose ends are looked at together.
SILENT_FILES = 1000


def _empty_or_broken(spark: SparkSession, silent: DataFrame) -> DataFrame:
    """``file_name`` of those files that cannot be read or lack the marks which begin and end a Parquet file.
    Names come to the driver a block at a time."""
    broken, block = [], []

    def look() -> None:
        content = spark.read.format("binaryFile").option("ignoreCorruptFiles", True).load(block)
        marked = F.col("content").startswith(F.lit(b"PAR1")) & F.col("content").endswith(F.lit(b"PAR1"))
        sound = content.filter(marked).select(F.col("path").alias("file_name"))
        names = spark.createDataFrame([(name,) for name in block], "file_name string")
        broken.append(staged(names.join(sound, "file_name", "left_anti"), "broken-files"))

    for row in silent.toLocalIterator():
        block.append(row.file_name)
        if len(block) == SILENT_FILES:
            look()
            block = []
    if block:
        look()
    return reduce(DataFrame.unionByName, broken) if broken else spark.createDataFrame([], "file_name string")


def decoded_rows(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """``file_name``, ``readable``: rows that come out of each Parquet file when every column of
    ``schema`` is decoded and page checksums are compared. Reading a file stops at its first damage."""
    rows = (
        spark.read.schema(schema)
        .option("ignoreCorruptFiles", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("parquet.page.verify-checksum.enabled", True)
        .parquet(pattern)
    )
    # The sum over all columns keeps them all in the scan.
    content = F.bit_xor(F.xxhash64(*rows.columns))
    counted = rows.groupBy(F.col("_metadata.file_path").alias("file_name")).agg(
        F.count(F.lit(1)).alias("readable"), content.alias("content")
    )
    return counted.filter(F.col("content").isNotNull()).drop("content")


def audit_table_files(spark: SparkSession, folder: str, tables: dict[str, str] | None = None) -> DataFrame:
    """Per Parquet file at any depth: ``rows`` by its footer, ``readable`` rows, and ``ok`` or ``file_error``.

    ``tables``: path patterns under the folder with their schemas. Their files are read whole, and one
    that gives fewer rows than its footer promises is an error, wherever the damage is. Of files
    outside the patterns the footers are read. Files that promise no rows are few; they are
    sound if they begin and end as a Parquet file does.
    """
    files = list_files(spark, folder, "*.parquet").select(F.col("path").alias("file_name"))
    promised = (
        spark.read.option("ignoreCorruptFiles", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .schema("_none string")
        .parquet(folder)
        .groupBy(F.col("_metadata.file_path").alias("file_name"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    listed = staged(files.join(promised, "file_name", "left"), "listed-files")
    broken = _empty_or_broken(spark, listed.filter(F.col("rows").isNull()).select("file_name"))
    audit = listed.join(broken.withColumn("broken", F.lit(True)), "file_name", "left")
    read = spark.createDataFrame([], "file_name string, readable bigint, whole boolean")
    for pattern, schema in (tables or {}).items():
        try:
            found = decoded_rows(spark, pattern, schema)
            names = list_files(spark, pattern, "*.parquet").select(F.col("path").alias("file_name"))
        except AnalysisException as error:
            if _is_missing(error):
                continue
            raise
        one = names.join(found, "file_name", "left").withColumn("whole", F.lit(True))
        read = read.unionByName(one.withColumn("readable", F.coalesce("readable", F.lit(0))))
    audit = audit.join(read, "file_name", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    bad = F.coalesce("broken", F.lit(False)) | (F.coalesce("whole", F.lit(False)) & (F.col("readable") < F.col("rows")))
    return audit.select("file_name", "rows", "readable", F.when(bad, "file_error").otherwise("ok").alias("status"))


@dataclass(frozen=True)
class Lake:
    base: str

    def path(self, *parts: str) -> str:
        return "/".join([self.base.rstrip("/"), *parts])

    # Bronze: history by source and run.

    def add_bronze(self, articles: DataFrame, run_id: str) -> None:
        """Add the articles of one run. Earlier runs stay; repeating a run replaces
        all of its rows. Rebalancing splits a source too large for one task and
        keeps small ones from becoming many files."""
        (
            articles.withColumn("source_key", source_key(F.col("source")))
            .hint("rebalance", "source_key")
            .write.partitionBy("source_key")
            .option("partitionOverwriteMode", "static")
            .mode("overwrite")
            .parquet(self.path("bronze", "articles", f"run_id={run_id}"))
        )

    def read_bronze(self, spark: SparkSession, schema: str, run_id: str | list[str] | None = None) -> DataFrame:
        """Bronze rows of all runs, of one or of some; ``file_name`` orders runs as file names would."""
        rows = read_or_empty(
            spark, self.path("bronze", "articles"), schema + ", pos bigint, source_key string, run_id string"
        )
        if run_id is not None:
            rows = rows.filter(F.col("run_id").isin([run_id] if isinstance(run_id, str) else run_id))
        return rows.withColumn(
            "file_name", F.concat("source_key", F.lit("_"), F.col("run_id").cast("string"))
        ).drop("source_key", "run_id")

    def bronze_runs(self, spark: SparkSession) -> dict[str, str]:
        """The whole runs of Bronze, and when each was written; a repeated run has a new time."""
        base = self.path("bronze", "articles")
        found = {}
        for name in names_in(spark, base):
            files, done = _file_system(spark, f"{base}/{name}/_SUCCESS")
            if name.startswith("run_id=") and files.exists(done):
                found[name.removeprefix("run_id=")] = str(files.getFileStatus(done).getModificationTime())
        return found

    # Lists of a run: empty files whose names are the entries, so that reading them starts no job.

    def write_list(self, spark: SparkSession, layer: str, run_id: str, name: str, entries: list[str]) -> None:
        folder = self.run_path(layer, "_" + name, run_id)
        remove(spark, folder)
        for number, entry in enumerate(entries):
            files, place = _file_system(spark, f"{folder}/{number:06d}-{entry}")
            files.mkdirs(place.getParent())
            files.create(place, True).close()

    def read_list(self, spark: SparkSession, layer: str, run_id: str, name: str) -> list[str]:
        return [n.partition("-")[2] for n in sorted(names_in(spark, self.run_path(layer, "_" + name, run_id)))]

    # Snapshots: a folder per run of a layer, and a pointer to the latest run.

    def run_path(self, layer: str, table: str, run_id: str) -> str:
        return self.path(layer, f"run_id={run_id}", table)

    def write_run(self, rows: DataFrame, layer: str, table: str, run_id: str, *partitions: str) -> None:
        """Write one table of a run; a repeated run replaces its own rows."""
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partitions:
            writer = writer.partitionBy(*partitions)
        writer.parquet(self.run_path(layer, table, run_id))

    def write_tables(self, tables: dict[str, DataFrame], layer: str, run_id: str) -> None:
        """Write independent tables of a run side by side: most are small, and
        one after the other they would leave the cluster idle."""
        with ThreadPoolExecutor(max_workers=4) as pool:
            writes = [pool.submit(self.write_run, rows, layer, name, run_id) for name, rows in tables.items()]
            for write in writes:
                write.result()

    def publish(self, spark: SparkSession, layer: str, run_id: str) -> None:
        """Make a written run the latest: all its tables become current at once.

        One writer publishes to a layer at a time; of equal numbers the later run id counts."""
        number = 1 + max((n for n, _ in self._markers(spark, layer)), default=0)
        files, marker = _file_system(spark, self.path(layer, PUBLISHED, f"{number:012d}-{run_id}"))
        files.mkdirs(marker.getParent())
        files.create(marker, False).close()

    def _markers(self, spark: SparkSession, layer: str) -> list[tuple[int, str]]:
        names = [n for n in names_in(spark, self.path(layer, PUBLISHED)) if n[:12].isdigit()]
        return sorted((int(n[:12]), n[13:]) for n in names)

    def published(self, spark: SparkSession, layer: str) -> bool:
        return bool(self._markers(spark, layer))

    def latest_run(self, spark: SparkSession, layer: str) -> str | None:
        """The run published last. In a layer where nothing ever was, the newest run of
        which all tables are complete; else None."""
        markers = self._markers(spark, layer)
        if markers:
            return markers[-1][1]
        newest = None
        files, _ = _file_system(spark, self.base)
        for name in names_in(spark, self.path(layer)):
            if not name.startswith("run_id="):
                continue
            tables = [t for t in names_in(spark, self.path(layer, name)) if not t.startswith("_")]
            done = [self.path(layer, name, t, "_SUCCESS") for t in tables]
            if not done or not all(exists(spark, d) for d in done):
                continue
            when = max(files.getFileStatus(_file_system(spark, d)[1]).getModificationTime() for d in done)
            newest = max(newest or (0, ""), (when, name.removeprefix("run_id=")))
        return newest[1] if newest else None

    def latest_path(self, spark: SparkSession, layer: str, table: str) -> str | None:
        """Path of a table of the latest run, or None when it is not there."""
        run_id = self.latest_run(spark, layer)
        if run_id is None:
            return None
        path = self.run_path(layer, table, run_id)
        return path if exists(spark, path) else None

    def read_run(
        self, spark: SparkSession, layer: str, table: str, run_id: str | None, schema: str
    ) -> DataFrame:
        """A table of a run, or no rows when it is not there."""
        if run_id is None:
            return spark.createDataFrame([], schema)
        return read_or_empty(spark, self.run_path(layer, table, run_id), schema)

    def read_latest(self, spark: SparkSession, layer: str, table: str, schema: str) -> DataFrame:
        return self.read_run(spark, layer, table, self.latest_run(spark, layer), schema)

    # Reports.

    def append_report(self, rows: DataFrame, name: str) -> None:
        rows.write.mode("append").json(self.path("reports", name))


def source_key(source):
    """Folder name of a source: lower case, blanks as ``_``."""
    return F.replace(F.lower(F.coalesce(source, F.lit(""))), F.lit(" "), F.lit("_"))


def write_json(rows: DataFrame, path: str) -> None:
    """JSON Lines in UTF-8, non-ASCII text unescaped."""
    rows.write.mode("overwrite").json(path)
