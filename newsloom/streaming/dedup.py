"""First article per URL over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsloom.operators.ranking import keep_first
from newsloom.settings import release, staged
from newsloom.sources.lake import exists, names_in, read_or_empty, remove
from newsloom.streaming.epochs import epoch_path, query_id, write_epoch

# Runs of equal length that are made one; files an epoch adds to the keys at most.
FAN, KEY_FILES = 8, 8


def first_seen(rows: DataFrame, key: str, delay: str = "7 days") -> DataFrame:
    """Drop rows whose key came before, within ``delay`` of arrival.

    Time is the time of arrival: no row is late, and rows without a time of their own are
    like any other, so none is lost. State is bounded, as a key is forgotten after the
    delay; one that comes again later is taken as new, and ``keep_first_ever`` is the form
    for which it is not. All rows of a key meet in one task; for keys that hold much
    of a stream that form is the better choice too.
    """
    timed = rows.withColumn("_arrived", F.current_timestamp())
    return timed.withWatermark("_arrived", delay).dropDuplicatesWithinWatermark([key]).drop("_arrived")


def first_article_seen(articles: DataFrame, delay: str = "7 days") -> DataFrame:
    """First article per URL."""
    return first_seen(articles, "url", delay)


def keep_first_ever(
    articles: DataFrame, out: str, checkpoint: str, order: tuple[str, ...] = ("file_name", "pos")
) -> StreamingQuery:
    """The exact form: write the articles whose URL is new, a folder per query and epoch.

    What was seen is kept beside the table, not in memory, as digests of URLs (see ``SeenKeys``),
    so articles written earlier are not read again; several queries may write to one table, one at a time. Each
    micro-batch is first cut to one row per URL, before its shuffle by digests, in which the rows stay until they
    are written. Known digests are looked up by those of the micro-batch, so that Spark can send the smaller
    side to the larger. A replayed epoch replaces its rows and its keys. A micro-batch is read twice, the
    first time for its URLs alone.
    """
    key = F.unhex(F.sha2(F.coalesce("url", F.lit("")), 256))

    def write(rows: DataFrame, epoch: int) -> None:
        spark = rows.sparkSession
        seen = SeenKeys(spark, out, query_id(spark, checkpoint))
        keyed = rows.withColumn("_key", key)
        fresh = staged(keyed.select("_key").distinct(), "fresh-keys")
        known = seen.before(epoch).join(fresh, "_key", "left_semi")
        new = keep_first(keyed, ["_key"], list(order)).join(known, "_key", "left_anti")
        write_epoch(new.drop("_key"), out, seen.query, epoch)
        written = read_or_empty(spark, epoch_path(out, seen.query, epoch), "url string")
        seen.add(written.select(key.alias("_key")), epoch)
        release(fresh)

    return (
        articles.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


class SeenKeys:
    """Digests of the URLs in a table, in runs of epochs.

    An epoch adds a run of its own. As soon as a query has ``FAN`` runs of equally many epochs
    behind each other, not counting its newest epoch, which may be replayed, they are written as one
    run. So n epochs leave at most about FAN * log(n) runs, and a key is written again
    log(n) times at most. A run counts from the moment it is whole; runs that lie within
    a larger one are removed an epoch later, when nothing reads them any more.
    """

    SCHEMA = "_key binary"

    def __init__(self, spark: SparkSession, out: str, query: str):
        self.spark, self.query = spark, query
        self.table, self.base = out.rstrip("/"), f"{out.rstrip('/')}/_keys"

    def path(self, query: str, first: int, last: int) -> str:
        return f"{self.base}/{query}/{first:012d}-{last:012d}"

    def runs(self, query: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
        """Whole runs of a query that lie in no other, in order, and those that do."""
        found = []
        for name in names_in(self.spark, f"{self.base}/{query}"):
            first, _, last = name.partition("-")
            if exists(self.spark, f"{self.base}/{query}/{name}/_SUCCESS"):
                found.append((int(first), int(last)))
        found.sort(key=lambda r: (r[0], -r[1]))
        outer, inner, end = [], [], -1
        for first, last in found:
            (inner if last <= end else outer).append((first, last))
            end = max(end, last)
        return outer, inner

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(*paths)

    def before(self, epoch: int) -> DataFrame:
        """Keys of all rows that an epoch may not repeat."""
        queries = names_in(self.spark, self.base)
        if not queries:
            self._adopt()
            queries = names_in(self.spark, self.base)
        paths = [
            self.path(query, first, last)
            for query in queries
            for first, last in self.runs(query)[0]
            if query != self.query or last < epoch
        ]
        return self._read(paths)

    def _adopt(self) -> None:
        """Keys of rows that were written without any."""
        if not exists(self.spark, self.table):
            return
        rows = read_or_empty(self.spark, self.table, "url string, query string")
        keys = rows.filter(~F.col("query").eqNullSafe(self.query)).select(F.unhex(F.sha2(F.coalesce("url", F.lit("")), 256)).alias("_key"))
        if not keys.isEmpty():
            keys.hint("rebalance").write.mode("overwrite").parquet(self.path("earlier", 0, 0))

    def add(self, keys: DataFrame, epoch: int) -> None:
        """The keys of an epoch; then what has become many runs is made one."""
        keys.coalesce(KEY_FILES).write.mode("overwrite").parquet(self.path(self.query, epoch, epoch))
        outer, inner = self.runs(self.query)
        for first, last in inner:
            if last < epoch - 1:
                remove(self.spark, self.path(self.query, first, last))
        done = [r for r in outer if r[1] < epoch]
        while len(done) >= FAN and len({last - first for first, last in done[-FAN:]}) == 1:
            merged = done[-FAN:]
            target = merged[0][0], merged[-1][1]
            self._read([self.path(self.query, *r) for r in merged]).hint("rebalance").write.mode("overwrite").parquet(
                self.path(self.query, *target)
            )
            done = [*done[:-FAN], target]
