"""Real-time ad-click processing with Structured Streaming.

``AdClickStreamJob`` is the reference's streaming job re-expressed as one
``foreachBatch`` function over a stream of ``epochMillis province city userId adId``
lines. For every micro-batch, in this order:

1. parse the lines (malformed lines go to the ``rejects`` table); with ``lateness_seconds``, clicks
   that are older than the newest click of earlier batches by more than that go to
   ``late_clicks`` and no further;
2. drop clicks of users blacklisted in *earlier* batches (a bit of ``blacklist_pages`` each);
3. append this batch's (date, user, ad) counts to ``user_clicks``;
4. list every user whose cumulative (date, user, ad) count, this batch included,
   reaches the threshold and who is not listed yet, into ``blacklist``, and OR their bits
   into the pages touched;
5. append this batch's (date, province, city, ad) counts to ``ad_stat_log``;
6. recompute the top-k ads of every (date, province) touched by this batch and
   replace those dates in ``province_top`` (dynamic partition overwrite);
7. append this batch's (ten-second pane, ad) counts to ``trend_log``; minutes and sliding
   hours are sums of panes.

Exactly-once: every append goes to a partition keyed by ``batch_id`` and is written
with dynamic partition overwrite, so a micro-batch replayed after a failure rewrites
the same partitions instead of adding to them; reads that must exclude the current
batch filter on ``batch_id``. Cumulative counts are sums over the logs, read back
only for the dates (partition column) present in the batch.

The logs grow by one partition set per batch. With ``compact_every=k`` the job
folds each log into a ``<log>_base`` table (partition ``upto=N`` holds the sums of all
batches <= N) every k batches; readers then sum the newest base and only the log
partitions after it. Reads made while processing batch N use a base strictly older
than N, so a replay of N after its own compaction still counts N exactly once.
"""

from __future__ import annotations

from datetime import datetime, timedelta

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader, StreamingQuery
from pyspark.sql.utils import AnalysisException

from visitlens.operators import ads, membership
from visitlens.sources.keyed_table import KeyedTable

USER_CLICKS_SCHEMA = "user_id bigint, ad_id bigint, click_count bigint, date string, batch_id bigint"
BLACKLIST_SCHEMA = "user_id bigint, batch_id bigint"
STAT_SCHEMA = "province string, city string, ad_id bigint, click_count bigint, date string, batch_id bigint"
TOP_SCHEMA = "province string, ad_id bigint, click_count bigint, date string"
TREND_SCHEMA = "pane bigint, ad_id bigint, click_count bigint, date string, batch_id bigint"
LATE_SCHEMA = "ts timestamp, province string, city string, user_id bigint, ad_id bigint, batch_id bigint"
#: Batches after which the blacklist's pages are folded.
PAGES_COMPACT_EVERY = 16
REJECTS_SCHEMA = "raw string, batch_id bigint"


def pane_start() -> Column:
    """Where a pane of the trend begins."""
    return F.timestamp_seconds(F.col("pane") * ads.SLIDE_SECONDS)


def _days(first: datetime, last: datetime) -> list[str]:
    return [(first + timedelta(days=k)).strftime("%Y-%m-%d") for k in range((last.date() - first.date()).days + 1)]


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read a parquet table; an absent table reads as empty with ``schema``."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def _write(df: DataFrame, path: str, partition_by: list[str]) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


@dataclass
class AdClickStreamJob:
    """State tables live under ``base_path`` (shared storage on a cluster)."""

    spark: SparkSession
    base_path: str
    threshold: int = ads.DEFAULT_THRESHOLD
    top_k: int = 3
    compact_every: int | None = None
    lateness_seconds: int | None = None

    LOGS = {
        "user_clicks": (USER_CLICKS_SCHEMA, ["date", "user_id", "ad_id"]),
        "ad_stat_log": (STAT_SCHEMA, ["date", "province", "city", "ad_id"]),
        "trend_log": (TREND_SCHEMA, ["date", "pane", "ad_id"]),
    }

    def path(self, name: str) -> str:
        return os.path.join(self.base_path, name)

    # ------------------------------------------------------------- logs

    def _newest(self, name: str, through_batch: int | None = None) -> DataFrame:
        """(date, upto): the newest usable base version of every compacted date.

        Read from a small version table (a row per compaction and date it touched), never
        from the bases themselves.
        """
        versions = read_or_empty(self.spark, self.path(name + "_versions"), "date string, upto bigint")
        if through_batch is not None:
            versions = versions.where(F.col("upto") < F.lit(through_batch))
        return versions.groupBy("date").agg(F.max("upto").alias("upto"))

    def log_rows(self, name: str, through_batch: int | None = None,
                 dates: list[str] | None = None) -> DataFrame:
        """Rows of a log (keys, click_count) covering batches <= ``through_batch`` (all when
        None): for each date its newest usable base and the log partitions after it. With
        ``dates``, only those ``date`` partitions are read (both tables are partitioned by
        date, so this is partition pruning, not a scan)."""
        schema, keys = self.LOGS[name]
        base_schema = ", ".join(c for c in schema.split(", ") if not c.startswith("batch_id")) + ", upto bigint"
        newest = self._newest(name, through_batch)
        base = read_or_empty(self.spark, self.path(name + "_base"), base_schema)
        log = read_or_empty(self.spark, self.path(name), schema)
        if through_batch is not None:
            log = log.where(F.col("batch_id") <= F.lit(through_batch))
        cols = keys + ["click_count"]
        if dates is not None:
            # a version per date of the batch: literal partition filters
            known = {r["date"]: r["upto"] for r in newest.where(F.col("date").isin(*dates)).collect()}
            log = log.where(F.col("date").isin(*dates))
            usable, later = F.lit(False), F.lit(True)
            for date, upto in known.items():
                usable = usable | ((F.col("date") == date) & (F.col("upto") == F.lit(upto)))
                later = later & ((F.col("date") != date) | (F.col("batch_id") > F.lit(upto)))
            return base.where(usable).select(*cols).unionByName(log.where(later).select(*cols))
        after = log.join(newest, "date", "left").where(F.col("upto").isNull() | (F.col("batch_id") > F.col("upto")))
        return base.join(newest, ["date", "upto"], "left_semi").select(*cols).unionByName(after.select(*cols))

    def _summed(self, name: str, through_batch: int | None = None, dates: list[str] | None = None) -> DataFrame:
        keys = self.LOGS[name][1]
        return (self.log_rows(name, through_batch, dates).groupBy(*keys)
                .agg(F.sum("click_count").cast("bigint").alias("click_count")))

    def compact(self, through_batch: int) -> None:
        """Fold the logs through ``through_batch`` into their base tables (partition
        ``upto=through_batch``), only for dates with log rows after their newest base.

        Idempotent, so it may run again on replay: the version rows are written last, and a
        version counts only for batches after it.
        """
        for name in self.LOGS:
            log = read_or_empty(self.spark, self.path(name), self.LOGS[name][0])
            newest = self._newest(name, through_batch)
            fresh = (log.where(F.col("batch_id") <= F.lit(through_batch)).select("date", "batch_id").distinct()
                     .join(newest, "date", "left")
                     .where(F.col("upto").isNull() | (F.col("batch_id") > F.col("upto"))))
            touched = [r["date"] for r in fresh.select("date").distinct().collect()]
            if not touched:
                continue
            upto = F.lit(through_batch).cast("bigint")
            folded = self._summed(name, through_batch, touched).withColumn("upto", upto)
            _write(folded, self.path(name + "_base"), ["upto", "date"])
            done = self.spark.createDataFrame([(d,) for d in touched], "date string").withColumn("upto", upto)
            _write(done.coalesce(1), self.path(name + "_versions"), ["upto"])

    # ------------------------------------------------------------- table views

    def user_clicks(self) -> DataFrame:
        """Cumulative (date yyyy-MM-dd, user_id, ad_id, click_count)."""
        return self._summed("user_clicks")

    def blacklist(self, before_batch: int | None = None) -> DataFrame:
        """Listed users (user_id); with ``before_batch``, only those listed earlier."""
        bl = read_or_empty(self.spark, self.path("blacklist"), BLACKLIST_SCHEMA)
        if before_batch is not None:
            bl = bl.where(F.col("batch_id") < F.lit(before_batch))
        return bl.select("user_id").distinct()

    def blacklist_pages(self) -> KeyedTable:
        """The listed users as bitmap pages: what the batches test. Its size follows the range of user ids, not
        the number of batches: a batch rewrites the pages it adds to, and every PAGES_COMPACT_EVERY
        batches they are folded and superseded files removed."""
        return KeyedTable(self.spark, self.path("blacklist_pages"), "page bigint, bits binary", ["page"], buckets=4)

    def ad_stat(self) -> DataFrame:
        """Running (date yyyyMMdd, province, city, ad_id, click_count)."""
        return self._summed("ad_stat_log")

    def province_top(self) -> DataFrame:
        return read_or_empty(self.spark, self.path("province_top"), TOP_SCHEMA) \
            .select("date", "province", "ad_id", "click_count")

    def click_trend(self, as_of: str | None = None, minutes: int = 60) -> DataFrame:
        """(date yyyy-MM-dd, hour, minute, ad_id, click_count) per event-time minute.

        With ``as_of`` (yyyy-MM-dd HH:mm:ss), only the ``minutes`` whole minutes up to and
        including that one; just their dates' partitions are read.
        """
        if as_of is None:
            return self._minutes(self.log_rows("trend_log"))
        last = datetime.strptime(as_of, "%Y-%m-%d %H:%M:%S").replace(second=0)
        first = last - timedelta(minutes=minutes - 1)
        panes = self.log_rows("trend_log", dates=_days(first, last)).where(
            pane_start().between(F.lit(first.isoformat(" ")), F.lit((last + timedelta(seconds=59)).isoformat(" "))))
        return self._minutes(panes)

    @staticmethod
    def _minutes(panes: DataFrame) -> DataFrame:
        return ads.minute_keys(panes.groupBy(F.date_trunc("minute", pane_start()).alias("m"), "ad_id")
                               .agg(F.sum("click_count").cast("bigint").alias("click_count")))

    def sliding_trend(self, first_end: str, last_end: str, window: int = ads.WINDOW_SECONDS) -> DataFrame:
        """(window_end, ad_id, click_count): each ad's clicks of the ``window`` seconds before every
        slide end (ten seconds apart) from ``first_end`` to ``last_end`` (yyyy-MM-dd HH:mm:ss); a
        row where there are any. Only the dates that these windows touch are read.
        """
        first, last = (datetime.strptime(t, "%Y-%m-%d %H:%M:%S") for t in (first_end, last_end))
        panes = self.log_rows("trend_log", dates=_days(first - timedelta(seconds=window), last))
        summed = panes.groupBy("ad_id", "pane").agg(F.sum("click_count").cast("bigint").alias("click_count"))
        runs = ads.sliding_runs(summed, window=window)
        lo, hi = (F.unix_seconds(F.to_timestamp(F.lit(t))) / ads.SLIDE_SECONDS for t in (first_end, last_end))
        clipped = runs.select("ad_id", "click_count", F.greatest("first_end", F.ceil(lo)).alias("first_end"),
                              F.least("last_end", F.floor(hi)).alias("last_end"))
        return ads.slide_ends(clipped.where("first_end <= last_end"))

    def late_clicks(self) -> DataFrame:
        """Clicks that came behind the watermark of their batch."""
        return read_or_empty(self.spark, self.path("late_clicks"), LATE_SCHEMA)

    def _newest_click(self) -> KeyedTable:
        """The newest event time after each batch: one row, kept through every batch that may be replayed."""
        return KeyedTable(self.spark, self.path("newest_click"), "stream string, newest_us bigint", ["stream"], buckets=1)

    def _on_time(self, clicks: DataFrame, batch_id: int) -> DataFrame:
        """The clicks at or after the watermark; the others are written to ``late_clicks`` first, so that every
        parsed click is in one of the two. The watermark is fixed by the batches before, so a replay cuts alike."""
        state = self._newest_click()
        known = state.current(before=batch_id).first()
        if known is not None:
            limit = F.lit(known["newest_us"] - self.lateness_seconds * 1_000_000)
            late = F.unix_micros("ts") < limit
            _write(clicks.where(late).withColumn("batch_id", F.lit(batch_id).cast("bigint")), self.path("late_clicks"), ["batch_id"])
            clicks = clicks.where(~late)
        newest = clicks.agg(F.max(F.unix_micros("ts"))).first()[0]
        if newest is not None:
            newest = max(newest, known["newest_us"]) if known is not None else newest
            state.overwrite(self.spark.createDataFrame([("ads", newest)], "stream string, newest_us bigint"), batch_id)
        if (batch_id + 1) % PAGES_COMPACT_EVERY == 0 and state.compact(batch_id, least=2):
            state.vacuum(keep_from=batch_id)
        return clicks

    def rejects(self) -> DataFrame:
        return read_or_empty(self.spark, self.path("rejects"), REJECTS_SCHEMA)

    # ------------------------------------------------------------- per batch

    def process(self, lines: DataFrame, batch_id: int) -> None:
        bid = F.lit(batch_id).cast("bigint")
        lines = lines.persist()            # the source is read once for clicks and rejects
        clicks, rejects = ads.parse_ad_log(lines)
        _write(rejects.withColumn("batch_id", bid), self.path("rejects"), ["batch_id"])

        if self.lateness_seconds is not None:
            clicks = self._on_time(clicks, batch_id)
        pages = self.blacklist_pages()
        listed_before = pages.current(before=batch_id).persist()
        kept = membership.without(clicks, listed_before, "user_id").persist()
        try:
            # the days present in this micro-batch (one or two for a live stream; bounded by
            # the days of late data): every read of a log below prunes to these partitions
            day_keys = [r[0] for r in kept.select(ads.day(F.col("ts")).alias("d")).distinct().collect()]
            date_keys = [d.replace("-", "") for d in day_keys]
            # 3. this batch's user/ad counts
            counts = ads.user_daily_clicks(kept).withColumn("batch_id", bid)
            _write(counts, self.path("user_clicks"), ["date", "batch_id"])

            # 4. users whose cumulative count reaches the threshold; the log is read back
            #    only for the (date) partitions of this batch's keys
            log = self.log_rows("user_clicks", batch_id, day_keys)
            keys = counts.select("date", "user_id", "ad_id")
            cumulative = (log.join(keys, ["date", "user_id", "ad_id"], "left_semi")
                          .groupBy("date", "user_id", "ad_id")
                          .agg(F.sum("click_count").alias("click_count")))
            over = cumulative.where(F.col("click_count") >= F.lit(self.threshold)).select("user_id").distinct()
            new_users = membership.without(over, listed_before, "user_id").withColumn("batch_id", bid)
            _write(new_users, self.path("blacklist"), ["batch_id"])
            listed_now = read_or_empty(self.spark, self.path("blacklist"), BLACKLIST_SCHEMA).where(F.col("batch_id") == bid)
            if not listed_now.isEmpty():
                fresh = membership.id_pages(listed_now, "user_id")
                pages.overwrite(membership.merge_pages(fresh, listed_before.join(fresh.select("page"), "page", "left_semi")), batch_id)

            # 5. running stat
            stat = ads.ad_stat(kept).withColumn("batch_id", bid)
            _write(stat, self.path("ad_stat_log"), ["date", "batch_id"])

            # 6. top-k per (date, province) for the dates touched by this batch
            current = (self.log_rows("ad_stat_log", batch_id, date_keys)
                       .groupBy("date", "province", "city", "ad_id")
                       .agg(F.sum("click_count").cast("bigint").alias("click_count")))
            top = ads.province_top_ads(current, self.top_k)
            _write(top.select("province", "ad_id", "click_count", "date"),
                   self.path("province_top"), ["date"])

            # 7. click trend per ten seconds of event time
            trend = (ads.click_panes(kept).withColumn("date", ads.day(pane_start()))
                     .withColumn("batch_id", bid))
            _write(trend, self.path("trend_log"), ["date", "batch_id"])

            if (batch_id + 1) % PAGES_COMPACT_EVERY == 0 and pages.compact(batch_id, least=2):
                pages.vacuum(keep_from=batch_id)  # a replay of this batch still finds the pages before it
            if self.compact_every and (batch_id + 1) % self.compact_every == 0:
                self.compact(batch_id)
        finally:
            kept.unpersist()
            listed_before.unpersist()
            lines.unpersist()

    # ------------------------------------------------------------- driver

    def start(self, lines: DataFrame, checkpoint_location: str, trigger: dict | None = None,
              query_name: str | None = None) -> StreamingQuery:
        """Run ``process`` for every micro-batch of the streaming ``lines`` (column value).

        ``trigger`` defaults to 5-second micro-batches; tests pass
        ``{"availableNow": True}``.
        """
        writer = (lines.writeStream.foreachBatch(self.process)
                  .option("checkpointLocation", checkpoint_location))
        if query_name:
            writer = writer.queryName(query_name)
        writer = writer.trigger(**(trigger or {"processingTime": "5 seconds"}))
        return writer.start()


# ----------------------------------------------------------------- sources

def kafka_lines(spark: SparkSession, bootstrap_servers: str, topics: str,
                starting_offsets: str = "latest") -> DataFrame:
    """Ad lines from Kafka (topics comma separated). Needs the spark-sql-kafka package on
    the cluster's classpath; the message value is the line."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topics)
            .option("startingOffsets", starting_offsets)
            .load()
            .select(F.col("value").cast("string").alias("value")))


def text_lines(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Ad lines from text files arriving in ``directory`` (one line per click)."""
    reader: DataStreamReader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(directory)


# ----------------------------------------------------------------- state-store forms

def running_ad_stat(clicks: DataFrame, retention: str | None = None) -> DataFrame:
    """Streaming running count per (date yyyyMMdd, province, city, ad_id).

    Use with ``outputMode("update")``: every batch emits the keys it changed with their
    new totals. Without ``retention`` the state never expires (as in the reference).
    With a retention such as ``"2 days"`` the day becomes an event-time window and a
    watermark on ``ts`` lets Spark drop the state of days older than the retention.
    """
    if retention is None:
        return (clicks.groupBy(ads.date_key(F.col("ts")).alias("date"), "province", "city", "ad_id")
                .agg(F.count(F.lit(1)).alias("click_count")))
    agg = (clicks.withWatermark("ts", retention)
           .groupBy(F.window("ts", "1 day").alias("w"), "province", "city", "ad_id")
           .agg(F.count(F.lit(1)).alias("click_count")))
    return agg.select(ads.date_key(F.col("w.start")).alias("date"), "province", "city", "ad_id",
                      "click_count")


def without_repeats(clicks: DataFrame, within: str = "1 hour") -> DataFrame:
    """A stream of clicks without those delivered again: of equal clicks (all five fields) the first stays, as
    long as the others come within the watermark's delay. State older than that is dropped."""
    return clicks.withWatermark("ts", within).dropDuplicatesWithinWatermark(["ts", "province", "city", "user_id", "ad_id"])


def user_session_updates(clicks: DataFrame, gap: str = "30 minutes", watermark: str = "1 hour") -> DataFrame:
    """Streaming form of ``ads.user_sessions`` (user_id, session_start, session_end, click_count): visits closed by
    ``gap`` without a click, in ``append`` mode once the watermark has passed them."""
    agg = (clicks.withWatermark("ts", watermark).groupBy(F.session_window("ts", gap).alias("w"), "user_id")
           .agg(F.min("ts").alias("session_start"), F.max("ts").alias("session_end"), F.count(F.lit(1)).alias("click_count")))
    return agg.select("user_id", "session_start", "session_end", "click_count")


def click_pane_updates(clicks: DataFrame, watermark: str = "31 days") -> DataFrame:
    """Streaming (ad_id, pane, click_count) per ten seconds of event time, in ``update`` mode the panes
    a batch changed with their full counts: ``ads.sliding_runs`` over the newest counts
    gives every sliding window. A native 60-minute window sliding by 10 seconds would
    put each click into 360 windows of state instead."""
    agg = (clicks.withWatermark("ts", watermark)
           .groupBy(F.window("ts", f"{ads.SLIDE_SECONDS} seconds").alias("w"), "ad_id")
           .agg(F.count(F.lit(1)).alias("click_count")))
    return agg.select("ad_id", F.floor(F.unix_seconds("w.start") / ads.SLIDE_SECONDS).alias("pane"), "click_count")


def click_trend_updates(clicks: DataFrame, watermark: str = "31 days") -> DataFrame:
    """Streaming per-minute click counts (date, hour, minute, ad_id, click_count).

    Event-time one-minute tumbling windows with a watermark; in ``update`` mode each
    batch emits the minutes it changed with their full counts. Clicks later than the
    watermark are dropped (documented Structured Streaming behaviour).
    """
    agg = (clicks.withWatermark("ts", watermark)
           .groupBy(F.window("ts", "1 minute").alias("w"), "ad_id")
           .agg(F.count(F.lit(1)).alias("click_count")))
    m = F.col("w.start")
    return agg.select(ads.day(m).alias("date"), F.date_format(m, "HH").alias("hour"),
                      F.date_format(m, "mm").alias("minute"), "ad_id", "click_count")
