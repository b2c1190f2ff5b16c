"""Ad-click analytics in batch form (the streaming job calls the same functions).

Input: parsed clicks (ts TIMESTAMP, province, city, user_id, ad_id).

The dynamic blacklist of the streaming job has a closed form over a batch column: a
user is listed in the first batch where the running click count of some
(date, user, ad) - that batch included - reaches the threshold, and from the next batch
on every click of that user is dropped. Until then nothing of theirs is dropped, so
the running counts over raw clicks equal those over kept clicks. Two aggregates and
one window over per-batch counts compute it; no iteration over batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.operators.joins import broadcast_if_small, hot_keys, salted_join
from visitlens.operators.membership import MAX_BROADCAST_PAGES, holds, id_pages, page_of

DEFAULT_THRESHOLD = 100
#: The last millisecond of the year 9999.
MAX_EPOCH_MS = 253_402_300_799_999


def parse_ad_log(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split ``epochMillis province city userId adId`` lines.

    Returns (clicks, rejects): clicks has ts, province, city, user_id, ad_id; rejects
    holds the raw lines that do not have five fields, whose numbers do not parse or whose
    time is outside 1970 to 9999.
    """
    parts = F.split(F.col(column), " ")
    parsed = lines.select(
        F.col(column).alias("raw"),
        F.size(parts).alias("n"),
        F.try_element_at(parts, F.lit(1)).try_cast("bigint").alias("ms"),
        F.try_element_at(parts, F.lit(2)).alias("province"),
        F.try_element_at(parts, F.lit(3)).alias("city"),
        F.try_element_at(parts, F.lit(4)).try_cast("bigint").alias("user_id"),
        F.try_element_at(parts, F.lit(5)).try_cast("bigint").alias("ad_id"),
    )
    ok = ((F.col("n") == 5) & F.col("ms").between(0, MAX_EPOCH_MS) & F.col("user_id").isNotNull()
          & F.col("ad_id").isNotNull())
    clicks = parsed.where(ok).select(F.timestamp_millis("ms").alias("ts"), "province", "city",
                                     "user_id", "ad_id")
    rejects = parsed.where(~ok | ok.isNull()).select("raw")
    return clicks, rejects


def date_key(ts: Column) -> Column:
    """yyyyMMdd"""
    return F.date_format(ts, "yyyyMMdd")


def day(ts: Column) -> Column:
    """yyyy-MM-dd"""
    return F.date_format(ts, "yyyy-MM-dd")


def daily_batch(ts: Column) -> Column:
    """Batch id used by the batch form: one batch per day."""
    return F.to_date(ts)


def _per_batch_counts(clicks: DataFrame, batch: Column | None) -> DataFrame:
    """(date, user_id, ad_id, batch, n): clicks pre-aggregated per batch (map-side partial)."""
    b = batch if batch is not None else daily_batch(F.col("ts"))
    return (clicks.select(day(F.col("ts")).alias("date"), "user_id", "ad_id", b.alias("batch"))
            .groupBy("date", "user_id", "ad_id", "batch")
            .agg(F.count(F.lit(1)).alias("n")))


def _first_batch(per_batch: DataFrame, threshold: int) -> DataFrame:
    w = (Window.partitionBy("date", "user_id", "ad_id").orderBy("batch")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = per_batch.withColumn("running", F.sum("n").over(w))
    return (running.where(F.col("running") >= F.lit(threshold))
            .groupBy("user_id").agg(F.min("batch").alias("first_batch")))


def blacklist_first_batch(clicks: DataFrame, threshold: int = DEFAULT_THRESHOLD,
                          batch: Column | None = None) -> DataFrame:
    """(user_id, first_batch): the batch in which each listed user crossed the threshold.

    Per-batch counts are aggregated first (map-side partial), so the running-sum window
    partitioned by (date, user, ad) sees one row per batch of that key - bounded by the
    number of batches in a day, whatever the click volume of a hot user.
    """
    return _first_batch(_per_batch_counts(clicks, batch), threshold)


def blacklist_filter(clicks: DataFrame, threshold: int = DEFAULT_THRESHOLD,
                     batch: Column | None = None, hot_user_rows: int | None = None) -> DataFrame:
    """Clicks kept by the dynamic blacklist: those of unlisted users, and of listed users
    up to and including the batch in which they were listed.

    A left outer join of the clicks with the listed users. The listed side comes out of
    an aggregate already partitioned by user, so AQE cannot split a user holding a large
    share of the clicks; users with more than ``hot_user_rows`` clicks (by default an even
    share, ``joins.hot_keys``, counted from the same per-batch pre-aggregate) are joined salted.
    """
    b = batch if batch is not None else daily_batch(F.col("ts"))
    per_batch = _per_batch_counts(clicks, batch)
    listed = _first_batch(per_batch, threshold)
    # hot users come from the same pre-aggregate, so its shuffle is shared
    hot = hot_keys(per_batch.groupBy("user_id").agg(F.sum("n").alias("n")), "user_id", "n", clicks, hot_user_rows)
    with_b = clicks.withColumn("_batch", b)
    return (salted_join(with_b, listed, "user_id", hot, "left")
            .where(F.col("first_batch").isNull() | (F.col("_batch") <= F.col("first_batch")))
            .select(*clicks.columns))


def blacklist_filter_pages(clicks: DataFrame, threshold: int = DEFAULT_THRESHOLD, batch: Column | None = None,
                           max_pages: int = MAX_BROADCAST_PAGES) -> DataFrame:
    """The same clicks as ``blacklist_filter``, tested against bitmap pages of the listed users.

    A page has a version for every batch that listed users of it, holding all those listed so far; a click
    looks up one bit of the newest version before its batch. Versions are broadcast if few (checked);
    otherwise clicks and versions are shuffled by page, and AQE may split a hot page.
    """
    b = batch if batch is not None else daily_batch(F.col("ts"))
    listed = _first_batch(_per_batch_counts(clicks, batch), threshold)
    w = Window.partitionBy("page").orderBy("first_batch")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    versions = id_pages(listed, "user_id", ["first_batch"]).select(
        F.col("page").alias("_page"), F.bitmap_or_agg("bits").over(so_far).alias("_bits"),
        F.col("first_batch").alias("_after"), F.lead("first_batch").over(w).alias("_until"))
    hint = broadcast_if_small(versions, max_pages)
    if hint is versions:
        hint = versions.repartition("_page")  # a shuffle of its own, which AQE may split
    with_page = clicks.withColumn("_batch", b).withColumn("_page", page_of(F.col("user_id")))
    newest = ((with_page["_page"] == hint["_page"]) & (F.col("_batch") > F.col("_after"))
              & (F.col("_until").isNull() | (F.col("_batch") <= F.col("_until"))))
    return (with_page.join(hint, newest, "left").where(~holds(F.col("_bits"), F.col("user_id")))
            .select(*[with_page[c] for c in clicks.columns]))


def blacklist_users(clicks: DataFrame, threshold: int = DEFAULT_THRESHOLD,
                    batch: Column | None = None) -> DataFrame:
    """Distinct listed users (user_id)."""
    return blacklist_first_batch(clicks, threshold, batch).select("user_id")


def anti_join_blacklist(clicks: DataFrame, blacklist: DataFrame,
                        hot_user_rows: int | None = None) -> DataFrame:
    """Drop clicks of users present in ``blacklist`` (left anti join on user_id).

    The blacklist is a distinct set (partitioned by user already), so a user with more
    than ``hot_user_rows`` clicks (by default an even share) is joined salted rather than left to one task.
    """
    hot = hot_keys(clicks.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")), "user_id", "n", clicks, hot_user_rows)
    return salted_join(clicks, blacklist.select("user_id"), "user_id", hot, "left_anti").select(*clicks.columns)


def user_daily_clicks(clicks: DataFrame) -> DataFrame:
    """(date yyyy-MM-dd, user_id, ad_id, click_count)."""
    return (clicks.groupBy(day(F.col("ts")).alias("date"), "user_id", "ad_id")
            .agg(F.count(F.lit(1)).alias("click_count")))


def ad_stat(clicks: DataFrame) -> DataFrame:
    """(date yyyyMMdd, province, city, ad_id, click_count): the running totals."""
    return (clicks.groupBy(date_key(F.col("ts")).alias("date"), "province", "city", "ad_id")
            .agg(F.count(F.lit(1)).alias("click_count")))


def province_clicks(stat: DataFrame) -> DataFrame:
    """(date, province, ad_id, click_count): ``ad_stat`` with the city rolled up."""
    return (stat.groupBy("date", "province", "ad_id")
            .agg(F.sum("click_count").cast("bigint").alias("click_count")))


def province_top_ads(stat: DataFrame, k: int = 3) -> DataFrame:
    """Top ``k`` ads per (date, province) by clicks (ad id breaks ties)."""
    w = Window.partitionBy("date", "province").orderBy(F.col("click_count").desc(), F.col("ad_id"))
    return (province_clicks(stat).withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= F.lit(k))
            .select("date", "province", "ad_id", "click_count"))


def click_trend(clicks: DataFrame) -> DataFrame:
    """(date yyyy-MM-dd, hour, minute, ad_id, click_count) per event-time minute."""
    m = F.date_trunc("minute", F.col("ts"))
    return minute_keys(clicks.groupBy(m.alias("m"), "ad_id").agg(F.count(F.lit(1)).alias("click_count")))


def minute_keys(counts: DataFrame) -> DataFrame:
    """Counts per minute ``m`` under the trend table's column names."""
    return counts.select(day(F.col("m")).alias("date"), F.date_format("m", "HH").alias("hour"),
                         F.date_format("m", "mm").alias("minute"), "ad_id", "click_count")


def click_trend_window(clicks: DataFrame, as_of: str, minutes: int = 60) -> DataFrame:
    """The trend restricted to clicks with ``as_of - minutes < ts <= as_of``."""
    end = F.to_timestamp(F.lit(as_of))
    start = end - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return click_trend(clicks.where((F.col("ts") > start) & (F.col("ts") <= end)))


#: Panes of the sliding trend and the blocks of time (a day) that its running sums are cut into.
SLIDE_SECONDS, WINDOW_SECONDS, BLOCK_SECONDS = 10, 3600, 86_400


def click_panes(clicks: DataFrame, slide: int = SLIDE_SECONDS) -> DataFrame:
    """(ad_id, pane, click_count): clicks per ``slide`` seconds; pane p covers [p * slide, (p + 1) * slide) since the epoch."""
    pane = F.floor(F.unix_seconds("ts") / slide)
    return clicks.groupBy("ad_id", pane.alias("pane")).agg(F.count(F.lit(1)).alias("click_count"))


def sliding_runs(panes: DataFrame, slide: int = SLIDE_SECONDS, window: int = WINDOW_SECONDS,
                 block: int = BLOCK_SECONDS) -> DataFrame:
    """(ad_id, first_end, last_end, click_count): runs of slide ends, counted in slides since the epoch, with one
    positive window count. The window that ends at e holds the panes e - window / slide to e - 1.

    A pane is counted once: it is added where it enters the windows and taken off where it has left them, and a
    running sum over those changes gives all windows between. Sums run inside (ad, block of time), so a task holds at most a
    block's slides, however many clicks or years an ad has; a pane near a block's end also opens the next block
    at its start. Runs end with their block.
    """
    width, span = window // slide, block // slide
    if window % slide or block % slide or span < width:
        raise ValueError("window and block must be multiples of slide, and a block no shorter than a window")
    e = F.col("pane") + 1
    own = F.floor(e / span)
    leaves = e + width

    def change(at_block, at, n):
        return F.struct(at_block.cast("long").alias("block"), at.cast("long").alias("e"), n.cast("long").alias("n"))

    n = F.col("click_count")
    none = F.lit(None).cast("struct<block:bigint,e:bigint,n:bigint>")
    later = F.floor((leaves - 1) / span) > own  # still counted when the next block begins
    changes = F.array_compact(F.array(
        change(own, e, n),
        F.when(~later & (leaves < (own + 1) * span), change(own, leaves, -n)).otherwise(none),
        F.when(later, change(own + 1, (own + 1) * span, n)).otherwise(none),
        F.when(later, change(own + 1, leaves, -n)).otherwise(none)))
    steps = (panes.select("ad_id", F.explode(changes).alias("c")).groupBy("ad_id", "c.block", "c.e")
             .agg(F.sum("c.n").alias("n")))
    w = Window.partitionBy("ad_id", "block").orderBy("e")
    runs = steps.select("ad_id", F.col("e").alias("first_end"),
                        (F.coalesce(F.lead("e").over(w), (F.col("block") + 1) * span) - 1).alias("last_end"),
                        F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("click_count"))
    return runs.where(F.col("click_count") > 0)


def sliding_trend(clicks: DataFrame, slide: int = SLIDE_SECONDS, window: int = WINDOW_SECONDS) -> DataFrame:
    """(window_end timestamp, ad_id, click_count): for every slide end, each ad's clicks of the ``window`` seconds before
    it (from, inclusive, to the end, exclusive); a row for each slide end and ad with clicks. No click is replicated over
    its windows: only the finished runs are spread over their slide ends.
    """
    return slide_ends(sliding_runs(click_panes(clicks, slide), slide, window), slide)


def slide_ends(runs: DataFrame, slide: int = SLIDE_SECONDS) -> DataFrame:
    """(window_end timestamp, ad_id, click_count): the runs with a row for each of their slide ends."""
    ends = runs.select(F.explode(F.sequence("first_end", "last_end")).alias("e"), "ad_id", "click_count")
    return ends.select(F.timestamp_seconds(F.col("e") * slide).alias("window_end"), "ad_id", "click_count")


def sliding_peaks(clicks: DataFrame, slide: int = SLIDE_SECONDS, window: int = WINDOW_SECONDS) -> DataFrame:
    """(ad_id, peak_clicks, peak_end, active_seconds): each ad's greatest window count, the first slide end that has it and
    the time covered by slide ends with clicks; from the runs alone, no slide end is listed."""
    runs = sliding_runs(click_panes(clicks, slide), slide, window)
    first = F.min(F.struct((-F.col("click_count")).alias("n"), "first_end"))
    return (runs.groupBy("ad_id").agg(first.alias("p"), F.sum(F.col("last_end") - F.col("first_end") + 1).alias("ends"))
            .select("ad_id", (-F.col("p.n")).alias("peak_clicks"), F.timestamp_seconds(F.col("p.first_end") * slide).alias("peak_end"),
                    (F.col("ends") * slide).alias("active_seconds")))


def user_sessions(clicks: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """(user_id, session_start, session_end, click_count, ads): visits of a user, cut where nothing was clicked for
    ``gap_seconds`` or more; ads: distinct ads clicked.

    Clicks of one pane of half a gap belong together whatever lies between, so they are added up first (in the
    map tasks): what a user's window sorts is bounded by time, not by clicks.
    """
    pane = F.floor(F.unix_micros("ts") / F.lit(gap_seconds * 500_000))
    parts = (clicks.groupBy("user_id", pane.alias("pane"))
             .agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count(F.lit(1)).alias("n"), F.collect_set("ad_id").alias("ads")))
    w = Window.partitionBy("user_id").orderBy("pane")
    begins = F.unix_micros("first") - F.unix_micros(F.lag("last").over(w)) >= F.lit(gap_seconds * 1_000_000)
    numbered = parts.withColumn("visit", F.sum(F.when(begins, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return (numbered.groupBy("user_id", "visit")
            .agg(F.min("first").alias("session_start"), F.max("last").alias("session_end"), F.sum("n").alias("click_count"),
                 F.size(F.array_distinct(F.flatten(F.collect_list("ads")))).cast("bigint").alias("ads"))
            .drop("visit"))
