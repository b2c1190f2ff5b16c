"""Structured Streaming jobs (ad clicks)."""

from visitlens.streaming.ad_stream import (  # noqa: F401
    AdClickStreamJob, click_pane_updates, click_trend_updates, kafka_lines, running_ad_stat, text_lines,
    user_session_updates, without_repeats,
)
