"""Page and post metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formfold.functions import ms_to_date, ms_to_time, ratio, sum_fields, urn_id
from formfold.operators import delta, metric_slots, new_rows


def page_growth(page_days: DataFrame) -> DataFrame:
    """Daily new followers per page from daily totals; the first day has 0."""
    return delta(
        page_days, ["page_id"], ["page_date"], "page_total_followers", "page_new_followers"
    )


def follower_gains(gains: DataFrame, counts: DataFrame) -> DataFrame:
    """New followers per page and period beside the page's follower total."""
    page = urn_id("organizationalEntity").alias("page_id")
    totals = counts.select(
        page,
        sum_fields(
            F.col("followerCountsByAssociationType")["followerCounts"],
            "organicFollowerCount",
            "paidFollowerCount",
        ).alias("followers"),
    )
    gain = F.col("followerGains")
    rows = gains.select(
        page,
        (gain["organicFollowerGain"] + gain["paidFollowerGain"]).alias("new_followers"),
        ms_to_date("timeRange.start").alias("start_date"),
        ms_to_date("timeRange.end").alias("end_date"),
    )
    return rows.join(totals, "page_id", "left")


def new_posts(posts: DataFrame, known: DataFrame) -> DataFrame:
    """Posts not stored yet, with the date and time they were made."""
    rows = posts.select(
        "post_id",
        ms_to_date("created_ms").alias("date_column"),
        ms_to_time("created_ms").alias("time_column"),
    )
    return new_rows(rows, known.select("post_id"), "post_id")


def post_metrics(post_days: DataFrame, groups: DataFrame) -> DataFrame:
    """Chosen metrics of each post and day in ordered slots, with the click rate.

    ``groups`` gives each page its metric names: page_id, cluster_id, names.
    """
    stats = F.col("totalShareStatistics")
    rows = post_days.select(
        urn_id("share").alias("post_id"),
        urn_id("organizationalEntity").alias("page_id"),
        ms_to_date("timeRange.start").alias("post_start_date"),
        ms_to_date("timeRange.end").alias("post_end_date"),
        "totalShareStatistics",
        ratio(stats["clickCount"], stats["impressionCount"]).alias("post_ctr"),
    )
    slotted = metric_slots(rows.join(groups, "page_id"), "totalShareStatistics", "names")
    return slotted.drop("totalShareStatistics", "names")
