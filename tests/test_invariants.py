"""Figures that must agree between queries, over the whole tables."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from soleprint.operators import counters, joins, tables, windows
from soleprint.plans import testviews as views


def test_counts_agree(spark, sf_dir):
    q = {name: queries()[name](spark, sf_dir) for name in (
        "click_source", "enriched_clicks", "unmatched_clicks", "views_tumbling",
        "views_compacted", "views_hopping", "late_clicks", "running_total")}
    clicks = q["click_source"].count()
    assert q["enriched_clicks"].count() + q["unmatched_clicks"].agg(F.sum("clicks")).first()[0] == clicks
    assert sorted(q["views_compacted"].collect()) == sorted(q["views_tumbling"].collect())
    assert q["views_hopping"].agg(F.sum("views")).first()[0] == 10 * clicks
    assert q["running_total"].agg(F.max("total")).first()[0] == clicks
    assert 0 < q["late_clicks"].count() < clicks


SCANS = {
    "asof": lambda clicks, updates, n: joins.enrich_asof(clicks, updates, slice_rows=n),
    "changelog": lambda clicks, updates, n: windows.views_changelog(
        clicks, "page_url", slice_rows=n),
    "stream_time": lambda clicks, updates, n: windows.with_stream_time(clicks, slice_rows=n),
    "ticks": lambda clicks, updates, n: counters.stream_time_ticks(clicks, slice_rows=n),
    "total": lambda clicks, updates, n: counters.running_total(clicks, slice_rows=n),
    "total_by": lambda clicks, updates, n: counters.running_total(
        clicks, ["partition"], slice_rows=n),
    "versions": lambda clicks, updates, n: tables.table_changelog(
        updates, "id", ("ts", "event_id"), slice_rows=n),
}


@pytest.mark.parametrize("name", sorted(SCANS))
def test_slicing_changes_no_result(spark, name):
    """Whole keys, spans of time and row ranges give the same rows."""
    small = "/root/testdata/sf0.001"
    clicks, updates = views.clicks(spark, small), views.shoe_updates(spark, small)
    whole, spans, ranges = (
        sorted(map(tuple, SCANS[name](clicks, updates, n).collect()), key=repr)
        for n in (10**9, 5, 1)
    )
    assert whole == spans == ranges
