"""The three jobs as batch plans, from decoded logs to results.

The streaming forms in ``soleprint.streaming.jobs`` are built from the same operators.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from soleprint.operators.counters import running_total
from soleprint.operators.joins import enrich
from soleprint.operators.tables import latest_by_key
from soleprint.operators.windows import (
    HOPPING,
    RETENTION_SECONDS,
    count_views,
    count_views_by_name,
    live_windows,
)
from soleprint.schemas import CLICK, ENRICHED_CLICK, SHOE
from soleprint.sources.records import decode_records, good_records, quarantined


@dataclass(frozen=True)
class ProductViews:
    enriched: DataFrame
    views: DataFrame


@dataclass(frozen=True)
class RetainedViews:
    views: DataFrame
    live: DataFrame


def decode_clicks(records: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Click records as (typed rows, quarantined records)."""
    decoded = decode_records(records, CLICK, strict)
    return good_records(decoded), quarantined(decoded)


def decode_shoes(records: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Product records as (typed rows, quarantined records)."""
    decoded = decode_records(records, SHOE, strict)
    return good_records(decoded), quarantined(decoded)


def decode_enriched(records: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Enriched click records as (typed rows, quarantined records)."""
    decoded = decode_records(records, ENRICHED_CLICK, strict)
    return good_records(decoded), quarantined(decoded)


def product_views(
    clicks: DataFrame, shoe_log: DataFrame, shoe_order: Sequence[str] = ("ts", "offset")
) -> ProductViews:
    """Clicks enriched from the product table, and views per product name and window."""
    shoes = latest_by_key(shoe_log, ["id"], shoe_order)
    return ProductViews(enrich(clicks, shoes), count_views_by_name(clicks, shoes))


def click_counter(clicks: DataFrame, by: Sequence[str] = ("partition",),
                  order: Sequence[str] = ("ts", "offset")) -> DataFrame:
    """The running number of clicks, one row per click, per log partition."""
    return running_total(clicks, by, order)


def retained_views(clicks: DataFrame) -> RetainedViews:
    """Views per product id in hopping windows, and those still within retention."""
    return RetainedViews(
        count_views(clicks, "product_id", HOPPING),
        live_windows(clicks, "product_id", HOPPING, RETENTION_SECONDS),
    )
