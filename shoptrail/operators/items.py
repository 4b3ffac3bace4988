"""Item arrays: one schema for all sources, and one row per item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail import schemas

# Fields a source's event does not carry, published as NULL.
_NOT_IN_EVENT = {
    "add_to_cart": frozenset(),
    "purchase": frozenset({"creative_name", "creative_slot"}),
    "view_item": frozenset(
        {"price_in_usd", "quantity", "item_revenue", "item_revenue_in_usd", "affiliation", "coupon"}
    ),
}


def normalise_items(items: str, source: str, event_name: str) -> Column:
    """The array with the 25 published item fields (ARR-2); NULL becomes empty."""
    raw = schemas.GA4_ITEM_FIELDS if source == "ga4" else schemas.SNOWPLOW_ITEM_FIELDS
    renames = {} if source == "ga4" else {"item_list_index": "index"}
    absent = _NOT_IN_EVENT[event_name]

    fields = []
    for name, kind in schemas.ITEM_FIELDS.items():
        origin = renames.get(name, name)
        value = f"item.`{origin}`" if origin in raw and name not in absent else "null"
        fields.append(f"'{name}', cast({value} as {kind})")
    rebuilt = f"transform(`{items}`, item -> named_struct({', '.join(fields)}))"
    return F.expr(f"coalesce({rebuilt}, cast(array() as {schemas.ITEM_ARRAY}))")


def one_row_per_item(events: DataFrame) -> DataFrame:
    """Unnest ``items`` with the 0-based ``item_offset`` (ARR-3, JOI-4).

    Events without items give no row. The item's fields become columns next to
    the event's; it is a narrow step without a shuffle.
    """
    others = [c for c in events.columns if c != "items"]
    rows = events.select(*others, F.posexplode("items").alias("item_offset", "item"))
    return rows.select(*others, "item_offset", "item.*")
