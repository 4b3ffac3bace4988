"""Streams joined with streams: bought items with the carts they came from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def purchases_with_carts(purchases: DataFrame, carts: DataFrame, within: str = "7 days", purchase_delay: str = "2 hours", cart_delay: str = "1 hour") -> DataFrame:
    """Each bought item (purchase_pk, user_fk, item_id, purchase_ts) with the carts (add_to_cart_pk, user_fk, item_id,
    add_to_cart_ts) of its user and item at most ``within`` before it: a row for each cart, one without if there is none.

    Both streams have a watermark, and the condition on time bounds what each side keeps: a cart waits ``within``
    longer than its watermark, a purchase until no cart before it can come. A row without a cart comes out once, when
    that is sure. Of both sides rows behind their own watermark are left out; purchases without a user or item
    match nothing and come out without a cart; purchases without a time are left out. Works on tables just the same.
    """
    # A row of no time never falls behind a watermark and would wait for ever: it is left out of the state.
    bought = purchases.filter(F.col("purchase_ts").isNotNull()).withWatermark("purchase_ts", purchase_delay)
    put = carts.select("add_to_cart_pk", F.col("user_fk").alias("cart_user"), F.col("item_id").alias("cart_item"), "add_to_cart_ts")
    put = put.filter("cart_user is not null and cart_item is not null and add_to_cart_ts is not null").withWatermark("add_to_cart_ts", cart_delay)
    on = (
        (F.col("user_fk") == F.col("cart_user")) & (F.col("item_id") == F.col("cart_item"))
        & (F.col("add_to_cart_ts") <= F.col("purchase_ts")) & (F.col("add_to_cart_ts") >= F.col("purchase_ts") - F.expr(f"interval {within}"))
    )
    return bought.join(put, on, "left_outer").drop("cart_user", "cart_item")
