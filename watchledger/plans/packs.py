"""Revenue of packs: an order for a group, dealt to the group's members."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchledger.functions import month_start
from watchledger.functions.amounts import cents
from watchledger.operators.apportion import apportion
from watchledger.plans.facts import MONEY
from watchledger.scratch import Scratch


def pack_orders(orders: DataFrame) -> DataFrame:
    """Orders of ``fact_order`` that are for a pack and no subscription."""
    is_pack = F.upper("line_items").contains("PACK") & F.col("subscription_type").isNull()
    return orders.where(is_pack & F.col("net_amount_usd").isNotNull()).select(
        "order_key",
        F.col("customer_key").alias("buyer_key"),
        month_start(F.col("order_created_at")).alias("revenue_month"),
        "net_amount_usd",
    )


def pack_revenue(
    packs: DataFrame, members: DataFrame, consumption: DataFrame, scratch: Scratch
) -> DataFrame:
    """Each pack's amount over the members of its buyer's group, to the cent.

    ``members`` has group_id and customer_key, a row per member. Members are weighed
    by the minutes they watched in the month of the order; if none watched, they get
    even parts. Parts of an order add up to its amount: what is left over goes to the
    largest remainders, then the smallest key. Negative amounts are dealt like
    positive ones. An order whose buyer is in no group stays whole, in a row without
    a member.

    A group may have any number of members or orders: minutes are summed per customer
    and month first, and no window takes an order.
    """
    groups = members.select("group_id", F.col("customer_key").alias("buyer_key"))
    everyone = members.select("group_id", F.col("customer_key").alias("member_key"))
    minutes = consumption.groupBy(
        F.col("customer_key").alias("member_key"),
        F.col("consumption_month").alias("revenue_month"),
    ).agg(F.sum("total_minutes_consumed").alias("member_minutes"))
    spread = (
        packs.join(groups, "buyer_key", "left")
        .join(everyone, "group_id", "left")
        .join(minutes, ["member_key", "revenue_month"], "left")
    )
    amount = cents(F.col("net_amount_usd")).cast("long")
    weighed = spread.select(
        "order_key",
        "buyer_key",
        "member_key",
        "revenue_month",
        "net_amount_usd",
        F.coalesce("member_minutes", F.lit(0)).cast("long").alias("member_minutes"),
        F.abs(amount).alias("order_cents"),
    )
    dealt = apportion(
        weighed, ["order_key"], "order_cents", "member_minutes", "part_cents",
        [F.asc("member_key")], scratch,
    )
    signed = F.col("part_cents") * F.signum("net_amount_usd").cast("int")
    revenue = signed.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")
    return dealt.select(
        "order_key",
        "buyer_key",
        "member_key",
        "revenue_month",
        "member_minutes",
        "net_amount_usd",
        revenue.cast(MONEY).alias("member_revenue"),
    )
