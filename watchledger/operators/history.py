"""Slowly changing dimension with one row per version (type 2)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VALID_FROM, VALID_TO = "dbt_valid_from", "dbt_valid_to"


def scd2_merge(
    load: DataFrame,
    prior: DataFrame | None,
    key: str,
    check: Sequence[str],
    load_time: dt.datetime,
) -> DataFrame:
    """All versions after taking in a new load.

    A key whose ``check`` columns differ (null counts as a value) gets its open
    version closed at ``load_time`` and a new one opened. Other columns alone
    change nothing, and a key missing from the load stays open. The load must
    hold each key once. The result must not be written over ``prior``. An open
    version that begins at ``load_time`` or later fails the job: loads come in
    order, or versions would end before they begin.
    """
    now = F.lit(load_time.isoformat(sep=" ")).cast("timestamp_ntz")
    never = F.lit(None).cast("timestamp_ntz")
    opened = load.select("*", now.alias(VALID_FROM), never.alias(VALID_TO))
    if prior is None:
        return opened

    columns = opened.columns
    still_open = F.col(VALID_TO).isNull()
    late = F.concat(
        F.lit(f"the load of {load_time} comes after a version that begins at "),
        F.col(VALID_FROM).cast("string"),
    )
    begun = F.when(F.col(VALID_FROM) < now, F.col(VALID_FROM)).otherwise(
        F.raise_error(late).cast("timestamp_ntz")
    )
    in_order = prior.where(still_open).withColumn(VALID_FROM, begun)
    old = in_order.select(F.struct(*columns).alias("old"))
    new = opened.select(F.struct(*columns).alias("new"))
    pairs = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")

    same = F.lit(True)
    for column in check:
        same = same & F.col(f"old.{column}").eqNullSafe(F.col(f"new.{column}"))
    both = F.col("old").isNotNull() & F.col("new").isNotNull()
    changed = both & ~same
    kept = F.when(changed, F.col("old").withField(VALID_TO, now)).otherwise(F.col("old"))
    added = F.when(F.col("old").isNull() | changed, F.col("new"))
    versions = pairs.select(F.explode(F.array(kept, added)).alias("version"))
    current = versions.where("version is not null").select("version.*")
    return prior.where(~still_open).select(*columns).unionByName(current)
