"""Rates, status ladders and hash draws as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status wording read by downstream consumers.
RED, AMBER, GREEN = "RED", "AMBER", "GREEN"
DRIFT_RED, DRIFT_AMBER, DRIFT_GREEN = "RED — escalate", "AMBER — watch", "GREEN — ok"
GAP_RED, GAP_AMBER, GAP_GREEN = "RED — investigate", "AMBER — watch", "GREEN"


def rate(part: Column, whole: Column) -> Column:
    """part / whole, NULL when undefined."""
    return F.try_divide(part, whole)


def rate_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, NULL when undefined."""
    return F.try_divide(F.lit(100) * part, whole)


def ladder(value: Column, red_above: Column, amber_above: Column,
           red: str = RED, amber: str = AMBER, green: str = GREEN) -> Column:
    """Strictly above a limit trips it; an undefined value is green."""
    return F.when(value > red_above, red).when(value > amber_above, amber).otherwise(green)


def hash_unit(key: Column, seed: int | str) -> Column:
    """A draw in [0, 1) that depends on the key and seed only, not on partitioning."""
    digest = F.md5(F.concat(F.lit(f"{seed}-"), key.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_order(key: Column, seed: int | str) -> Column:
    """A pseudo-random sort key that depends on the key and seed only."""
    return F.md5(F.concat(F.lit(f"{seed}-"), key.cast("string")).cast("binary"))
