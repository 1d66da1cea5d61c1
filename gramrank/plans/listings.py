"""Business listings as points: postal number against popularity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramrank.functions.listing import ZIP_SCALE, popularity, valid_code, zip_number
from gramrank.sources.text import parse_businesses


def valid_businesses(lines: DataFrame) -> DataFrame:
    """``[name, state, zip, stars, reviews]`` of the listings that are complete and
    have a postal code; ``zip`` is the code as a number."""
    rows = parse_businesses(lines)
    code, second = F.col("code"), F.col("second")
    return (
        rows.where(
            (F.col("n_parts") == 2) & (F.col("n_fields") >= 5) & valid_code(code, second)
        )
        .select("name", "state", zip_number(code, second).alias("zip"), "stars", "reviews")
        .where(
            F.col("zip").isNotNull() & F.col("stars").isNotNull() & (F.col("reviews") >= 1)
        )
    )


def in_states(businesses: DataFrame, state1: str, state2: str) -> DataFrame:
    """Listings of either state; ``ALL`` as the first keeps every state."""
    if state1 == "ALL":
        return businesses
    return businesses.where(F.col("state").isin(state1, state2))


def business_points(lines: DataFrame, state1: str = "ALL", state2: str = "ALL") -> DataFrame:
    """``[name, x, y]`` of the valid listings of the given states."""
    return in_states(valid_businesses(lines), state1, state2).select(
        "name",
        (F.col("zip") / ZIP_SCALE).alias("x"),
        popularity(F.col("stars"), F.col("reviews")).alias("y"),
    )
