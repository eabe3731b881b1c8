"""History of families from dated events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kohortflow.functions.exprs import ADULT_AGE
from kohortflow.operators.aggregates import latest_per_key


def family_history(events: DataFrame) -> DataFrame:
    """New family id from the year of a divorce, a death, or the moving out of an adult.

    ``events``: person_id, year, event_type, age, event_id (unique). The last event of a year counts.
    """
    counts = F.col("event_type").isin("divorce", "death") | (
        (F.col("event_type") == "child_moving_out") & (F.col("age") >= ADULT_AGE)
    )
    changed = events.where(counts).select(
        "person_id", "year", "event_id", F.concat(F.lit("F"), F.col("event_id").cast("string")).alias("family_id")
    )
    return latest_per_key(changed, ["person_id", "year"], [F.col("event_id")]).select(
        "person_id", "year", "family_id"
    )
