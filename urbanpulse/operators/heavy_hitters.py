"""Frequent vehicles from mergeable hourly summaries.

The summary of an hour holds its ``size`` most frequent values with their counts, and
``floor``: the greatest count of a value that it does not hold (0 where it holds all).  Summaries of
any hours merge: a value's count is at least the sum of the counts that were kept and at most
that sum plus the floors of the hours that do not hold it.  So each estimate comes with
an error, and the exact count lies in ``[estimate - error, estimate]``, always.

An hour is counted once, by (hour, value) with a partial aggregate, so a hot value costs a row per
task; ranking keeps ``size + 1`` rows an hour below the shuffle as well.  Later questions
read summaries only, ``size`` rows an hour whatever the traffic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SIZE = 1_000
HOUR = ["event_date", "event_hour"]


def summarise(fact: DataFrame, value: str = "vehicle_id", size: int = SIZE, hour: Sequence[str] = HOUR) -> DataFrame:
    """(hour, value, times, floor): the summary of every hour; NULL values are not counted.

    Ties of the last place go to the smaller value.
    """
    counted = fact.where(F.col(value).isNotNull()).groupBy(*hour, F.col(value).alias("value")).agg(
        F.count(F.lit(1)).alias("times"))
    ranked = counted.withColumn("place", F.row_number().over(
        Window.partitionBy(*hour).orderBy(F.col("times").desc(), "value"))).where(F.col("place") <= size + 1)
    # size + 1 rows an hour are left
    floor = F.max(F.when(F.col("place") == size + 1, F.col("times"))).over(Window.partitionBy(*hour))
    return (ranked.withColumn("floor", F.coalesce(floor, F.lit(0))).where(F.col("place") <= size)
            .select(*hour, "value", "times", "floor"))


def combine(summaries: DataFrame, hour: Sequence[str] = HOUR) -> DataFrame:
    """(value, estimate, error) over all hours of ``summaries`` (filter them for a range).

    A value that no summary holds occurs at most as often as all floors together; it has no row.
    """
    floors = summaries.groupBy(*hour).agg(F.max("floor").alias("floor")).agg(F.coalesce(F.sum("floor"), F.lit(0)).alias("all_floors"))
    held = summaries.groupBy("value").agg(F.sum("times").alias("times"), F.sum("floor").alias("own_floors"))
    error = floors.scalar() - F.col("own_floors")
    return held.select("value", (F.col("times") + error).alias("estimate"), error.alias("error"))


def top_k(summaries: DataFrame, k: int, hour: Sequence[str] = HOUR) -> DataFrame:
    """The ``k`` values with the greatest estimates; ties go to the smaller value."""
    return combine(summaries, hour).orderBy(F.col("estimate").desc(), "value").limit(k)
