"""Quality checks measured by the job that writes the table (Q12, Q14, Q15, Q16).

Every check is a count over rows, so it can be observed while the rows pass to the sink: no second
scan.  ``write_checked`` does so for a batch, ``observe_stream`` for a stream, whose counts come with the
progress of each micro-batch and add up.  Uniqueness (Q13) needs a shuffle by the key and stays a
query of its own.

Observed counts are those of the rows that the successful write job produced; a job
that recomputes a lost task counts its rows once.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from urbanpulse import schemas as S
from urbanpulse.functions.columns import count_if
from urbanpulse.operators.quality import SLA_RULE_STATUS


class Check(NamedTuple):
    """Rows of ``model`` for which ``fails`` holds are failures of ``test`` on ``column``."""

    model: str
    test: str
    column: str
    fails: Column

    @property
    def name(self) -> str:
        return f"{self.model}|{self.test}|{self.column}"


def not_null(model: str, columns: Sequence[str]) -> list[Check]:
    return [Check(model, "not_null", c, F.col(c).isNull()) for c in columns]


def accepted(model: str, column: str, values: Sequence[Any]) -> Check:
    """NULL is not counted."""
    c = F.col(column)
    return Check(model, "accepted_values", column, c.isNotNull() & ~c.isin(*values))


def rule_checks(model: str = "traffic_bronze") -> list[Check]:
    """Rows that fail each rule of the SLA matrix, and all that are quarantined."""
    status = F.col("dq_status")
    return [Check(model, "sla", rule, status == SLA_RULE_STATUS[rule]) for rule, _, _ in S.DQ_SLA_TARGETS] + [
        Check(model, "sla", "quarantined", status != S.STATUS_VALID)]


CHECK_SCHEMA = "model string, test string, column_name string, failures long, total long"


def _metrics(checks: Sequence[Check]) -> list[Column]:
    return [F.count(F.lit(1)).alias("total"), *(count_if(c.fails).alias(c.name) for c in checks)]


def report(spark: SparkSession, checks: Sequence[Check], found: dict[str, int]) -> DataFrame:
    """(model, test, column_name, failures, total) of observed counts."""
    return spark.createDataFrame([(c.model, c.test, c.column, int(found.get(c.name) or 0), int(found.get("total") or 0))
                                  for c in checks], CHECK_SCHEMA)


def observed(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, Observation]:
    """``df`` whose next action also counts the failures of ``checks``, over the rows as they are here:
    what is filtered or projected later does not change the counts."""
    seen = Observation()
    return df.observe(seen, *_metrics(checks)), seen


def write_checked(df: DataFrame, path: str, checks: Sequence[Check]) -> DataFrame:
    """Write ``df`` as a table and report the checks that its write job counted."""
    rows, seen = observed(df, checks)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return report(df.sparkSession, checks, seen.get)


def observe_stream(df: DataFrame, name: str, checks: Sequence[Check]) -> DataFrame:
    """A stream whose progress carries the counts under ``name`` (see ``StreamHealth.observed``)."""
    return df.observe(name, *_metrics(checks))
