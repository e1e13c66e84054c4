"""The derived message feed has the fault mix documented in FIXTURES.md."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from urbanpulse import schemas as S
from urbanpulse.operators import quality
from urbanpulse.plans.lakehouse import Lakehouse

EXPECTED = {
    S.STATUS_CORRUPT: 18, S.STATUS_NO_VEHICLE: 46, S.STATUS_BAD_TS: 14, S.STATUS_SPEED: 89,
    S.STATUS_FUTURE: 16, S.STATUS_LATENCY: 18, S.STATUS_VALID: 832,
}


def test_class_counts(spark):
    lh = Lakehouse(spark, SF_SMALL)
    assert lh.messages.count() == 1033
    got = {r[0]: r[1] for r in lh.evaluated.groupBy("dq_status").count().collect()}
    assert got == EXPECTED
    assert lh.silver.count() == 800
    assert lh.fact.select(F.countDistinct("event_date"), F.countDistinct("event_hour"),
                          F.countDistinct("city_zone"), F.countDistinct("road_id")).first() == (30, 24, 6, 5)


def test_rules_partition_the_input(spark):
    """Every message gets exactly one status; clean + quarantine = all."""
    lh = Lakehouse(spark, SF_SMALL)
    total = lh.evaluated.count()
    assert lh.quarantine.count() + lh.valid.count() == total
    assert lh.evaluated.where(F.col("dq_status").isNull()).count() == 0


def test_drift_report(spark):
    lh = Lakehouse(spark, SF_SMALL)
    rows = {r.drift_key: r.rows for r in quality.schema_drift_report(lh.bronze).collect()}
    assert rows == {"road_surface_temp_c": 53, "firmware_version": 53}
