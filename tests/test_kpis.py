"""Edge cases of the KPI operators."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from urbanpulse import schemas as S
from urbanpulse.operators import kpis, quality
from urbanpulse.plans.lakehouse import Lakehouse


def test_unknown_zone_gives_no_row(spark):
    lh = Lakehouse(spark, SF_SMALL)
    assert kpis.zone_detail(lh.fact, lh.dim_zone, "nowhere").count() == 0
    assert kpis.zone_detail(lh.fact, lh.dim_zone, "cBd").count() == 1


def test_zone_status_approximate_close_to_exact(spark):
    lh = Lakehouse(spark, SF_SMALL)
    exact = {r.city_zone: r.active_vehicles for r in kpis.zone_status(lh.fact, lh.dim_zone).collect()}
    approx = {r.city_zone: r.active_vehicles
              for r in kpis.zone_status(lh.fact, lh.dim_zone, approximate=True).collect()}
    assert exact.keys() == approx.keys()
    for z in exact:
        assert abs(exact[z] - approx[z]) <= max(2, 0.1 * exact[z])


def test_zone_status_since(spark):
    lh = Lakehouse(spark, SF_SMALL)
    late = kpis.zone_status(lh.fact, lh.dim_zone, since=F.lit("2024-01-30").cast("timestamp"))
    full = kpis.zone_status(lh.fact, lh.dim_zone)
    a = {r.city_zone: r.active_vehicles for r in late.collect()}
    b = {r.city_zone: r.active_vehicles for r in full.collect()}
    assert all(a[z] <= b[z] for z in a)


def test_banner_on_empty_input(spark):
    lh = Lakehouse(spark, SF_SMALL)
    empty_fact = lh.fact.where(F.lit(False))
    empty_dlq = lh.quarantine.where(F.lit(False))
    r = kpis.banner_kpis(empty_fact, empty_dlq).first()
    assert (r.total_clean, r.total_quarantined, r.total_events) == (0, 0, 0)
    assert (r.dq_pass_rate_pct, r.avg_velocity_kmh, r.high_congestion_pct) == (100.0, 0.0, 0.0)


def test_sla_matrix_counts_match_status_counts(spark):
    lh = Lakehouse(spark, SF_SMALL)
    m = {r.dq_rule: r.failed_events for r in quality.dq_sla_matrix(lh.evaluated).collect()}
    by_status = {r[0]: r[1] for r in lh.evaluated.groupBy("dq_status").count().collect()}
    for rule, status in quality.SLA_RULE_STATUS.items():
        assert m[rule] == by_status.get(status, 0)
    audit = quality.dlq_sla_audit(lh.evaluated).first()
    assert audit.total_events == 1033 and audit.quarantined_events == 1033 - by_status[S.STATUS_VALID]
    assert audit.sla_breached is True  # the fixture is dirtier than 5 %
