"""Filters, search, queues, custom weights and alias coalescing."""

import datetime as dt

from pyspark.sql import functions as F

from paysignal.config import RuleConfig
from paysignal.operators import alerts, rules, standardize
from paysignal.schema import TYPED

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def scored(spark, cfg=None):
    rows = [
        ("a", "U1", "D", 0, 60000.0, "Mumbai", "SUCCESS"),
        ("b", "U1", "D", 30, 10.0, "Delhi", "SUCCESS"),
        ("c", "u2", "E", 5000, 10.0, "Pune", "FAILED"),
        ("d", "U3", "F", 9000, 10.0, None, "SUCCESS"),
    ]
    data = [(t, "R" + t, u, T0 + dt.timedelta(seconds=s), a, "a@b", "c@d", "m", c, d, "1.1.1.1", st, None) for t, u, d, s, a, c, st in rows]
    return rules.score(spark.createDataFrame(data, TYPED), cfg or RuleConfig(), label_style="labels")


def ids(df):
    return sorted(r.transaction_id for r in df.collect())


def test_reason_filters(spark):
    s = scored(spark)
    assert ids(alerts.filter_transactions(s, risk_levels=None, reasons=[])) == []
    assert ids(alerts.filter_transactions(s, risk_levels=None, reasons=["Any reason"])) == ["a", "b", "c", "d"]
    assert ids(alerts.filter_transactions(s, risk_levels=None, reasons=["No rule triggered"])) == ["c", "d"]
    assert ids(alerts.filter_transactions(s, risk_levels=None, reasons=["Velocity check"])) == ["a", "b"]


def test_in_lists_nulls_and_user_search(spark):
    s = scored(spark)
    assert ids(alerts.filter_transactions(s, risk_levels=None, cities=["Mumbai", "Pune"])) == ["a", "c"]
    assert ids(alerts.filter_transactions(s, risk_levels=None, user_query="u")) == ["a", "b", "c", "d"]
    assert ids(alerts.filter_transactions(s, risk_levels=None, user_query="^u[23]$", user_regex=True)) == ["c", "d"]
    assert ids(alerts.filter_transactions(s, risk_levels=None, amount_min=11.0)) == ["a"]
    assert ids(alerts.filter_transactions(s, start_date="2024-01-02", risk_levels=None)) == []


def test_queue_and_search(spark):
    s = scored(spark)
    fraud = s.filter("is_fraud")
    q = alerts.alert_queue(fraud, "amount", n=1).collect()
    assert [r.transaction_id for r in q] == ["a"] and q[0].investigation_status == "Review"
    assert ids(alerts.search(alerts.with_investigation_status(fraud), "DELHI")) == ["b"]


def test_custom_weights_and_cap(spark):
    cfg = RuleConfig(weights={"velocity_check": 70, "geo_anomaly": 70, "device_mule_check": 0, "failure_burst_check": 0}, cap=90)
    r = {x.transaction_id: x for x in scored(spark, cfg).collect()}
    assert r["a"].risk_score == 90 and r["a"].risk_level == "Critical"


def test_alias_coalesces_with_canonical(spark):
    df = spark.createDataFrame([("t1", None, "Pune"), ("t2", "Agra", "Pune")], "transaction_id string, location_city string, city string")
    got = {r.transaction_id: r.location_city for r in standardize.standardize(df).collect()}
    assert got == {"t1": "Pune", "t2": "Agra"}
