"""User features against plain Python, on fixtures with gaps, one-row users and a hot user."""

import math
import random
import statistics
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest

from tripledger.operators import features
from tripledger.sources import raw

SAMPLE = [
    ("pay-a", "ana", 1704106800000, 31.25, "completed", "Lisbon", "visa", "10.0.0.7", "phone"),
    ("pay-b", "ana", 1704107100000, 8.4, "completed", "Lisbon", "visa", "10.0.0.7", "phone"),
    ("pay-c", "ben", 1704107400000, 77.0, "failed", "Oslo", "amex", "10.0.0.9", "tablet"),
]
SCHEMA = (
    "transaction_id string, user_id string, timestamp long, amount double, status string, location string, "
    "card_type string, ip_address string, device_id string"
)


def test_sample(spark):
    rows = features.user_features(raw.with_event_time(spark.createDataFrame(SAMPLE, SCHEMA))).collect()
    by = {r["user_id"]: r for r in rows}
    one, other = by["ana"], by["ben"]
    assert [one[c] for c in features.DIVERSITY] == [1, 1, 1, 1]
    assert one["failed_txn_ratio"] == 0 and one["max_txn_count_hourly"] == 2
    assert math.isclose(one["risk_score"], 1.3)
    assert other["failed_txn_ratio"] == 1 and other["stddev_txn_amount"] is None
    assert math.isclose(other["risk_score"], 5.8)
    assert [r["user_id"] for r in features.high_risk(features.user_features(
        raw.with_event_time(spark.createDataFrame(SAMPLE, SCHEMA)))).collect()] == ["ben"]


def random_rows():
    rng = random.Random(3)
    start = datetime(2021, 1, 1)
    rows = []
    for k in range(900):
        user = "hot" if k % 3 == 0 else rng.choice(["a", "b", "c", None])
        at = start + timedelta(minutes=rng.randrange(3 * 366 * 24 * 60))
        amount = None if k % 50 == 1 else rng.randrange(1, 100000) / 100
        rows.append((
            None if k % 70 == 2 else f"t{k}", user, at, amount, rng.choice(["completed", "failed", "timeout", "declined", None]),
            rng.choice(["x", "y", None]), rng.choice(["visa", "amex"]), f"ip{rng.randrange(60)}", rng.choice(["d", None]),
        ))
    rows.append(("lone", "lone", start, 5.0, "completed", None, None, None, None))
    return rows


def expected(rows, grain):
    keys = {
        "clock": {"hourly": lambda t: t.hour, "daily": lambda t: t.date(), "weekly": lambda t: t.isocalendar()[1]},
        "bucket": {
            "hourly": lambda t: (t.date(), t.hour), "daily": lambda t: t.date(), "weekly": lambda t: t.isocalendar()[:2],
        },
    }[grain]
    users = defaultdict(list)
    for r in rows:
        users[r[1]].append(r)
    out = {}
    for user, mine in users.items():
        f = {}
        for period, key in keys.items():
            counts, cents = Counter(), Counter()
            for r in mine:
                counts[key(r[2])] += r[0] is not None
                cents[key(r[2])] += round((r[3] or 0) * 100)
            f[f"max_txn_count_{period}"] = max(counts.values())
            f[f"max_txn_amount_{period}"] = max(cents.values()) / 100
        amounts = [r[3] for r in mine if r[3] is not None]
        f["avg_txn_amount"] = statistics.fmean(amounts)
        f["stddev_txn_amount"] = statistics.stdev(amounts) if len(amounts) > 1 else None
        f["max_txn_amount"], f["min_txn_amount"] = max(amounts), min(amounts)
        for name, i in (("location_count", 5), ("card_type_count", 6), ("ip_count", 7), ("device_count", 8)):
            f[name] = len({r[i] for r in mine if r[i] is not None})
        f["failed_txn_count"] = sum(r[4] in ("failed", "declined", "rejected", "error", "timeout") for r in mine)
        f["failed_txn_ratio"] = f["failed_txn_count"] / sum(r[0] is not None for r in mine)
        out[user] = f
    return out


@pytest.mark.parametrize("grain", ["clock", "bucket"])
@pytest.mark.parametrize("exact", [True, False])
def test_against_python(spark, grain, exact):
    rows = random_rows()
    schema = SCHEMA.replace("timestamp long", "event_time timestamp")
    df = spark.createDataFrame(rows, schema).repartition(4)
    for partitions in ("3", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            got = features.user_features(df, grain=grain, exact_amounts=exact).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        want = expected(rows, grain)
        assert {r["user_id"] for r in got} == set(want) and len(got) == len(want)
        for r in got:
            for name, value in want[r["user_id"]].items():
                assert r[name] == value or math.isclose(r[name], value, rel_tol=1e-12), (r["user_id"], name)


def test_deviation_of_close_amounts(spark):
    """Large amounts a cent apart: the difference of squares must not cancel."""
    rows = [("t%d" % k, "u", datetime(2024, 1, 1), 12345678.90 + (k % 2) / 100, "completed", None, None, None, None) for k in range(100)]
    schema = SCHEMA.replace("timestamp long", "event_time timestamp")
    got = features.user_amounts(spark.createDataFrame(rows, schema)).collect()[0]["stddev_txn_amount"]
    assert math.isclose(got, 0.01 * math.sqrt(0.25 * 100 / 99), rel_tol=1e-9)


def test_context_agrees_with_features(spark):
    rows = random_rows()
    schema = SCHEMA.replace("timestamp long", "event_time timestamp")
    df = spark.createDataFrame(rows, schema)
    context = features.transaction_context(df)
    assert context.count() == len(rows)
    top = {r[0]: r[1] for r in context.groupBy("user_id").agg({"txn_count_weekly": "max"}).collect()}
    want = {r["user_id"]: r["max_txn_count_weekly"] for r in features.user_volume(df).collect()}
    assert top == want


def test_summary_of_nothing(spark):
    schema = SCHEMA.replace("timestamp long", "event_time timestamp")
    row = features.summarize(features.user_features(spark.createDataFrame([], schema))).collect()[0]
    assert row["user_count"] == 0 and row["high_risk_pct"] is None


def test_approximate_counts_are_close(spark):
    schema = SCHEMA.replace("timestamp long", "event_time timestamp")
    df = spark.createDataFrame(random_rows(), schema)
    near = {r["user_id"]: r for r in features.user_diversity(df, distinct="approx").collect()}
    for r in features.user_diversity(df).collect():
        for name in features.DIVERSITY:
            assert abs(near[r["user_id"]][name] - r[name]) <= 0.15 * r[name]


def test_amounts_of_any_size(spark):
    amounts = {"fine": [0.004, 0.004], "spread": [0.00001, 0.00003], "large": [1e17, 3e17], "vast": [1e300, None], "none": [None]}
    rows = [(f"t{u}{k}", u, datetime(2024, 1, 1), a, "completed", None, None, None, None) for u, s in amounts.items() for k, a in enumerate(s)]
    df = spark.createDataFrame(rows, SCHEMA.replace("timestamp long", "event_time timestamp"))
    got = {r["user_id"]: r for r in features.user_features(df).collect()}
    assert got["fine"]["avg_txn_amount"] == 0.004 and got["fine"]["max_txn_amount_hourly"] == 0.008
    assert math.isclose(got["spread"]["stddev_txn_amount"], statistics.stdev([0.00001, 0.00003]))
    assert math.isclose(got["large"]["stddev_txn_amount"], statistics.stdev([1e17, 3e17]))
    assert got["large"]["max_txn_amount_daily"] == 4e17 and got["vast"]["avg_txn_amount"] == 1e300
    assert got["none"]["avg_txn_amount"] is None and got["none"]["max_txn_amount_weekly"] is None
