"""Folded days: merged in any grouping they give the features of the whole."""

import math
import random
from datetime import date, datetime, timedelta
from functools import reduce

import pytest
from pyspark.sql import functions as F

from tripledger.operators import features, partials
from tripledger.sources import folds

SCHEMA = ("transaction_id string, user_id string, event_time timestamp, amount double, status string, location string, "
          "card_type string, ip_address string, device_id string")
START = datetime(2024, 1, 1)


def rows(n=600, cents=True):
    rng = random.Random(9)
    return [(
        f"t{k}" if k % 50 else None, rng.choice(["hot", "hot", "a", "b", None]), START + timedelta(minutes=rng.randrange(20 * 24 * 60)),
        (rng.randrange(100_000) / 100 if cents else rng.random() * 1e6) if k % 40 else None,
        rng.choice(["completed", "failed", None]), rng.choice(["x", "y", None]), "visa", f"ip{rng.randrange(40)}", None) for k in range(n)]


def whole(spark, **kind):
    return spark.createDataFrame(rows(**kind), SCHEMA)


def by_user(df):
    return {r["user_id"]: r.asDict() for r in df.drop("feature_extraction_time").collect()}


@pytest.mark.parametrize("grain", partials.GRAINS)
def test_parts_merge_to_the_whole(spark, grain):
    txns = whole(spark)
    day = F.dayofmonth("event_time")
    parts = [partials.fold(txns.filter(day % 4 == k)) for k in range(4)]
    merged = partials.merge(reduce(lambda a, b: a.unionByName(b), parts), grain=grain)
    assert by_user(merged) == by_user(features.user_features(txns, grain=grain))


def test_same_as_features_part_by_part(spark):
    txns = whole(spark)
    got = by_user(features.user_features(txns))
    volume, profile = by_user(features.user_volume(txns)), by_user(features.user_profile(txns))
    assert got.keys() == volume.keys() == profile.keys()
    for user, row in got.items():
        assert {**volume[user], **profile[user]}.items() <= row.items()


def test_deviation_of_amounts_that_are_no_cents(spark):
    txns = whole(spark, cents=False)
    got, want = by_user(features.user_features(txns)), by_user(features.user_amounts(txns))
    for user, row in want.items():
        assert math.isclose(got[user]["stddev_txn_amount"], row["stddev_txn_amount"], rel_tol=1e-12)
        assert math.isclose(got[user]["avg_txn_amount"], row["avg_txn_amount"], rel_tol=1e-14)


def test_one_scan(spark, tmp_path):
    whole(spark).write.parquet(f"{tmp_path}/t")
    plan = features.user_features(spark.read.parquet(f"{tmp_path}/t"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and "Window" not in plan


def test_days_are_kept_and_folded_anew(spark, tmp_path):
    path, txns = f"{tmp_path}/days", whole(spark)
    day = F.to_date("event_time")
    folds.write_days(txns.filter(day <= F.lit("2024-01-10").cast("date")), path)
    early = txns.filter((day == F.lit("2024-01-11").cast("date")) & (F.hour("event_time") < 9))
    folds.write_days(early, path)
    folds.write_days(txns.filter(day >= F.lit("2024-01-11").cast("date")), path)  # the rest came late
    assert folds.kept_days(spark, path) == {date(2024, 1, d) for d in range(1, 21)}
    first, last = date(2024, 1, 5), date(2024, 1, 11)
    week = txns.filter(day.between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date")))
    kept = folds.read_days(spark, path, first, last)
    assert by_user(partials.merge(kept)) == by_user(features.user_features(week))
    scan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in scan  # other days are not opened


def test_nothing_folded(spark, tmp_path):
    assert folds.kept_days(spark, f"{tmp_path}/none") == set()
    assert features.user_features(spark.createDataFrame([], SCHEMA)).count() == 0
