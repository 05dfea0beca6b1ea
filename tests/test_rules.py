"""Message classes, fraud rules, verdict lines, bursts."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripledger.functions import messages
from tripledger.operators import burst, rules
from tripledger.operators.skew import KeyProfile
from tripledger.plans.jobs import batch_verdicts

CLASSES = [
    ('{"user_id":"u1","amount":10.0,"status":"completed"}', "normal"),
    ('{"user_id":"u1","amount":"12.5"}', "normal"),
    ('{"user_id":"u1","amount":5,"status":"declined"}', "alert"),
    ('{"user_id":"u1","amount":5,"status":null}', "normal"),
    ('{"user_id":"","amount":5}', "missing"),
    ('{"amount":5}', "missing"),
    ('{"user_id":"u1"}', "missing"),
    ("{}", "missing"),
    ('{"user_id":"u1","amount":0}', "normal"),
    ('{"user_id":"u1","amount":200.0}', "normal"),
    ('{"user_id":"u1","amount":200.01}', "alert"),
    ('{"user_id":"u1","amount":"abc"}', "error"),
    ('{"user_id":"u1","amount":"1.5d"}', "error"),
    ('{"user_id":"u1","amount":[1]}', "error"),
    ('{"user_id":"u1","amount":" 1e2 "}', "normal"),
    ("5", "error"),
    ("[1]", "error"),
    ('"text"', "error"),
    ("null", "error"),
    (None, "error"),
    ("hello", "invalid"),
    ("", "invalid"),
    ('{"user_id":', "invalid"),
    ('{"user_id":"u1","amount":5} tail', "invalid"),
    ("{'user_id':'u1','amount':5}", "invalid"),
    ('  {"user_id":"u1","amount":5}\t', "normal"),
    ("Transaction: u9, amount=7.5 trailing", "normal"),
    ("Transaction: u9, amount=7", "invalid"),
    ("Transaction: jürgen, amount=7.5", "normal"),
    (" Transaction: u9, amount=7.5", "invalid"),
]


def test_message_classes(spark):
    df = spark.createDataFrame([(v, c) for v, c in CLASSES], "value string, want string")
    judged = messages.classify(messages.parse_messages(df)).withColumn("got", messages.class_alone())
    wrong = judged.filter(~F.col("got").eqNullSafe(F.col("want"))).select("value", "want", "got").collect()
    assert wrong == []


def test_text_stream_lines(spark):
    sent = [
        "Transaction: user1, amount=100.0",
        "Transaction: user2, amount=250.0",
        "Transaction: user1, amount=300.0",
        "Transaction: user3, amount=50.0",
        "Transaction: user2, amount=150.0",
        "Transaction: user3, amount=350.0",
        "nonsense",
    ]
    df = spark.createDataFrame(list(enumerate(sent)), "arrival int, value string")
    rows = batch_verdicts(df, order_by=("arrival",)).orderBy("arrival").collect()
    large = "Large transaction of {} exceeds threshold of 200.0"
    assert [r["verdict"] for r in rows] == [
        "NORMAL: user1 - 100.00",
        f"FRAUD ALERT: user2 - 250.00 - {large.format(250.0)}",
        f"FRAUD ALERT: user1 - 300.00 - {large.format(300.0)} & Multiple transactions totaling 400.00 from user user1",
        "NORMAL: user3 - 50.00",
        "FRAUD ALERT: user2 - 150.00 - Multiple transactions totaling 400.00 from user user2",
        f"FRAUD ALERT: user3 - 350.00 - {large.format(350.0)} & Multiple transactions totaling 400.00 from user user3",
        "Invalid transaction format: nonsense",
    ]


def history(spark, seed=1):
    """A user with a third of all rows, many of them identical copies."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = []
    for k in range(400):
        at = start + timedelta(seconds=rng.randrange(600))
        rows.append((f"t{k}", rng.choice("abcdef"), at, rng.randrange(1, 30000) / 100, rng.choice(["completed", "failed"])))
    rows += [(f"h{k}", "hot", start + timedelta(seconds=k % 50), 1.25, "completed") for k in range(100)]
    rows += [("same", "hot", start + timedelta(seconds=7), 2.5, "declined")] * 100
    return spark.createDataFrame(rows, "transaction_id string, user_id string, event_time timestamp, amount double, status string").repartition(5)


def brute_running(rows):
    out, state = Counter(), {}
    for r in sorted(rows, key=lambda r: (r["event_time"], r["transaction_id"], r["amount"], r["status"])):
        n, cents = state.get(r["user_id"], (0, 0))
        state[r["user_id"]] = n, cents = n + 1, cents + round(r["amount"] * 100)
        out[(r["transaction_id"], r["user_id"], n, cents / 100)] += 1
    return out


@pytest.mark.parametrize("skew", [KeyProfile(), KeyProfile(600, 0, {"hot": 200}), KeyProfile(600, 0, {"hot": 200, "a": 60, "gone": 9})])
def test_running_totals(spark, skew):
    df = history(spark)
    got = rules.fraud_rules(df, skew=skew, rows_per_slice=13)
    rows = got.select("transaction_id", "user_id", "txn_count", "txn_total").collect()
    assert Counter(map(tuple, rows)) == brute_running(df.collect())


def test_slices_split_identical_copies(spark):
    df = history(spark).filter("user_id = 'hot'")
    sliced = rules._sliced(df, ["event_time", "transaction_id", "amount", "status"], {"hot": 200}, 13)
    assert sliced.filter("transaction_id = 'same'").count() == 100
    ranged = df.withColumn("_copy", F.xxhash64(F.spark_partition_id(), "transaction_id")).repartitionByRange(
        8, "user_id", "event_time", "transaction_id", "_copy"
    )
    assert ranged.filter("transaction_id = 'same'").select(F.spark_partition_id()).distinct().count() > 1


def test_burst_shape(spark):
    start = datetime(2024, 1, 1)
    rows = [(f"a{k}", "u1", start + timedelta(seconds=5 * k)) for k in range(5)]
    rows += [(f"b{k}", "u2", start + timedelta(seconds=10 * k)) for k in range(5)]
    rows += [("n", None, start), ("m", "u1", None)]
    df = spark.createDataFrame(rows, "transaction_id string, user_id string, event_time timestamp")
    for skew in (KeyProfile(), KeyProfile(12, 1, {"u1": 6})):
        found = burst.burst_detect(df, skew=skew)
        assert [r[0] for r in found.filter("is_burst").select("transaction_id").collect()] == ["a4"]
        zero = {r[0] for r in found.filter("burst_count = 0").select("transaction_id").collect()}
        assert zero == {"n", "m"}


@pytest.mark.parametrize("seconds", [1, 7, 30, 86400])
def test_burst_against_brute_force(spark, seconds):
    df = history(spark)
    rows = df.collect()
    want = Counter(
        (r["transaction_id"], r["user_id"], sum(
            o["user_id"] == r["user_id"] and timedelta() <= r["event_time"] - o["event_time"] <= timedelta(seconds=seconds)
            for o in rows))
        for r in rows
    )
    for skew in (KeyProfile(), KeyProfile(600, 0, {"hot": 200, "a": 60})):
        found = burst.burst_detect(df, seconds=seconds, skew=skew)
        assert Counter(map(tuple, found.select("transaction_id", "user_id", "burst_count").collect())) == want


EDGES = [("a", 100.004), ("a", 200.003), ("b", 0.004), ("b", 0.004), ("c", 1e17), ("c", 1e17), ("d", 2e15), ("e", 1e300), ("e", None), ("f", None)]
TOTALS = {"a": 300.007, "b": 0.008, "c": 2e17, "d": 2e15, "e": 1e300, "f": None}


@pytest.mark.parametrize("skew", [KeyProfile(), KeyProfile(10, 0, {"a": 2, "c": 2, "e": 2})])
def test_no_amount_is_rounded_or_too_large(spark, skew):
    rows = [(f"t{k}", u, datetime(2024, 1, 1, 0, k), a, "completed") for k, (u, a) in enumerate(EDGES)]
    df = spark.createDataFrame(rows, "transaction_id string, user_id string, event_time timestamp, amount double, status string")
    judged = rules.fraud_rules(df, skew=skew, rows_per_slice=1).collect()
    last = {r["user_id"]: r for r in sorted(judged, key=lambda r: r["txn_count"])}
    assert {u: r["txn_total"] for u, r in last.items()} == TOTALS
    assert last["a"]["is_repeated"] and not last["b"]["is_repeated"]
    opening = rules.balances(df)
    again = {r["user_id"]: r for r in rules.fraud_rules(df, skew=skew, opening=opening).collect() if r["txn_count"] == 4 or r["user_id"] in "d"}
    assert again["a"]["txn_total"] == 600.014 and again["c"]["txn_total"] == 4e17 and again["d"]["txn_total"] == 4e15


def test_large_amounts_are_judged(spark):
    df = spark.createDataFrame([(f'{{"user_id":"u","amount":{a}}}',) for a in ("2e15", "1e300", "1e400")], "value string")
    judged = messages.classify(messages.parse_messages(df)).withColumn("got", messages.class_alone())
    assert [r["got"] for r in judged.collect()] == ["alert", "alert", "error"]


def test_rows_without_user_share_one_sliced_history(spark):
    df = history(spark).withColumn("user_id", F.when(F.col("user_id") != "hot", F.col("user_id")))
    columns = ["transaction_id", "user_id", "txn_count", "txn_total"]
    plain = rules.fraud_rules(df, skew=KeyProfile()).select(columns).collect()
    sliced = rules.fraud_rules(df, skew=KeyProfile(600, 200, {"a": 60}), rows_per_slice=13).select(columns).collect()
    assert Counter(map(tuple, plain)) == Counter(map(tuple, sliced))
