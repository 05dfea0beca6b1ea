"""The ledger's log, the outbox, contract drift and bucketed tables."""

import os
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripledger.operators import drift, reconcile, rules
from tripledger.operators.skew import KeyProfile
from tripledger.sources import bucketed
from tripledger.sources.scratch import fresh_path
from tripledger.streaming import ledger, outbox

START = datetime(2024, 1, 1)
SCHEMA = "transaction_id string, user_id string, event_time timestamp, amount double, status string"
COLUMNS = ("transaction_id", "user_id", "txn_count", "txn_total", "row_class")


def bag(df, columns=COLUMNS):
    return Counter(map(tuple, df.select(*columns).collect()))


@pytest.fixture()
def few(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def batches(n, size):
    rng = random.Random(6)
    return [[(f"t{b}-{k}", rng.choice(["a", "b", "c", None]), START + timedelta(minutes=b, seconds=k),
              rng.choice([10.5, 250.0, 3e16, None]), "completed") for k in range(size)] for b in range(n)]


def test_twenty_batches_with_replays(spark, few):
    out, parts = fresh_path(spark, "ledger"), batches(20, 4)
    for number, rows in enumerate(parts):
        for _ in range(2 if number in (0, 6, 7, 14, 19) else 1):  # 6, 13: the log is summed up
            ledger.advance(spark.createDataFrame(rows, SCHEMA), number, out, compact_every=7)
    whole = spark.createDataFrame([r for rows in parts for r in rows], SCHEMA)
    assert bag(ledger.read_judged(spark, out)) == bag(rules.fraud_rules(whole, skew=KeyProfile()))
    assert sorted(os.listdir(f"{out}/sums")) == ["upto=13", "upto=6"]
    assert sorted(int(n.split("=")[1]) for n in os.listdir(f"{out}/added")) == list(range(7, 20))


def test_a_batch_writes_and_reads_for_its_own_users(spark, few):
    out = fresh_path(spark, "ledger")
    many = spark.range(20_000).select(
        F.col("id").cast("string").alias("transaction_id"), F.concat(F.lit("user-"), "id").alias("user_id"),
        F.lit(START).alias("event_time"), F.lit(5.0).alias("amount"), F.lit("completed").alias("status"))
    ledger.advance(many, 0, out)
    ledger.advance(spark.createDataFrame([("x", "user-7", START, 400.0, "completed")], SCHEMA), 1, out)

    def size(n):
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{out}/added/batch={n}") for f in fs if f.endswith("parquet"))

    assert size(1) < size(0) / 50
    last = ledger.read_judged(spark, out).filter("transaction_id = 'x'").first()
    assert (last["txn_count"], last["txn_total"]) == (2, 405.0)
    log = ledger._log(spark, out, 2, [3])
    assert "PartitionFilters: [bucket" in log._jdf.queryExecution().executedPlan().toString().replace("isnotnull(", "")


MESSAGE_SCHEMA = "topic string, key string, value string"


class Killed(Exception):
    pass


class Target(outbox.FolderTarget):
    """Dies after having sent a part of its first messages."""

    def __init__(self, spark, path, part):
        super().__init__(spark, path)
        self.part = part

    def send(self, messages):
        super().send(messages.filter(self.part))
        raise Killed


@pytest.mark.parametrize("part", ["true", "false", "key < 'k2'"])
def test_every_message_once_whatever_was_sent_before_the_kill(spark, few, part):
    root = fresh_path(spark, "outbox")
    rows = [("alerts", f"k{i}", "v") for i in range(4)] + [("alerts", "k1", "v"), (None, None, None)]
    for number in (0, 1):  # two equal batches are different messages; equal rows of one are, too
        for _ in range(2):
            outbox.put(spark.createDataFrame(rows, MESSAGE_SCHEMA), number, root)
    good = outbox.FolderTarget(spark, f"{root}/topic")
    for _ in range(2):
        with pytest.raises(Killed):
            outbox.publish(spark, root, Target(spark, good.path, part))
        outbox.put(spark.createDataFrame(rows, MESSAGE_SCHEMA), 0, root)  # the stream repeats its batch as well
    assert outbox.publish(spark, root, good) == 2 and outbox.publish(spark, root, good) == 0
    got = Counter(map(tuple, good.read().select(*outbox.MESSAGE).collect()))
    assert got == Counter({row: 2 * n for row, n in Counter(rows).items()})
    assert good.read().select("message_id").distinct().count() == 12


def test_nothing_to_publish(spark):
    root = fresh_path(spark, "outbox")
    assert outbox.publish(spark, root, outbox.FolderTarget(spark, f"{root}/topic")) == 0


GOOD = ('{"transaction_id":"a","user_id":"u","timestamp":1,"amount":%s,"status":"s","source":"b","merchant":"m","card_type":"v"%s}')


def test_drift(spark):
    sent = [GOOD % ("5", ""), GOOD % ("5.5", ""), GOOD % ('"5"', ""), GOOD % ("1e300", ',"location":null,"new":{"x":1}'),
            '{"transaction_id":7}', "noise", "[1]", None]
    rows = spark.createDataFrame([("t", m) for m in sent] + [("empty", "{}")], "topic string, value string")
    got = {(r["topic"], r["field"], r["kind"], r["type"]): (r["messages"], r["share"])
           for r in drift.schema_drift(rows, by=["topic"]).collect()}
    assert got["t", "amount", "known", "integer"] == (1, 1 / 8) and got["t", "amount", "known", "number"] == (2, 2 / 8)
    assert got["t", "amount", "retyped", "string"] == (1, 1 / 8) and got["t", "amount", "absent", None] == (1, 1 / 8)
    assert got["t", "new", "unknown", "object"] == (1, 1 / 8) and got["t", "location", "known", "null"] == (1, 1 / 8)
    assert got["t", "transaction_id", "retyped", "integer"] == (1, 1 / 8)
    assert got["t", None, "unreadable", None] == (3, 3 / 8)
    assert sum(1 for k in got if k[0] == "empty") == 8 and got["empty", "status", "absent", None] == (1, 1.0)
    assert drift.schema_drift(rows.limit(0), by=["topic"]).count() == 0


VIEW = "transaction_id string, user_id string, event_time timestamp, amount double, status string, source string"


def test_bucketed_channels_meet_where_they_lie(spark):
    def views(seed):
        rng = random.Random(seed)
        rows = [(f"p{k}", "u", START, rng.choice([10.0, 12.0, None]), rng.choice(["completed", None]), "s") for k in range(60) if rng.random() > 0.3]
        return rows + rows[:4] + [(None, "n", START, 1.0, "completed", "s")] * 2

    frames = {c: spark.createDataFrame(views(n), VIEW) for n, c in enumerate(("bank", "gateway", "processor"))}
    root, names = fresh_path(spark, "bucketed"), {}
    for c, f in frames.items():
        names[c] = f"test_{c}_{root[-8:]}"
        bucketed.write_bucketed(f, names[c], f"{root}/{c}", 8)
    got = bucketed.reconcile_bucketed(spark, **names, as_of=START)
    want = reconcile.reconcile(**frames, skew={}, as_of=START)
    assert bag(got, want.columns) == bag(want, want.columns)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 6 and "Bucketed: true" in plan
