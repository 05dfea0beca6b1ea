"""Streams in event-time order, bursts and matching against their batch twins."""

import random
from collections import Counter
from contextlib import contextmanager
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripledger.operators import burst, reconcile, rules
from tripledger.operators.skew import KeyProfile
from tripledger.settings import STREAM_CONF
from tripledger.sources.scratch import fresh_path
from tripledger.streaming import sinks, sources
from tripledger.streaming.matching import reconcile_stream
from tripledger.streaming.ordered import burst_ordered, fraud_rules_ordered

START = datetime(2024, 1, 1)
SCHEMA = "transaction_id string, user_id string, event_time timestamp, amount double, status string, source string"
COLUMNS = ("transaction_id", "user_id", "event_time", "txn_count", "txn_total", "row_class")


@pytest.fixture(autouse=True)
def small(spark):
    """Keyed state with timers needs its store; two partitions are enough here."""
    conf = {**STREAM_CONF, "spark.sql.shuffle.partitions": "2"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


class Feed:
    """A folder to which rows arrive, and a stream over it that goes on where it stopped."""

    def __init__(self, spark, make, schema=SCHEMA):
        self.spark, self.make, self.schema = spark, make, spark.createDataFrame([], schema).schema
        self.folder, self.out = fresh_path(spark, "in"), fresh_path(spark, "out")

    def step(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.folder)
        stream = self.make(sources.file_rows(self.spark, self.folder, self.schema))
        query = sinks.to_parquet(stream, f"{self.out}/rows", f"{self.out}/checkpoint", trigger=sinks.AVAILABLE_NOW)
        query.awaitTermination()
        self.progress = query.recentProgress
        return self.spark.read.schema(stream.schema).parquet(f"{self.out}/rows")


def closing(at=START + timedelta(days=900)):
    return [(None, None, at, None, None, None)]


def payments(n, seed=1):
    rng = random.Random(seed)
    return [(f"t{k % (n - 3)}", rng.choice(["a", "b", "c"]), START + timedelta(seconds=rng.randrange(4000), microseconds=k),
             float(rng.choice([0.1, 40, 250, 3e16])), rng.choice(["completed", "failed", None]), rng.choice(["x", None])) for k in range(n)]


def bag(df, columns=COLUMNS):
    return Counter(map(tuple, df.select(*columns).collect()))


def test_any_order_gives_the_batch_history(spark):
    rows = payments(90)
    rows += rows[:2]
    feed = Feed(spark, lambda s: fraud_rules_ordered(s, lateness="1 day"))
    shuffled = rows[:]
    random.Random(5).shuffle(shuffled)
    assert feed.step(shuffled[:50]).count() == 0
    feed.step(shuffled[50:])
    got = feed.step(closing())
    assert bag(got) == bag(rules.fraud_rules(spark.createDataFrame(rows, SCHEMA), skew=KeyProfile()))
    # Nothing waits but the closing row; what is left per user is one small record.
    assert feed.progress[-1]["stateOperators"][0]["numRowsTotal"] < 25


def test_state_holds_the_rows_of_the_lateness_only(spark):
    feed = Feed(spark, lambda s: fraud_rules_ordered(s, lateness="10 seconds"))
    rows = [(f"t{k}", "u", START + timedelta(seconds=k), 1.0, None, None) for k in range(300)]
    held = []
    for at in range(0, 300, 100):
        got = feed.step(rows[at:at + 100])
        held.append(feed.progress[-1]["stateOperators"][0]["numRowsTotal"])
    assert got.count() >= 289 and max(held) < 40 and held[0] >= held[-1] - 2
    assert sorted(r["txn_count"] for r in got.collect()) == list(range(1, got.count() + 1))


def test_late_rows_and_rows_without_time_are_not_lost(spark):
    feed = Feed(spark, lambda s: fraud_rules_ordered(s, lateness="10 seconds"))
    feed.step([("b", "u", START + timedelta(hours=1), 250.0, None, None)])
    feed.step(closing(START + timedelta(hours=2)))
    got = feed.step([("a", "u", START, 100.0, None, None), ("none", "u", None, 5.0, None, None)])
    rows = {r["transaction_id"]: (r["txn_count"], r["txn_total"], r["event_time"]) for r in got.collect()}
    assert rows == {"b": (1, 250.0, START + timedelta(hours=1)), "none": (2, 255.0, None), "a": (3, 355.0, START)}


def test_users_are_forgotten_in_order_too(spark):
    feed = Feed(spark, lambda s: fraud_rules_ordered(s, lateness="1 second", forget_after="1 hour"))
    feed.step([("a", "u", START, 10.0, None, None)])
    feed.step([("x", "other", START + timedelta(hours=9), 10.0, None, None)])
    feed.step([("y", "other", START + timedelta(hours=9), 10.0, None, None)])
    feed.step([("b", "u", START + timedelta(hours=9, minutes=1), 10.0, None, None)])
    got = feed.step(closing())
    assert {r["transaction_id"]: r["txn_count"] for r in got.collect()} == {"a": 1, "x": 1, "y": 2, "b": 1}


def test_bursts_equal_the_batch_operator(spark):
    """Bursts that straddle any aligned window, equal times, arrivals out of order."""
    rng = random.Random(2)
    rows = [(f"t{k}", rng.choice(["a", "b"]), START + timedelta(seconds=rng.randrange(300)), 1.0, None, None) for k in range(80)]
    rows += [(f"s{k}", "straddler", START + timedelta(seconds=27 + 1.5 * k), 1.0, None, None) for k in range(5)]
    rows += [("n1", None, START, 1.0, None, None), ("n2", "a", None, 1.0, None, None)]
    feed = Feed(spark, lambda s: burst_ordered(s, lateness="1 day"))
    shuffled = rows[:]
    rng.shuffle(shuffled)
    feed.step(shuffled[:40])
    feed.step(shuffled[40:])
    got = feed.step(closing())
    columns = ("transaction_id", "user_id", "burst_count", "is_burst")
    want = burst.burst_detect(spark.createDataFrame(rows, SCHEMA), skew=KeyProfile())
    assert bag(got, columns) == bag(want, columns)
    assert got.filter("user_id = 'straddler' AND is_burst").count() == 1


def test_bursts_over_many_small_steps(spark):
    """The ring keeps just what later rows can see."""
    rows = [(f"t{k}", "u", START + timedelta(seconds=4 * k + (k * k) % 3), 1.0, None, None) for k in range(30)]
    feed = Feed(spark, lambda s: burst_ordered(s, lateness="5 seconds"))
    for at in range(0, 30, 10):
        feed.step(rows[at:at + 10])
    got = feed.step(closing())
    want = burst.burst_detect(spark.createDataFrame(rows, SCHEMA), skew=KeyProfile())
    columns = ("transaction_id", "burst_count", "is_burst")
    assert bag(got, columns) == bag(want, columns)


REPORT = ("transaction_id", "user_id", "event_time", "bank_amount", "gateway_amount", "processor_amount", "bank_presence",
          "gateway_presence", "processor_presence", "reconciliation_status")


class Channels:
    def __init__(self, spark, **options):
        self.spark, self.options, self.out = spark, options, fresh_path(spark, "out")
        self.folders = {c: fresh_path(spark, c) for c in ("bank", "gateway", "processor")}

    def step(self, **rows):
        schema = self.spark.createDataFrame([], SCHEMA).schema
        for c, folder in self.folders.items():
            self.spark.createDataFrame(rows.get(c, []), schema).coalesce(1).write.mode("append").parquet(folder)
        streams = {c: sources.file_rows(self.spark, f, schema) for c, f in self.folders.items()}
        stream = reconcile_stream(**streams, as_of=START, **self.options)
        query = sinks.to_parquet(stream, f"{self.out}/rows", f"{self.out}/checkpoint", trigger=sinks.AVAILABLE_NOW)
        query.awaitTermination()
        self.dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress if p["stateOperators"])
        return self.spark.read.schema(stream.schema).parquet(f"{self.out}/rows")


@pytest.mark.parametrize("dedupe", [None, "latest"])
def test_matching_equals_batch(spark, dedupe):
    def views(seed):
        own = random.Random(seed)
        rows = [(f"p{k}", "u", START + timedelta(minutes=k, seconds=own.randrange(60)), own.choice([10.0, 12.0, None]),
                 own.choice(["completed", "failed", None]), "s") for k in range(25) if own.random() > 0.3]
        twice = [(i, "v", t + timedelta(seconds=1), 77.0, s, "s") for i, _, t, _, s, _ in rows[:3]]
        return rows + twice + [(None, "u", START, 5.0, "completed", "s")] * 2

    frames = {c: views(n) for n, c in enumerate(("bank", "gateway", "processor"))}
    feed = Channels(spark, lateness="1 day", dedupe=dedupe)
    feed.step(bank=frames["bank"], processor=frames["processor"][:9])
    feed.step(gateway=frames["gateway"], processor=frames["processor"][9:])
    got = feed.step(gateway=closing())
    want = reconcile.reconcile(**{c: spark.createDataFrame(f, SCHEMA) for c, f in frames.items()}, skew={}, dedupe=dedupe, as_of=START)
    assert bag(got, REPORT) == bag(want, REPORT) and got.columns == want.columns


def test_a_late_third_view(spark):
    """In time it completes its payment; after the session it is left out, and counted as such."""
    def view(k, at):
        return (k, "u", START + timedelta(minutes=at), 10.0, "completed", "s")

    feed = Channels(spark, lateness="5 minutes", apart="10 minutes")
    assert feed.step(bank=[view("x", 0), view("y", 0)], gateway=[view("x", 1), view("y", 1)]).count() == 0
    assert feed.step(processor=[view("x", 2)], bank=[view("z", 60)]).count() == 2  # both sessions are over
    feed.step(bank=[view("w", 61)])
    got = feed.step(processor=[view("y", 2)], bank=closing())
    rows = {r["transaction_id"]: r["reconciliation_status"] for r in got.collect()}
    assert rows["x"] == "reconciled" and rows["y"] == rows["z"] == "incomplete"
    assert got.filter("transaction_id = 'y'").count() == 1 and feed.dropped >= 1
