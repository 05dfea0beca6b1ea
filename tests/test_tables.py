"""Loading, deduplication, upserts and settings."""

import json
from collections import Counter
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.errors import AnalysisException

from tripledger.operators import channels, upsert
from tripledger.schema import FIELDS
from tripledger.settings import Settings
from tripledger.sources import kafka, raw, tables
from tripledger.sources.scratch import fresh_path

RECORDS = [
    {"transaction_id": "pay-a", "user_id": "ana", "timestamp": 1704106800000, "amount": 31.25,
     "status": "completed", "source": "bank", "location": "Lisbon", "card_type": "visa",
     "ip_address": "10.0.0.7", "device_id": "phone"},
    {"transaction_id": "pay-b", "user_id": "ana", "timestamp": 1704107100000, "amount": 8.4,
     "status": "completed", "source": "Adyen", "location": "Lisbon", "card_type": "visa",
     "ip_address": "10.0.0.7", "device_id": "phone"},
    {"transaction_id": "pay-c", "user_id": "ben", "timestamp": 1704107400000, "amount": 77.0,
     "status": "failed", "source": "bank", "location": "Oslo", "card_type": "amex",
     "ip_address": "10.0.0.9", "device_id": "tablet"},
]
LO, HI = 1704106800000, 1704107400000


@pytest.mark.parametrize("form", ["lines", "array", "pretty"])
def test_json_forms(spark, tmp_path, form):
    text = {
        "lines": "\n".join(map(json.dumps, RECORDS)) + "\nno json\n",
        "array": json.dumps(RECORDS),
        "pretty": json.dumps(RECORDS, indent=2),
    }[form]
    (tmp_path / "data.json").write_text(text)
    rows = raw.load_topic(spark, str(tmp_path), LO, HI, multi_line=form == "pretty")
    assert rows.columns == [*FIELDS, "event_time"]
    got = {r["transaction_id"]: r for r in rows.collect()}
    assert set(got) == {r["transaction_id"] for r in RECORDS}
    assert got["pay-a"]["merchant"] is None
    assert raw.load_topic(spark, str(tmp_path), LO + 1, HI - 1, multi_line=form == "pretty").count() == 1


def test_missing_folder(spark, tmp_path):
    gone = str(tmp_path / "gone")
    with pytest.raises(AnalysisException):
        raw.load_topic(spark, gone, LO, HI).count()
    empty = raw.load_topic(spark, gone, LO, HI, on_missing="empty")
    assert empty.count() == 0 and empty.columns == [*FIELDS, "event_time"]
    assert raw.load_topics(spark, [], LO, HI).count() == 0


def test_event_date_folders_are_pruned(spark, tmp_path):
    for day, record in (("2024-01-01", RECORDS[0]), ("2024-01-05", RECORDS[1])):
        folder = tmp_path / f"event_date={day}"
        folder.mkdir()
        (folder / "a.json").write_text(json.dumps(record))
    rows = raw.load_topic(spark, str(tmp_path), LO, HI)
    assert [r[0] for r in rows.collect()] == ["pay-a"]  # the other lies in a wrong day's folder
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date" in plan


def test_range():
    end = datetime(2025, 1, 2, tzinfo=timezone.utc)
    assert raw.resolve_range(end=end, lookback=timedelta(hours=6))[0] == raw.resolve_range(end=end, start=end - timedelta(hours=6))[0]
    early = datetime(2024, 1, 1)
    assert raw.resolve_range(early, end, timedelta(days=1))[0] == 1704067200000
    with pytest.raises(ValueError):
        raw.resolve_range(end=end)


def test_channels_and_contract(spark):
    rows = [("bank", "completed"), ("Adyen", "error"), ("Worldpay", "timeout"), ("else", "declined"), (None, "rejected")]
    df = spark.createDataFrame(rows, "source string, status string")
    got = [r[0] for r in channels.channel_split(df).select("channel").collect()]
    assert got == ["bank", "gateway", "processor", "processor", "processor"]
    full = df.selectExpr(*[f"{'source' if f == 'source' else 'status' if f == 'status' else 'null'} as {f}" for f in FIELDS])
    by = {r["rule"]: r["violations"] for r in channels.conformance(full).collect()}
    assert by["domain:status"] == 1 and by["required:source"] == 1 and by["required:amount"] == 5
    assert "required:location" not in by


TARGET = [("k1", 1, "a"), ("k2", 1, "b")]
INCOMING = [("k1", 2, "c"), ("k1", 3, "d"), ("k3", 1, "e"), (None, 1, "f"), (None, 2, "g")]
MERGED = [("k1", 3, "d"), ("k2", 1, "b"), ("k3", 1, "e"), (None, 2, "g")]


def test_upsert_latest(spark):
    target, incoming = [spark.createDataFrame(r, "k string, t int, v string") for r in (TARGET, INCOMING)]
    once = upsert.upsert_latest(target, incoming, ["k"], "t")
    twice = upsert.upsert_latest(once, incoming, ["k"], "t")
    for result in (once, twice):
        assert Counter(map(tuple, result.collect())) == Counter(MERGED)


def test_dedupe_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("k", i % 7, str(i)) for i in range(100)], "k string, t int, v string")
    latest = upsert.dedupe_latest(df, ["k"], "t")
    assert [tuple(r) for r in latest.collect()] == [("k", 6, "97")]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_table_without_partitions(spark):
    path = fresh_path(spark, "t")
    for rows in (TARGET, INCOMING, INCOMING):
        tables.upsert_table(spark.createDataFrame(rows, "k string, t int, v string"), path, ["k"], "t")
    assert Counter(map(tuple, tables.read_table(spark, path).collect())) == Counter(MERGED)


def test_partitioned_table_moves_keys(spark):
    path = fresh_path(spark, "t")
    d1, d2, d3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
    schema = "k string, t int, day date"
    first = [("a", 1, d1), ("b", 1, d2), ("c", 1, d2), ("n", 1, None)]
    second = [("a", 2, d3), ("b", 2, d2), ("n", 2, d3)]
    for rows in (first, second, second):
        tables.upsert_table(spark.createDataFrame(rows, schema), path, ["k"], "t", "day")
    want = {("a", 2, d3), ("b", 2, d2), ("c", 1, d2), ("n", 2, d3)}
    assert Counter(map(tuple, tables.read_table(spark, path).select("k", "t", "day").collect())) == Counter(want)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Cluster:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        fresh_path(Cluster, "x")


def test_settings_and_kafka_options():
    assert Settings(s3_endpoint=None).object_store_conf() == {}
    conf = Settings(s3_endpoint="http://store", s3_access_key=None, s3_secret_key=None).object_store_conf()
    assert "spark.hadoop.fs.s3a.access.key" not in conf and conf["spark.hadoop.fs.s3a.endpoint"] == "http://store"
    options = kafka.source_options("h:1", ["a", "b"], starting="latest", group_prefix="g", max_per_trigger=100)
    assert options == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": "latest",
        "groupIdPrefix": "g", "maxOffsetsPerTrigger": "100",
    }
    with pytest.raises(ValueError):
        kafka.source_options("h:1", ["a"], starting="middle")


def test_partitioned_upsert_keeps_stored_columns(spark, tmp_path):
    path = str(tmp_path / "wide")
    stored = spark.createDataFrame([(1, "a", "old", 1, "d1"), (2, "b", "kept", 1, "d1")], "id int, v string, note string, t int, day string")
    tables.upsert_table(stored, path, ["id"], "t", "day")
    tables.upsert_table(spark.createDataFrame([(1, "z", 2, "d2")], "id int, v string, t int, day string"), path, ["id"], "t", "day")
    got = {(r["id"], r["v"], r["note"], r["day"]) for r in spark.read.parquet(path).collect()}
    assert got == {(1, "z", "old", "d2"), (2, "b", "kept", "d1")}


def test_whole_keys_keep_every_row(spark):
    """Repeated keys stay, a later run replaces them together, and running twice changes nothing."""
    schema = "k string, t int, v string, day string"
    first = [("a", 1, "x", "1"), ("a", 1, "x", "1"), ("a", 1, "y", "2"), ("b", 1, "z", "1")]
    second = [("a", 2, "w", "3"), ("a", 2, "w", "3"), ("c", 2, "q", "1")]
    for part in (None, "day"):
        path = fresh_path(spark, "whole")
        for rows in (first, first, second, second):
            tables.upsert_table(spark.createDataFrame(rows, schema), path, ["k"], "t", part, whole_keys=True)
        got = [(r["k"], r["t"], r["v"], str(r["day"])) for r in tables.read_table(spark, path).collect()]
        assert Counter(got) == Counter([*second, first[3]])


def test_many_incoming_keys_are_sorted_not_broadcast(spark, monkeypatch, tmp_path):
    first = spark.createDataFrame([(k, 1, "d1") for k in ("a", "b", "c", None)], "k string, t int, day string")
    second = spark.createDataFrame([("a", 2, "d2"), (None, 2, "d1"), ("e", 2, "d3"), ("e", 1, "d1")], first.schema)
    for name, frame in (("first", first), ("second", second)):
        frame.write.parquet(str(tmp_path / name))
    first, second = (spark.read.parquet(str(tmp_path / name)) for name in ("first", "second"))
    for few in (upsert.FEW_KEYS, 2):
        monkeypatch.setattr(upsert, "FEW_KEYS", few)
        kept = upsert.replace_keys(first, second, ["k"])
        plan = kept._jdf.queryExecution().sparkPlan().toString()
        assert ("SortMergeJoin" in plan) == (few == 2) and ("BroadcastHashJoin" in plan) == (few > 2)
        plan = upsert.upsert_latest(first, second, ["k"], "t")._jdf.queryExecution().sparkPlan().toString()
        assert ("SortMergeJoin" in plan) == (few == 2)
        for part in (None, "day"):
            path = str(tmp_path / f"{few}-{part}")
            tables.upsert_table(first, path, ["k"], "t", part)
            tables.upsert_table(second, path, ["k"], "t", part)
            got = {tuple(map(str, r)) for r in tables.read_table(spark, path).select("k", "t", "day").collect()}
            assert got == {("a", "2", "d2"), ("b", "1", "d1"), ("c", "1", "d1"), ("None", "2", "d1"), ("e", "2", "d3")}
