"""Jobs, settings, and how lander, loaders and parser agree."""

import json
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tripledger import fixed_values as fv
from tripledger.functions import messages
from tripledger.operators import features, reconcile
from tripledger.plans import jobs
from tripledger.settings import STREAM_CONF, Settings
from tripledger.sources import indexed, kafka, raw, tables
from tripledger.sources.scratch import fresh_path
from tripledger.streaming import landing, sinks, sources
from tripledger.streaming.rules import valid_messages, verdict_lines

START = datetime(2024, 1, 1)
FIELDS = {"transaction_id": "t", "user_id": "u", "amount": 5.0, "status": "completed", "source": "bank", "merchant": "m", "card_type": "visa"}


def millis(at):
    return int(at.replace(tzinfo=timezone.utc).timestamp() * 1000)


def message(k, at, **changed):
    return json.dumps({**FIELDS, "transaction_id": f"t{k}", "timestamp": millis(at), **changed})


def settings_in(tmp_path):
    return Settings(raw_root=f"{tmp_path}/raw", features_root=f"{tmp_path}/features", reconciled_root=f"{tmp_path}/reconciled")


def write_topics(tmp_path, lines_of):
    for topic, lines in zip(fv.TOPICS.values(), lines_of):
        (tmp_path / "raw" / topic).mkdir(parents=True, exist_ok=True)
        (tmp_path / "raw" / topic / "a.json").write_text("\n".join(lines))


WHEN = {"start": START, "end": START + timedelta(days=2)}


def test_reconcile_job_on_an_indexed_table(spark, tmp_path):
    settings, sent = settings_in(tmp_path), []
    first = [message(i, START + timedelta(hours=i)) for i in range(10)]
    write_topics(tmp_path, [first, first[:8], [*first[:6], "{broken", message(99, START + timedelta(days=30))]])
    for _ in range(2):
        summary = jobs.reconcile_job(spark, settings, layout="indexed", publish=sent.append, **WHEN).first()
        assert (summary["total_count"], summary["reconciled_count"], summary["incomplete_count"]) == (10, 6, 4)
        assert (summary["bank_read_count"], summary["processor_read_count"]) == (10, 8)
        assert (summary["processor_unreadable_count"], summary["processor_out_of_range_count"]) == (1, 1)
    table = indexed.IndexedTable(spark, f"{tmp_path}/reconciled/reconciled_transactions")
    assert table.read().count() == 10 and table.read().select("row_key").distinct().count() == 10
    assert {r["key"] for r in sent[0].collect()} == {f"t{i}" for i in range(6, 10)}
    assert sent[0].first()["topic"] == fv.RESULT_TOPIC
    write_topics(tmp_path, [first] * 3)  # the others have caught up
    jobs.reconcile_job(spark, settings, layout="indexed", **WHEN)
    assert table.read().filter("reconciliation_status = 'reconciled'").count() == table.read().count() == 10
    with pytest.raises(ValueError, match="layout"):
        jobs.reconcile_job(spark, settings, layout="heap", **WHEN)


def test_counting_reads_nothing_twice(spark, tmp_path):
    write_topics(tmp_path, [[message(1, START), "noise"]])
    lo, hi = raw.resolve_range(**{"start": START, "end": START + timedelta(days=1)})
    seen = Observation("rows")
    path = f"{tmp_path}/raw/{fv.TOPICS['bank']}"
    rows = raw.load_topic(spark, path, lo, hi, seen=seen)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan and "Exchange" not in plan
    assert rows.count() == 1 and seen.get == {"read": 2, "unreadable": 1, "out_of_range": 0}


def test_feature_job_counts_and_reads_once(spark, tmp_path):
    settings = settings_in(tmp_path)
    lines = [message(i, START + timedelta(hours=i)) for i in range(5)]
    write_topics(tmp_path, [lines, [*lines, "?"]])
    summary = jobs.feature_job(spark, settings, on_missing="empty", **WHEN).first()
    assert (summary["user_count"], summary["bank_transactions_read_count"], summary["gateway_transactions_unreadable_count"]) == (1, 5, 1)
    assert summary["processor_transactions_read_count"] == 0
    assert tables.read_table(spark, f"{tmp_path}/features/user_features").first()["max_txn_count_daily"] == 10


def test_folded_days_serve_the_feature_job(spark, tmp_path, monkeypatch):
    settings, n = settings_in(tmp_path), 10
    lines = [message(i, START + timedelta(days=i, hours=i), user_id=f"u{i % 3}", amount=10.0 + i) for i in range(n)]
    write_topics(tmp_path, [lines, lines[:n - 2]])
    read = []
    load = raw.load_topics
    monkeypatch.setattr(jobs.raw, "load_topics", lambda s, p, lo, hi, **o: (read.append((lo, hi)), load(s, p, lo, hi, **o))[1])

    def run(last):
        return jobs.folded_feature_job(spark, settings, last=last, on_missing="empty").first()

    assert run(date(2024, 1, 7))["user_count"] == 3
    assert run(date(2024, 1, 8))["user_count"] == 3
    day = 24 * 3600 * 1000
    assert [(hi - lo + 1) // day for lo, hi in read] == [7, 2]  # the new day and the newest one kept
    when = {"start": START + timedelta(days=1), "end": START + timedelta(days=8) - timedelta(milliseconds=1)}
    whole = features.user_features(load(spark, [f"{settings.raw_root}/{t}" for t in fv.TOPICS.values()],
                                        *raw.resolve_range(**when), on_missing="empty"))
    columns = [c for c in whole.columns if c != "feature_extraction_time"]
    stored = tables.read_table(spark, f"{settings.features_root}/user_features")
    assert sorted(map(str, stored.select(columns).collect())) == sorted(map(str, whole.select(columns).collect()))


#: Message -> whether it is an object with a usable time, or without any.
SHARED = [
    ('{"user_id":"u","amount":5,"timestamp":1704067200000}', True),
    ('{"user_id":"u","amount":5,"timestamp":"1704067200000"}', True),
    ('{"user_id":"u","amount":"5.5","timestamp":1704067200000,"source":"bank"}', True),
    ('{"user_id":"u","amount":5}', True),
    ('{"user_id":"u","amount":5,"timestamp":null}', True),
    (' {"user_id":"u"} ', True),
    ('{"user_id":"u","timestamp":"soon"}', False),
    ('{"user_id":"u","timestamp":9223372036854775807}', False),
    ("{'user_id':'u','timestamp':1704067200000}", False),
    ('{"user_id":"u","timestamp":1704067200000} junk', False),
    ('{"user_id":"u"', False), ("[1]", False), ("7", False), ("", False), ("Transaction: u, amount=5.0", False),
]


def test_lander_parser_and_loader_agree(spark):
    root = fresh_path(spark, "raw")
    batch = spark.createDataFrame([("bank_transactions", v) for v, _ in SHARED], "topic string, value string")
    landing.write_batch(batch, 0, root)

    def zone(name):
        return sorted(r[0] for r in spark.read.text(landing.topic_path(root, "bank_transactions", name)).select("value").collect())

    assert zone(landing.LANDED) == sorted(v for v, ok in SHARED if ok)
    assert zone(landing.QUARANTINE) == sorted(v for v, ok in SHARED if not ok)
    parsed = messages.parse_messages(batch).filter("shape = 'json' AND event_time IS NOT NULL")
    lo, hi = raw.resolve_range(START - timedelta(days=1), START + timedelta(days=1))
    loaded = raw.load_topic(spark, landing.topic_path(root, "bank_transactions"), lo, hi)
    assert sorted(r[0] for r in loaded.select("amount").collect()) == [5.0, 5.0, 5.5]
    assert parsed.count() == loaded.count() and parsed.filter(F.col("event_time") != F.lit(START)).count() == 0


def test_verdict_lines_read_their_source_once(spark, tmp_path):
    (tmp_path / "a.txt").write_text('{"user_id":"u","amount":150}\nnoise\n')
    stream = verdict_lines(sources.file_messages(spark, str(tmp_path), "bank_transactions"))
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert plan.count("StreamingRelation") == 1 and plan.count("from_json") == 1


def test_console_sink(spark, tmp_path):
    (tmp_path / "a.txt").write_text("line one\n")
    stream = sources.file_messages(spark, f"{tmp_path}/a.txt", "bank_transactions")
    query = sinks.to_console(stream, f"{tmp_path}/c", trigger=sinks.AVAILABLE_NOW)
    query.awaitTermination()
    assert query.exception() is None and "Console" in query.lastProgress["sink"]["description"]
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1


def test_kafka_options():
    options = kafka.source_options("h:1", ["a", "b"], starting="latest", group_prefix="g", max_per_trigger=jobs.MESSAGES_PER_TRIGGER)
    assert options == {"kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": "latest",
                       "groupIdPrefix": "g", "maxOffsetsPerTrigger": "1000000"}
    assert kafka.source_options("h:1", ["a"])["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        kafka.source_options("h:1", ["a"], starting="middle")
    assert kafka.since_options("h:1", ["a"], "12")["startingTimestamp"] == "12"


def test_object_store_settings(monkeypatch):
    for name in ("S3_ENDPOINT_URL", "S3_ACCESS_KEY", "S3_SECRET_KEY"):
        monkeypatch.delenv(name, raising=False)
    assert Settings().object_store_conf() == {}
    monkeypatch.setenv("S3_ENDPOINT_URL", "http://store:9000")
    conf = Settings().object_store_conf()
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000" and conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert not any("key" in name for name in conf)
    monkeypatch.setenv("S3_ACCESS_KEY", "a")
    monkeypatch.setenv("S3_SECRET_KEY", "b")
    conf = Settings().object_store_conf()
    assert (conf["spark.hadoop.fs.s3a.access.key"], conf["spark.hadoop.fs.s3a.secret.key"]) == ("a", "b")


def test_burst_settings_act(spark, monkeypatch):
    monkeypatch.setenv("FRAUD_BURST_COUNT", "3")
    monkeypatch.setenv("FRAUD_BURST_WINDOW_SECONDS", "10")
    for name, value in {**STREAM_CONF, "spark.sql.shuffle.partitions": "2"}.items():
        spark.conf.set(name, value)
    folder, out = fresh_path(spark, "in"), fresh_path(spark, "out")
    schema = "transaction_id string, user_id string, event_time timestamp"
    rows = [(f"t{k}", "u", START + timedelta(seconds=5 * k)) for k in range(3)] + [("far", "u", START + timedelta(days=3))]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(folder)
    valid = sources.file_rows(spark, folder, spark.createDataFrame([], schema).schema)
    found = jobs.burst_alerts(valid, Settings())
    sinks.to_parquet(found, f"{out}/rows", f"{out}/c", trigger=sinks.AVAILABLE_NOW).awaitTermination()
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    sent = spark.read.parquet(f"{out}/rows").collect()
    assert [(r["topic"], r["key"], json.loads(r["value"])["burst_count"]) for r in sent] == [(fv.ALERT_TOPIC, "t2", 3)]


def test_topics_are_matched_continuously(spark, tmp_path):
    """Messages of three topics in one stream; a payment that the processor lacks is a result message."""
    for k, topic in enumerate(fv.TOPICS.values()):
        (tmp_path / topic).mkdir()
        lines = [message(i, START + timedelta(minutes=i)) for i in range(3) if (k, i) != (2, 1)]
        (tmp_path / topic / "a.txt").write_text("\n".join([*lines, "noise", message("last", START + timedelta(days=9))]))
    stream = sources.union_streams([sources.file_messages(spark, f"{tmp_path}/{t}", t) for t in fv.TOPICS.values()])
    report = jobs.match_topics(valid_messages(stream), lateness="1 hour")
    assert report._jdf.queryExecution().analyzed().toString().count("StreamingRelation") == 3  # each topic once
    payload = reconcile.result_payload(report)
    out = fresh_path(spark, "results")
    sinks.to_parquet(payload, f"{out}/rows", f"{out}/c", trigger=sinks.AVAILABLE_NOW).awaitTermination()
    rows = spark.read.parquet(f"{out}/rows").collect()
    assert [(r["topic"], r["key"], json.loads(r["value"])["processor_presence"]) for r in rows] == [(fv.RESULT_TOPIC, "t1", "missing")]
