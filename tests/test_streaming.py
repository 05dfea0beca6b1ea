"""Streams: same results as batch, restarts, replays, late rows, forgetting."""

import json
from collections import Counter
from datetime import datetime, timedelta, timezone
from pathlib import Path

from pyspark.sql import functions as F

from tripledger.operators import rules
from tripledger.operators.skew import KeyProfile
from tripledger.plans import jobs
from tripledger.settings import Settings
from tripledger.sources import raw, tables
from tripledger.sources.scratch import fresh_path
from tripledger.streaming import bursts, landing, ledger, sinks, sources
from tripledger.streaming.rules import fraud_rules_stream, valid_messages, verdict_lines

START = datetime(2024, 1, 1)
SCHEMA = "transaction_id string, user_id string, event_time timestamp, amount double, status string"


def put(spark, rows, folder):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(stream, out):
    sinks.to_parquet(stream, f"{out}/rows", f"{out}/checkpoint", trigger=sinks.AVAILABLE_NOW).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{out}/rows")


def source(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    return sources.file_rows(spark, folder, schema)


def payments(offset, n, users="abc"):
    return [
        (f"t{offset + k}", users[k % len(users)], START + timedelta(seconds=offset + k), 10.0 + (k * 37 % 300), ["completed", "failed"][k % 2])
        for k in range(n)
    ]


COLUMNS = ("transaction_id", "user_id", "txn_count", "txn_total", "row_class")


def bag(df):
    return Counter(map(tuple, df.select(*COLUMNS).collect()))


def test_stream_equals_batch_across_restart(spark):
    folder, out = fresh_path(spark, "in"), fresh_path(spark, "out")
    first, second = payments(0, 40), payments(40, 40)
    put(spark, first, folder)
    run(fraud_rules_stream(source(spark, folder)), out)
    put(spark, second, folder)
    rows = run(fraud_rules_stream(source(spark, folder)), out)
    batch = rules.fraud_rules(spark.createDataFrame(first + second, SCHEMA), skew=KeyProfile())
    assert bag(rows) == bag(batch)
    again = run(fraud_rules_stream(source(spark, folder)), out)
    assert bag(again) == bag(batch)


def test_ledger_equals_batch_and_survives_repeats(spark):
    out = fresh_path(spark, "ledger")
    first, second = payments(0, 40), payments(40, 40)
    for number, rows in ((0, first), (1, second), (1, second)):
        ledger.advance(spark.createDataFrame(rows, SCHEMA), number, out)
    batch = rules.fraud_rules(spark.createDataFrame(first + second, SCHEMA), skew=KeyProfile())
    assert bag(ledger.read_judged(spark, out)) == bag(batch)


def test_late_rows_see_a_later_history(spark):
    folder, out = fresh_path(spark, "in"), fresh_path(spark, "out")
    put(spark, [("new", "u", START + timedelta(hours=1), 250.0, "completed")], folder)
    run(fraud_rules_stream(source(spark, folder)), out)
    put(spark, [("old", "u", START, 100.0, "completed")], folder)
    rows = {r["transaction_id"]: r for r in run(fraud_rules_stream(source(spark, folder)), out).collect()}
    assert (rows["new"]["txn_count"], rows["old"]["txn_count"]) == (1, 2)
    assert rows["old"]["is_repeated"] and rows["old"]["txn_total"] == 350.0


def test_users_are_forgotten(spark):
    folder, out = fresh_path(spark, "in"), fresh_path(spark, "out")

    def step(rows):
        put(spark, rows, folder)
        return run(fraud_rules_stream(source(spark, folder), forget_after="1 hour"), out)

    step([("a", "u", START, 10.0, "completed")])
    step([("b", "other", START + timedelta(hours=9), 10.0, "completed")])
    step([("c", "other", START + timedelta(hours=9), 10.0, "completed")])
    rows = step([("d", "u", START + timedelta(hours=9), 10.0, "completed")])
    counts = {r["transaction_id"]: r["txn_count"] for r in rows.collect()}
    assert counts == {"a": 1, "b": 1, "c": 2, "d": 1}


def test_once_per_id(spark):
    folder, out = fresh_path(spark, "in"), fresh_path(spark, "out")
    put(spark, payments(0, 6) * 3, folder)
    rows = run(fraud_rules_stream(source(spark, folder), forget_after="1 hour", once_per_id=True), out)
    assert rows.count() == 6


def test_invalid_messages_never_touch_state(spark, tmp_path):
    sent = ['{"user_id":"u","amount":150}', "noise", '{"user_id":"u","amount":"x"}', '{"user_id":"u","amount":160}']
    (tmp_path / "a.txt").write_text("\n".join(sent))
    stream = valid_messages(sources.file_messages(spark, str(tmp_path), "bank_transactions"))
    rows = run(fraud_rules_stream(stream), fresh_path(spark, "out")).collect()
    assert sorted((r["txn_count"], r["txn_total"]) for r in rows)[1] == (2, 310.0) and len(rows) == 2


def test_verdict_lines_in_arrival_order(spark):
    sent = [
        ("Transaction: user1, amount=300.0", 0), ("Transaction: user1, amount=100.0", 1), ("noise", 2), ('{"user_id":"u"}', 3),
    ]
    folder = fresh_path(spark, "in")
    rows = [(v, START + timedelta(seconds=k)) for v, k in sent]
    spark.createDataFrame(rows, "value string, arrival timestamp").coalesce(1).write.parquet(folder)
    stream = sources.file_rows(spark, folder, spark.read.parquet(folder).schema)
    lines = {r[0] for r in run(verdict_lines(stream), fresh_path(spark, "out")).collect()}
    assert lines == {
        "FRAUD ALERT: user1 - 300.00 - Large transaction of 300.0 exceeds threshold of 200.0",
        "FRAUD ALERT: user1 - 100.00 - Multiple transactions totaling 400.00 from user user1",
        "Invalid transaction format: noise",
        'Missing required fields in transaction: {"user_id":"u"}',
    }


def message(k, at):
    return json.dumps({"transaction_id": f"t{k}", "user_id": "u", "timestamp": int(at.replace(tzinfo=timezone.utc).timestamp() * 1000),
                       "amount": 5.0, "status": "completed", "source": "bank", "merchant": "m", "card_type": "visa"})


def test_landing_quarantine_and_replay(spark, tmp_path):
    root = fresh_path(spark, "raw")
    good = [message(k, START + timedelta(days=k % 2)) for k in range(20)]
    bad = ["{broken", "7", ""]
    batch = spark.createDataFrame(
        [("bank_transactions", v) for v in good + bad] + [("gateway_transactions", good[0])], "topic string, value string"
    )
    for _ in range(2):  # the same batch written again, as after a failure
        landing.write_batch(batch, 0, root)
    path = landing.topic_path(root, "bank_transactions")
    lo, hi = raw.resolve_range(START, START + timedelta(days=9))
    assert raw.load_topic(spark, path, lo, hi).count() == 20
    assert sorted(p.split("event_date=")[1] for p in map(str, Path(path).glob("event_date=*"))) == ["2024-01-01", "2024-01-02"]
    kept = spark.read.text(landing.topic_path(root, "bank_transactions", landing.QUARANTINE))
    assert Counter(r[0] for r in kept.select("value").collect()) == Counter(bad)
    assert raw.load_topic(spark, landing.topic_path(root, "gateway_transactions"), lo, hi).count() == 1


def test_burst_windows(spark):
    folder, out = fresh_path(spark, "in"), fresh_path(spark, "out")
    at = [(f"t{k}", "u", START + timedelta(seconds=5 * k), 1.0, "completed") for k in range(5)]
    put(spark, at + [("z", "w", START + timedelta(hours=1), 1.0, "completed")], folder)
    rows = run(bursts.burst_stream(source(spark, folder)), out).collect()
    assert {r["user_id"] for r in rows} == {"u"} and all(r["txn_count"] == 5 for r in rows)
    assert START in {r["window_start"] for r in rows}


def test_jobs_end_to_end(spark, tmp_path):
    topics = {"bank": "bank_transactions", "gateway": "gateway_transactions", "processor": "processor_transactions"}
    for k, topic in enumerate(topics.values()):
        (tmp_path / "raw" / topic).mkdir(parents=True)
        lines = [message(i, START + timedelta(hours=i)) for i in range(10) if i % (k + 2)]
        (tmp_path / "raw" / topic / "a.json").write_text("\n".join(lines))
    settings = Settings(
        raw_root=str(tmp_path / "raw"), features_root=str(tmp_path / "features"), reconciled_root=str(tmp_path / "reconciled")
    )
    when = {"start": START, "end": START + timedelta(days=2)}
    for _ in range(2):
        summary = jobs.reconcile_job(spark, settings, **when).collect()[0]
        assert (summary["total_count"], summary["reconciled_count"]) == (9, 3)
        table = tables.read_table(spark, str(tmp_path / "reconciled" / "reconciled_transactions"))
        assert table.count() == 9 and table.select("transaction_id").distinct().count() == 9
    summary = jobs.feature_job(spark, settings, **when).collect()[0]
    assert (summary["user_count"], summary["high_risk_count"]) == (1, 0)
    features = tables.read_table(spark, str(tmp_path / "features" / "user_features")).collect()
    assert features[0]["max_txn_count_daily"] == 18


def test_landed_messages_reach_the_jobs(spark, tmp_path):
    from datetime import datetime, timezone

    from tripledger import fixed_values as fv
    from tripledger.plans import jobs
    from tripledger.settings import Settings
    from tripledger.streaming import landing

    root = str(tmp_path / "raw")
    rows = [(t, '{"transaction_id":"x","user_id":"u","amount":5.0,"timestamp":1700000000000,"status":"SUCCESS"}')
            for t in fv.TOPICS.values()]
    rows.append((next(iter(fv.TOPICS.values())), '{"user_id":"u","amount":5,"timestamp":9223372036854775807}'))
    landing.write_batch(spark.createDataFrame(rows, "topic string, value string"), 0, root)
    settings = Settings(raw_root=root, features_root=str(tmp_path / "f"), reconciled_root=str(tmp_path / "r"))
    days = {"start": datetime(2023, 11, 1, tzinfo=timezone.utc), "end": datetime(2023, 12, 1, tzinfo=timezone.utc)}
    jobs.reconcile_job(spark, settings, **days)
    assert spark.read.parquet(f"{root.replace('raw', 'r')}/reconciled_transactions").count() == 1
    assert jobs.feature_job(spark, settings, **days).count() >= 1
    assert spark.read.text(f"{root}/zone=quarantine").count() == 1


def test_rows_of_a_user_are_ordered_by_time_alone_where_times_differ(monkeypatch):
    import pandas as pd

    from tripledger.streaming import rules

    def frame(times):
        return pd.DataFrame({
            "event_time": pd.to_datetime(times), "transaction_id": [f"t{9 - i}" for i in range(len(times))],
            "source": None, "amount": 1.0, "status": "ok"})

    apart = frame(["2024-01-03", "2024-01-01", "2024-01-02"])
    tied = frame(["2024-01-03", "2024-01-01", "2024-01-03", None])
    for rows in (apart, tied, frame(["2024-01-01", None])):
        want = rows.sort_values(rules._ORDER, na_position="first", kind="stable")
        assert rules._ordered(rows)["transaction_id"].tolist() == want["transaction_id"].tolist()
    monkeypatch.setattr(pd.DataFrame, "sort_values", None)
    assert rules._ordered(apart)["transaction_id"].tolist() == ["t8", "t7", "t9"]
