"""One query per operator over the driver's tables: `(spark, sf_dir) -> DataFrame`.

Queries that test reading, writing or streaming put the tables' rows into the shared scratch
folder first, then read, merge or stream them from there.
"""

from __future__ import annotations

from contextlib import contextmanager
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger import fixed_values as fv
from tripledger.functions import alerts, messages
from tripledger.operators import burst, channels, drift, features, partials, reconcile, rules, skew, upsert
from tripledger.plans import views
from tripledger.schema import FIELDS
from tripledger.settings import STREAM_CONF
from tripledger.sources import bucketed, folds, indexed, paths, raw, tables
from tripledger.sources.scratch import fresh_path
from tripledger.streaming import landing, ledger, outbox, sinks, sources
from tripledger.streaming.bursts import burst_stream
from tripledger.streaming.matching import reconcile_stream
from tripledger.streaming.ordered import burst_ordered, fraud_rules_ordered
from tripledger.streaming.rules import fraud_rules_stream, verdict_lines

START, END = datetime(2024, 1, 8), datetime(2024, 1, 15)
FIRST_RUN, SECOND_RUN = datetime(2024, 2, 1), datetime(2024, 2, 2)
TOPIC = fv.TOPICS
LOADED = ("transaction_id", "user_id", "timestamp", "amount", "status", "source", "location", "event_ntz")


def _ntz(df: DataFrame, column: str = "event_time", name: str = "event_ntz") -> DataFrame:
    return df.withColumn(name, F.col(column).cast("timestamp_ntz"))


# ---------------------------------------------------------------- loading


def _written_topics(spark: SparkSession, sf_dir: str, names=tuple(TOPIC)) -> dict[str, str]:
    """Channel -> folder of JSON lines with its payments."""
    root = fresh_path(spark, "raw")
    frames = views.channels(spark, sf_dir)
    for c in names:
        frames[c].select(*FIELDS).write.json(f"{root}/{TOPIC[c]}")
    return {c: f"{root}/{TOPIC[c]}" for c in TOPIC}


def load_topic(spark, sf_dir):
    folders = _written_topics(spark, sf_dir, ["bank"])
    lo, hi = raw.resolve_range(START, END)
    return _ntz(raw.load_topic(spark, folders["bank"], lo, hi)).select(*LOADED)


def load_topic_lookback(spark, sf_dir):
    folders = _written_topics(spark, sf_dir, ["gateway"])
    lo, hi = raw.resolve_range(end=END, lookback=timedelta(days=fv.FEATURE_DAYS))
    return _ntz(raw.load_topic(spark, folders["gateway"], lo, hi)).select(*LOADED)


def load_topics_union(spark, sf_dir):
    folders = _written_topics(spark, sf_dir)
    lo, hi = raw.resolve_range(START, END)
    return _ntz(raw.load_topics(spark, list(folders.values()), lo, hi)).select(*LOADED)


def load_missing_topic(spark, sf_dir):
    """The processor's folder does not exist: its rows are missing, the others are there."""
    folders = _written_topics(spark, sf_dir, ["bank", "gateway"])
    lo, hi = raw.resolve_range(START, END)
    rows = raw.load_topics(spark, list(folders.values()), lo, hi, on_missing="empty")
    return _ntz(rows).select(*LOADED)


def load_json_array(spark, sf_dir):
    """Files whose lines are JSON arrays of up to 100 payments."""
    path = fresh_path(spark, "arrays")
    numbered = views.channels(spark, sf_dir)["bank"].withColumn("row", F.monotonically_increasing_id())
    arrays = numbered.groupBy(F.expr("row DIV 100").alias("piece")).agg(
        F.to_json(F.collect_list(F.struct(*FIELDS))).alias("value")
    )
    arrays.select("value").write.text(path)
    lo, hi = raw.resolve_range(START, END)
    return _ntz(raw.load_topic(spark, path, lo, hi)).select(*LOADED)


def load_counts(spark, sf_dir):
    folders = _written_topics(spark, sf_dir)
    lo, hi = raw.resolve_range(START, END)
    return channels.load_counts(
        {TOPIC[c]: raw.load_topic(spark, path, lo, hi) for c, path in folders.items()}
    )


def channel_split(spark, sf_dir):
    split = channels.channel_split(views.payments(spark, sf_dir))
    return split.select("transaction_id", "source", "channel")


def schema_conformance(spark, sf_dir):
    frames = views.channels(spark, sf_dir)
    return channels.conformance(raw.union_all(list(frames.values())))


# ---------------------------------------------------------------- reconciliation

REPORT = (
    "transaction_id", "user_id", "event_ntz",
    *[f"{c}_{f}" for f in ("amount", "status", "source", "presence") for c in TOPIC],
    "bank_gateway_amount_check", "bank_processor_amount_check", "gateway_processor_amount_check",
    "reconciliation_status",
)


def _reconciled(spark, sf_dir, **options):
    return reconcile.reconcile(**views.channels(spark, sf_dir), **options)


def recon_detail(spark, sf_dir):
    return _ntz(_reconciled(spark, sf_dir)).select(*REPORT)


def recon_detail_bank_key(spark, sf_dir):
    return _ntz(_reconciled(spark, sf_dir, key_mode="bank")).select(*REPORT)


def recon_detail_exact(spark, sf_dir):
    return _ntz(_reconciled(spark, sf_dir, exact=True, tolerance=1.5)).select(*REPORT)


def recon_two_way(spark, sf_dir):
    frames = views.channels(spark, sf_dir)
    report = reconcile.compare_two(frames["bank"], frames["gateway"])
    return report.select(
        "transaction_id", "user_id", "bank_amount", "gateway_amount", "bank_status", "gateway_status",
        "bank_presence", "gateway_presence", "bank_gateway_amount_check", "reconciliation_status",
    )


def recon_amount_checks(spark, sf_dir):
    return _reconciled(spark, sf_dir).groupBy(
        "bank_gateway_amount_check", "bank_processor_amount_check", "gateway_processor_amount_check"
    ).agg(F.count(F.lit(1)).alias("txn_count"))


def recon_status_checks(spark, sf_dir):
    return _reconciled(spark, sf_dir).groupBy(
        "bank_status", "gateway_status", "processor_status", "reconciliation_status"
    ).agg(F.count(F.lit(1)).alias("txn_count"))


def recon_summary(spark, sf_dir):
    return reconcile.summarize(_reconciled(spark, sf_dir))


def recon_result_payload(spark, sf_dir):
    return reconcile.result_payload(_reconciled(spark, sf_dir))


def recon_duplicates(spark, sf_dir):
    """Ids repeat in every channel: each combination is a row."""
    report = reconcile.reconcile(**views.line_channels(spark, sf_dir))
    return _ntz(report).select(*REPORT)


def recon_hot_ids(spark, sf_dir):
    """The same with repeated ids treated as hot: salted, row by row."""
    frames = views.line_channels(spark, sf_dir)
    profile = skew.profile_keys(frames, "transaction_id", min_rows=2, skip_below_bytes=0, look_at=1)
    report = reconcile.reconcile(**frames, skew=profile, rows_per_salt=1)
    return _ntz(report).select(*REPORT)


def recon_latest(spark, sf_dir):
    report = reconcile.reconcile(**views.line_channels(spark, sf_dir), dedupe="latest")
    return _ntz(report).select(*REPORT)


def recon_bucketed(spark, sf_dir):
    """Channels kept bucketed by id are matched where they lie."""
    root, names = fresh_path(spark, "bucketed"), {}
    for c, frame in views.channels(spark, sf_dir).items():
        names[c] = f"bucketed_{c}_{root[-12:]}"
        rows = frame.withColumn("event_time", F.col("event_time").cast("timestamp"))
        bucketed.write_bucketed(rows, names[c], f"{root}/{c}", 8)
    return _ntz(bucketed.reconcile_bucketed(spark, **names)).select(*REPORT)


def schema_drift(spark, sf_dir):
    """Messages whose fields drift with the kind of payment, by topic and day."""
    found = drift.schema_drift(views.drifting_messages(spark, sf_dir))
    return found.select("topic", "event_date", "field", "kind", "type", "messages", F.round("share", 9).alias("share"))


# ---------------------------------------------------------------- user features


def _features(spark, sf_dir, **options):
    return features.user_features(views.payments(spark, sf_dir), as_of=FIRST_RUN, **options)


def user_features(spark, sf_dir):
    return _features(spark, sf_dir).drop("feature_extraction_time")


def user_features_incremental(spark, sf_dir):
    """Days folded as they come, one of them twice because a half of it came late; then merged."""
    path = fresh_path(spark, "folded-days")
    source = views.payments(spark, sf_dir)
    day, cut = F.to_date("event_time"), F.lit(START.date())
    folds.write_days(source.filter(day < cut), path)
    folds.write_days(source.filter((day == cut) & (F.hour("event_time") < 12)), path)
    folds.write_days(source.filter(day >= cut), path)
    merged = partials.merge(folds.read_days(spark, path), as_of=FIRST_RUN)
    return merged.drop("feature_extraction_time")


def user_features_volume(spark, sf_dir):
    return features.user_volume(views.payments(spark, sf_dir))


def user_features_volume_bucketed(spark, sf_dir):
    return features.user_volume(views.payments(spark, sf_dir), grain="bucket")


def user_features_week_collision(spark, sf_dir):
    """Orders span years: weeks with the same number fall together."""
    return features.user_volume(views.order_payments(spark, sf_dir))


def user_features_amount(spark, sf_dir):
    return features.user_amounts(views.payments(spark, sf_dir))


def user_features_diversity(spark, sf_dir):
    return features.user_diversity(views.payments(spark, sf_dir))


def user_features_failed(spark, sf_dir):
    return features.user_failures(views.payments(spark, sf_dir))


def user_features_windowed(spark, sf_dir):
    return _ntz(features.transaction_context(views.payments(spark, sf_dir))).drop("event_time")


def risk_score(spark, sf_dir):
    return _features(spark, sf_dir).select("user_id", "risk_score")


def high_risk_users(spark, sf_dir):
    return features.high_risk(_features(spark, sf_dir)).select("user_id", "risk_score")


def feature_summary(spark, sf_dir):
    return features.summarize(_features(spark, sf_dir))


# ---------------------------------------------------------------- fraud rules


def _judged_messages(spark, sf_dir):
    stored = views.messages_of(views.payments(spark, sf_dir)).select(
        F.col("transaction_id").alias("sent_id"), "value"
    )
    return messages.classify(messages.parse_messages(stored))


def txn_parse(spark, sf_dir):
    return _judged_messages(spark, sf_dir).select("sent_id", "shape", "user_id", "amount", "status")


def txn_validate(spark, sf_dir):
    return _judged_messages(spark, sf_dir).select("sent_id", "row_class")


RULES = (
    "transaction_id", "user_id", "amount", "status", "txn_count", "txn_total",
    "is_large", "is_repeated", "is_bad_status", "is_suspicious", "row_class",
)


def fraud_rules(spark, sf_dir):
    return rules.fraud_rules(views.payments(spark, sf_dir)).select(*RULES)


def fraud_rules_fine_amounts(spark, sf_dir):
    """Amounts of four decimals: totals add all of them."""
    fine = views.payments(spark, sf_dir).withColumn("amount", F.round(F.col("amount").cast("decimal(18,2)") / 7, 4).cast("double"))
    return rules.fraud_rules(fine).select(*RULES)


def fraud_rules_hot_users(spark, sf_dir):
    """The same with every user treated as hot: history summed in slices."""
    source = views.payments(spark, sf_dir)
    profile = skew.profile_keys({"payments": source}, "user_id", min_rows=1, skip_below_bytes=0, look_at=1)
    found = profile["payments"]
    judged = rules.fraud_rules(source, skew=found, rows_per_slice=found.rows // 16 + 1)
    return judged.select(*RULES)


def fraud_alert_text(spark, sf_dir):
    judged = rules.fraud_rules(views.payments(spark, sf_dir))
    return judged.select("transaction_id", alerts.alert_text().alias("verdict"))


def fraud_text_sample(spark, sf_dir):
    """Payments as plain-text messages, in their order of arrival."""
    source = views.payments(spark, sf_dir)
    text = F.format_string("Transaction: %s, amount=%s", "user_id", F.col("amount").cast("string"))
    stored = source.select(F.col("event_time").alias("arrival"), "transaction_id", text.alias("value"))
    parsed = messages.parse_messages(stored.withColumnRenamed("transaction_id", "sent_id"))
    valid = messages.classify(parsed).filter(F.col("row_class") == messages.VALID)
    judged = rules.fraud_rules(valid, order_by=("arrival", "sent_id"))
    return judged.select("sent_id", alerts.alert_text().alias("verdict"))


def fraud_alert_payload(spark, sf_dir):
    return rules.alert_payload(rules.fraud_rules(views.payments(spark, sf_dir)))


BURST = {"count": 5, "seconds": 86_400}


def burst_detect(spark, sf_dir):
    found = burst.burst_detect(views.payments(spark, sf_dir), **BURST)
    return found.select("transaction_id", "user_id", "burst_count", "is_burst")


def burst_detect_hot_users(spark, sf_dir):
    """The same with every user treated as hot."""
    source = views.payments(spark, sf_dir)
    profile = skew.profile_keys({"payments": source}, "user_id", min_rows=1, skip_below_bytes=0, look_at=1)
    found = burst.burst_detect(source, skew=profile["payments"], **BURST)
    return found.select("transaction_id", "user_id", "burst_count", "is_burst")


# ---------------------------------------------------------------- upserts


def dedupe_latest(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    return upsert.dedupe_latest(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")


def upsert_features(spark, sf_dir):
    """Features of all payments, then those of the large ones, merged twice."""
    path = fresh_path(spark, "user-features")
    source = views.payments(spark, sf_dir)
    first = features.user_features(source, as_of=FIRST_RUN)
    second = features.user_features(source.filter(F.col("amount") > 250), as_of=SECOND_RUN)
    for batch in (first, second, second):
        tables.upsert_table(batch, path, ["user_id"], "feature_extraction_time")
    rows = _ntz(tables.read_table(spark, path), "feature_extraction_time", "extracted_at")
    return rows.select("user_id", "max_txn_count_hourly", "avg_txn_amount", "risk_score", "extracted_at")


def upsert_reconciled(spark, sf_dir):
    """A first report, then one in which the processor has caught up with the bank."""
    path = fresh_path(spark, "reconciled")
    frames = views.channels(spark, sf_dir)
    late = {**frames, "processor": frames["bank"]}
    for channel_frames, as_of in ((frames, FIRST_RUN), (late, SECOND_RUN)):
        report = reconcile.reconcile(**channel_frames, as_of=as_of)
        if as_of == SECOND_RUN:
            report = report.filter(F.col("bank_presence") == fv.PRESENT)
        dated = report.withColumn("event_date", F.to_date("event_time"))
        tables.upsert_table(dated, path, ["transaction_id"], "reconciliation_time", "event_date")
    rows = _ntz(tables.read_table(spark, path), "reconciliation_time", "reconciled_at")
    return rows.select("transaction_id", "user_id", "reconciliation_status", "reconciled_at")


def upsert_reconciled_bank_key(spark, sf_dir):
    """Every row of two reports matched on the bank's id, also those of one id and those without;
    the second run sees the processor late, and only payments of which it has something."""
    path = fresh_path(spark, "reconciled-bank-key")
    frames = views.channels(spark, sf_dir)
    frames["gateway"] = frames["gateway"].unionByName(frames["gateway"].filter(F.col("amount") > 400))
    frames["processor"] = frames["processor"].withColumn(
        "transaction_id", F.when(F.col("amount") > 50, F.col("transaction_id"))
    )
    late = {**frames, "processor": frames["bank"]}
    for channel_frames, as_of in ((frames, FIRST_RUN), (frames, FIRST_RUN), (late, SECOND_RUN)):
        report = reconcile.reconcile(**channel_frames, key_mode="bank", as_of=as_of)
        if as_of == SECOND_RUN:
            report = report.filter(F.col("bank_presence") == fv.PRESENT)
        dated = reconcile.with_row_key(report).withColumn("event_date", F.to_date("event_time"))
        tables.upsert_table(dated, path, ["row_key"], "reconciliation_time", "event_date", whole_keys=True)
    rows = _ntz(tables.read_table(spark, path), "reconciliation_time", "reconciled_at")
    return rows.select(
        "transaction_id", "user_id", "bank_presence", "gateway_presence", "processor_presence",
        "reconciliation_status", "reconciled_at",
    )


def _dated(spark, sf_dir):
    rows = views.payments(spark, sf_dir).withColumn("updated_at", F.lit(FIRST_RUN))
    return rows.select("transaction_id", "user_id", "amount", "status", "updated_at",
                       F.to_date("event_time").alias("event_date"))


def _indexed_table(spark, label, rows):
    return indexed.create(spark, fresh_path(spark, label), rows.schema, ["transaction_id"], "event_date",
                          buckets=2, slots=16)


def upsert_indexed(spark, sf_dir):
    """All payments by day; then, twice, the large ones settled on a later day and some new ones."""
    rows = _dated(spark, sf_dir)
    table = _indexed_table(spark, "indexed", rows)
    later = rows.withColumn("updated_at", F.lit(SECOND_RUN))
    moved = later.filter(F.col("amount") > 400).withColumns(
        {"event_date": F.date_add("event_date", 3), "status": F.lit("settled")})
    new = later.filter(F.col("amount") < 5).withColumn("transaction_id", F.concat("transaction_id", F.lit("-2")))
    batch = moved.unionByName(new)
    for part in (rows, batch, batch):
        table.upsert(part, "updated_at")
    return _ntz(table.read(), "updated_at", "stored_at").select(
        "transaction_id", "user_id", "amount", "status", "event_date", "stored_at")


def upsert_snapshot(spark, sf_dir):
    """Three writers start from one version; the table as each version of it shows it."""
    rows = _dated(spark, sf_dir)
    table = _indexed_table(spark, "snapshots", rows)
    table.upsert(rows, "updated_at")
    slow = table.prepare(rows.filter(F.col("amount") > 300).withColumn("status", F.lit("slow")), "updated_at")
    apart = table.prepare(
        rows.filter(F.col("amount") < 5).withColumn("transaction_id", F.concat("transaction_id", F.lit("-2"))), "updated_at")
    table.upsert(rows.filter(F.col("amount") > 400).withColumn("status", F.lit("quick")), "updated_at")
    table.commit(slow)
    table.commit(apart)
    seen = [table.read(v).withColumn("version", F.lit(v)) for v in table.versions()]
    return raw.union_all(seen).groupBy("version", "status").agg(
        F.count(F.lit(1)).alias("txn_count"), F.count_distinct("transaction_id").alias("ids"),
        F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("amount"))


# ---------------------------------------------------------------- streams


def _run(query) -> None:
    query.awaitTermination()


def _to_table(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over what is there now and read its output."""
    spark = stream.sparkSession
    out = fresh_path(spark, label)
    _run(sinks.to_parquet(stream, f"{out}/rows", f"{out}/checkpoint", trigger=sinks.AVAILABLE_NOW))
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def _message_folders(spark, sf_dir) -> dict[str, str]:
    """Topic -> folder of text files with the channel's payments as messages."""
    root = fresh_path(spark, "messages")
    for c, frame in views.channels(spark, sf_dir).items():
        frame.select(F.to_json(F.struct(*FIELDS)).alias("value")).write.text(f"{root}/{TOPIC[c]}")
    return {t: f"{root}/{t}" for t in TOPIC.values()}


def stream_source(spark, sf_dir):
    """Raw messages of all kinds, parsed and validated as a stream."""
    path = fresh_path(spark, "messages")
    views.messages_of(views.payments(spark, sf_dir)).select("value").write.text(path)
    stream = sources.file_messages(spark, path, TOPIC["bank"])
    judged = messages.classify(messages.parse_messages(stream))
    return _to_table(judged.select("topic", "shape", "row_class", "user_id", "amount"), "stream-source")


def stream_union(spark, sf_dir):
    folders = _message_folders(spark, sf_dir)
    united = sources.union_streams(
        [sources.file_messages(spark, path, topic) for topic, path in folders.items()]
    )
    parsed = messages.classify(messages.parse_messages(united))
    return _to_table(
        parsed.select("topic", "transaction_id", "user_id", "amount", "status"), "stream-union"
    )


def land_topics(spark, sf_dir):
    """Messages of all topics landed by a stream, then loaded by the batch reader."""
    folders = _message_folders(spark, sf_dir)
    united = sources.union_streams(
        [sources.file_messages(spark, path, topic) for topic, path in folders.items()]
    )
    root = fresh_path(spark, "landed")
    _run(landing.land_topics(united, f"{root}/raw", f"{root}/checkpoint", trigger=sinks.AVAILABLE_NOW))
    lo, hi = raw.resolve_range(START, END)
    loaded = raw.load_topics(spark, [landing.topic_path(f"{root}/raw", t) for t in folders], lo, hi)
    return _ntz(loaded).select(*LOADED)


def _payment_stream(spark, sf_dir) -> DataFrame:
    name = "events.parquet"
    schema = views.table(spark, sf_dir, "events").schema
    if paths.is_directory(spark, f"{sf_dir}/{name}"):
        stream = sources.file_rows(spark, f"{sf_dir}/{name}", schema)
    else:
        stream = sources.file_rows(spark, sf_dir, schema, glob=name)
    rows = views.payments_of(stream)
    return rows.withColumn("event_time", F.col("event_time").cast("timestamp"))


def stream_fraud_rules(spark, sf_dir):
    judged = fraud_rules_stream(_payment_stream(spark, sf_dir))
    return _to_table(judged.select(*RULES), "stream-fraud-rules")


LATENESS = "1 minute"


def stream_burst(spark, sf_dir):
    bursts = burst_stream(
        _payment_stream(spark, sf_dir), count=5, window="24 hours", slide="6 hours", lateness=LATENESS
    )
    rows = _to_table(bursts, "stream-burst")
    return _ntz(_ntz(rows, "window_start", "starts_at"), "window_end", "ends_at").select(
        "user_id", "starts_at", "ends_at", "txn_count"
    )


def _in_two_steps(spark, sf_dir, run) -> None:
    """Calls `run(stream)` after the first half of the payments has arrived, and again after
    the second."""
    source = views.payments(spark, sf_dir).withColumn("event_time", F.col("event_time").cast("timestamp"))
    half, folder = F.lit(str(START)).cast("timestamp"), fresh_path(spark, "two-steps")
    for part in (source.filter(F.col("event_time") < half), source.filter(F.col("event_time") >= half)):
        part.write.mode("append").parquet(folder)
        run(sources.file_rows(spark, folder, source.schema))


def stream_restart(spark, sf_dir):
    """The fraud rules stream stopped after the first half of the payments and restarted."""
    out = fresh_path(spark, "restart")

    def run(stream):
        judged = fraud_rules_stream(stream).select(*RULES)
        _run(sinks.to_parquet(judged, f"{out}/rows", f"{out}/checkpoint", trigger=sinks.AVAILABLE_NOW))

    _in_two_steps(spark, sf_dir, run)
    return spark.read.parquet(f"{out}/rows")


def stream_fraud_ledger(spark, sf_dir):
    """The same in large micro-batches through the batch operator."""
    out = fresh_path(spark, "ledger")
    _in_two_steps(spark, sf_dir, lambda stream: _run(
        ledger.fraud_rules_ledger(stream, f"{out}/ledger", f"{out}/checkpoint", trigger=sinks.AVAILABLE_NOW)
    ))
    return ledger.read_judged(spark, f"{out}/ledger").select(*RULES)


@contextmanager
def _state_outside_heap(spark):
    """The state store that keyed state with lists and timers needs, for the queries started inside."""
    before = {name: spark.conf.get(name) for name in STREAM_CONF}
    for name, value in STREAM_CONF.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _closing(rows: DataFrame) -> DataFrame:
    """One row years after all others. It only moves the watermark: nothing ever passes it."""
    last = rows.agg((F.max("event_time") + F.expr("interval 10 years")).alias("event_time"))
    return last.select(*[
        F.col(f.name) if f.name == "event_time" else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema])


def _shuffled(spark, sf_dir, make) -> DataFrame:
    """Output of the stream `make(payments)`, run and restarted while payments arrive in any order."""
    source = views.payments(spark, sf_dir).withColumn("event_time", F.col("event_time").cast("timestamp"))
    out, folder = fresh_path(spark, "shuffled"), fresh_path(spark, "arrivals")
    turn = F.pmod(F.xxhash64("transaction_id"), F.lit(2))
    with _state_outside_heap(spark):
        for part in (source.filter(turn == 0), source.filter(turn == 1), _closing(source)):
            part.write.mode("append").parquet(folder)
            stream = make(sources.file_rows(spark, folder, source.schema))
            _run(sinks.to_parquet(stream, f"{out}/rows", f"{out}/checkpoint", trigger=sinks.AVAILABLE_NOW))
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def stream_fraud_rules_ordered(spark, sf_dir):
    """The rules in event-time order though half of all payments come after later ones."""
    return _shuffled(spark, sf_dir, lambda s: fraud_rules_ordered(s, lateness="1000 days")).select(*RULES)


def stream_burst_exact(spark, sf_dir):
    found = _shuffled(spark, sf_dir, lambda s: burst_ordered(s, lateness="1000 days", **BURST))
    return found.select("transaction_id", "user_id", "burst_count", "is_burst")


def stream_reconcile(spark, sf_dir):
    """Three channel streams matched continuously; the processor's payments come last."""
    frames = {c: f.withColumn("event_time", F.col("event_time").cast("timestamp"))
              for c, f in views.channels(spark, sf_dir).items()}
    out, folder = fresh_path(spark, "matched"), fresh_path(spark, "channel-arrivals")
    schema = frames["bank"].schema
    for step in ({c: frames[c] for c in ("bank", "gateway")}, {"processor": frames["processor"]},
                 {"bank": _closing(frames["bank"])}):
        for c in frames:
            rows = step.get(c, frames[c].limit(0))
            rows.write.mode("append").parquet(f"{folder}/{c}")
        stream = reconcile_stream(
            **{c: sources.file_rows(spark, f"{folder}/{c}", schema) for c in frames}, lateness="1000 days", as_of=FIRST_RUN)
        _run(sinks.to_parquet(stream, f"{out}/rows", f"{out}/checkpoint", trigger=sinks.AVAILABLE_NOW))
    return _ntz(spark.read.schema(stream.schema).parquet(f"{out}/rows")).select(*REPORT)


def stream_verdict_lines(spark, sf_dir):
    """A line for every message of all kinds, rejected ones too; they are read once."""
    folder = fresh_path(spark, "timed-messages")
    source = views.payments(spark, sf_dir)
    times = source.select("transaction_id", F.col("event_time").cast("timestamp").alias("arrival"))
    sent = views.messages_of(source).select("transaction_id", "value").join(times, "transaction_id").select("arrival", "value")
    sent.write.parquet(folder)
    stream = sources.file_rows(spark, folder, sent.schema)
    return _to_table(verdict_lines(stream), "verdict-lines")


class _Killed(Exception):
    pass


def stream_alert_outbox(spark, sf_dir):
    """Alerts sent through an outbox by a publisher that is killed after its first send, before it
    notes it, and again after half of its second."""
    out = fresh_path(spark, "alerts")
    target = outbox.FolderTarget(spark, f"{out}/topic")
    kills = iter((lambda m: m, lambda m: m.filter(F.pmod(F.xxhash64("message_id"), F.lit(2)) == 0)))

    class Failing(outbox.FolderTarget):
        def send(self, messages):
            super().send(next(kills)(messages))
            raise _Killed

    def run(stream):
        payload = rules.alert_payload(fraud_rules_stream(stream))
        _run(outbox.collect(payload, out, f"{out}/checkpoint", trigger=sinks.AVAILABLE_NOW))
        try:
            outbox.publish(spark, out, Failing(spark, target.path))
        except _Killed:
            pass
        outbox.publish(spark, out, target)

    _in_two_steps(spark, sf_dir, run)
    return target.read().select(*outbox.MESSAGE)


QUERIES = {
    f.__name__: f
    for f in (
        load_topic, load_topic_lookback, load_topics_union, load_missing_topic, load_json_array,
        load_counts, channel_split, schema_conformance,
        recon_detail, recon_detail_bank_key, recon_detail_exact, recon_two_way, recon_amount_checks,
        recon_status_checks, recon_summary, recon_result_payload, recon_duplicates, recon_hot_ids,
        recon_latest, recon_bucketed, schema_drift,
        user_features, user_features_incremental, user_features_volume, user_features_volume_bucketed,
        user_features_week_collision, user_features_amount, user_features_diversity,
        user_features_failed, user_features_windowed, risk_score, high_risk_users, feature_summary,
        txn_parse, txn_validate, fraud_rules, fraud_rules_fine_amounts, fraud_rules_hot_users, fraud_alert_text,
        fraud_text_sample, fraud_alert_payload, burst_detect, burst_detect_hot_users,
        dedupe_latest, upsert_features, upsert_reconciled, upsert_reconciled_bank_key,
        upsert_indexed, upsert_snapshot,
        stream_source, stream_union, land_topics, stream_fraud_rules, stream_burst, stream_restart,
        stream_fraud_ledger, stream_fraud_rules_ordered, stream_burst_exact, stream_reconcile,
        stream_verdict_lines, stream_alert_outbox,
    )
}
