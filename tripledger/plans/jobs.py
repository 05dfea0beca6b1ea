"""The jobs a user schedules: read, compute, write. Everything else does no I/O."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripledger import fixed_values as fv
from tripledger.functions import alerts, messages
from tripledger.operators import features as user
from tripledger.operators import reconcile as recon
from tripledger.operators import partials, rules
from tripledger.operators.skew import profile_keys
from tripledger.settings import STREAM_CONF, Settings
from tripledger.sources import folds, indexed, kafka, paths, raw, tables
from tripledger.sources.scratch import materialize
from tripledger.streaming import landing, matching, ordered, sinks
from tripledger.streaming.rules import fraud_rules_stream, valid_messages, verdict_lines

#: Messages in a micro-batch, also in the first one after years: keyed state holds a user's share of it in one task.
MESSAGES_PER_TRIGGER = 1_000_000
LAYOUTS = ("partitions", "indexed")
OUTPUTS = ("alerts", "lines")


def _topic_root(spark: SparkSession, settings: Settings, topic: str) -> str:
    """Where `landing_job` puts a topic, or the plain folder of a topic that others have put there."""
    landed = landing.topic_path(settings.raw_root, topic)
    return landed if paths.exists(spark, landed) else f"{settings.raw_root}/{topic}"


def reconcile_job(
    spark: SparkSession,
    settings: Settings | None = None,
    *,
    start: datetime | None = None,
    end: datetime | None = None,
    lookback: timedelta = timedelta(hours=fv.RECONCILE_HOURS),
    topics: dict[str, str] = fv.TOPICS,
    table: str = "reconciled_transactions",
    on_missing: str = "error",
    layout: str = "partitions",
    publish: Callable[[DataFrame], None] | None = None,
    **options,
) -> DataFrame:
    """Reconcile a time range, merge it into the table, return the summary of the range.

    The table has every row of the report; a later run that sees an id replaces all its rows.
    `layout="indexed"` keeps it as `sources.indexed` describes: a run then opens only the files
    that hold its ids, and several may run at once. `publish` is called with the result messages
    of the payments that are not reconciled (`to_results` sends them to their topic).

    The summary also has, per channel, the rows read, those without a readable time and those out
    of range, counted while they were read.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout is one of {LAYOUTS}")
    settings = settings or Settings()
    lo, hi = raw.resolve_range(start, end, lookback)
    seen = {c: Observation(f"{c}_rows") for c in topics}

    def loaded(**observers):
        return {c: raw.load_topic(spark, _topic_root(spark, settings, t), lo, hi, on_missing=on_missing, seen=observers.get(c))
                for c, t in topics.items()}

    as_of = datetime.now(timezone.utc)
    # Looking for hot ids must not be what the observers see.
    if "skew" not in options and options.get("dedupe") is None:
        options["skew"] = profile_keys(loaded(), "transaction_id")
    report = recon.reconcile(**loaded(**seen), as_of=as_of, **options)
    path = f"{settings.reconciled_root}/{table}"
    # Merged and summarized below: computed once.
    dated = materialize(recon.with_row_key(report).withColumn("event_date", F.to_date("event_time")), "report")
    if layout == "indexed":
        table = indexed.create(spark, path, dated.schema, ["row_key"], "event_date", buckets=16, slots=1024)
        table.upsert(dated, "reconciliation_time", whole_keys=True)
    else:
        tables.upsert_table(dated, path, ["row_key"], "reconciliation_time", "event_date", whole_keys=True)
    if publish is not None:
        publish(recon.result_payload(dated))
    return _with_counts(recon.summarize(dated), seen, spark, settings, topics)


def to_results(settings: Settings) -> Callable[[DataFrame], None]:
    """Sends result messages to the topic they name."""
    return lambda payload: kafka.write_batch(payload, settings.kafka_servers)


def _with_counts(summary: DataFrame, seen: dict[str, Observation], spark, settings, topics) -> DataFrame:
    """Adds what the observers counted; a channel whose folder is missing has read nothing."""
    for c, observation in seen.items():
        there = paths.exists(spark, _topic_root(spark, settings, topics[c]))
        counts = observation.get if there else {"read": 0, "unreadable": 0, "out_of_range": 0}
        summary = summary.withColumns({f"{c}_{n}_count": F.lit(v) for n, v in counts.items()})
    return summary


def feature_job(
    spark: SparkSession,
    settings: Settings | None = None,
    *,
    start: datetime | None = None,
    end: datetime | None = None,
    lookback: timedelta = timedelta(days=fv.FEATURE_DAYS),
    topics: Sequence[str] = tuple(fv.TOPICS.values()),
    table: str = "user_features",
    on_missing: str = "error",
    **options,
) -> DataFrame:
    """Features of a time range merged into the table; returns the summary of the table's run.

    The summary also has the rows read, those without a readable time and those out of range.
    """
    settings = settings or Settings()
    lo, hi = raw.resolve_range(start, end, lookback)
    as_of = datetime.now(timezone.utc)
    named = {t: t for t in topics}
    seen = {t: Observation(f"{t}_rows") for t in topics}
    txns = raw.union_all([
        raw.load_topic(spark, _topic_root(spark, settings, t), lo, hi, on_missing=on_missing, seen=seen[t]) for t in topics
    ]) if topics else raw.empty_transactions(spark)
    # Written down, since the merge looks at it more than once: the payments are read once.
    features = materialize(user.user_features(txns, as_of=as_of, **options), "features")
    path = f"{settings.features_root}/{table}"
    tables.upsert_table(features, path, ["user_id"], "feature_extraction_time")
    return _with_counts(user.summarize(features), seen, spark, settings, named)


def folded_feature_job(
    spark: SparkSession,
    settings: Settings | None = None,
    *,
    last: date,
    days: int = fv.FEATURE_DAYS,
    late: int = 1,
    topics: Sequence[str] = tuple(fv.TOPICS.values()),
    table: str = "user_features",
    on_missing: str = "error",
    grain: str = "clock",
) -> DataFrame:
    """Features of the `days` whole days up to `last`, from folded days that are kept.

    A run reads the payments of the days that are not folded yet and of the `late` newest folded
    ones, which late payments may still reach; the other days are merged from what is kept.
    """
    settings = settings or Settings()
    window = [last - timedelta(days=k) for k in range(days)]
    path = f"{settings.features_root}/{table}_days"
    kept = folds.kept_days(spark, path)
    stale = sorted({d for d in window if d not in kept} | set(sorted(d for d in window if d in kept)[-late:] if late else []))
    if stale:
        lo, _ = raw.resolve_range(datetime.combine(stale[0], datetime.min.time()), lookback=timedelta(0))
        _, hi = raw.resolve_range(end=datetime.combine(stale[-1] + timedelta(days=1), datetime.min.time()), lookback=timedelta(0))
        txns = raw.load_topics(
            spark, [_topic_root(spark, settings, t) for t in topics], lo, hi - 1, on_missing=on_missing)
        folds.write_days(txns.filter(F.to_date("event_time").isin(stale)), path)
    as_of = datetime.now(timezone.utc)
    if not folds.kept_days(spark, path):
        merged = partials.merge(partials.fold(raw.empty_transactions(spark)), grain=grain, as_of=as_of)
    else:
        merged = partials.merge(folds.read_days(spark, path, window[-1], last), grain=grain, as_of=as_of)
    merged = materialize(merged, "features")
    tables.upsert_table(merged, f"{settings.features_root}/{table}", ["user_id"], "feature_extraction_time")
    return user.summarize(merged)


def landing_job(
    spark: SparkSession,
    checkpoint: str,
    settings: Settings | None = None,
    *,
    topics: Sequence[str] = tuple(fv.TOPICS.values()),
    max_per_trigger: int | None = MESSAGES_PER_TRIGGER,
    trigger: dict | None = None,
):
    """Kafka topics to raw folders; returns the running query."""
    settings = settings or Settings()
    options = kafka.source_options(
        settings.kafka_servers, topics, group_prefix="landing", max_per_trigger=max_per_trigger
    )
    return landing.land_topics(
        kafka.read_stream(spark, options), settings.raw_root, checkpoint, trigger=trigger
    )


def fraud_job(
    spark: SparkSession,
    checkpoint: str,
    settings: Settings | None = None,
    *,
    topics: Sequence[str] = tuple(fv.TOPICS.values()),
    starting: str = "earliest",
    max_per_trigger: int = MESSAGES_PER_TRIGGER,
    forget_after: str | None = None,
    lateness: str | None = None,
    output: str = "alerts",
):
    """Fraud rules over Kafka topics; returns the running query.

    `output="alerts"` sends alerts to the alert topic, `"lines"` prints the verdict line of every
    message, rejected ones too. With `lateness` a user's alerts follow event time, however late
    messages come within it (`streaming.ordered`); otherwise arrival. A micro-batch, the first one
    over a full topic too, has at most `max_per_trigger` messages.
    """
    settings = settings or Settings()
    if output == "lines":
        return sinks.to_console(
            verdict_lines(_messages(spark, settings, topics, starting, max_per_trigger), threshold=settings.large_amount,
                          forget_after=forget_after), checkpoint)
    if output != "alerts":
        raise ValueError(f"output is one of {OUTPUTS}")
    valid = valid_messages(_messages(spark, settings, topics, starting, max_per_trigger))
    if lateness:
        judged = ordered.fraud_rules_ordered(
            valid, lateness=lateness, threshold=settings.large_amount, forget_after=forget_after)
    else:
        judged = fraud_rules_stream(valid, threshold=settings.large_amount, forget_after=forget_after)
    payload = rules.alert_payload(judged, settings.large_amount)
    return kafka.write_stream(payload, settings.kafka_servers, checkpoint, fv.STREAM_TRIGGER)


def matching_job(
    spark: SparkSession,
    checkpoint: str,
    settings: Settings | None = None,
    *,
    topics: dict[str, str] = fv.TOPICS,
    starting: str = "earliest",
    max_per_trigger: int = MESSAGES_PER_TRIGGER,
    **options,
):
    """Continuous reconciliation of the three topics (options: see `streaming.matching`): payments
    that are not reconciled go to the result topic; returns the running query."""
    settings = settings or Settings()
    valid = valid_messages(_messages(spark, settings, tuple(topics.values()), starting, max_per_trigger))
    payload = recon.result_payload(match_topics(valid, topics, **options))
    return kafka.write_stream(payload, settings.kafka_servers, checkpoint, fv.STREAM_TRIGGER)


def match_topics(valid: DataFrame, topics: dict[str, str] = fv.TOPICS, **options) -> DataFrame:
    """The continuous report over one stream of valid messages of three topics, read once."""
    if "source" not in valid.columns:
        valid = valid.withColumn("source", F.lit(None).cast("string"))
    channel = F.lit(None).cast("string")
    for c, t in topics.items():
        channel = F.when(F.col("topic") == t, c).otherwise(channel)
    return matching.match_views(valid.withColumn("channel", channel).filter("channel IS NOT NULL"), **options)


def burst_job(
    spark: SparkSession,
    checkpoint: str,
    settings: Settings | None = None,
    *,
    topics: Sequence[str] = tuple(fv.TOPICS.values()),
    starting: str = "earliest",
    max_per_trigger: int = MESSAGES_PER_TRIGGER,
    lateness: str = "1 minute",
):
    """Bursts by the settings' count and seconds, to the alert topic; returns the running query."""
    settings = settings or Settings()
    valid = valid_messages(_messages(spark, settings, topics, starting, max_per_trigger))
    found = burst_alerts(valid, settings, lateness)
    return kafka.write_stream(found, settings.kafka_servers, checkpoint, fv.STREAM_TRIGGER)


def burst_alerts(valid: DataFrame, settings: Settings, lateness: str = "1 minute") -> DataFrame:
    """Key and JSON value of every transaction in a burst, for the alert topic."""
    found = ordered.burst_ordered(valid, count=settings.burst_count, seconds=settings.burst_seconds, lateness=lateness)
    value = F.to_json(F.struct("transaction_id", "user_id", "event_time", "burst_count"))
    return found.filter("is_burst").select(
        F.lit(fv.ALERT_TOPIC).alias("topic"), F.col("transaction_id").alias("key"), value.alias("value"))


def _messages(spark, settings: Settings, topics, starting: str, max_per_trigger: int) -> DataFrame:
    for name, value in STREAM_CONF.items():  # users are remembered outside the heap
        spark.conf.set(name, value)
    return kafka.read_stream(spark, kafka.source_options(
        settings.kafka_servers, topics, starting=starting, group_prefix="fraud", max_per_trigger=max_per_trigger))


def batch_verdicts(stored: DataFrame, *, threshold: float = fv.LARGE_AMOUNT, **options) -> DataFrame:
    """Verdict line of every stored message, valid or not, over the users' whole history."""
    judged = messages.classify(messages.parse_messages(stored))
    valid = judged.filter(F.col("row_class") == messages.VALID)
    rejected = judged.filter(F.col("row_class") != messages.VALID)
    good = rules.fraud_rules(valid, threshold=threshold, **options)
    good = good.withColumn("verdict", alerts.alert_text(threshold))
    return good.unionByName(
        rejected.withColumn("verdict", alerts.rejected_text()), allowMissingColumns=True
    )
