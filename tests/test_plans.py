"""What the plans must look like."""

from pyspark.sql import functions as F

from tripledger.functions import messages
from tripledger.operators import features, reconcile, rules
from tripledger.operators.skew import KeyProfile
from tripledger.plans import views

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_messages_are_parsed_once(spark):
    stored = spark.createDataFrame([("{}",)], "value string")
    judged = messages.classify(messages.parse_messages(stored))
    text = judged.filter(F.col("row_class") == messages.VALID)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1


def test_summary_reads_only_what_it_needs(spark):
    frames = views.channels(spark, SF_DIR)
    text = plan(reconcile.summarize(reconcile.reconcile(**frames)))
    assert "props" not in text.split("ReadSchema", 1)[1].split("\n")[0]


def test_joins_are_shuffled_once_per_side(spark):
    text = plan(reconcile.reconcile(**views.channels(spark, SF_DIR)))
    assert text.count("Exchange hashpartitioning") == 4 and "Cartesian" not in text and "NestedLoop" not in text


def test_latest_takes_one_shuffle(spark):
    text = plan(reconcile.reconcile(**views.channels(spark, SF_DIR), dedupe="latest"))
    assert text.count("Exchange") == 1 and "partial_max" in text


def test_features_fold_before_they_gather(spark):
    text = plan(features.user_features(views.payments(spark, SF_DIR)))
    assert "Window" not in text and "Join" not in text and "Sort " not in text
    gathers = [line for line in text.splitlines() if "Exchange hashpartitioning(user_id" in line and line.count("#") == 1 + line.count("plan_id=#")]
    assert len(gathers) <= 3  # volume, sums, distinct counts; their merge shuffles nothing


def test_only_the_needed_columns_ride_along(spark):
    judged = rules.fraud_rules(views.payments(spark, SF_DIR), skew=KeyProfile())
    text = plan(judged.select("transaction_id", "is_suspicious"))
    assert text.count("Exchange") == 1 and "props" not in text.rsplit("ReadSchema", 1)[1]
