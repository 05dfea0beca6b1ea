"""Hand-written three-way cases, and skewed plans against the plain one and brute force."""

from collections import Counter
from datetime import datetime
from itertools import product

import pytest
from pyspark.sql import functions as F

from tripledger.operators import reconcile as recon
from tripledger.operators.skew import KeyProfile, profile_keys
from tripledger.schema import LOADED

AT = datetime(2024, 1, 1)
CHANNELS = ("bank", "gateway", "processor")


def side(spark, rows):
    """rows of (id, amount, status)"""
    full = [(i, f"u-{i}", 0, a, s, "x", None, None, None, None, None, AT) for i, a, s in rows]
    return spark.createDataFrame(full, LOADED)


# name: bank, gateway, processor (amount, status lists), verdicts coalesced, verdicts by bank key
CASES = {
    "equal": ([(10.0, "completed")], [(10.0, "completed")], [(10.0, "completed")], ["reconciled"], None),
    "no_processor": ([(10.0, "completed")], [(10.0, "completed")], [], ["incomplete"], None),
    "amount": ([(10.0, "completed")], [(12.5, "completed")], [(10.0, "completed")], ["amount_mismatch"], None),
    "status": ([(10.0, "completed")], [(10.0, "pending")], [(10.0, "completed")], ["status_mismatch"], None),
    "amount_first": ([(10.0, "completed")], [(12.5, "pending")], [(10.0, "completed")], ["amount_mismatch"], None),
    "gap_first": ([(10.0, "completed")], [(12.5, "completed")], [], ["incomplete"], None),
    "no_bank": ([], [(10.0, "completed")], [(10.0, "completed")], ["incomplete"], ["incomplete"] * 2),
    "only_gateway": ([], [(10.0, "completed")], [], ["incomplete"], None),
    "null_amount": ([(10.0, "completed")], [(None, "completed")], [(10.0, "completed")], ["reconciled"], None),
    "null_status": ([(10.0, "completed")], [(10.0, None)], [(10.0, "completed")], ["reconciled"], None),
    "null_status_off": ([(10.0, "completed")], [(10.0, None)], [(10.0, "failed")], ["status_mismatch"], None),
    "twice": ([(10.0, "completed")] * 2, [(10.0, "completed")], [(10.0, "completed")], ["reconciled"] * 2, None),
}


def case_frames(spark):
    return {
        c: side(spark, [(name, *row) for name, case in CASES.items() for row in case[k]])
        for k, c in enumerate(CHANNELS)
    }


@pytest.mark.parametrize("key_mode", ["coalesced", "bank"])
def test_cases(spark, key_mode):
    report = recon.reconcile(**case_frames(spark), key_mode=key_mode, skew={})
    got = Counter((r[0], r[1]) for r in report.select("transaction_id", "reconciliation_status").collect())
    want = Counter()
    for name, case in CASES.items():
        verdicts = case[3] if key_mode == "coalesced" or case[4] is None else case[4]
        want.update((name, v) for v in verdicts)
    assert got == want


@pytest.mark.parametrize("key_mode", ["coalesced", "bank"])
def test_latest_keeps_one_row_per_channel(spark, key_mode):
    report = recon.reconcile(**case_frames(spark), key_mode=key_mode, dedupe="latest")
    rows = Counter(r[0] for r in report.select("transaction_id").collect())
    assert rows["twice"] == 1
    assert rows["no_bank"] == (1 if key_mode == "coalesced" else 2)
    assert sum(rows.values()) == len(CASES) + (key_mode == "bank")


def brute_force(frames, key_mode):
    """Ids of every output row, by nested loops per id."""
    sides = [Counter() for _ in CHANNELS]
    out = Counter()
    for k, c in enumerate(CHANNELS):
        for r in frames[c].select("transaction_id", "amount", "status").collect():
            if r[0] is None:
                out[(None,) * 3 + ((k, r[1], r[2]),)] += 1
            else:
                sides[k][tuple(r)] += 1
    ids = {row[0] for s in sides for row in s}
    for i in ids:
        b, g, p = [[row[1:] for row in s.elements() if row[0] == i] for s in sides]
        if b or key_mode == "coalesced":
            combos = product(b or [None], g or [None], p or [None])
        else:
            combos = [(None, x, None) for x in g] + [(None, None, x) for x in p]
        out.update(combos)
    return out


def as_combos(report):
    out = Counter()
    columns = [f"{c}_{f}" for c in CHANNELS for f in ("presence", "amount", "status")]
    for r in report.select("transaction_id", *columns).collect():
        if r[0] is None:
            k = next((k for k, c in enumerate(CHANNELS) if r[f"{c}_status"] is not None), None)
            out[(None,) * 3 + ((k, r[f"{CHANNELS[k]}_amount"], r[f"{CHANNELS[k]}_status"]),)] += 1
        else:
            out[tuple(
                (r[f"{c}_amount"], r[f"{c}_status"]) if r[f"{c}_presence"] == "present" else None
                for c in CHANNELS
            )] += 1
    return out


def skewed_frames(spark):
    """One id holds a third of the bank's rows, one exists only at the gateway, ids are missing."""
    bank = [("hot", float(k % 3), "completed") for k in range(60)] + [(f"t{k}", 1.0, "completed") for k in range(90)]
    bank += [(None, 5.0, "bad")] * 30
    gateway = [("hot", 1.0, "completed"), ("hot", 2.0, "pending")] + [(f"t{k}", 1.0, "completed") for k in range(0, 90, 2)]
    gateway += [("orphan", 3.0, "failed")] * 40 + [(None, 6.0, "bad")] * 2
    processor = [(f"t{k}", 1.0, "completed") for k in range(0, 90, 3)] + [("orphan", 3.0, "failed")] * 2 + [("hot", 1.0, "x")]
    return dict(zip(CHANNELS, [side(spark, rows) for rows in (bank, gateway, processor)]))


@pytest.mark.parametrize("key_mode", ["coalesced", "bank"])
def test_hot_ids_change_no_row(spark, key_mode):
    frames = skewed_frames(spark)
    profile = profile_keys(frames, "transaction_id", min_rows=10, skip_below_bytes=0, look_at=1)
    assert set(profile["bank"].hot) == {"hot"} and set(profile["gateway"].hot) == {"orphan"}
    assert profile["bank"].null_keys == 30
    want = brute_force(frames, key_mode)
    plain = recon.reconcile(**frames, key_mode=key_mode, skew={})
    salted = recon.reconcile(**frames, key_mode=key_mode, skew=profile, rows_per_salt=5)
    assert as_combos(plain) == want
    assert as_combos(salted) == want


def test_hot_rows_get_many_salts(spark):
    frames = skewed_frames(spark)
    bank = frames["bank"].repartition(4).filter("transaction_id = 'hot'")
    salts = recon.stable_salt(F.lit(12), "amount", "status")
    assert bank.select(salts.alias("s")).distinct().count() > 4


def test_two_way_hot_ids(spark):
    frames = skewed_frames(spark)
    two = (frames["bank"], frames["gateway"])
    columns = ["transaction_id", "bank_amount", "gateway_amount", "bank_status", "gateway_status", "reconciliation_status"]
    profile = {"bank": KeyProfile(180, 30, {"hot": 60}), "gateway": KeyProfile(87, 2, {"orphan": 40})}
    plain = recon.compare_two(*two, skew={}).select(columns)
    salted = recon.compare_two(*two, skew=profile, rows_per_salt=7).select(columns)
    assert Counter(map(tuple, plain.collect())) == Counter(map(tuple, salted.collect()))


def test_one_cent(spark):
    """A cent may read as more than a cent on doubles; on decimals it is one cent."""
    frames = dict(zip(CHANNELS, (side(spark, [("b", a, "s")]) for a in (1.0, 1.01, 1.0))))
    assert abs(1.0 - 1.01) > 0.01
    for exact, want in ((False, "amount_mismatch"), (True, "reconciled")):
        row = recon.reconcile(**frames, exact=exact, skew={}).collect()[0]
        assert row["reconciliation_status"] == want


def test_summary_of_nothing(spark):
    empty = side(spark, [])
    row = recon.summarize(recon.reconcile(empty, empty, empty, skew={})).collect()[0]
    assert row["total_count"] == 0 and row["reconciled_pct"] is None


def test_bad_arguments(spark):
    frames = case_frames(spark)
    with pytest.raises(ValueError):
        recon.reconcile(**frames, key_mode="other")
    with pytest.raises(ValueError):
        recon.reconcile(**frames, dedupe="first")


STALE = [
    {},
    {"bank": KeyProfile(9, 0, {"orphan": 50})},  # listed for a channel that does not have it
    {"gateway": KeyProfile(9, 50, {"hot": 1, "gone": 10**7, "t2": 3})},
    {"bank": KeyProfile(9, 9, {"hot": 60}), "gateway": KeyProfile(9, 9, {"hot": 2, "orphan": 7}), "processor": KeyProfile(9, 9, {"t3": 1})},
]


@pytest.mark.parametrize("key_mode", ["coalesced", "bank"])
@pytest.mark.parametrize("profile", STALE)
def test_any_profile_gives_the_same_rows(spark, key_mode, profile):
    frames = skewed_frames(spark)
    report = recon.reconcile(**frames, key_mode=key_mode, skew=profile, rows_per_salt=4)
    assert as_combos(report) == brute_force(frames, key_mode)


def test_id_that_is_hot_in_two_channels(spark):
    rows = [("hot", float(k), "completed") for k in range(40)]
    frames = {c: side(spark, rows[: 40 if c != "processor" else 3]) for c in CHANNELS}
    sides = {c: recon._prefixed(df, c) for c, df in frames.items()}
    counts = {"hot": {"bank": 40, "gateway": 40, "processor": 3}}
    out = recon._product(sides, counts, 10)
    assert out.count() == out.distinct().count() == 40 * 40 * 3


@pytest.mark.parametrize("key_mode", ["coalesced", "bank"])
def test_rows_the_bank_does_not_know_spread(spark, key_mode):
    """Two thirds of the gateway is unknown to the bank, and many rows have no id."""
    bank = side(spark, [(f"t{k}", 1.0, "completed") for k in range(2000)])
    gateway = side(spark, [(f"t{k}" if k < 6000 else None, float(k), "completed") for k in range(9000)])
    processor = side(spark, [(f"t{k}", 1.0, "completed") for k in range(1000)])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        report = recon.reconcile(bank, gateway, processor, key_mode=key_mode, skew={})
        sizes = [r[1] for r in report.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 9000 and max(sizes) <= 2 * sum(sizes) / len(sizes) and len(sizes) == 8
