"""Indexed tables against a plain dictionary: upserts, crashes, writers at once, snapshots."""

import os
import random
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tripledger.sources import indexed, paths
from tripledger.sources.scratch import fresh_path

SCHEMA = "id string, day date, at int, v int"
DAY = date(2024, 1, 1)


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def table_of(spark, schema=SCHEMA, by="day", **options):
    options = {"buckets": 2, "slots": 8, **options}
    empty = spark.createDataFrame([], schema)
    return indexed.create(spark, fresh_path(spark, "indexed"), empty.schema, ["id"], by, **options)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("bits", [48, 3])
def test_upserts_follow_a_dictionary(spark, bits):
    """Also with fingerprints so short that nearly every file seems to hold every key."""
    rng, table, model = random.Random(bits), table_of(spark, print_bits=bits), {}
    for step in range(4):
        batch = [(f"k{rng.randrange(40)}" if rng.random() > 0.05 else None, DAY + timedelta(rng.randrange(4)) if rng.random() > 0.1 else None,
                  rng.randrange(5), rng.randrange(1000)) for _ in range(25)]
        for _ in range(1 + step % 2):  # a repeated run changes nothing
            assert table.upsert(frame(spark, batch), "at") == table.version()
        newest = {}
        for row in batch:
            rank = (row[2], row[1] is not None, row[1] or DAY, row[3])
            if row[0] not in newest or rank > newest[row[0]][0]:
                newest[row[0]] = (rank, row)
        model |= {k: row for k, (_, row) in newest.items()}
        assert rows_of(table.read()) == sorted(model.values(), key=repr)
    some = [r for r in model.values() if r[1] and DAY <= r[1] <= DAY + timedelta(1)]
    assert rows_of(table.read(between=(DAY, DAY + timedelta(1)))) == sorted(some, key=repr)


def test_one_day_opens_few_of_a_thousand_days(spark):
    table = table_of(spark, buckets=1, slots=4)
    days = spark.range(20_000).select(
        F.format_string("key-%032d", "id").alias("id"), F.date_add(F.lit(DAY), (F.col("id") % 1000).cast("int")).alias("day"),
        F.lit(1).alias("at"), F.col("id").cast("int").alias("v"))
    table.upsert(days, "at")
    files = {r["file"] for r in table.files(table.record(table.version())).collect()}
    assert len(files) == 1000
    new = [(f"key-{k:032d}", DAY + timedelta(999), 2, -k) for k in range(999, 20_000, 1000)]  # a stored day again
    new += [(f"new-{k}", DAY + timedelta(1000), 2, k) for k in range(100)]  # a day of new keys
    new += [("key-" + "0" * 29 + "005", DAY + timedelta(1000), 2, -5)]  # a key that has moved
    change = table.prepare(frame(spark, new), "at")

    def size(names):
        return sum(os.path.getsize(f"{table.path}/data/{n}") for n in names)

    assert set(change.removed) <= set(change.opened) <= files and len(change.removed) == 2
    assert size(change.opened) < 0.02 * size(files)
    table.commit(change)
    after = {r["id"]: r for r in table.read().filter("at = 2").collect()}
    assert len(after) == 121 and table.read().count() == 20_100
    assert after["key-" + "0" * 29 + "005"]["day"] == DAY + timedelta(1000)


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["_write", "log", "after log"])
def test_a_crash_changes_nothing_or_all(spark, monkeypatch, step):
    table = table_of(spark)
    table.upsert(frame(spark, [("a", DAY, 1, 1), ("b", DAY, 1, 1)]), "at")
    before = rows_of(table.read())
    batch = frame(spark, [("b", DAY + timedelta(1), 2, 2), ("c", DAY, 2, 2)])
    with monkeypatch.context() as patch:
        if step == "_write":
            own = table._write
            patch.setattr(table, "_write", lambda *a: (own(*a), (_ for _ in ()).throw(Crash()))[1])
        else:
            put = paths.put_if_absent

            def crash(*a):
                if step == "after log":
                    put(*a)
                raise Crash

            patch.setattr(indexed.paths, "put_if_absent", crash)
        with pytest.raises(Crash):
            table.upsert(batch, "at")
    done = sorted([("a", DAY, 1, 1), ("b", DAY + timedelta(1), 2, 2), ("c", DAY, 2, 2)], key=repr)
    assert rows_of(table.read()) == (done if step == "after log" else before)
    table.upsert(batch, "at")
    assert rows_of(table.read()) == done
    table.expire(1, timedelta(0))
    assert rows_of(table.read()) == done
    live = {r["file"] for r in table.files(table.record(table.version())).collect()}
    left = {f"{os.path.relpath(d, table.path + '/data')}/{f}" for d, _, fs in os.walk(f"{table.path}/data")
            for f in fs if f.endswith(".parquet")}
    assert left == live


def test_writers_at_once(spark):
    table = table_of(spark)
    table.upsert(frame(spark, [(f"k{i}", DAY, 0, 0) for i in range(6)]), "at")

    def write(w):
        own = indexed.IndexedTable(spark, table.path)
        for i in range(2):  # one key that all write, one of their own, and one moved
            own.upsert(frame(spark, [("k0", DAY, w, 10 * w + i), (f"w{w}-{i}", DAY, w, w), (f"k{w}", DAY + timedelta(w), w, w)]), "at")

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(1, 5)))
    rows = {r["id"]: r for r in table.read().collect()}
    assert table.version() == 9 and table.read().count() == len(rows) == 14
    assert {f"w{w}-{i}" for w in range(1, 5) for i in range(2)} < set(rows)
    assert all(rows[f"k{w}"]["day"] == DAY + timedelta(w) for w in range(1, 5))
    last = [table.read(v).filter("id = 'k0'").first()["v"] for v in table.versions()[2:]]
    assert sorted(set(last)) == sorted(10 * w + i for w in range(1, 5) for i in range(2))


def test_a_change_apart_is_not_computed_again(spark, monkeypatch):
    table = table_of(spark)
    table.upsert(frame(spark, [(f"k{i}", DAY + timedelta(i), 0, 0) for i in range(8)]), "at")
    change = table.prepare(frame(spark, [("k1", DAY + timedelta(1), 1, 1)]), "at")
    table.upsert(frame(spark, [("k2", DAY + timedelta(2), 1, 1)]), "at")
    monkeypatch.setattr(table, "_compute", None)
    assert table.commit(change) == 3
    assert table.read().filter("at = 1").count() == 2


def test_snapshots_and_expiry(spark):
    table = table_of(spark)
    for step in range(4):
        table.upsert(frame(spark, [("a", DAY, step, step), (f"s{step}", DAY, step, step)]), "at")
    assert [table.read(v).count() for v in table.versions()] == [0, 2, 3, 4, 5]
    assert table.expire(2, timedelta(days=1)) == []  # too young
    old = table.read(1)
    assert table.expire(2, timedelta(0)) == [0, 1, 2] and table.versions() == [3, 4]
    assert [table.read(v).count() for v in (3, 4)] == [4, 5]
    with pytest.raises(Exception):
        old.collect()
    table.upsert(frame(spark, [("a", DAY, 9, 9)]), "at")
    assert table.read().count() == 5 and table.version() == 5


def test_columns_may_be_added(spark):
    table = table_of(spark)
    table.upsert(frame(spark, [("a", DAY, 1, 1), ("b", DAY, 1, 1)]), "at")
    table.upsert(frame(spark, [("b", DAY, 2, "x"), ("c", DAY, 2, "y")], "id string, day date, at int, note string"), "at")
    got = {r["id"]: (r["v"], r["note"]) for r in table.read().collect()}
    assert got == {"a": (1, None), "b": (1, "x"), "c": (None, "y")}
    table.upsert(frame(spark, [("a", DAY, 3, 7)]), "at")
    assert {r["id"]: (r["v"], r["note"]) for r in table.read().collect()}["a"] == (7, None)
    with pytest.raises((TypeError, AnalysisException)):
        table.upsert(frame(spark, [("a", DAY, 4, "7")], "id string, day date, at int, v string"), "at")


def test_whole_keys_and_no_partition(spark):
    table = table_of(spark, by=None)
    table.upsert(frame(spark, [("a", DAY, 1, 1), ("a", DAY, 1, 1), ("a", DAY, 1, 2), ("b", DAY, 1, 3)]), "at", whole_keys=True)
    assert table.read().count() == 4
    table.upsert(frame(spark, [("a", DAY, 2, 5), ("a", DAY, 2, 5)]), "at", whole_keys=True)
    assert sorted(r["v"] for r in table.read().collect()) == [3, 5, 5]


def test_nothing_to_merge(spark):
    table = table_of(spark)
    assert table.read().count() == 0 and table.read().columns == ["id", "day", "at", "v"]
    table.upsert(frame(spark, []), "at")
    table.upsert(frame(spark, [("a", DAY, 1, 1)]), "at")
    table.upsert(frame(spark, []), "at")
    assert table.read().count() == 1
    again = indexed.create(spark, table.path, table.read().schema, ["v"])
    assert again.options(again.record(0)).keys == ("id",)


def test_put_if_absent(spark, tmp_path):
    path = f"{tmp_path}/record.json"
    assert paths.put_if_absent(spark, path, "first é") and not paths.put_if_absent(spark, path, "second")
    assert paths.read_text(spark, path) == "first é" and paths.children(spark, str(tmp_path)) == ["record.json"]
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: paths.put_if_absent(spark, f"{path}.2", str(i)), range(16)))
    assert sum(won) == 1 and paths.read_text(spark, f"{path}.2") == str(won.index(True))
