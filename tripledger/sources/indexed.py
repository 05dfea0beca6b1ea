"""Keyed Parquet tables with a key filter per file and a log of snapshots.

Layout under the table's path:

- `data/<commit>/_part=…/_bucket=…/` data files, never changed. Rows lie in hash buckets of their
  key, within values of the partition column.
- `index/<commit>/` per file and slot (a bucket consists of slots) the sorted fingerprints of the
  file's keys. Like a Bloom filter, it can err only by naming a file that has no such key.
- `manifest/<commit>/` the live files of a version.
- `log/<version>.json` one small record per version, put in place only if it is absent.

An upsert probes the filters with the fingerprints of its keys, opens the key columns of the files
they name, and rewrites the files that do hold a key. Nothing is visible before the log record is;
a run that stops earlier leaves files no version names. A writer that finds its number taken looks
at what was committed meanwhile: if that touched neither its files nor its keys, it puts its change
on top, else it computes the change again. So no update is lost and none applied twice.

Readers name a version and see its files, whatever is committed meanwhile. `expire` removes old
versions: those beyond the newest `keep` and older than `min_age`, then every file that no version
left names and that is older than `min_age`, which must exceed the longest write or read.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripledger.operators.upsert import asked_keys, dedupe_latest, same_key
from tripledger.sources import paths
from tripledger.sources.scratch import materialize

#: Incoming fingerprints tested together; a slot with more is tested in pieces.
PROBED = 100_000
ROWS_PER_FILE = 1_000_000

_INDEX = "file string, slot int, prints array<long>"


@dataclass(frozen=True)
class Options:
    """Fixed when the table is made. Choose `buckets` so that a bucket of a partition value is a
    file of sensible size, and `slots` (a multiple of it) for some thousand keys each in a file."""

    keys: tuple[str, ...]
    partition_by: str | None = None
    buckets: int = 16
    slots: int = 256
    print_bits: int = 48


@dataclass(frozen=True)
class Change:
    """A computed upsert that is not committed yet; `opened` names the files whose keys it read."""

    commit: str
    base: int
    fresh: DataFrame
    order_by: tuple[str, ...]
    schema: T.StructType
    removed: tuple[str, ...]
    opened: tuple[str, ...]


def exists(spark: SparkSession, path: str) -> bool:
    return paths.exists(spark, f"{path}/log")


def create(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
           partition_by: str | None = None, **options) -> IndexedTable:
    """Makes an empty table, or opens the one that somebody else made first."""
    table = IndexedTable(spark, path)
    record = {"version": 0, "commit": None, "schema": schema.jsonValue(), "time": time.time(),
              "options": vars(Options(tuple(keys), partition_by, **options))}
    paths.put_if_absent(spark, table._log(0), json.dumps(record))
    return table


class IndexedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ------------------------------------------------------------ reading

    def versions(self) -> list[int]:
        names = paths.children(self.spark, f"{self.path}/log")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def version(self) -> int:
        return self.versions()[-1]

    def record(self, version: int) -> dict:
        return json.loads(paths.read_text(self.spark, self._log(version)))

    def options(self, record: dict) -> Options:
        return Options(**{**record["options"], "keys": tuple(record["options"]["keys"])})

    def read(self, version: int | None = None, between: tuple | None = None) -> DataFrame:
        """The rows of a version (the newest, if none is named).

        `between` gives a closed range of the partition column: other files are not opened.
        """
        record = self.record(self.version() if version is None else version)
        schema = T.StructType.fromJson(record["schema"])
        files = self.files(record)
        if between is not None:
            files = files.filter((F.col("high") >= F.lit(between[0])) & (F.col("low") <= F.lit(between[1])))
        rows = self._rows([r["file"] for r in files.select("file").collect()], schema)
        if between is not None:
            rows = rows.filter(F.col(self.options(record).partition_by).between(*between))
        return rows

    def files(self, record: dict) -> DataFrame:
        """Live files of a version: `file`, `commit`, `rows`, and the range of the partition column."""
        schema = T.StructType.fromJson(record["schema"])
        by = self.options(record).partition_by
        kind = schema[by].dataType if by else T.StringType()
        fields = T.StructType().add("file", "string").add("commit", "string").add("rows", "long")
        fields = fields.add("low", kind).add("high", kind)
        if record["commit"] is None:
            return self.spark.createDataFrame([], fields)
        return self.spark.read.schema(fields).parquet(f"{self.path}/manifest/{record['manifest']}")

    # ------------------------------------------------------------ writing

    def upsert(self, incoming: DataFrame, order_by: str | Sequence[str], whole_keys: bool = False) -> int:
        """Merges `incoming`; returns the version that has it.

        One row per key, the newest of `incoming` by `order_by` wins; a null key is a key. With
        `whole_keys` all incoming rows of a key together replace all stored rows of it. Columns
        that only the table has keep what they hold; columns that only `incoming` has are added.
        """
        return self.commit(self.prepare(incoming, order_by, whole_keys))

    def prepare(self, incoming: DataFrame, order_by: str | Sequence[str], whole_keys: bool = False) -> Change:
        """Computes an upsert against the newest version and writes its files, which nobody sees yet."""
        order = (order_by,) if isinstance(order_by, str) else tuple(order_by)
        keys = list(self.options(self.record(self.version())).keys)
        fresh = incoming if whole_keys else dedupe_latest(incoming, keys, order)
        return self._compute(materialize(fresh, "upsert-incoming"), order)

    def commit(self, change: Change) -> int:
        """Makes a change visible on top of whatever has been committed since it was computed."""
        while True:
            head = self.version()
            if head != change.base and self._clashes(change, head):
                change = self._compute(change.fresh, change.order_by)
                continue
            record = self.record(head)
            added = self.spark.read.parquet(f"{self.path}/added/{change.commit}")
            gone = self.spark.createDataFrame([(f,) for f in change.removed], "file string")
            live = self.files(record).join(gone, "file", "left_anti").unionByName(added)
            manifest = f"{change.commit}-{head + 1}"
            live.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/{manifest}")
            schema = _merged(T.StructType.fromJson(record["schema"]), change.schema)
            record = {**record, "version": head + 1, "commit": change.commit, "manifest": manifest,
                      "schema": schema.jsonValue(), "time": time.time()}
            if paths.put_if_absent(self.spark, self._log(head + 1), json.dumps(record)):
                return head + 1

    def expire(self, keep: int, min_age: timedelta) -> list[int]:
        """Removes old versions and files without a version; returns the versions removed."""
        spark, before = self.spark, time.time() - min_age.total_seconds()
        records = {v: self.record(v) for v in self.versions()}
        newest = sorted(records)[-max(keep, 1):]
        old = [v for v, r in records.items() if v not in newest and r["time"] < before]
        kept = [r for v, r in records.items() if v not in old and r["commit"]]
        for v in old:
            paths.drop(spark, self._log(v))
        live, commits = set(), set()
        for r in kept:
            for row in self.files(r).select("file", "commit").collect():
                live.add(row["file"])
                commits.add(row["commit"])
        manifests = {r["manifest"] for r in kept}
        for v in old:
            if records[v]["commit"]:
                for row in self.files(records[v]).select("file").collect():
                    if row["file"] not in live:
                        paths.drop(spark, f"{self.path}/data/{row['file']}")
        for folder, used in (("manifest", manifests), ("data", commits), ("index", commits), ("added", commits)):
            for name in paths.older(spark, f"{self.path}/{folder}", before):
                if name not in used:
                    paths.drop(spark, f"{self.path}/{folder}/{name}")
        return old

    # ------------------------------------------------------------ parts

    def _log(self, version: int) -> str:
        return f"{self.path}/log/{version:012d}.json"

    def _rows(self, files: Sequence[str], schema: T.StructType) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{f}" for f in files])

    def _named(self, df: DataFrame, options: Options) -> DataFrame:
        """Adds the key's `slot` and `print`."""
        keys = [F.col(f"`{k}`") for k in options.keys]
        mixed = F.xxhash64(F.lit("print"), *[F.struct(k.isNull(), k) for k in keys])
        return df.withColumns({
            "slot": F.pmod(F.xxhash64(*keys), F.lit(options.slots)).cast("int"),
            "print": F.shiftrightunsigned(mixed, 64 - options.print_bits),
        })

    def _probe(self, fresh: DataFrame, options: Options) -> DataFrame:
        """Incoming fingerprints by slot, at most some `PROBED` in a row."""
        pieces = 1 + fresh.count() // (options.slots * PROBED)
        prints = self._named(fresh.select(*options.keys), options).select("slot", "print")
        piece = F.pmod(F.col("print"), F.lit(pieces))
        return prints.groupBy("slot", piece.alias("piece")).agg(F.collect_set("print").alias("asked"))

    def _candidates(self, live: DataFrame, probe: DataFrame) -> list[str]:
        """Files among `live` that may hold a probed key. Names only come to the driver."""
        commits = [r[0] for r in live.select("commit").distinct().collect()]
        if not commits:
            return []
        index = self.spark.read.schema(_INDEX).parquet(*[f"{self.path}/index/{c}" for c in commits])
        index = index.join(live.select("file"), "file", "left_semi")
        hit = index.join(probe, "slot").where(F.arrays_overlap("prints", "asked"))
        return [r[0] for r in hit.select("file").distinct().collect()]

    def _compute(self, fresh: DataFrame, order: tuple[str, ...]) -> Change:
        head = self.version()
        record = self.record(head)
        options, schema = self.options(record), T.StructType.fromJson(record["schema"])
        keys = list(options.keys)
        live = self.files(record)
        asked = asked_keys(fresh, keys)
        opened = self._candidates(live, self._probe(fresh, options))
        removed, rows = [], fresh
        if opened:
            relative = F.element_at(F.split("_metadata.file_path", "/data/"), -1)
            held = self._rows(opened, schema).select(*keys, relative.alias("_file")).alias("t")
            held = held.join(asked, same_key("t", "f", keys), "left_semi")
            removed = [r[0] for r in held.select("_file").distinct().collect()]
        if removed:
            stored = self._rows(removed, schema)
            rows = self._filled(fresh, stored, keys, order).unionByName(
                stored.alias("t").join(asked, same_key("t", "f", keys), "left_anti"), allowMissingColumns=True)
        rows = _widened(rows, _merged(schema, rows.schema))
        commit = uuid.uuid4().hex
        self._write(rows, commit, options)
        return Change(commit, head, fresh, order, rows.schema, tuple(removed), tuple(opened))

    def _filled(self, fresh: DataFrame, stored: DataFrame, keys: list[str], order: tuple[str, ...]) -> DataFrame:
        """`fresh` with what the table holds in columns that `fresh` has not."""
        more = [c for c in stored.columns if c not in fresh.columns]
        if not more:
            return fresh
        by = [c for c in order if c in stored.columns]
        newest = F.max_by(F.struct(*more), F.struct(*by)) if by else F.first(F.struct(*more))
        old = stored.groupBy(*keys).agg(newest.alias("_stored")).alias("t")
        return fresh.alias("f").join(old, same_key("t", "f", keys), "left").select(
            "f.*", *[F.col(f"t._stored.{c}").alias(c) for c in more])

    def _write(self, rows: DataFrame, commit: str, options: Options) -> None:
        """Data files, then their filters and the list of them, from the files as written."""
        by = options.partition_by
        # The folder only keeps like rows together: the column itself stays in the file.
        part = F.regexp_replace(F.coalesce(F.col(f"`{by}`").cast("string"), F.lit("none")), "[^A-Za-z0-9]", "-") if by else F.lit("all")
        placed = self._named(rows, options).withColumns({
            "_part": part, "_bucket": F.pmod("slot", F.lit(options.buckets))}).drop("slot", "print")
        (
            placed.hint("rebalance", "_part", "_bucket").write.option("maxRecordsPerFile", ROWS_PER_FILE)
            .partitionBy("_part", "_bucket").parquet(f"{self.path}/data/{commit}")
        )
        file = F.element_at(F.split("_metadata.file_path", "/data/"), -1)
        back = self.spark.read.schema(rows.schema).parquet(f"{self.path}/data/{commit}")
        column = F.col(f"`{by}`") if by else F.lit(None).cast("string")
        named = self._named(back.select(*dict.fromkeys([*options.keys, *([by] if by else [])]), file.alias("file")), options)
        index = named.groupBy("file", "slot").agg(
            F.array_sort(F.collect_set("print")).alias("prints"), F.count(F.lit(1)).alias("rows"),
            F.min(column).alias("low"), F.max(column).alias("high"))
        index.write.parquet(f"{self.path}/index/{commit}")
        kept = self.spark.read.schema(index.schema).parquet(f"{self.path}/index/{commit}")
        (
            kept.groupBy("file").agg(F.lit(commit).alias("commit"), F.sum("rows").alias("rows"),
                                     F.min("low").alias("low"), F.max("high").alias("high"))
            .write.parquet(f"{self.path}/added/{commit}")
        )

    def _clashes(self, change: Change, head: int) -> bool:
        """Whether versions after the change's base touched its files or its keys."""
        now, base = self.record(head), self.record(change.base)
        live = self.files(now)
        gone = self.spark.createDataFrame([(f,) for f in change.removed], "file string")
        if gone.join(live, "file", "left_anti").count():
            return True
        later = live.join(self.files(base).select("file"), "file", "left_anti")
        return bool(self._candidates(later, self._probe(change.fresh, self.options(now))))


def _merged(old: T.StructType, new: T.StructType) -> T.StructType:
    """`old` and what `new` adds; a column of another type is an error."""
    known = {f.name: f.dataType for f in old}
    for f in new:
        if f.name in known and known[f.name] != f.dataType:
            raise TypeError(f"column {f.name} is {known[f.name].simpleString()} in the table, not {f.dataType.simpleString()}")
    both = [*old, *[f for f in new if f.name not in known]]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in both])


def _widened(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.select(*[
        F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
