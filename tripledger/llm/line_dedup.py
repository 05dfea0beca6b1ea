"""Repeated runs of lines: content-defined chunks, compared byte by byte.

Each line has a hash, and each pair of neighbouring lines a rolling hash. A chunk ends after a
line whose rolling hash is a local minimum, so boundaries depend on four lines around them and
come back after any insertion, and every chunk has two lines at least. Chunk hashes are counted
over all documents in narrow rows; only chunks whose hash occurs again have their text looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.llm.common import packed
from tripledger.sources.scratch import materialize

#: A chunk is looked at if this many of its lines hold a word.
MIN_LINES = 2


def _ends() -> Column:
    """The last line of each chunk of `lines` with rolling hashes `rolling`."""
    n = F.size("lines")

    def ends_after(i: Column) -> Column:
        here = F.get("rolling", i)
        return ((i == 1) | (here < F.get("rolling", i - 1))) & (here <= F.get("rolling", i + 1))

    inner = F.when(n >= 4, F.filter(F.sequence(F.lit(1), n - 3), ends_after)).otherwise(
        F.array().cast("array<int>"))
    return F.concat(inner, F.array(n - 1))


def _spans() -> Column:
    """(first line, last line) of each chunk from the column `ends`."""
    return F.transform("ends", lambda e, k: F.struct(
        F.when(k == 0, F.lit(0)).otherwise(F.get("ends", k - 1) + 1).alias("first"), e.alias("last")))


def _whole(docs: DataFrame, key: str, text: str) -> DataFrame:
    return packed(docs, key=F.col(key), body=F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")))


def _lines(text: str) -> Column:
    """The lines of `row`'s text."""
    return F.split(F.coalesce(F.col(f"row.`{text}`").cast("string"), F.lit("")), "\n")


def _occurrences(docs: DataFrame, key: str, text: str) -> DataFrame:
    hashed = _whole(docs, key, text).withColumn("lines", _lines(text)).select(
        "key", "body", "lines", F.transform("lines", lambda x: F.md5(x.cast("binary"))).alias("hs"))
    rolled = hashed.withColumn("rolling", F.transform(
        "hs", lambda h, i: F.when(i > 0, F.md5(F.concat(F.get("hs", i - 1), h).cast("binary")))))
    # explode() would imply a filter that Spark moves under the projections, where it computes
    # the hashes anew for every element.
    cut = rolled.withColumn("ends", _ends()).withColumn("chunk", F.explode_outer(_spans())).select(
        "key", "body", "chunk.first", "chunk.last",
        F.slice("lines", F.col("chunk.first") + 1, F.col("chunk.last") - F.col("chunk.first") + 1).alias("of"),
        F.slice("hs", F.col("chunk.first") + 1, F.col("chunk.last") - F.col("chunk.first") + 1).alias("hs"))
    many = F.col("last") > F.col("first")
    worded = F.size(F.filter("of", lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    return cut.where(many & (worded >= MIN_LINES)).select(
        "key", "body", "first", "last", F.md5(F.array_join("hs", "").cast("binary")).alias("hash"))


def _same_document(a: DataFrame, b: DataFrame) -> Column:
    return a["key"].eqNullSafe(b["key"]) & (a["body"] == b["body"])


def _to_remove(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, body, first, last) of each chunk that repeats an earlier one byte for byte."""
    place = F.struct("key", "body", "first")
    seen = materialize(_occurrences(docs, key, text), "chunks")
    again = (
        seen.groupBy("hash").agg(F.min(place).alias("a"), F.max(place).alias("z")).where("a <> z").select("hash")
    )
    found = materialize(seen.join(again, "hash"), "repeated")
    wanted = materialize(
        found.groupBy("key", "body").agg(F.collect_set(F.struct("first", "last", "hash")).alias("chunks")), "wanted")
    # The texts are shuffled as they are and cut into lines afterwards. The hint keeps the plan,
    # and so its cost per byte, the same however few chunks repeat.
    whole = _whole(docs, key, text)
    texts = (
        whole.join(wanted.hint("merge"), _same_document(whole, wanted))
        .select(whole["key"], whole["body"], "row", "chunks").withColumn("lines", _lines(text))
        .select("key", "body", "lines", F.explode("chunks").alias("c"))
        .select("key", "body", "c.first", "c.last", "c.hash", F.array_join(
            F.slice("lines", F.col("c.first") + 1, F.col("c.last") - F.col("c.first") + 1), "\n").alias("of"))
    )
    # Grouping by the bytes themselves; copies fold to one row per map task.
    groups = materialize(
        texts.groupBy("hash", "of").agg(F.min(place).alias("keep"), F.max(place).alias("z")), "groups")
    per_hash = groups.groupBy("hash").agg(F.count("*").alias("n"), F.min("keep").alias("keep"))
    removed = found.join(per_hash.where("n = 1"), "hash").where(place != F.col("keep"))
    out = removed.select("key", "body", "first", "last")
    clashing = materialize(per_hash.where("n > 1").select("hash"), "clashes")
    if not clashing.isEmpty():  # one hash, different bytes: by the bytes again
        apart = groups.join(clashing, "hash", "left_semi")
        out = out.unionByName(
            texts.join(apart.select("hash", "of", "keep"), ["hash", "of"]).where(place != F.col("keep"))
            .select("key", "body", "first", "last"))
    return materialize(
        out.groupBy("key", "body").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("spans")), "removed")


def remove_repeated_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`row`, `text` without its repeated chunks, and `spans` (first and last line removed, from 0).

    The first of equal chunks stays: that of the smallest key, then of the smallest MD5 of the
    text, then the earliest in it. A chunk is at least two lines with words; texts of one line,
    and empty texts, stay as they are, and null texts stay null. A text may lose all its lines
    and is then empty; its row stays. Null keys are smallest. Rows equal in key and text are one
    document and lose the same chunks. An empty input gives no row.
    """
    spans = _to_remove(docs, key, text)
    whole = _whole(docs, key, text)
    lost = F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["last"])))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), lost)
    cleaned = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    joined = whole.join(spans.hint("merge"), _same_document(whole, spans), "left")
    return joined.select("row", "spans").withColumn("lines", _lines(text)).select(
        "row", F.when(F.col("spans").isNull(), F.col(f"row.`{text}`")).otherwise(cleaned).alias("text"),
        F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)).alias("spans"))
