"""SimHash near-duplicates over a Gray-ordered hierarchical index.

Texts with one fingerprint are one class. Two classes that differ in at most `distance` bits
agree on some `KEEP` of `CUTS` bit ranges (at least `CUTS - distance` ranges are untouched), so
for each choice of ranges the fingerprints are permuted to carry those ranges first. Sorted by
Gray rank, fingerprints that share these leading bits stand together: they are one upper node.
Inside a node, runs of `LEAF` neighbours in Gray order form leaves, each with the mask and value
of the bits that all its members share, and runs of leaves form middle nodes in the same way. A
search adds up differences from the top and leaves out a whole pair of groups as soon as their
shared bits differ too often. Only pairs of leaves that pass are compared code by code.

A node above `BLOCK` fingerprints is cut into blocks by a hash, and every pair of blocks is one
unit of work, so no task holds a large node. A unit emits a spanning forest of its links
(at most one link per fingerprint), never all pairs; the forests join into the same components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripledger.llm.common import packed
from tripledger.llm.components import components
from tripledger.sources.scratch import fresh_path, materialize

CUTS, KEEP = 6, 2
LEAF, FAN = 16, 16
BLOCK = 2048
#: Nodes up to this size are compared without an index below them.
SMALL = 64


def fingerprint(text: str | None, shingle: int) -> int:
    """Majority bits of the XXH64 values (seed 42) of all word shingles, repeats included."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # A-Z; ASCII space
    if not words:
        return 0
    if len(words) < shingle:
        hashes = [xxh64_intdigest(b" ".join(words), 42)]
    else:
        grams = zip(*[words[i:] for i in range(shingle)])
        hashes = [xxh64_intdigest(b" ".join(g), 42) for g in grams]
    ones = np.zeros(64, np.int64)
    step = 1 << 14
    for at in range(0, len(hashes), step):
        raw = np.array(hashes[at:at + step], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _ranges() -> list[tuple[int, int]]:
    edges = [64 * i // CUTS for i in range(CUTS + 1)]
    return list(zip(edges, edges[1:]))


def _permuted(fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each choice of ranges: the chosen bits, and the fingerprint with them in front."""
    ranges = _ranges()
    for chosen in combinations(range(CUTS), KEEP):
        rest = [i for i in range(CUTS) if i not in chosen]
        key = np.zeros_like(fp)
        for i in chosen:
            lo, hi = ranges[i]
            key = (key << np.uint64(hi - lo)) | ((fp >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1))
        code = key
        for i in rest:
            lo, hi = ranges[i]
            code = (code << np.uint64(hi - lo)) | ((fp >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1))
        yield key, code


def gray_rank(code: np.ndarray) -> np.ndarray:
    """The place of each code in the Gray sequence (the inverse of n ^ n >> 1)."""
    code = code.copy()
    for s in (1, 2, 4, 8, 16, 32):
        code ^= code >> np.uint64(s)
    return code


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column("fp").to_numpy().view(np.uint64)
        for i, (key, code) in enumerate(_permuted(fp)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(((np.int64(i) << np.int64(32)) | key.view(np.int64))),
                 pa.array(gray_rank(code).view(np.int64)), batch.column("fp")],
                names=["node", "rank", "fp"])


def _groups(fp: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Mask and value of the bits shared by each run of `size` neighbours."""
    starts = np.arange(0, len(fp), size)
    every, some = np.bitwise_and.reduceat(fp, starts), np.bitwise_or.reduceat(fp, starts)
    return ~(every ^ some), every


def _near(mask_a, value_a, mask_b, value_b, distance: int):
    """Pairs of groups whose shared bits differ at most `distance` times."""
    return np.bitwise_count((value_a ^ value_b) & mask_a & mask_b) <= distance


def near_pairs(a: np.ndarray, b: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) with at most `distance` differing bits; `a` and `b` in Gray order."""
    if len(a) * len(b) <= SMALL * SMALL:
        return np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= distance)
    (ma, va), (mb, vb) = _groups(a, LEAF), _groups(b, LEAF)
    starts_a, starts_b = np.arange(0, len(ma), FAN), np.arange(0, len(mb), FAN)
    upper_a = (np.bitwise_and.reduceat(ma, starts_a), va[starts_a])
    upper_b = (np.bitwise_and.reduceat(mb, starts_b), vb[starts_b])
    # A bit is shared by a middle node if all its leaves share it with one value.
    for m, v, starts, masks, values in ((upper_a[0], upper_a[1], starts_a, ma, va),
                                        (upper_b[0], upper_b[1], starts_b, mb, vb)):
        m &= ~(np.bitwise_and.reduceat(values, starts) ^ np.bitwise_or.reduceat(values, starts))
    left, right = [], []
    for p, q in zip(*np.nonzero(_near(upper_a[0][:, None], upper_a[1][:, None],
                                      upper_b[0][None, :], upper_b[1][None, :], distance))):
        la, lb = slice(p * FAN, (p + 1) * FAN), slice(q * FAN, (q + 1) * FAN)
        for i, j in zip(*np.nonzero(_near(ma[la, None], va[la, None], mb[None, lb], vb[None, lb],
                                          distance))):
            at_a, at_b = (p * FAN + i) * LEAF, (q * FAN + j) * LEAF
            x, y = np.nonzero(np.bitwise_count(
                a[at_a:at_a + LEAF, None] ^ b[None, at_b:at_b + LEAF]) <= distance)
            left.append(x + at_a)
            right.append(y + at_b)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _forest(codes: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[list, list]:
    """Links that span the same components: each code with the root it ends under."""
    root = np.arange(len(codes))
    while True:
        least = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(codes)))
    return codes[moved].tolist(), codes[root[moved]].tolist()


def _searched(distance: int):
    """Rows of one unit (node, block pair) stand together, in Gray order within either side."""

    def unit(fp: np.ndarray, side: np.ndarray) -> tuple[list, list]:
        a, b = fp[side == 0], fp[side == 1]
        if not len(b):
            i, j = near_pairs(a, a, distance)
            up = i < j
            return _forest(a, i[up], j[up])
        i, j = near_pairs(a, b, distance)
        return _forest(np.concatenate([a, b]), i, j + len(a))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush(node, pair, fp, side):
            out_a: list = []
            out_b: list = []
            new = np.flatnonzero((node[1:] != node[:-1]) | (pair[1:] != pair[:-1])) + 1
            starts, ends = np.append(0, new), np.append(new, len(node))
            for s, e in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
                if e - s == 2:  # the usual node; no index needed
                    if int(fp[s] ^ fp[s + 1]).bit_count() <= distance:
                        out_a.append(int(fp[s]))
                        out_b.append(int(fp[s + 1]))
                    continue
                x, y = unit(fp[s:e], side[s:e])
                out_a += x
                out_b += y
            a, b = np.array(out_a, np.uint64).view(np.int64), np.array(out_b, np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in ("node", "pair", "fp", "side")]
            cols[2] = cols[2].view(np.uint64)
            if held:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
            if not len(cols[0]):
                continue
            # The last unit may go on in the next batch; a unit has at most 2 * BLOCK rows or so.
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield flush(*[c[:cut] for c in cols])
            held = [c[cut:] for c in cols]
        if held and len(held[0]):
            yield flush(*held)

    return run


def links(fingerprints: DataFrame, distance: int) -> DataFrame:
    """A spanning set of links (`a`, `b`) between distinct `fp` values (long) within `distance`.

    Complete for distances up to `CUTS - KEEP`.
    """
    if distance > CUTS - KEEP:
        raise ValueError(f"at most {CUTS - KEEP} bits")
    spark = fingerprints.sparkSession
    path = fresh_path(spark, "nodes")
    fingerprints.select("fp").mapInArrow(_keyed, "node long, rank long, fp long").write.parquet(path)
    keyed = spark.read.schema("node long, rank long, fp long").parquet(path)
    sizes = keyed.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
    # Nodes of one fingerprint have no pair; larger ones say into how many blocks they are cut.
    sized = keyed.join(sizes.select("node", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "node")
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    units = (
        sized.withColumn("block", block).withColumn("other", F.explode(others))
        .select("node", "rank", "fp",
                (F.least("block", "other").cast("long") * F.lit(1 << 31) + F.greatest("block", "other")).alias("pair"),
                (F.col("block") > F.col("other")).cast("int").alias("side"))
    )
    # Within a block's own unit all rows are on side 0.
    return (
        units.repartition("node", "pair").sortWithinPartitions("node", "pair", "side", "rank")
        .select("node", "pair", "fp", "side").mapInArrow(_searched(distance), "a long, b long")
    )


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Each row as struct `row`, with `fp` (long) , `component_id` and `keeper`.

    `component_id` is the smallest key among the rows whose fingerprints are joined by chains of
    links of at most `distance` bits; `keeper` marks exactly one row of each component, one that
    has that key. Texts without words have fingerprint zero and are linked like any other; null
    texts are texts without words. Null keys are smallest. Repeated rows are one class. An empty
    input gives no row.
    """
    spark = docs.sparkSession

    @F.pandas_udf(T.LongType())
    def fp_of(texts: pd.Series) -> pd.Series:
        return pd.Series([_signed(fingerprint(t, shingle)) for t in texts], dtype="int64")

    rows = materialize(
        packed(docs, key=F.col(key), fp=fp_of(F.col(text).cast("string")),
               n=F.monotonically_increasing_id()), "fingerprints")
    classes = materialize(
        rows.groupBy("fp").agg(F.min(F.struct("key", "n")).alias("first"), F.count("*").alias("n")), "classes")
    found = materialize(components(links(classes, distance)), "components")
    least = (
        found.join(classes.select(F.col("fp").alias("node"), "first"), "node")
        .groupBy("root").agg(F.min("first").alias("first"))
    )
    moved = found.join(least, "root").select(F.col("node").alias("fp"), F.col("first").alias("least"))
    firsts = (
        classes.join(moved, "fp", "left")
        .select("fp", F.coalesce("least", "first").alias("least"), (F.col("n") > 1).alias("shared"))
    )
    # Only classes of several rows or with links need a lookup; all other rows lead themselves.
    special = materialize(
        firsts.join(found.select(F.col("node").alias("fp")), "fp", "left_semi")
        .unionByName(firsts.join(found.select(F.col("node").alias("fp")), "fp", "left_anti").where("shared"))
        .select("fp", "least"), "special")
    return rows.join(special, "fp", "left").select(
        "row", "fp", F.when(F.col("least").isNull(), F.col("key")).otherwise(F.col("least.key")).alias("component_id"),
        F.when(F.col("least").isNull(), F.lit(True)).otherwise(F.col("least.n") == F.col("n")).alias("keeper"))
