"""Token ids as range-coded blocks: a static asymmetric numeral system over shared frequencies.

Ids are written in ascending key order. A block holds whole documents and is coded on its own:
`LANES` states take turns, so a step codes `LANES` ids as one vector. After every `STEPS` steps
the states and the place in the stream are noted, and decoding starts at all those checkpoints
at once. Each block carries a CRC of its ids. Blocks are rows of a Parquet table, so that
Spark's committer makes the output atomic on any file system; payloads are stored uncompressed.

Block row: `start` (ids of all documents before the block), `n_tokens`, `doc_ids`, `lengths`,
`crc` (of the ids as little-endian 32-bit numbers) and `payload`:
checkpoint states (uint64, segment by segment), stream places (uint32 per segment), words (uint32).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.llm.tokens import word_memory
from tripledger.sources.scratch import fresh_path

LANES = 1024
STEPS = 64
#: Frequencies add up to 2 ** BITS, or to more when the vocabulary needs it.
BITS = 18
#: A block is closed by the document that brings it to this many ids.
BLOCK_IDS = 4 * LANES * STEPS
_LOW = np.uint64(1 << 31)
_32 = np.uint64(32)

BLOCK_SCHEMA = ("start long, n_tokens long, doc_ids array<long>, lengths array<long>, "
                "crc long, payload binary")


class Frequencies:
    """Shared static model: id -> frequency; ids that never occur have none."""

    def __init__(self, ids, counts):
        order = np.argsort(np.asarray(ids, np.int64))
        self.ids = np.asarray(ids, np.int64)[order]
        counts = np.asarray(counts, object)[order]
        self.bits = max(BITS, int(2 * max(1, len(order)) - 1).bit_length())
        spare, total = (1 << self.bits) - len(order), int(sum(counts)) or 1
        freq = np.array([1 + int(c) * spare // total for c in counts], np.int64)
        if len(freq):
            freq[np.argmax(freq)] += (1 << self.bits) - freq.sum()
        self.freq = freq.astype(np.uint64)
        self.cum = (np.cumsum(freq) - freq).astype(np.uint64)

    def ranks(self, ids: np.ndarray) -> np.ndarray:
        table = np.zeros(int(self.ids[-1]) + 1, np.int64)
        table[self.ids] = np.arange(len(self.ids))
        return table[ids]

    def slots(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ids)), self.freq.astype(np.int64))


def encode_block(model: Frequencies, ids: np.ndarray) -> bytes:
    """Code ids back to front, so that decoding runs forward."""
    n_steps = max(1, -(-len(ids) // LANES))
    sym = np.full(n_steps * LANES, int(np.argmax(model.freq)), np.int64)
    sym[: len(ids)] = model.ranks(ids)
    sym = sym.reshape(n_steps, LANES)
    bits, shift = np.uint64(model.bits), np.uint64(63 - model.bits)
    x = np.full(LANES, _LOW)
    words = np.empty((n_steps, LANES), np.uint32)
    full = np.empty((n_steps, LANES), bool)
    states = np.empty((-(-n_steps // STEPS), LANES), np.uint64)
    for s in range(n_steps - 1, -1, -1):
        f = model.freq[sym[s]]
        over = x >= f << shift
        words[s], full[s] = x.astype(np.uint32), over
        x = np.where(over, x >> _32, x)
        q = x // f
        x = (q << bits) + (x - q * f) + model.cum[sym[s]]
        if s % STEPS == 0:
            states[s // STEPS] = x
    per = np.add.reduceat(full.sum(axis=1), np.arange(0, n_steps, STEPS))
    places = (np.cumsum(per) - per).astype("<u4")
    return states.astype("<u8").tobytes() + places.tobytes() + words[full].astype("<u4").tobytes()


def decode_block(model: Frequencies, slots: np.ndarray, payload: bytes, n: int) -> np.ndarray:
    """All segments between checkpoints side by side."""
    n_steps = max(1, -(-n // LANES))
    segments = -(-n_steps // STEPS)
    x = np.frombuffer(payload, "<u8", segments * LANES).reshape(segments, LANES)
    at = segments * LANES * 8
    place = np.frombuffer(payload, "<u4", segments, at).astype(np.int64)
    words = np.append(np.frombuffer(payload, "<u4", offset=at + 4 * segments), 0).astype(np.uint64)
    out = np.zeros((segments, STEPS, LANES), np.int64)
    bits, low = np.uint64(model.bits), np.uint64((1 << model.bits) - 1)
    last = n_steps - (segments - 1) * STEPS  # steps of the last segment
    for s in range(STEPS):
        if s == last:
            x, place = x[:-1], place[:-1]
        if not len(x):
            break
        slot = x & low
        sym = slots[slot.astype(np.int64)]
        out[: len(x), s] = sym
        x = model.freq[sym] * (x >> bits) + slot - model.cum[sym]
        need = x < _LOW
        upto = np.cumsum(need, axis=1)
        taken = words[np.minimum(place[:, None] + upto - 1, len(words) - 1)]
        x = np.where(need, (x << _32) | taken, x)
        place = place + upto[:, -1]
    return model.ids[out.reshape(-1)[:n]]


def _tokenized(vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, start = TaskContext.get().partitionId(), 0
        memory = word_memory(vocabulary)
        end = np.array([end_id], memory.dtype).tobytes()
        tally = np.zeros(0, np.int64)
        names = ["part", "at", "key", "n_tokens", "ids", "tally"]
        for batch in batches:
            ids = [x + end for x in memory.encode([t or "" for t in batch.column("text").to_pylist()])]
            lengths = np.array([len(x) // memory.dtype.itemsize for x in ids], np.int64)
            starts = start + np.cumsum(lengths) - lengths
            start += int(lengths.sum())
            got = np.bincount(np.frombuffer(b"".join(ids), memory.dtype), minlength=len(tally))
            got[: len(tally)] += tally
            tally = got
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), part, np.int32)), pa.array(starts), batch.column("key"),
                 pa.array(lengths), pa.array(ids, pa.binary()), pa.nulls(len(ids), pa.binary())], names=names)
        # A last row, without a document, has the counts of the whole task.
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1], pa.int32()), *[pa.nulls(1, pa.int64())] * 3, pa.nulls(1, pa.binary()),
             pa.array([tally.tobytes()], pa.binary())], names=names)

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for tally in batch.column("tally").to_pylist():
            one = np.frombuffer(tally, np.int64)
            if len(one) > len(total):
                one, total = total, one.copy()
            total[: len(one)] += one
    ids = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "n"])


def _blocks(model: Frequencies, dtype: np.dtype, offsets: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_memory.cache_clear()  # of the stage before, if this worker served it
        held: list[tuple] = []  # documents of the open block, next to each other
        size, following = 0, None

        def close():
            ids = np.frombuffer(b"".join(h[3] for h in held), dtype)
            row = [[held[0][0]], [len(ids)], [[h[1] for h in held]], [[h[2] for h in held]],
                   [zlib.crc32(ids.astype("<u4"))], [encode_block(model, ids)]]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                     pa.int64(), pa.binary()]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds)],
                names=["start", "n_tokens", "doc_ids", "lengths", "crc", "payload"])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("part", "at", "key", "n_tokens", "ids")]
            for part, at, key, n, ids in zip(*cols):
                start = offsets[part] + at
                if held and start != following:
                    yield close()
                    size = 0
                held.append((start, key, n, ids))
                size, following = size + n, start + n
                if size >= BLOCK_IDS:
                    yield close()
                    size = 0
        if held:
            yield close()

    return run


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2,
                 key: str = "doc_id", text: str = "text") -> None:
    """Tokenize `docs`, append `end_id` to each, and write blocks and model under `path`.

    Null and empty texts give the end id alone. Keys are whole numbers; null keys come first,
    rows with one key are ordered by a hash of their text, and repeated rows are all written.
    An empty input gives an empty table. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = fresh_path(spark, "tokens")
    schema = "part int, at long, key long, n_tokens long, ids binary, tally binary"
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"),
                       F.xxhash64(text).alias("tie"), F.monotonically_increasing_id().alias("n"))
    (
        rows.repartitionByRange("key", "tie", "n").sortWithinPartitions("key", "tie", "n")
        .select("key", "text")
        .mapInArrow(_tokenized(vocabulary, end_id), schema).write.parquet(scratch)
    )
    dtype = word_memory(vocabulary).dtype
    written = spark.read.schema(schema).parquet(scratch)
    done = written.where("part >= 0").drop("tally")
    totals = done.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()  # one row per partition
    totals = sorted((r["part"], r["n"]) for r in totals)
    offsets = dict(zip([p for p, _ in totals], [0, *accumulate(n for _, n in totals)]))
    counts = (  # one row per id of the vocabulary
        written.select("tally").where("tally IS NOT NULL").mapInArrow(_counted, "id long, n long")
        .groupBy("id").agg(F.sum("n").alias("n")).collect()
    )
    model = Frequencies([r["id"] for r in counts], [r["n"] for r in counts])
    table = list(zip(model.ids.tolist(), model.freq.astype(np.int64).tolist()))
    spark.createDataFrame(table, "id long, freq long").coalesce(1).write.parquet(f"{path}/model")
    (
        done.mapInArrow(_blocks(model, dtype, offsets), BLOCK_SCHEMA)
        .write.option("compression", "none").parquet(f"{path}/blocks")
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: `doc_id`, `start`, `n_tokens`, `ids` (little-endian uint32).

    A block whose CRC does not match its ids is an error.
    """
    table = sorted((r["id"], r["freq"])  # one row per id of the vocabulary
                   for r in spark.read.schema("id long, freq long").parquet(f"{path}/model").collect())
    model = Frequencies([], [])
    model.ids = np.array([i for i, _ in table], np.int64)
    freq = np.array([f for _, f in table], np.int64)
    model.bits = int(freq.sum()).bit_length() - 1 if len(freq) else BITS
    model.freq, model.cum = freq.astype(np.uint64), (np.cumsum(freq) - freq).astype(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = model.slots()
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_block(model, slots, row["payload"], row["n_tokens"]).astype("<u4")
                if zlib.crc32(ids) != row["crc"]:
                    raise ValueError(f"block at id {row['start']} is damaged")
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                raw = ids.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + ends - lengths),
                     pa.array(lengths),
                     pa.array([raw[4 * (e - n):4 * e] for e, n in zip(ends, lengths)], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])

    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
