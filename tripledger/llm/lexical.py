"""Ranked lexical search: the best documents of each item, found in an inverted index of blocks.

A block holds the posting lists of a bounded run of documents, ordered by document. Over each
list lies a range-maximum sparse table of its impacts. An item's search in a block keeps intervals
of documents in a heap, by the sum of the lists' maxima inside them, which no document in the
interval can exceed. The best interval is split at the document of its greatest impact, which is
scored; intervals with few postings are scored whole. The search ends when no interval left can
reach the k-th best score. The blocks' winners are ranked together.

Lists of one term never meet as a whole: they stay cut by block, so a term that every document
holds costs each task only a block's share. Items come in chunks of at most `CHUNK`, so a task
holds a bounded set of them too. Terms are joined by Spark, which measures the written list of
asked terms before it broadcasts it.

Documents: every row is a document, also one with a null or repeated `doc_id` (null ids come last
among equal scores); null and empty texts hold no term. Very long texts form a block of their
own. Items: rows equal in `item_id` and `text` are one item; an item whose terms no document
holds, or without terms, has no rows. Other columns of both inputs are not read and may have any
name. Empty tables give no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from heapq import heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripledger.sources.scratch import materialize

#: A block is closed at so many documents or tokens; one longer document is a block alone.
BLOCK_DOCS = 1 << 15
BLOCK_TOKENS = 4_000_000
#: Items searched together.
CHUNK = 1000
#: An interval with at most so many postings is scored without further splits.
LEAF = 4096

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What a term cannot hold; the characters above U+007F all belong to terms.
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: The same on UTF-8 bytes: letters lowered, everything between terms a space.
_TABLE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).translate(
    bytes.maketrans(_LETTERS.encode(), _LETTERS.lower().encode()))

_POSTINGS = "block long, term binary, docs array<int>, tfs array<int>, lens array<int>, ids array<long>, n_terms long"
_LIST, _IDS = pa.list_(pa.int32()), pa.list_(pa.int64())
_ARROW = pa.schema([("block", pa.int64()), ("term", pa.binary()), ("docs", _LIST), ("tfs", _LIST),
                    ("lens", _LIST), ("ids", _IDS), ("n_terms", pa.int64())])
_HITS = "block long, item long, doc int, score long"


def terms(text: Column) -> Column:
    """The distinct terms of a text."""
    low = F.translate(F.coalesce(text, F.lit("")), _LETTERS, _LETTERS.lower())
    return F.array_distinct(F.regexp_extract_all(low, F.lit(TERM), F.lit(0)))


class _Block:
    """Documents on the way into one block."""

    def __init__(self):
        self.known: dict[bytes, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        self.ids: list[int | None] = []
        self.tokens: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, text: bytes | None) -> None:
        found = (text or b"").translate(_TABLE).split()
        self.ids.append(doc_id)
        self.tokens.append(np.fromiter(map(self.known.__getitem__, found), np.int32, len(found)))
        self.size += len(found)

    def full(self) -> bool:
        return len(self.ids) >= BLOCK_DOCS or self.size >= BLOCK_TOKENS

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        """One row for the documents in ascending id, then one per term with its postings."""
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))
        lens = np.array([len(self.tokens[i]) for i in order], np.int32)
        ids = pa.array([[self.ids[i] for i in order]], _IDS)
        # No term holds a zero byte, so this row joins with none; it is kept for its ids.
        mark = b"\0" + block.to_bytes(8, "big")
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([mark], pa.binary()), pa.nulls(1, _LIST), pa.nulls(1, _LIST),
             pa.array([lens], _LIST), ids, pa.array([int(lens.sum())], pa.int64())], schema=_ARROW)
        if not self.size:
            return
        wide = len(order)
        keys = np.concatenate([self.tokens[i] for i in order]).astype(np.int64) * wide
        keys += np.repeat(np.arange(wide), lens)
        keys, tfs = np.unique(keys, return_counts=True)
        term, doc = keys // wide, (keys % wide).astype(np.int32)
        starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        names = list(self.known)
        names = pa.array([names[t] for t in term[starts]], pa.binary())
        ends = pa.array(np.r_[starts, len(term)], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32()))
                 for x in (doc, tfs.astype(np.int32), lens[doc])]
        n = len(names)
        whole = pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, block)), names, *lists, pa.nulls(n, _IDS), pa.nulls(n, pa.int64())], schema=_ARROW)
        for at in range(0, n, 10_000):
            yield whole.slice(at, 10_000)


def _invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    block = _Block()
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
            block.add(doc_id, text.as_py())
            if block.full():
                yield from block.rows(number)
                number, block = number + 1, _Block()
    if block.ids:
        yield from block.rows(number)


def index(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """Blocks of `docs` with the posting lists of the terms in `asked` (column `term`), written down."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_invert, _POSTINGS)
    flagged = rows.join(asked.select("term", F.lit(True).alias("asked")), "term", "left")
    return materialize(flagged.where("asked OR ids IS NOT NULL").drop("asked"), "postings")


class Lists:
    """The posting lists of one block end to end, with a sparse table of maxima over them."""

    def __init__(self, lists: list[tuple[int, np.ndarray, np.ndarray]]):
        """`lists` holds weight, ascending documents and impacts of each list."""
        sizes = np.array([len(d) for _, d, _ in lists])
        self.start = np.r_[0, np.cumsum(sizes)]
        self.weight = np.array([w for w, _, _ in lists], np.int64)
        self.doc = np.concatenate([d for _, d, _ in lists]).astype(np.int64)
        self.impact = np.concatenate([i for _, _, i in lists]).astype(np.int32)
        self.wide = int(self.doc.max()) + 2
        self.key = self.doc + np.repeat(np.arange(len(sizes)) * self.wide, sizes)
        # best[k][p] is the place of the greatest impact among p .. p + 2^k - 1.
        self.best = [np.arange(len(self.doc), dtype=np.int32)]
        while 1 << len(self.best) <= sizes.max():
            last, half = self.best[-1], 1 << (len(self.best) - 1)
            a, b = last[:-half], last[half:]
            self.best.append(np.where(self.impact[b] > self.impact[a], b, a))
        self.table = np.zeros((len(self.best), len(self.doc)), np.int32)
        for k, row in enumerate(self.best):
            self.table[k, :len(row)] = row
        del self.best

    def peaks(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The place of the greatest impact in each non-empty range of places."""
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        a, b = self.table[level, lo], self.table[level, hi - (1 << level)]
        return np.where(self.impact[b] > self.impact[a], b, a)

    def search(self, own: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (score, document) of an item with the lists `own`; equal scores by document."""
        weight, offset = self.weight[own], own * self.wide
        best: list[tuple[int, int]] = []  # a heap of (score, -document), the worst on top
        heap: list[tuple] = []

        def offer(score: int, doc: int) -> None:
            if score <= 0:
                return
            if len(best) < k:
                heappush(best, (score, -doc))
            elif (score, -doc) > best[0]:
                heapreplace(best, (score, -doc))

        def push(first: int, lo: np.ndarray, hi: np.ndarray) -> None:
            some = np.flatnonzero(hi > lo)
            if not len(some):
                return
            top = self.peaks(lo[some], hi[some])
            worth = weight[some] * self.impact[top]
            bound = int(worth.sum())
            if len(best) == k and (bound, -first) <= best[0]:
                return
            heappush(heap, (-bound, first, len(heap), int(self.doc[top[worth.argmax()]]), lo, hi))

        def whole(lo: np.ndarray, hi: np.ndarray) -> None:
            size = hi - lo
            place = np.arange(size.sum()) + np.repeat(lo - np.r_[0, np.cumsum(size)[:-1]], size)
            doc = self.doc[place]
            base = int(doc.min())
            scores = np.zeros(int(doc.max()) - base + 1, np.int64)
            np.add.at(scores, doc - base, np.repeat(weight, size) * self.impact[place])
            least = best[0][0] if len(best) == k else 1
            found = np.flatnonzero(scores >= least)
            if len(found) > k:
                found = found[np.lexsort((found, -scores[found]))[:k]]
            for d in found.tolist():
                offer(int(scores[d]), d + base)

        push(0, self.start[own], self.start[own + 1])
        while heap:
            bound, first, _, at, lo, hi = heappop(heap)
            if len(best) == k and (-bound, -first) <= best[0]:
                # Bounds fall from here on; an equal one matters only for an earlier document.
                if -bound < best[0][0]:
                    break
                continue
            if int((hi - lo).sum()) <= LEAF:
                whole(lo, hi)
                continue
            # The place of document `at` in each list, or where it would be.
            cut = np.searchsorted(self.key, offset + at)
            cut = np.clip(cut, lo, hi)
            held = cut < hi
            held[held] = self.doc[cut[held]] == at
            offer(int((weight[held] * self.impact[cut[held]]).sum()), at)
            push(first, lo, cut)
            push(at + 1, cut + held, hi)
        return sorted(((s, -d) for s, d in best), key=lambda x: (-x[0], x[1]))


def _searcher(n_docs: int, n_terms: int, k: int):
    def search(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        columns = {name: table.column(name) for name in ("docs", "tfs", "lens")}
        lists = []
        for i, w in enumerate(table.column("weight").to_pylist()):
            docs, tf, n = (columns[c][i].values.to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
            m = 10 + 90 * n * n_docs // n_terms
            lists.append((w, docs, 1_000_000_000 * tf // (1000 * tf + 8 * m)))
        own = defaultdict(list)
        for i, items in enumerate(table.column("items").to_pylist()):
            for item in items:
                own[item].append(i)
        block = Lists(lists)
        out = [(key[1].as_py(), item, doc, score) for item, rows in own.items()
               for score, doc in block.search(np.array(rows), k)]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
        return pa.table([pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 4, kinds)],
                        ["block", "item", "doc", "score"])

    return search


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """`item_id`, `rank`, `doc_id`, `score`: the `k` best documents (`doc_id`, `text`) of each item.

    Items have `item_id` and `text`. Only scores above zero count; equal scores rank by ascending
    doc_id.
    """
    spark = docs.sparkSession
    items = materialize(
        items.select("item_id", "text").distinct().withColumn("item", F.monotonically_increasing_id()), "items")
    holds = items.select("item", F.explode(terms(F.col("text")).cast("array<binary>")).alias("term"))
    asked = materialize(holds.select("term").distinct(), "terms")
    blocks = index(docs, asked)
    n_docs, n_terms = blocks.where("ids IS NOT NULL").agg(
        F.sum(F.size(F.filter("lens", lambda n: n > 0)).cast("long")), F.sum("n_terms")).first()
    if not n_terms:
        return spark.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, "
                                         "rank int, doc_id long, score long")
    postings = blocks.where("ids IS NULL")
    odds = F.lit(2.0 * n_docs + 2.0) / (2 * F.col("df") + 1).cast("double")
    weights = postings.groupBy("term").agg(F.sum(F.size("docs").cast("long")).alias("df")).select(
        "term", F.floor(1000 * F.log(odds)).cast("long").alias("weight"))
    wanted = holds.join(weights.where("weight > 0"), "term").groupBy(
        F.expr(f"item div {CHUNK}").alias("chunk"), "term", "weight").agg(F.collect_list("item").alias("items"))
    wanted = materialize(wanted, "wanted")
    hits = postings.select("block", "term", "docs", "tfs", "lens").join(wanted, "term").drop("term").groupBy(
        "chunk", "block").applyInArrow(_searcher(n_docs, n_terms, k), _HITS)
    # Ties stay until the ids are known; a block gives at most k documents of an item.
    by_score = Window.partitionBy("item").orderBy(F.desc("score"))
    hits = materialize(hits.withColumn("place", F.rank().over(by_score)).where(f"place <= {int(k)}").drop("place"), "hits")
    named = hits.join(blocks.where("ids IS NOT NULL").select("block", "ids"), "block").select(
        "item", "block", "doc", "score", F.expr("ids[doc]").alias("doc_id"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "block", "doc")
    ranked = named.withColumn("rank", F.row_number().over(order)).where(f"rank <= {int(k)}")
    return ranked.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
