"""Perplexity under an interpolated modified Kneser-Ney model, with thresholds per language.

The model is an n-gram model over bytes (order 5 by default) for each language, counted over all
trusted text. Counts, continuation counts, discounts and probabilities are tables keyed by
language and n-gram, and every step between them is a join or an aggregation sharded by that key.

Scoring needs for each byte the probability of its n-gram, or those of shorter ones and the
weights of its contexts. All of these share the two bytes before it, so the tables of a language
are cut into model shards by these two bytes, none above `SHARD_ROWS` rows unless one such pair
is. Tasks sort and pack the shards; the driver passes them on one after the other and never holds
the model. A pass over the texts takes shards of up to `PASS_ROWS` rows in all, and every document
adds up its share.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tripledger.llm.common import packed
from tripledger.sources.scratch import materialize

ORDER = 5
SHARD_ROWS = 500_000
PASS_ROWS = 16_000_000
#: A threshold lies `REACH` times as far above the median of trusted texts as this quantile.
QUANTILE = 0.95
REACH = 3.0
#: Thresholds are read from counts of log-perplexity in bins of this width.
BIN = 0.001
#: Texts are counted and scored in groups of about this many bytes.
CHUNK = 2_000_000
#: Language of the model that scores languages without trusted text.
POOLED = ""
#: Kind of rows that name a pair which another shard than the language's first one scores.
ELSEWHERE = "e"


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of the texts its last `ORDER` bytes as one number, and the texts' lengths.

    Line feeds stand before the start of a text.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    lengths = np.array([len(r) for r in raw], np.int64)
    pad = b"\n" * (ORDER - 1)
    data = np.frombuffer(b"".join([pad + r for r in raw]), np.uint8).astype(np.int64)
    if not len(data):
        return np.zeros(0, np.int64), lengths
    code = np.zeros(max(0, len(data) - ORDER + 1), np.int64)
    for k in range(ORDER):
        code = (code << 8) | data[k:k + len(code)]
    # Windows that end inside the next text's padding are not the text's.
    ends = np.ones(len(code), bool)
    starts = np.cumsum(lengths + ORDER - 1)
    for k in range(ORDER - 1):
        at = starts[:-1] - (ORDER - 1) + k
        ends[at[at < len(code)]] = False
    return code[ends], lengths


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        texts = np.array(batch.column("text").to_pylist(), object)
        for lang in sorted(set(langs)):
            own = texts[langs == lang].tolist()
            for a, b in _chunks(own):
                code, n = np.unique(_grams(own[a:b])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(code), pa.string()), pa.array(code), pa.array(n)],
                    names=["lang", "gram", "n"])


def _discounts(counts: DataFrame) -> DataFrame:
    """Modified Kneser-Ney discounts from the counts of counts; one row per language."""
    of = [F.sum((F.col("n") == k).cast("long")).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = F.coalesce(F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2")), F.lit(0.5))

    def d(k: int) -> Column:
        value = k - (k + 1) * y * F.coalesce(F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}")), F.lit(0.5))
        return F.greatest(F.lit(0.05), F.least(value, F.lit(float(k)))).alias(f"d{k}")

    return counts.groupBy("lang").agg(*of).select("lang", d(1), d(2), d(3))


def train(trusted: DataFrame) -> DataFrame:
    """From (`lang`, `text`) to rows (`lang`, `kind`, `size`, `gram`, `value`).

    Kind "p": interpolated probability of an n-gram's last byte after the others; kind "g":
    weight of the next shorter model after a context of `size` bytes.
    """
    grams = trusted.mapInArrow(_counted, "lang string, gram long, n long")
    counts = materialize(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    pooled = counts.groupBy("gram").agg(F.sum("n").alias("n")).select(F.lit(POOLED).alias("lang"), "gram", "n")
    counts = materialize(counts.where(F.col("lang") != POOLED).unionByName(pooled), "grams")
    tables = {ORDER: counts}
    for size in range(ORDER - 1, 0, -1):  # in how many contexts one byte longer a gram occurs
        shorter = F.col("gram").bitwiseAND((1 << 8 * size) - 1)
        tables[size] = materialize(
            tables[size + 1].groupBy("lang", shorter.alias("gram")).agg(F.count("*").alias("n")), f"grams{size}")
    # Order 0: all bytes alike.
    parts, lower = [], None
    for size in range(1, ORDER + 1):
        d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        discounted = (
            tables[size].join(F.broadcast(_discounts(tables[size])), "lang")  # one row per language
            .select("lang", "gram", F.shiftright("gram", 8).alias("context"),
                    F.col("n").cast("double").alias("n"), d.alias("d"))
        )
        sums = discounted.groupBy("lang", "context").agg(F.sum("n").alias("all"), F.sum("d").alias("off"))
        weights = sums.select("lang", "context", "all", (F.col("off") / F.col("all")).alias("weight"))
        weights = materialize(weights, f"contexts{size}")
        seen = discounted.join(weights, ["lang", "context"]).withColumn("own", (F.col("n") - F.col("d")) / F.col("all"))
        if lower is None:
            below = seen.withColumn("below", F.lit(1 / 256))
        else:
            shorter = F.col("gram").bitwiseAND((1 << 8 * (size - 1)) - 1).alias("shorter")
            below = seen.select("*", shorter).join(
                lower.select("lang", F.col("gram").alias("shorter"), F.col("value").alias("below")), ["lang", "shorter"])
        lower = materialize(
            below.select("lang", "gram", (F.col("own") + F.col("weight") * F.col("below")).alias("value")), f"p{size}")
        parts.append(lower.select("lang", F.lit("p").alias("kind"), F.lit(size).alias("size"), "gram", "value"))
        parts.append(weights.select("lang", F.lit("g").alias("kind"), F.lit(size - 1).alias("size"),
                                    F.col("context").alias("gram"), F.col("weight").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _shards(model: DataFrame) -> DataFrame:
    """The model's shards: `lang`, `shard`, its rows `n` and the `packed` shard itself."""
    # The two bytes before the scored one; shorter entries go to all shards of their language (at most 65,793).
    pair = (F.when(F.col("kind") == "p", F.shiftright("gram", 8)).otherwise(F.col("gram"))).bitwiseAND(0xFFFF)
    local = ((F.col("kind") == "p") & (F.col("size") >= 3)) | ((F.col("kind") == "g") & (F.col("size") >= 2))
    rows = materialize(model.withColumn("pair", F.when(local, pair)), "model")
    sizes = rows.where("pair IS NOT NULL").groupBy("lang", "pair").agg(F.count("*").alias("n"))
    # At most 65,536 rows per language: running sums cut the list into shards.
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("pair")) - F.col("n")
    cut = sizes.withColumn("shard", F.floor(upto / SHARD_ROWS).cast("int")).select("lang", "pair", "shard")
    cut = materialize(cut, "model-shards")
    columns = ("lang", "shard", "kind", "size", "gram", "value")
    placed = rows.where("pair IS NOT NULL").join(cut, ["lang", "pair"]).select(*columns).unionByName(
        rows.where("pair IS NULL").join(cut.select("lang", "shard").distinct(), "lang").select(*columns)).unionByName(
        cut.where("shard > 0").select("lang", F.lit(0).alias("shard"), F.lit(ELSEWHERE).alias("kind"),
                                      F.lit(0).alias("size"), F.col("pair").alias("gram"), F.lit(0.0).alias("value")))
    packed = placed.groupBy("lang", "shard").applyInArrow(_packed, "lang string, shard int, n long, packed binary")
    return materialize(packed, "model-packed")


def _packed(key: tuple, table: pa.Table) -> pa.Table:
    lang, number = (k.as_py() for k in key)
    away = pc.equal(table.column("kind"), ELSEWHERE)
    elsewhere = pa.table({"lang": table.column("lang"), "pair": table.column("gram")}).filter(away)
    shard = _Shard(table.filter(pc.invert(away)), None if number else elsewhere, False)
    return pa.table({"lang": pa.array([lang], pa.string()), "shard": pa.array([number], pa.int32()),
                     "n": pa.array([table.num_rows], pa.int64()), "packed": pa.array([pickle.dumps(shard)], pa.binary())})


def _by_value(column: pa.ChunkedArray) -> dict[str, np.ndarray]:
    """Which rows have each value of a column of few values."""
    coded = pa.concat_arrays(column.chunks).dictionary_encode() if len(column) else None
    if coded is None:
        return {}
    at = coded.indices.to_numpy()
    return {x: at == k for k, x in enumerate(coded.dictionary.to_pylist())}


class _Shard:
    """Sorted tables of one shard."""

    def __init__(self, table: pa.Table, elsewhere: pa.Table | None, whole: bool):
        """`elsewhere`: for the first shard the pairs of all others; it scores the pairs of none."""
        self.tables = {}
        self.elsewhere = None
        if elsewhere is not None:
            pairs = elsewhere.column("pair").to_numpy()
            self.elsewhere = {x: pairs[own] for x, own in _by_value(elsewhere.column("lang")).items()}
        langs, kinds = _by_value(table.column("lang")), _by_value(table.column("kind"))
        size, gram = table.column("size").to_numpy(), table.column("gram").to_numpy()
        value = table.column("value").to_numpy()
        none = np.zeros(len(gram), bool)
        of_p, of_g = kinds.get("p", none), kinds.get("g", none)
        local = (of_p & (size >= 3)) | (of_g & (size >= 2))
        pair = np.where(of_p, gram >> 8, gram) & 0xFFFF
        self.pairs = None if whole else {x: np.unique(pair[local & own]) for x, own in langs.items()}
        self.langs = set(langs)
        for x, own in langs.items():
            for k, of_kind, sizes in (("p", of_p, range(1, ORDER + 1)), ("g", of_g, range(ORDER))):
                for s in sizes:
                    at = np.flatnonzero(own & of_kind & (size == s))
                    at = at[np.argsort(gram[at])]
                    self.tables[x, k, s] = gram[at], value[at]

    def _find(self, lang: str, kind: str, size: int, gram: np.ndarray):
        keys, values = self.tables[lang, kind, size]
        if not len(keys):
            return np.zeros(len(gram), bool), np.zeros(len(gram))
        at = np.minimum(np.searchsorted(keys, gram), len(keys) - 1)
        return keys[at] == gram, values[at]

    def log_p(self, lang: str, gram: np.ndarray) -> np.ndarray:
        """Log-probability of each n-gram; of meaning for those of this shard."""
        _, weight = self._find(lang, "g", 0, np.zeros(1, np.int64))
        p = np.full(len(gram), weight[0] / 256)
        for size in range(1, ORDER + 1):
            if size > 1:
                found, weight = self._find(lang, "g", size - 1, (gram >> 8) & ((1 << 8 * (size - 1)) - 1))
                p = np.where(found, weight * p, p)
            found, own = self._find(lang, "p", size, gram & ((1 << 8 * size) - 1))
            p = np.where(found, own, p)
        return np.log(p)

    def mine(self, lang: str, gram: np.ndarray) -> np.ndarray:
        """Which n-grams this shard scores; pairs that no shard holds are the first one's."""
        if self.pairs is None:
            return np.ones(len(gram), bool)
        if self.elsewhere is not None:
            return ~np.isin((gram >> 8) & 0xFFFF, self.elsewhere.get(lang, ()))
        return np.isin((gram >> 8) & 0xFFFF, self.pairs.get(lang, ()))


def _scored(shards: dict[str, list[Broadcast]], languages: set[str]):
    """Adds what `shards` (packed, by language) score; `languages` have a model of their own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            langs = batch.column("lang").to_pylist()
            total = np.array(batch.column("log_p").to_numpy(zero_copy_only=False))
            scored = np.array(batch.column("n_scored").to_numpy(zero_copy_only=False))
            by_lang: dict[str, list[int]] = {}
            for i, x in enumerate(langs):
                by_lang.setdefault(x if x in languages else POOLED, []).append(i)
            for lang, rows in by_lang.items():
                if lang not in shards:
                    continue
                own = [texts[i] or "" for i in rows]
                for a, b in _chunks(own):
                    code, lengths = _grams(own[a:b])
                    if not len(code):
                        continue
                    distinct = np.unique(code)
                    value, here = np.zeros(len(distinct)), np.zeros(len(distinct), bool)
                    for packed in shards[lang]:  # one at a time is unpacked
                        shard = pickle.loads(packed.value)
                        mine = np.flatnonzero(shard.mine(lang, distinct))
                        value[mine], here[mine] = shard.log_p(lang, distinct[mine]), True
                    at = np.searchsorted(distinct, code)
                    ends = np.cumsum(lengths)
                    for out, of in ((total, value), (scored, here.astype(np.int64))):
                        upto = np.append(0, np.cumsum(of[at]))
                        out[rows[a:b]] += (upto[ends] - upto[ends - lengths]).astype(out.dtype)
            cols = [batch.column(n) for n in ("row", "text", "lang")]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(total), pa.array(scored)], names=["row", "text", "lang", "log_p", "n_scored"])

    return run


def perplexity(docs: DataFrame, model: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """`row` (the input's other columns), `lang` and `log_ppl`: mean negative log-probability of a byte.

    Empty and null texts have no perplexity. Languages without trusted text, and null, are
    scored by the pooled model.
    """
    spark = docs.sparkSession
    others = [c for c in docs.columns if c != text]
    whole = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(None).alias("none"))
    rows = docs.select(whole.alias("row"), F.col(text).cast("string").alias("text"),
                       F.coalesce(F.col(lang), F.lit(POOLED)).alias("lang"),
                       F.lit(0.0).alias("log_p"), F.lit(0).cast("long").alias("n_scored"))
    schema = rows.schema
    shards = _shards(model)
    sizes = shards.select("lang", "n").collect()  # one row per shard
    languages, left = {r["lang"] for r in sizes}, sum(r["n"] for r in sizes)
    held: dict[str, list[Broadcast]] = {}
    n_held = 0
    for shard in shards.toLocalIterator():  # a partition at a time is with the driver
        held.setdefault(shard["lang"], []).append(spark.sparkContext.broadcast(bytes(shard["packed"])))
        n_held, left = n_held + shard["n"], left - shard["n"]
        if n_held >= PASS_ROWS or not left:
            rows = rows.mapInArrow(_scored(held, languages), schema)
            if left:
                rows = materialize(rows, "scored")
            held, n_held = {}, 0
    return rows.select("row", "lang", (-F.try_divide("log_p", F.col("n_scored"))).alias("log_ppl"))


def _limits(held_out: DataFrame, quantile: float, reach: float) -> DataFrame:
    """(`lang`, `limit`) from held-out trusted texts; "\\0all" stands for all languages."""
    binned = materialize(
        held_out.where("log_ppl IS NOT NULL").groupBy("lang", F.floor(F.col("log_ppl") / BIN).alias("bin"))
        .agg(F.count("*").alias("n")), "bins")
    both = binned.unionByName(binned.groupBy("bin").agg(F.sum("n").alias("n")).select(
        F.lit("\0all").alias("lang"), "bin", "n"))
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("bin"))
    whole = F.sum("n").over(Window.partitionBy("lang"))

    def at(q: float) -> Column:  # upper edge of the bin that holds the quantile
        return (F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("bin"))) + 1) * BIN

    sums = both.withColumn("upto", upto).withColumn("all", whole)
    ends = sums.groupBy("lang").agg(at(0.5).alias("middle"), at(quantile).alias("high"))
    return materialize(ends.select("lang", (
        F.col("middle") + reach * F.greatest(F.col("high") - F.col("middle"), F.lit(0.1))).alias("limit")), "limits")


def judge(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          quantile: float = QUANTILE, reach: float = REACH) -> DataFrame:
    """`row` (all columns but the text), `lang`, `log_ppl`, `limit` and `kept`.

    `trusted` holds the keys of trusted documents (nulls and repeats are ignored). The model is
    trained on all their text. Its thresholds come from texts it has not seen: a model of one
    half of the trusted documents (by key hash) scores the other half, and a language's limit is
    the median of its log-perplexities plus `reach` times the way from there to the quantile (or
    to 0.1 above the median). Languages without trusted text take the limit of all. A document
    is kept if its log-perplexity is at most the limit. Empty and null texts have none and are
    not kept. Without held-out text nothing is judged and everything is kept. An empty input
    gives no row.
    """
    keys = trusted.select(F.col(key).alias("_trusted")).where("_trusted IS NOT NULL").distinct()
    keys = materialize(keys, "trusted")
    marked = docs.join(keys, F.col(key) == F.col("_trusted"), "left_semi").where(F.length(text) > 0).select(
        F.coalesce(F.col(lang), F.lit(POOLED)).alias("lang"), F.col(text).cast("string").alias("text"),
        (F.pmod(F.xxhash64(key), F.lit(2)) == 0).alias("half"))
    marked = materialize(marked, "trusted-text")
    half = train(marked.where("half").select("lang", "text"))
    held_out = perplexity(marked.where("NOT half").select("lang", "text"), half)
    limits = _limits(held_out, quantile, reach)  # one row per language
    scored = perplexity(docs, train(marked.select("lang", "text")), text, lang)
    fallback = limits.where(F.col("lang") == "\0all").first()
    limit = F.coalesce(F.col("limit"), F.lit(fallback["limit"] if fallback else None).cast("double"))
    fits = F.col("log_ppl").isNotNull() & (F.col("log_ppl") <= limit) if fallback else F.lit(True)
    return scored.join(F.broadcast(limits), "lang", "left").select(
        "row", "lang", "log_ppl", limit.alias("limit"), fits.alias("kept"))
