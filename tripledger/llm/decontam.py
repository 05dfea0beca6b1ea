"""Benchmark decontamination with spaced seeds.

A mask selects some of `SPAN` neighbouring tokens and ignores the others, so a hit survives
substitutions at ignored places. Hashes of the selected tokens are joined between test items and
documents; around each hit the aligned tokens are compared, and a document is contaminated if
some `WINDOW` aligned tokens that hold the hit agree in `AGREE` of them (or four fifths of a
shorter item).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.llm.common import SPACE, packed
from tripledger.sources.scratch import materialize

#: 1: the token counts; 0: it is ignored.
MASKS = ("110101101", "111001011", "110110011")
SPAN = 9
WINDOW = 13
AGREE = 11
#: Tokens kept on either side of a hit's first token, and all of them.
BEFORE, AFTER = WINDOW - 1, SPAN + WINDOW - 2
AROUND = BEFORE + 1 + AFTER
#: Places of a text that a row holds; longer texts are cut into several rows.
STEP = 1024
#: Words of 64 bits, at most, of the table of test hashes that goes to every task.
LISTED = 1 << 21


def tokens(text: Column) -> Column:
    """Lower-cased words without anything but letters and digits."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\s]+", "")
    return F.array_remove(F.split(plain, SPACE), "")


# Filters on computed arrays, and explode() which implies one, are avoided below: Spark would move
# them under the projections and compute the arrays anew for every element of a lambda. What follows
# an explode holds one piece only: Spark keeps all rows exploded from one row in memory at once.
def _places(df: DataFrame, text: str, **more: Column) -> DataFrame:
    """A row for each place where a mask fits: `toks` and `hs` of a piece of the text, the place `i`
    in it, the text's number of tokens `n`; `toks` is null beyond the ends of the text."""
    blank = F.lit(None).cast("string")
    df = df.select(*[c.alias(n) for n, c in more.items()], tokens(F.col(text).cast("string")).alias("toks"))
    df = df.select(*more, F.size("toks").alias("n"), F.concat(
        F.array_repeat(blank, BEFORE), "toks", F.array_repeat(blank, AFTER)).alias("toks"))
    starts = F.when(F.col("n") >= SPAN, F.sequence(F.lit(0), F.col("n") - SPAN, F.lit(STEP)))
    pieces = F.transform(starts, lambda at: F.slice("toks", at + 1, STEP + AROUND + SPAN - 2))
    df = df.select(*more, "n", pieces.alias("pieces"))
    df = df.select(*more, "n", F.explode_outer("pieces").alias("toks")).where("toks IS NOT NULL")
    df = df.withColumn("hs", F.transform("toks", lambda w: F.xxhash64(w)))
    return df.select(*more, "n", "toks", "hs", F.explode_outer(
        F.sequence(F.lit(0), F.size("toks") - (AROUND + SPAN - 1))).alias("i"))


def _masked(mask: int) -> Column:
    """Hash of the tokens that a mask selects from the place `i` on."""
    picked = [F.get("hs", F.col("i") + BEFORE + k) for k, bit in enumerate(MASKS[mask]) if bit == "1"]
    return F.xxhash64(F.lit(mask), *picked)


def _hashes() -> Column:
    return F.array(*[_masked(m) for m in range(len(MASKS))])


def _around() -> Column:
    """Tokens from `BEFORE` before to `AFTER` after the place `i`; null beyond the ends."""
    return F.slice("toks", F.col("i") + 1, AROUND)


def test_hashes(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (`around`, `width`) of all items, their `hashes`, and the smallest item id."""
    return _places(benchmark, text, item=F.col(item)).select(
        "item", _hashes().alias("hashes"), _around().alias("around"),
        F.least("n", F.lit(WINDOW)).alias("width"),
    ).groupBy("hashes", "around", "width").agg(F.min("item").alias("item"))


def _listed(hashes: DataFrame, size: int) -> tuple[DataFrame, Column, Column]:
    """One row with `size` words of 64 bits, in which each hash has set 3 bits of one word; the
    number of a hash's word, and its bits."""
    word = F.expr(f"pmod(hash, {size}L)")
    bits = F.expr(" | ".join(f"shiftleft(1L, CAST(shiftrightunsigned(hash, {k}) & 63 AS int))" for k in (46, 52, 58)))
    every = hashes.sparkSession.range(size).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = hashes.select(word.alias("word"), bits.alias("bits")).union(every).groupBy("word").agg(
        F.expr("bit_or(bits)").alias("bits"))
    # Stretches first, so that the last task reads few rows.
    in_order = lambda by: F.array_sort(F.collect_list(F.struct(by, "bits")))["bits"]
    stretches = words.groupBy(F.shiftright("word", 12).alias("stretch")).agg(in_order("word").alias("bits"))
    return stretches.agg(F.flatten(in_order("stretch"))), word, bits


def _hits(docs: DataFrame, tests: DataFrame, key: str, text: str) -> DataFrame:
    """Places in documents whose masked hash some test item has, and a few others."""
    more = {"key": F.col(key), "body": F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))}
    size = max(1, min(LISTED, 4 * len(MASKS) * tests.count()))
    words, word, bits = _listed(tests.select(F.explode("hashes").alias("hash")), size)
    seeds = _places(docs, text, **more).select(*more, "toks", "i", F.explode_outer(_hashes()).alias("hash"))
    return seeds.where(F.get(words.scalar(), word.cast("int")).bitwiseAND(bits) == bits).select(
        *more, "hash", _around().alias("found"))


def _same() -> Column:
    """Bit k is 1 if the tokens at k of `found` and `around` are equal."""
    equal = [F.when(F.get("found", F.lit(k)) == F.get("around", F.lit(k)), F.lit(1 << k).cast("long"))
             .otherwise(F.lit(0).cast("long")) for k in range(AROUND)]
    return reduce(Column.bitwiseOR, equal)


def _agreeing() -> Column:
    """Some window that holds the hit's first token, and lies in the kept tokens, agrees."""
    need = F.when(F.col("width") == WINDOW, F.lit(AGREE)).otherwise(F.ceil(F.col("width") * 0.8))
    windows = [(F.col("width") <= AROUND - k)
               & (F.expr(f"bit_count(shiftrightunsigned(same, {k}) & (shiftleft(1L, width) - 1L))") >= need)
               for k in range(AROUND - SPAN + 1)]
    return reduce(Column.__or__, windows)


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                 item: str = "item_id", item_text: str = "text") -> DataFrame:
    """`row`, `contaminated`, `item` (smallest id of a verified item) and `n_items` found.

    Tokens are lower-cased words of letters and digits. Items and documents of fewer than 9
    tokens have no seed and are clean; so are null and empty texts. Items with equal
    surroundings count once, as the smallest id. Rows equal in key and text are one document.
    An empty benchmark leaves every document clean; an empty input gives no row.
    """
    tests = materialize(test_hashes(benchmark, item, item_text), "tests")
    hits = _hits(docs, tests, key, text)
    # The files of the tests are some 70 times smaller than their rows, so Spark must not judge by them.
    by_hash = tests.select(F.explode("hashes").alias("hash"), "around", "width", "item").hint("merge")
    verified = (
        hits.join(by_hash, "hash")
        .select("key", "body", "item", "width", F.explode_outer(F.array(_same())).alias("same"))
        .where(_agreeing())
        .groupBy("key", "body").agg(F.min("item").alias("item"), F.count_distinct("item").alias("n_items"))
    )
    verified = materialize(verified, "verified")
    whole = packed(docs, key=F.col(key),
                   body=F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")))
    on = whole["key"].eqNullSafe(verified["key"]) & (whole["body"] == verified["body"])
    return whole.join(verified, on, "left").select(
        "row", F.col("n_items").isNotNull().alias("contaminated"), "item",
        F.coalesce("n_items", F.lit(0)).alias("n_items"))
