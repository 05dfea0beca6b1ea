"""Surrogates: coreference of names, no end of them, HMAC, check digits, odd rows."""

import hashlib
import hmac
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tripledger.llm import surrogates

SCHEMA = "doc_id long, text string, row int, found int, by string, kind string"


def replaced(spark, texts, secret="k"):
    df = spark.createDataFrame([(i, t, i, 1, "b", "k") for i, t in enumerate(texts)], SCHEMA).repartition(3)
    return {r["row"]["row"]: r["text"] for r in surrogates.replace_entities(df, secret).collect()}


def test_a_person_keeps_one_family_name(spark):
    """With and without a given name, whichever given names collide."""
    given = "Adam Bert Carl Dirk Eric Fred Gus Hank Ivan Jack Karl Lars Mike Nick Otto".split()
    out = replaced(spark, [f"Mr {g} Smith met Mr Smith and Mrs Smith." for g in given])
    families = {f for t in out.values() for f in re.findall(r"(\w+)(?: met| and|\.)", t)}
    assert len(families) == 1 and not families & {"Smith"}
    assert len({re.match(r"Mr ([\w-]+) ", t)[1] for t in out.values()}) == len(given)


def test_names_never_run_out(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "SYLLABLES", {s: of[:16] for s, of in surrogates.SYLLABLES.items()})
    few = {k: names[:2] for k, names in surrogates.GIVEN.items()}
    monkeypatch.setattr(surrogates, "GIVEN", few)
    names = [f"Dr {chr(65 + i % 26)}{'abcdefghij'[i // 26]}n Miller" for i in range(150)]
    table = surrogates.assign(spark.createDataFrame([("name", n) for n in names], "kind string, canon string"), "k")
    rows = table.collect()
    assert len({r["surrogate"] for r in rows}) == len(rows) == 150
    assert len({r["surrogate"].split(" ")[-1] for r in rows}) == 1


def test_many_families(spark):
    """More than four syllables can tell apart."""
    found = spark.range(100_000).select(F.lit("name").alias("kind"), F.concat(
        F.lit("Mr "), F.initcap(F.translate(F.lpad(F.col("id").cast("string"), 6, "0"), "0123456789", "abcdefghij"))).alias("canon"))
    table = surrogates.assign(found, "k")
    assert table.count() == table.select("surrogate").distinct().count() == 100_000


@pytest.mark.parametrize("secret", ["k", "é" * 70])
def test_draws_are_an_hmac(spark, secret):
    row = spark.range(1).select(surrogates._draw(secret, F.lit("what é"), 1000).alias("x")).first()
    key = secret.encode()
    want = hmac.new(key, "what é".encode(), hashlib.sha256).hexdigest()[:15]
    assert row["x"] == int(want, 16) % 1000


def mod97(iban):
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def test_account_numbers_stay_valid(spark):
    valid, broken = "DE89 3704 0044 0532 0130 00", "DE88370400440532013000"
    out = replaced(spark, [f"to {valid} now", f"to {broken} now", "GB82WEST12345698765432"])
    one = out[0].removeprefix("to ").removesuffix(" now")
    assert one != valid and mod97(one.replace(" ", "")) == 1 and [len(p) for p in one.split()] == [4, 4, 4, 4, 4, 2]
    assert mod97(out[2]) == 1 and out[2][:2] == "GB" and re.fullmatch("[A-Z]{4}[0-9]{14}", out[2][4:])
    assert out[1] != f"to {broken} now"


def test_odd_rows(spark):
    """Null keys, equal rows, clashing columns, a very long text, other scripts, ties."""
    long = "word " * 40_000 + "Mr Smith " + "tail " * 40_000
    texts = [None, "", "nothing here", long, "Mr Smith", "г-н Иван Петров и г-н Петров", "κ Νίκος Παππάς, κα Παππάς", "Dr. Jones, Dr Jones"]
    rows = [(None if i < 5 else i, t, i, 1, "b", "k") for i, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, rows[4], rows[4]], SCHEMA)
    got = defaultdict(list)
    for r in surrogates.replace_entities(df, "k").collect():
        got[r["row"]["row"]].append((r["text"], r["n_entities"]))
    assert got[0] == [(None, 0)] and got[1] == [("", 0)] and got[2] == [("nothing here", 0)]
    smith = got[4][0][0]
    assert got[4] == [(smith, 1)] * 3 and got[3] == [(long.replace("Mr Smith", smith), 1)]
    russian = re.findall(r"(\w+)(?: и|$)", got[5][0][0])
    assert len(set(russian)) == 1 and re.fullmatch("[А-Яа-я]+", russian[0])
    greek = re.findall(r"(\w+)(?:,|$)", got[6][0][0])
    assert len(set(greek)) == 1 and re.fullmatch("[Α-Ωα-ωά-ώΆ-Ώ]+", greek[0])
    assert len(set(re.findall(r"Dr\.? (\w+)", got[7][0][0]))) == 1
    assert surrogates.replace_entities(df.limit(0), "k").count() == 0
    others = replaced(spark, ["Mr Smith"], "another")
    assert others[0] != smith
