"""The text operators against brute force, and on odd rows."""

import pickle
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripledger.llm import (
    components, decontam, kneser_ney, line_dedup, merge_dropout, outliers, rans, shards, simhash, surrogates, toxicity,
)
from tripledger.llm.queries import vocabulary

WORDS = "the of and to in that was for on are with as his they be at one have this from".split()
SCHEMA = "doc_id long, text string, lang string, source string, row int, shard string, key string, spans int"
BENCH = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau"


def prose(rng, n):
    return " ".join(WORDS[i] + str(int(rng.integers(0, 30))) for i in rng.integers(0, len(WORDS), n))


@pytest.fixture(scope="module")
def rows():
    """Plain texts, copies, near copies, shared passages, and rows that are odd in every way."""
    rng = np.random.default_rng(5)
    texts = [prose(rng, int(n)) for n in rng.integers(25, 90, 40)]
    texts += [texts[0]] * 30
    long = prose(rng, 400)
    texts += [long, long.replace("the", "a", 1), long + " end"]
    passage = "\n".join(prose(rng, 9) for _ in range(9))
    texts += [prose(rng, 12) + "\n" + passage + "\n" + prose(rng, 15) for _ in range(6)]
    texts += [prose(rng, 20) + " " + BENCH + " " + prose(rng, 20),
              prose(rng, 20) + " " + BENCH.replace("eta ", "XX, ") + " " + prose(rng, 20)]
    texts += ["", None, " ", "\n\n", "one", "a\tb\x0bc", "é ▁ 日本 🙂\0x", "x  y \n z", prose(rng, 6000), "*** " * 40, "a <|endoftext|> b"]
    out = [(i, t, ["en", "fr", None][i % 3], "hot" if i % 2 else None, i, "s", "k", 1) for i, t in enumerate(texts)]
    return out + [out[3], out[3], (None, texts[4], "en", "hot", 1, "s", "k", 1)]


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def split(t):
    return [w for w in re.split("[\x20\x09-\x0d]+", t or "") if w]


def test_shards_follow_prefix_sums(spark, docs, none, rows, tmp_path):
    got = shards.write_shards(docs, str(tmp_path / "a"), n_shards=7).collect()
    assert len(got) == len(rows)
    sizes = [r["size"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert sorted(sizes) == sorted(len((r[1] or "").encode()) + 8 for r in rows)
    ids = [r["row"]["doc_id"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert ids == sorted(ids, key=lambda d: -1 if d is None else d)
    before, slots = 0, Counter()
    for r in sorted(got, key=lambda r: (r["shard"], r["slot"])):
        assert r["shard"] == (2 * before + r["size"]) * 7 // (2 * sum(sizes))
        assert r["slot"] == slots[r["shard"]]
        slots[r["shard"]] += 1
        before += r["size"]
    assert shards.write_shards(none, str(tmp_path / "b")).count() == 0


def test_more_shards_than_rows(spark, docs, tmp_path):
    got = shards.write_shards(docs.limit(3), str(tmp_path / "c"), n_shards=24)
    assert got.count() == 3 and got.where("slot <> 0").count() == 0


def test_tokens_round_trip(spark, docs, none, rows, tmp_path):
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    rans.write_tokens(docs, str(tmp_path / "t"), path)
    got = rans.read_tokens(spark, str(tmp_path / "t")).orderBy("start").collect()
    start = 0
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    want = Counter((r[0], tuple(own.encode(r[1] or "", add_special_tokens=False).ids + [2])) for r in rows)
    assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in got) == want
    rans.write_tokens(none, str(tmp_path / "u"), path)
    assert rans.read_tokens(spark, str(tmp_path / "u")).count() == 0


@pytest.mark.parametrize("n", [1, 5, rans.LANES, rans.LANES * rans.STEPS + 17])
def test_blocks_decode(n):
    ids = np.random.default_rng(n).zipf(1.3, n) % 5000
    model = rans.Frequencies(*np.unique(ids, return_counts=True))
    payload = rans.encode_block(model, ids)
    assert (rans.decode_block(model, model.slots(), payload, n) == ids).all()


def test_damaged_block_is_an_error(spark, docs, tmp_path):
    path = str(tmp_path / "d")
    rans.write_tokens(docs, path, vocabulary("byte_bpe_50k.json"))
    blocks = spark.read.parquet(f"{path}/blocks").withColumn("crc", F.col("crc") + 1)
    spark.read.parquet(f"{path}/model").write.parquet(f"{path}x/model")
    blocks.write.parquet(f"{path}x/blocks")
    with pytest.raises(Exception, match="damaged"):
        rans.read_tokens(spark, f"{path}x").collect()


def test_simhash_against_all_pairs(docs, none, rows):
    got = simhash.near_duplicates(docs).select("row.doc_id", "row.text", "fp", "component_id", "keeper").collect()
    assert len(got) == len(rows)
    prints = {r["text"]: r["fp"] & (1 << 64) - 1 for r in got}
    for text, fp in prints.items():
        assert fp == simhash.fingerprint(text, 4)
    texts = [r["text"] for r in got]
    root = list(range(len(got)))
    changed = True
    while changed:
        changed = False
        for i in range(len(got)):
            for j in range(i):
                if (prints[texts[i]] ^ prints[texts[j]]).bit_count() <= 4 and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    by_root = {}
    for i, r in enumerate(got):
        by_root.setdefault(root[i], []).append(r)
    for group in by_root.values():
        least = min((r["doc_id"] for r in group), key=lambda d: -1 if d is None else d)
        assert {r["component_id"] for r in group} == {least}
        assert [r["doc_id"] for r in group if r["keeper"]] == [least]
    assert simhash.near_duplicates(none).count() == 0


def test_index_finds_what_all_pairs_find():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    codes = np.unique(np.concatenate([b ^ (np.uint64(1) << rng.integers(0, 64, 20).astype(np.uint64)) for b in base]))
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    i, j = simhash.near_pairs(codes, codes, 4)
    want = np.nonzero(np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 4)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(want[0].tolist(), want[1].tolist()))


def test_large_nodes_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    codes = [x << 20 for x in range(64)]  # one dense group in the same leading bits
    got = components.components(simhash.links(spark.createDataFrame([(c,) for c in codes], "fp long"), 1))
    assert {tuple(r) for r in got.collect()} == {(c, 0) for c in codes}


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(links).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100}


def test_statistics_by_hand(docs, rows):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = Counter((r["row"]["text"], *[r[n] for n in names]) for r in outliers.statistics(docs).collect())
    want = Counter()
    for r in rows:
        w, t = split(r[1]), r[1] or ""
        windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        covered = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in t.split("\n") if split(x)]
        want[r[1], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)] += 1
    assert got == want


def test_outliers_go_and_others_stay(spark, docs, none, rows):
    rng = np.random.default_rng(2)
    extra = [(1000 + i, prose(rng, 60), "en", "hot", 1, "s", "k", 1) for i in range(60)]
    extra += [(2000, " ".join(w + "***$$$" for w in prose(rng, 60).split()), "en", "hot", 1, "s", "k", 1)]
    got = outliers.quality(docs.unionByName(spark.createDataFrame(extra, SCHEMA))).collect()
    assert len(got) == len(rows) + len(extra)
    kept = {r["row"]["doc_id"]: r["kept"] for r in got if r["row"]["doc_id"] is not None and r["row"]["doc_id"] >= 1000}
    assert not kept.pop(2000) and all(kept.values())
    assert all(not r["kept"] for r in got if r["n_words"] < 20)
    assert outliers.quality(none).count() == 0


def test_chi_square():
    assert abs(outliers.chi2_quantile(0.95, 4) - 9.4877) < 1e-3


def test_chunks_against_plain_python(docs, none, rows):
    import hashlib

    def md5(s):
        return hashlib.md5(s.encode()).hexdigest()

    def chunks(text):
        lines = (text or "").split("\n")
        h = [md5(x) for x in lines]
        r = [None] + [md5(h[i - 1] + h[i]) for i in range(1, len(h))]
        ends = [i for i in range(1, len(h) - 2) if (i == 1 or r[i] < r[i - 1]) and r[i] <= r[i + 1]] + [len(h) - 1]
        return lines, list(zip([0] + [e + 1 for e in ends[:-1]], ends))

    seen, lost = set(), {}
    order = sorted({(r[0], r[1]) for r in rows}, key=lambda x: (-1 if x[0] is None else x[0], md5(x[1] or "")))
    for doc, text in order:
        lines, spans = chunks(text)
        gone = []
        for a, b in spans:
            body = "\n".join(lines[a:b + 1])
            if b > a and sum(bool(split(x)) for x in lines[a:b + 1]) > 1:
                if body in seen:
                    gone.append((a, b))
                seen.add(body)
        keep = [x for i, x in enumerate(lines) if not any(a <= i <= b for a, b in gone)]
        lost[doc, text] = (text if not gone else "\n".join(keep), gone)
    got = line_dedup.remove_repeated_chunks(docs).collect()
    assert len(got) == len(rows) and any(r["spans"] for r in got)
    for r in got:
        assert (r["text"], [tuple(s) for s in r["spans"]]) == lost[r["row"]["doc_id"], r["row"]["text"]]
    assert line_dedup.remove_repeated_chunks(none).count() == 0


def test_benchmark_passages(spark, docs, none, rows):
    bench = spark.createDataFrame([(7, BENCH), (3, BENCH), (8, "too short"), (9, None)], "item_id long, text string")
    got = decontam.contaminated(docs, bench).collect()
    assert len(got) == len(rows)
    assert {r["row"]["doc_id"] for r in got if r["contaminated"]} == {r[0] for r in rows if r[1] and "alpha" in r[1]}
    assert {r["item"] for r in got if r["contaminated"]} == {3}
    assert decontam.contaminated(none, bench).count() == 0
    assert decontam.contaminated(docs, bench.limit(0)).where("contaminated").count() == 0


def test_large_benchmarks_take_the_join(spark, docs, monkeypatch):
    bench = spark.createDataFrame([(7, BENCH)], "item_id long, text string")
    docs = docs.where("length(text) < 5000")  # the test session has 1 GB of heap
    want = decontam.contaminated(docs, bench).where("contaminated").count()
    monkeypatch.setattr(decontam, "LISTED", 0)
    assert decontam.contaminated(docs, bench).where("contaminated").count() == want


@pytest.mark.parametrize("listed", [1 << 21, 1])
def test_passages_in_long_texts(spark, monkeypatch, listed):
    """A text of 60,000 words that repeats a passage keeps what its hits need, and no more."""
    monkeypatch.setattr(decontam, "LISTED", listed)
    rng = np.random.default_rng(8)
    words = BENCH.split()
    inside = prose(rng, 2100).split()
    at = [0, 1, *range(1000, 1032, 4), len(inside) - 13, len(inside)]
    texts = [" ".join(inside[:k] + words[2:15] + inside[k:]) for k in at]
    texts += [" ".join(inside[:k] + words[2:9] + ["x"] * 3 + words[12:15] + inside[k:]) for k in at]
    texts += [" ".join([BENCH] * 3000), prose(rng, 60_000), " ".join(words[:8]), " ".join(words[:9]), "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(7, BENCH), (5, BENCH.upper() + " upsilon")], "item_id long, text string")
    got = {r["row"]["doc_id"]: (r["contaminated"], r["item"]) for r in decontam.contaminated(docs, bench).collect()}
    assert len(got) == len(texts)
    assert {k for k, (yes, _) in got.items() if yes} == {*range(len(at)), 2 * len(at)}
    assert {item for yes, item in got.values() if yes} == {5}


def test_verdicts_against_plain_windows(spark):
    """Every aligned pair of places around a shared seed, judged in plain Python."""
    rng = np.random.default_rng(9)
    items = [[f"w{x}" for x in rng.integers(0, 400, n)] for n in (9, 10, 11, 12, 13, 14, 30, 45)]
    texts = []
    for _ in range(150):
        part = list(items[rng.integers(0, len(items))])
        for k in rng.integers(0, len(part), rng.integers(0, 5)):
            part[k] = "other"
        texts.append([f"v{x}" for x in rng.integers(0, 400, rng.integers(0, 30))] + part
                     + [f"v{x}" for x in rng.integers(0, 400, rng.integers(0, 30))])

    def seeds(a, i):
        return {(m, tuple(a[i + k] for k, bit in enumerate(mask) if bit == "1")) for m, mask in enumerate(decontam.MASKS)}

    def found(text, item):
        width = min(len(item), decontam.WINDOW)
        need = decontam.AGREE if width == decontam.WINDOW else -(-width * 8 // 10)
        for i in range(len(text) - 8):
            for j in range(len(item) - 8):
                if seeds(text, i) & seeds(item, j):
                    same = [0 <= i + k < len(text) and 0 <= j + k < len(item) and text[i + k] == item[j + k]
                            for k in range(-decontam.BEFORE, decontam.AFTER + 1)]
                    if any(sum(same[k:k + width]) >= need for k in range(len(same) - width + 1)):
                        return True
        return False

    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    want = {i: [k for k, item in enumerate(items) if found(t, item)] for i, t in enumerate(texts)}
    assert 0 < sum(map(bool, want.values())) < len(texts)
    for r in decontam.contaminated(docs, bench).collect():
        hits = want[r["row"]["doc_id"]]
        assert (r["contaminated"], r["item"], r["n_items"]) == (bool(hits), min(hits, default=None), len(hits))


def test_merge_dropout_is_lossless(docs, none, rows):
    path = vocabulary("piece_bpe_32k.model")
    got = merge_dropout.encode(docs, path)
    got = got.withColumn("back", merge_dropout.decoder(path)(F.col("ids"))).collect()
    assert len(got) == len(rows)
    assert all(r["back"] == r["row"]["text"] for r in got)
    again = merge_dropout.encode(docs, path, decoded=True)
    assert again.where("NOT (decoded <=> row.text)").count() == 0
    assert merge_dropout.encode(none, path).count() == 0


def test_merges_without_dropout_and_with(monkeypatch):
    from sentencepiece import SentencePieceProcessor

    path = vocabulary("piece_bpe_32k.model")
    own, model = merge_dropout.Vocabulary(path), SentencePieceProcessor(model_file=path)
    for text in ("the theory of information", "a  b   c", "über façade naïve", "tokens, 12345!"):
        assert next(own.encode([" " + text], [1], 17, 0.0))[0].tolist() == model.encode(text)
    own = merge_dropout.Vocabulary(path)
    a, b = (x.tolist() for x in next(own.encode(["information theory " * 50] * 2, [1, 2], 17, 0.3)))
    monkeypatch.setattr(merge_dropout, "GROUP", 10)
    groups = list(own.encode(["information theory " * 50, None, "a"], [1, 1, 1], 17, 0.3))
    assert a != b and groups[0][0].tolist() == a and groups[1][0] is None


def test_words_are_numbered_once_and_forgotten_when_memory_is_full(monkeypatch):
    path = vocabulary("piece_bpe_32k.model")
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{int(i)}é" for i in rng.integers(0, 60, 40)) for _ in range(12)] + ["", None, "日本🙂" * 30]
    keys = list(range(len(texts)))

    def ids(own):
        return [None if x is None else x.tolist() for group in own.encode(texts, keys, -3, 0.3) for x in group]

    want = [next(merge_dropout.Vocabulary(path).encode([t], [k], -3, 0.3))[0] for t, k in zip(texts, keys)]
    want = [None if x is None else x.tolist() for x in want]
    whole = merge_dropout.Vocabulary(path)
    assert ids(whole) == want
    asked = []
    monkeypatch.setattr(whole, "segment_all", lambda pairs, *a: asked.extend(pairs) or [])
    assert ids(whole) == want and not asked  # all are known
    assert whole.n_known == whole.known.sum() and len(whole.made) == merge_dropout.VARIANTS * len(whole.numbers)
    monkeypatch.setattr(merge_dropout, "REMEMBERED", 50)
    monkeypatch.setattr(merge_dropout, "GROUP", 150)
    small = merge_dropout.Vocabulary(path)
    assert ids(small) == want and ids(small) == want
    assert small.n_known == small.known.sum() < whole.n_known
    assert len(small.known) == len(small.made) == merge_dropout.VARIANTS * len(small.numbers)
    assert all(bool(x) == bool(k) for x, k in zip(small.made, small.known))


def test_words_side_by_side_as_by_the_agenda(monkeypatch):
    path = vocabulary("piece_bpe_32k.model")
    rng = np.random.default_rng(3)
    letters = list("aeinorstlé▁日🙂%$1 ")
    words = ["".join(rng.choice(letters, int(n))) for n in rng.integers(1, 40, 400)] + [" information", "ing" * 50]
    pairs = [(w, int(v)) for w in words for v in (0, 1, 3)]
    own = merge_dropout.Vocabulary(path)
    for dropout in (0.0, 0.1, 0.6, 1.0):
        got = own.segment_all(pairs, 17, dropout)
        monkeypatch.setattr(merge_dropout, "SIDE_BY_SIDE", 0)
        assert got == own.segment_all(pairs, 17, dropout)
        monkeypatch.undo()
        assert all(own.decode(np.frombuffer(x, np.int32)) == w for x, (w, _) in zip(got, pairs))


def test_surrogates_are_distinct_and_consistent(spark, none):
    texts = ["Mail ann.lee@mail5.example.com or ANN.LEE@MAIL5.EXAMPLE.COM now", "IP 10.20.30.40, 10.20.30.41!",
             "card 4111111111111111 and 4111-1111-1111-1111", "call +1 (743) 555-3824", "Mrs. Anna Smith met Mr. Smith",
             'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "nothing 12 here", "", None, "г-жа Анна Петрова"]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(0, texts[0])], "doc_id long, text string")
    rows = surrogates.replace_entities(docs, "secret").collect()
    got = {r["row"]["doc_id"]: r["text"] for r in rows}
    assert len(rows) == len(texts) + 1
    for i in (6, 7, 8):
        assert got[i] == texts[i]
    mail = re.findall(r"\S+@\S+", got[0])
    assert mail[0].upper() == mail[1] and mail[0] != "ann.lee@mail5.example.com"
    assert len(set(re.findall(r"[\d.]{7,}", got[1]))) == 2 and "10.20.30" not in got[1]
    a, b = re.findall(r"[\d-]{16,}", got[2])
    assert a == b.replace("-", "") and b.count("-") == 3 and a[0] == "4"
    digits = [int(c) for c in reversed(a)]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4}", got[3]) and "743" not in got[3]
    first, last = re.fullmatch(r"Mrs\. (\w+) (\w+) met Mr\. \w+", got[4]).groups()
    assert first in surrogates.GIVEN["latin", "f"] and got[4].endswith(f"Mr. {last}")
    assert re.search('"[0-9a-f]{40}"', got[5]) and "24be" not in got[5]
    assert got[9].split()[1] in surrogates.GIVEN["cyrillic", "f"]
    assert surrogates.replace_entities(none, "secret").count() == 0


def test_colliding_surrogates_are_drawn_again(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "_surrogate", lambda key, kind, canon, attempt: F.concat(
        F.lit("x"), F.when(attempt == 0, F.lit("0")).otherwise(F.concat(canon, attempt.cast("string")))))
    found = spark.createDataFrame([("ip", str(i)) for i in range(5)], "kind string, canon string")
    got = surrogates.assign(found, "k").collect()
    assert len(got) == 5 and len({r["surrogate"] for r in got}) == 5


def test_kneser_ney_probabilities_add_up(spark, docs, none):
    texts = [("en", "the cat sat on the mat. " * 8), ("en", "the dog sat on the log. " * 6), ("fr", "le chat. " * 9)]
    model = kneser_ney.train(spark.createDataFrame(texts, "lang string, text string"))
    shard = kneser_ney._Shard(model.toArrow(), None, True)
    for context in (b"the ", b"zzzz", b"\n\n\n\n"):
        grams = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.int64)
        assert abs(np.exp(shard.log_p("en", grams)).sum() - 1) < 1e-9


def test_kneser_ney_shards_agree(spark, monkeypatch, docs):
    train = spark.createDataFrame([("en", "the cat sat on the mat. " * 8), ("fr", "le chat. " * 9)], "lang string, text string")
    model = kneser_ney.train(train)
    one = {r["row"]["doc_id"]: r["log_ppl"] for r in kneser_ney.perplexity(docs, model).collect()}
    monkeypatch.setattr(kneser_ney, "SHARD_ROWS", 40)
    for r in kneser_ney.perplexity(docs, model).collect():
        assert r["log_ppl"] == pytest.approx(one[r["row"]["doc_id"]], nan_ok=True)


def test_kneser_ney_shards_are_bounded_and_packed_by_tasks(spark, monkeypatch, docs, none):
    texts = [("en", "the cat sat on the mat. " * 8), ("fr", "le chat. " * 9), ("de", "der Hund und die Katze")]
    model = kneser_ney.train(spark.createDataFrame(texts, "lang string, text string"))

    def scores():
        return {r["row"]["doc_id"]: r["log_ppl"] for r in kneser_ney.perplexity(docs, model).collect()}

    one = scores()
    monkeypatch.setattr(kneser_ney, "SHARD_ROWS", 40)
    sent = []
    context = type(spark.sparkContext)
    whole = context.broadcast
    monkeypatch.setattr(context, "broadcast", lambda self, value: sent.append(value) or whole(self, value))
    for rows_per_pass in (kneser_ney.PASS_ROWS, 150):
        monkeypatch.setattr(kneser_ney, "PASS_ROWS", rows_per_pass)
        got = scores()
        assert got.keys() == one.keys()
        assert all(got[k] == pytest.approx(one[k], nan_ok=True) for k in one)
    # What the driver passes on at once has one language, and of long entries no more than a shard and a pair.
    shards = [pickle.loads(x) for x in sent]
    assert len(shards) > 8 and all(len(s.langs) == 1 for s in shards)
    assert all(sum(len(gram) for (_, kind, size), (gram, _) in s.tables.items()
                   if size >= 3 or size == 2 and kind == "g") < 80 for s in shards)
    monkeypatch.undo()
    assert kneser_ney.perplexity(none, model).count() == 0
    assert kneser_ney.perplexity(docs, model.limit(0)).where("log_ppl IS NOT NULL").count() == 0


def test_kneser_ney_judges(spark, none, docs, rows):
    rng = np.random.default_rng(3)
    texts = [(i, prose(rng, 80), "en") for i in range(80)] + [(100, "%$#@!^ *&()_ zqzq xkxk " * 20, "en"), (101, "", None)]
    frame = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(60)] + [(None,), (3,)], "doc_id long")
    got = {r["row"]["doc_id"]: r["kept"] for r in kneser_ney.judge(frame, trusted).collect()}
    assert all(got[i] for i in range(80)) and not got[100] and not got[101] and len(got) == 82
    assert kneser_ney.judge(docs, trusted.limit(0)).count() == len(rows)
    assert kneser_ney.judge(none, trusted).count() == 0


def test_chain_finds_toxic_texts(spark, none, docs, rows):
    rng = np.random.default_rng(4)
    texts, labels = [], []
    for i in range(240):
        toxic = i % 4 == 0
        texts.append((i, prose(rng, 60) + (" you idiot" if toxic else "") + " " + prose(rng, 20)))
        labels.append((i, int(i % 6 == 0), int(toxic)))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    known = spark.createDataFrame(labels[:160] + [(None, 1, 1), (5, None, 1)], "doc_id long, rude int, toxic int")
    chain = toxicity.train(frame, known, ["rude", "toxic"])
    got = {r["row"]["doc_id"]: r["is_toxic"] for r in toxicity.score(frame, chain).collect()}
    assert sum(got[i] == (i % 4 == 0) for i in range(160, 240)) >= 78
    assert toxicity.score(docs, chain).count() == len(rows)
    assert toxicity.score(none, chain).count() == 0
    assert toxicity.score(docs, toxicity.train(none, known.limit(0), ["rude", "toxic"])).count() == len(rows)
