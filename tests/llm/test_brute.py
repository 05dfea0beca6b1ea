"""Results of earlier operators against plain Python, written from their descriptions alone."""

import re
from collections import Counter
from math import log

import pytest
import xxhash

from tripledger.llm import kneser_ney
from tripledger.llm.queries import op2_simhash

SF_DIR = "/root/testdata/sf0.001"


def fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_simhash_fingerprints_and_components(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    prints = {d: fingerprint(t) for d, t in texts.items()}
    group = {d: d for d in prints}

    def root(d):
        while group[d] != d:
            d = group[d]
        return d

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((root(a), root(b)))
                group[y] = x
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op2_simhash(spark, SF_DIR).collect()}
    assert got == {d: (f"{p:016x}", root(d)) for d, p in prints.items()}


class Plain:
    """Interpolated modified Kneser-Ney over bytes, order 5."""

    def __init__(self, texts):
        counts = Counter()
        for t in texts:
            raw = b"\n" * 4 + t.encode()
            counts.update(raw[i:i + 5] for i in range(len(raw) - 4))
        self.counts = {5: counts}
        for size in (4, 3, 2, 1):
            self.counts[size] = Counter(g[1:] for g in self.counts[size + 1])
        self.models = {size: self.model(self.counts[size]) for size in self.counts}

    def model(self, counts):
        n = Counter(counts.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0.5
        d = {k: max(0.05, min(k, k - (k + 1) * y * (n[k + 1] / n[k] if n[k] else 0.5))) for k in (1, 2, 3)}
        total, off = Counter(), Counter()
        for g, c in counts.items():
            total[g[:-1]] += c
            off[g[:-1]] += d[min(c, 3)]
        return {g: (c - d[min(c, 3)]) / total[g[:-1]] for g, c in counts.items()}, {c: off[c] / total[c] for c in total}

    def p(self, gram):
        if not gram:
            return 1 / 256
        own, weight = self.models[len(gram)]
        below = self.p(gram[1:])
        context = gram[:-1]
        return own.get(gram, 0.0) + weight[context] * below if context in weight else below

    def log_ppl(self, text):
        raw = b"\n" * 4 + text.encode()
        return -sum(log(self.p(raw[i:i + 5])) for i in range(len(raw) - 4)) / (len(raw) - 4)


@pytest.mark.parametrize("rows_per_shard", [kneser_ney.SHARD_ROWS, 60])
def test_perplexity(spark, monkeypatch, rows_per_shard):
    monkeypatch.setattr(kneser_ney, "SHARD_ROWS", rows_per_shard)
    trusted = [("en", "the cat sat on the mat, and the dog sat on the log. " * 3), ("en", "a cat and a dog, a hat and a log"),
               ("fr", "le chat est sur le tapis; où est le chien? "), ("fr", "é"), ("de", "der Hund")]
    sent = [("en", "the dog and the cat"), ("en", "zzz\n\nthe"), ("fr", "le chien est sur"), ("de", "Hund der"), ("xx", "the chat"),
            (None, "où"), ("en", "é日"), ("fr", "x")]
    model = kneser_ney.train(spark.createDataFrame(trusted, "lang string, text string"))
    docs = spark.createDataFrame([(i, lang, t) for i, (lang, t) in enumerate(sent)], "id int, lang string, text string")
    got = {r["row"]["id"]: r["log_ppl"] for r in kneser_ney.perplexity(docs, model).collect()}
    plain = {x: Plain([t for lang, t in trusted if lang == x]) for x in ("en", "fr", "de")}
    pooled = Plain([])
    pooled.counts[5] = sum((plain[x].counts[5] for x in plain), Counter())
    for size in (4, 3, 2, 1):
        pooled.counts[size] = Counter(g[1:] for g in pooled.counts[size + 1])
    pooled.models = {size: pooled.model(c) for size, c in pooled.counts.items()}
    for i, (lang, text) in enumerate(sent):
        assert got[i] == pytest.approx(plain.get(lang, pooled).log_ppl(text), rel=1e-9), (lang, text)
