"""BPE with word ends: encoding by a contiguous rank array, and decoding.

A text is cut at white space into chunks, a chunk at added tokens and then, after normalizing,
by the vocabulary's pattern into words. Of a short word the part boundaries and the ranks of
adjacent parts lie in two short lists; the least rank is looked up by a scan, its inner boundary
is deleted, and the ranks to both sides are looked up again. A long word would make those scans
quadratic; its parts are linked and its ranks kept in a heap, with the same merges in the same
order (least rank first, leftmost first). A worker remembers a bounded number of words.

Null and empty texts have no tokens; a text of any length is encoded whole. Every input row gives
one output row, so repeated rows and ties need no rule. All input columns ride along in one
struct `row` and cannot clash with the columns added.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator, Sequence
from functools import cached_property, lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words up to this many bytes use the rank array.
SHORT = 160
#: Chunks and words a worker remembers, each; a full memory is emptied and fills again.
REMEMBERED = 250_000
#: Longer chunks are not remembered.
MEMORABLE = 48
#: Tokens after which an Arrow batch is sent on.
TOKENS = 500_000

_NONE = 1 << 30
#: Control characters that part words for Python, but not for the vocabulary's pattern.
_CONTROLS = "\x1c\x1d\x1e\x1f"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves; the others follow from U+0100 on.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


def _is_word_bpe(spec: dict) -> bool:
    """Whether a tokenizer file has the parts that this module knows, and no others."""
    model, (split, to_bytes) = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
    return (
        model["type"] == "BPE" and not model.get("unk_token") and not model.get("continuing_subword_prefix")
        and [n["type"] for n in spec["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"]
        and split["type"] == "Split" and split["invert"] and split["behavior"] == "Removed"
        and to_bytes["type"] == "ByteLevel" and not to_bytes["use_regex"] and not to_bytes["add_prefix_space"]
        and spec.get("decoder") is None
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"])
    )


class WordBpe:
    """Encodes and decodes with a tokenizer file of this kind; files of another kind are an error."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        try:
            known = _is_word_bpe(spec)
        except (KeyError, TypeError, ValueError):
            known = False
        if not known:
            raise ValueError("not a lower-case word BPE file")
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.inner = [vocab[c] for c in byte_letters()]
        self.last = [vocab[c + end] for c in byte_letters()]
        self.rank_of: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank_of[vocab[a] << 32 | vocab[b]] = rank
            self.merged.append(vocab[a + b])
        names = {**vocab, **added}
        self.tokens = np.empty(max(names.values()) + 1, object)
        self.tokens[:] = None
        for token, i in names.items():
            self.tokens[i] = token
        # White space is that of the Unicode property; no word spans it.
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")).findall
        self.chunks = regex.compile(r"\P{White_Space}+").findall
        self.added = {t: array("i", [i]).tobytes() for t, i in added.items()}
        self.path = path
        self.byte_of = {c: b for b, c in enumerate(byte_letters())}.__getitem__
        self.cut_added = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")").split
        self.mark = min(added, key=len)[0] if added else None
        self.known_words: dict[str, bytes] = {}
        self.known_chunks: dict[str, bytes] = {}

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def merge_short(self, ids: list[int]) -> list[int]:
        """All merges of one word, by scanning its ranks."""
        rank_of, merged = self.rank_of.get, self.merged
        ranks = [rank_of(a << 32 | b, _NONE) for a, b in zip(ids, ids[1:])]
        while ranks:
            least = min(ranks)
            if least == _NONE:
                break
            i = ranks.index(least)
            ids[i] = whole = merged[least]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of(ids[i - 1] << 32 | whole, _NONE)
            if i < len(ranks):
                ranks[i] = rank_of(whole << 32 | ids[i + 1], _NONE)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same merges for a word of any length, by a heap over linked parts."""
        rank_of, merged, n = self.rank_of.get, self.merged, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank_of(ids[i] << 32 | ids[i + 1], _NONE)) < _NONE]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or rank_of(ids[i] << 32 | ids[j], _NONE) != rank:
                continue  # one of its parts has been merged since
            ids[i], ids[j] = merged[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of(ids[i] << 32 | ids[k], _NONE)) < _NONE:
                    heappush(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := rank_of(ids[h] << 32 | ids[i], _NONE)) < _NONE:
                heappush(heap, (r, h))
        return [i for i in ids if i >= 0]

    def word(self, word: str) -> bytes:
        """Token ids of one word, 32 bits each."""
        found = self.known_words.get(word)
        if found is None:
            raw, inner = word.encode(), self.inner
            ids = [inner[b] for b in raw]
            ids[-1] = self.last[raw[-1]]
            found = array("i", self.merge_short(ids) if len(ids) <= SHORT else self.merge_long(ids)).tobytes()
            if len(word) <= MEMORABLE:
                if len(self.known_words) >= REMEMBERED:
                    self.known_words.clear()
                self.known_words[word] = found
        return found

    def piece(self, piece: str) -> bytes:
        """Token ids of text without white space and added tokens."""
        # Lower case letter by letter: a sigma at a word's end is no exception.
        plain = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
        if plain.isalpha():
            return self.word(plain)
        if plain[:-1].isalpha() and plain[-1] in ",.;:!?":
            return self.word(plain[:-1]) + self.word(plain[-1])
        if any(unicodedata.category(c) == "Cn" for c in plain):
            # Characters newer than this Python: the tokenizer's own tables decide how they part words.
            words = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(piece))
            # Each byte of a word is one letter here.
            return b"".join([self.word(bytes(map(self.byte_of, w)).decode()) for w, _ in words])
        return b"".join([self.word(w) for w in self.words(plain)])

    def chunk(self, chunk: str) -> bytes:
        """Token ids of text without white space."""
        if self.mark and self.mark in chunk:
            pieces = [p for p in self.cut_added(chunk) if p]
            found = b"".join([self.added[p] if p in self.added else self.piece(p) for p in pieces])
        else:
            found = self.piece(chunk)
        if len(chunk) <= MEMORABLE:
            if len(self.known_chunks) >= REMEMBERED:
                self.known_chunks.clear()
            self.known_chunks[chunk] = found
        return found

    def encode(self, text: str) -> bytes:
        """Token ids, 32 bits each, of a whole text."""
        known, chunk = self.known_chunks.get, self.chunk
        odd = any(c in text for c in _CONTROLS)
        return b"".join([chunk(c) if (ids := known(c)) is None else ids
                         for c in (self.chunks(text) if odd else text.split())])

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by one space; ids that are no token are left out."""
        ids = ids[(ids >= 0) & (ids < len(self.tokens))]
        return " ".join([t for t in self.tokens[ids] if t is not None])


@lru_cache(maxsize=1)
def codec(path: str) -> WordBpe:
    """One per worker and file."""
    return WordBpe(path)


def _lists(rows: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(rows), np.int32)))


def encode(docs: DataFrame, path: str, *, keep: Sequence[str] | None = None, decoded: bool = False) -> DataFrame:
    """`row`, `ids`: the token ids of every text, added tokens in a text included.

    `keep` names the columns that ride along in `row` (all, if none are named); `decoded` adds the
    text that the ids decode to.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            first, size, out = 0, 0, []
            for i, text in enumerate(batch.column("text")):
                out.append(own.encode(text.as_py() or ""))
                size += len(out[-1]) // 4
                if size >= TOKENS or i == batch.num_rows - 1:
                    part = [batch.column("row").slice(first, len(out)), _lists(out)]
                    if decoded:
                        part.append(pa.array([own.decode(np.frombuffer(x, np.int32)) for x in out], pa.string()))
                    yield pa.RecordBatch.from_arrays(part, schema.names)
                    first, size, out = i + 1, 0, []

    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)])
    whole = docs.select(row.alias("row"), F.col("text").alias("text"))
    added = {"ids": "array<int>", **({"decoded": "string"} if decoded else {})}
    schema = whole.select("row", *[F.lit(None).cast(t).alias(n) for n, t in added.items()]).schema
    return whole.mapInArrow(run, schema)


def decoder(path: str):
    """A column function from token ids to the decoded text; null ids give null."""

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        to_text, ids = codec(path).decode, ids.cast(pa.large_list(pa.int32()))
        ends, flat = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False)
        return pa.array([to_text(flat[a:b]) if ok else None
                         for a, b, ok in zip(ends[:-1], ends[1:], ids.is_valid().to_pylist())], pa.string())

    return decode


def digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids, joined by one space."""
    return F.sha2(F.array_join(ids.cast("array<string>"), " "), 256)
