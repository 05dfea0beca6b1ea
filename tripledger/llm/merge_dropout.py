"""SentencePiece BPE with seeded merge dropout, and its lossless decoder.

A text is cut before each run of spaces; pieces never cross such a cut, so each word is segmented
alone. An agenda holds the possible merges of neighbouring symbols, best vocabulary score first;
each candidate that is taken from it is skipped if a hash keyed by the seed, the word's variant
and the candidate says so, and is then gone for this word. Which of `VARIANTS` variants a word
occurrence follows is a keyed hash of document and place, so one word is segmented in several
ways, and a worker can remember (word, variant).
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripledger.llm.common import packed

SPACE = "▁"  # stands for a space inside pieces
DROPOUT = 0.1
VARIANTS = 4
#: (word, variant) pairs remembered per worker.
REMEMBERED = 200_000
#: Characters of text whose new words are segmented together.
GROUP = 1_000_000
#: Words of up to so many characters are segmented side by side, `TOGETHER` at once.
SIDE_BY_SIDE = 64
TOGETHER = 4096
#: Symbol of a character that no piece holds; rank of a pair that makes no piece.
OTHER = -2
NEVER = 1 << 40
_ALL = (1 << 64) - 1

#: No piece holds a space after another character, or a line feed.
_WORD = re.compile(r" *[^ \n]+|\n| +")


def _drawn(base: np.ndarray, place: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Keyed hash of merge candidates: `base` stands for seed, variant and word."""
    x = base + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + piece.astype(np.uint64) * np.uint64(
        0xC2B2AE3D27D4EB4F)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class _Numbers(dict):
    """Words numbered as they come; the last ones can be taken back."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class Pieces:
    """What each id decodes to."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.ids, self.scores, self.bytes_of = {}, {}, [b""] * n
        self.byte_ids = [-1] * 256
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value], self.bytes_of[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece], self.scores[piece] = i, model.get_score(i)
                self.bytes_of[i] = piece.replace(SPACE, " ").encode()

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "surrogatepass")


class Vocabulary(Pieces):
    """Segments words, and remembers those it has met."""

    def __init__(self, path: str):
        super().__init__(path)
        # Word k has the pairs from VARIANTS * k on; `made` has the ids of those that are `known`.
        self.numbers = _Numbers()
        self.made: list[bytes] = []
        self.known = np.zeros(0, bool)
        self.n_known = 0
        self._merges()

    def _merges(self) -> None:
        """The table of merges: two symbols side by side, the piece they make and its rank.

        Symbols are pieces, and characters that are no piece but occur in some; `OTHER` stands for
        every further character. Rank 0 is the best score.
        """
        names = dict(self.ids)
        for piece in self.ids:
            for c in piece:
                names.setdefault(c, len(self.bytes_of) + len(names))
        ranks = {score: k for k, score in enumerate(sorted(set(self.scores.values()), reverse=True))}
        self.of_code = np.full(0x110000, OTHER, np.int64)
        for c, symbol in names.items():
            if len(c) == 1:
                self.of_code[ord(c)] = symbol
        self.of_code[ord(" ")], self.of_code[ord(SPACE)] = names.get(SPACE, OTHER), OTHER
        made = []
        for piece, own in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = names.get(piece[:cut]), names.get(piece[cut:])
                if left is not None and right is not None:
                    made.append((left << 32 | right, own, ranks[self.scores[piece]]))
        made.sort()
        self.joins, self.makes, self.ranks = (np.array([m[k] for m in made], np.int64) for k in range(3))

    def _found(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The piece that two symbols make, and its rank: `NEVER` if none."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.joins, key), len(self.joins) - 1)
        return self.makes[at], np.where((self.joins[at] == key) & (right >= 0), self.ranks[at], NEVER)

    def symbols(self, words: list[str]) -> np.ndarray:
        """The symbols of all characters. A literal U+2581 and what no piece holds are `OTHER`."""
        return self.of_code[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)]

    def segment(self, word: str, base: int, limit: int) -> list[tuple[int, int]]:
        """(place, symbol) of a word's symbols after all merges, by an agenda in a heap."""
        symbols: list[int | None] = self.symbols([word]).tolist()
        following = list(range(1, len(symbols))) + [-1]
        before = [-1, *range(len(symbols) - 1)]
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = following[i]
            if i >= 0 and j >= 0:
                made, rank = self._found(np.array([symbols[i]]), np.array([symbols[j]]))
                if rank[0] < NEVER:
                    heapq.heappush(agenda, (int(rank[0]), i, symbols[i], symbols[j], int(made[0])))

        for i in range(len(symbols) - 1):
            offer(i)
        while agenda:
            _, i, left, right, made = heapq.heappop(agenda)
            j = following[i]
            if j < 0 or symbols[i] != left or symbols[j] != right:
                continue  # one side has changed since
            if limit and int(_drawn(np.uint64(base), np.array([i]), np.array([made]))[0]) < limit:
                continue
            symbols[i], symbols[j] = made, None
            following[i] = following[j]
            if following[j] >= 0:
                before[following[j]] = i
            offer(before[i])
            offer(i)
        return [(i, s) for i, s in enumerate(symbols) if s is not None]

    def _segment_alike(self, symbols: np.ndarray, base: np.ndarray, limit: int) -> np.ndarray:
        """The same agenda for many words of one length side by side: -1 where a symbol was merged away.

        Whether a candidate is skipped hangs on its key alone, so it is drawn when it is offered.
        """
        n, width = symbols.shape
        sym = np.full((n, width + 1), OTHER, np.int64)  # a last column ends each word
        sym[:, :width] = symbols
        following = np.tile(np.arange(1, width + 2), (n, 1))
        before = np.tile(np.arange(-1, width), (n, 1))
        made = np.zeros((n, width), np.int64)
        rank = np.full((n, width), NEVER, np.int64)

        def offer(r: np.ndarray, i: np.ndarray) -> None:
            piece, best = self._found(sym[r, i], sym[r, following[r, i]])
            if limit:
                hit = np.flatnonzero(best < NEVER)
                skipped = _drawn(base[r[hit]], i[hit], piece[hit]) < np.uint64(limit)
                best[hit[skipped]] = NEVER
            made[r, i], rank[r, i] = piece, best

        every = np.arange(n)
        offer(np.repeat(every, width - 1), np.tile(np.arange(width - 1), n))
        live = every
        while len(live):
            own = rank[live]
            i = own.argmin(axis=1)
            open_ = own[np.arange(len(live)), i] < NEVER
            live, i = live[open_], i[open_]
            j = following[live, i]
            sym[live, i], sym[live, j] = made[live, i], -1
            rank[live, j] = NEVER
            after = following[live, j]
            following[live, i] = after
            before[live, after] = i
            offer(live, i)
            left = before[live, i]
            has = left >= 0
            offer(live[has], left[has])
        return sym[:, :width]

    def _written(self, word: str, placed: list[tuple[int, int]]) -> bytes:
        out = []
        for i, s in placed:
            if 0 <= s < len(self.bytes_of):
                out.append(s)
            else:  # a single character without a piece
                out += [self.byte_ids[b] for b in word[i].encode("utf-8", "surrogatepass")]
        return np.array(out, np.int32).tobytes()

    def segment_all(self, pairs: list[tuple[str, int]], seed: int, dropout: float) -> list[bytes]:
        """Ids of (word, variant) pairs: short words of one length together, longer ones alone."""
        from xxhash import xxh64_intdigest

        limit, key = min(int(dropout * (1 << 64)), _ALL), seed & _ALL
        bases = np.array([xxh64_intdigest(f"{v}\0{w}".encode("utf-8", "surrogatepass"), key) for w, v in pairs],
                         np.uint64)
        words = [w for w, _ in pairs]
        widths = np.fromiter(map(len, words), np.int64, len(words))
        by_width = np.argsort(widths, kind="stable")
        out: list[bytes] = [b""] * len(pairs)
        for places in np.split(by_width, np.flatnonzero(np.diff(widths[by_width])) + 1):
            width = int(widths[places[0]]) if len(places) else 0
            if width > SIDE_BY_SIDE:
                for at in places.tolist():
                    out[at] = self._written(words[at], self.segment(words[at], int(bases[at]), limit))
                continue
            for k in range(0, len(places), TOGETHER):
                chosen = places[k:k + TOGETHER]
                some = chosen.tolist()
                start = self.symbols([words[at] for at in some]).reshape(len(some), width)
                sym = self._segment_alike(start, bases[chosen], limit)
                # Words of pieces alone are cut from one array; the others are written one by one.
                there = sym != -1
                odd = (there & ((sym < 0) | (sym >= len(self.bytes_of)))).any(axis=1)
                raw = sym[there].astype(np.int32).tobytes()
                begin = 0
                for at, end in zip(some, (4 * np.cumsum(there.sum(axis=1))).tolist()):
                    out[at] = raw[begin:end]
                    begin = end
                for k_odd in np.flatnonzero(odd).tolist():
                    word = words[some[k_odd]]
                    placed = [(i, s) for i, s in enumerate(sym[k_odd].tolist()) if s != -1]
                    out[some[k_odd]] = self._written(word, placed)
        return out

    def encode_all(self, texts: list[str], documents: list[int], seed: int, dropout: float) -> list[np.ndarray]:
        """Ids of whole texts, whose new words are segmented together.

        The first word of a text carries no extra space in front.
        """
        numbers, made = self.numbers, self.made
        before, room = len(numbers), self.n_known < REMEMBERED
        parts = [_WORD.findall(text) for text in texts]
        words = list(chain.from_iterable(parts))
        pairs = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) * VARIANTS
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(sizes)
        if dropout:
            # A keyed mix of document and place gives each occurrence its variant.
            place = (np.arange(len(words)) - np.repeat(ends - sizes, sizes)).astype(np.uint64) + np.repeat(
                np.array([(d ^ seed) & _ALL for d in documents], np.uint64), sizes)
            place = (place ^ (place >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            pairs += (place >> np.uint64(32)).astype(np.int64) % VARIANTS
        grown = VARIANTS * (len(numbers) - before)
        made += [b""] * grown
        self.known = np.append(self.known, np.zeros(grown, bool))
        lacking = np.flatnonzero(~self.known[pairs])
        new, first = np.unique(pairs[lacking], return_index=True)
        segmented = self.segment_all(
            list(zip(map(words.__getitem__, lacking[first].tolist()), (new % VARIANTS).tolist())), seed, dropout)
        new = new.tolist()
        for pair, ids in zip(new, segmented):
            made[pair] = ids
        ids_of = list(map(made.__getitem__, pairs.tolist()))
        out, start = [], 0
        for end in ends.tolist():
            out.append(np.frombuffer(b"".join(ids_of[start:end]), np.int32))
            start = end
        if room:
            self.known[new] = True
            self.n_known += len(new)
        else:
            for pair in new:
                made[pair] = b""
            for _ in range(len(numbers) - before):
                numbers.popitem()
            del made[VARIANTS * before:]
            self.known = self.known[:VARIANTS * before]
        return out

    def encode(self, texts: list[str | None], documents: list[int], seed: int,
               dropout: float) -> Iterator[list[np.ndarray | None]]:
        """Ids of whole texts, null for null: one list per group of about `GROUP` characters."""
        start = size = 0
        for end, text in enumerate(texts, 1):
            size += len(text or "")
            if size >= GROUP or end == len(texts):
                some = texts[start:end]
                ids = self.encode_all([t or "" for t in some], documents[start:end], seed, dropout)
                yield [None if t is None else x for t, x in zip(some, ids)]
                start, size = end, 0


@lru_cache(maxsize=1)
def pieces(path: str) -> Pieces:
    """One per worker."""
    return Pieces(path)


@lru_cache(maxsize=2)
def vocabulary(path: str, seed: int, dropout: float) -> Vocabulary:
    """One per worker; what it remembers holds for one seed and dropout."""
    return Vocabulary(path)


def encode(docs: DataFrame, path: str, seed: int = 17, dropout: float = DROPOUT,
           key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """`row` and `ids` (array<int>), the pieces of the whole text; with `decoded` also the text
    that they decode to, made by the same worker.

    Equal key, text and seed give equal ids. Null texts give null, empty texts no id. Null keys
    count as one key. Without dropout the ids are the plain BPE segmentation.
    """
    rows = packed(docs, document=F.xxhash64(F.col(key)))
    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if decoded:
        schema.add("decoded", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(path, seed, dropout)
        for batch in batches:
            row, start = batch.column("row"), 0
            texts = row.field(text).to_pylist()
            # Small batches leave as soon as they are encoded.
            for ids in own.encode(texts, batch.column("document").to_pylist(), seed, dropout):
                out = [row.slice(start, len(ids)), pa.array(ids, pa.list_(pa.int32()))]
                if decoded:
                    out.append(pa.array([None if x is None else own.decode(x.tolist()) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=schema.names)
                start += len(ids)

    return rows.mapInArrow(run, schema)


def decoder(path: str):
    """A column function from ids back to the text, byte for byte; null stays null."""
    @F.pandas_udf("string")
    def decoded(ids: pd.Series) -> pd.Series:
        own = pieces(path)
        return pd.Series([None if x is None else own.decode(x.tolist()) for x in ids], dtype=object)

    def of(ids: Column) -> Column:
        return decoded(ids)

    return of
