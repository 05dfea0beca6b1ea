"""Tokenizing inside Python workers, with a memory of words that were met before."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from string import punctuation

import numpy as np

from tripledger.llm.word_bpe import byte_letters

#: Pieces a worker remembers before it forgets all but the first ones.
REMEMBERED, KEPT = 1_000_000, 700_000
#: Characters of text whose new words are encoded together.
GROUP = 4_000_000

#: White space besides single spaces and line feeds between words, and the byte used for cutting.
_ODD = ("  ", "\n\n", " \n", "\n ", *"\0\t\v\f\r\x1c\x1d\x1e\x1f")
_WIDE = (*"\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000", *map(chr, range(0x2000, 0x200B)))


def _odd(text: str) -> bool:
    if not text or text[0] in " \n" or text[-1] in " \n" or any(x in text for x in _ODD):
        return True
    return not text.isascii() and any(x in text for x in _WIDE)


class _Known(dict):
    """Ids of pieces; one that is looked up in vain is noted in `new`."""

    def __init__(self, *args):
        super().__init__(*args)
        self.new: list[str] = []

    def __missing__(self, piece: str) -> bytes:
        self.new.append(piece)
        return b""


class WordMemory:
    """Encodes whole texts with a byte-level BPE tokenizer, each frequent word once.

    The tokenizer's own first step cuts a text before every space that a word follows, around a
    line feed between two words, and between a letter or number and punctuation, so such pieces
    can be encoded alone: words of letters only by the tokenizer's merges, others by all its steps.
    Texts with any other white space, or with an added token, go to the tokenizer as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.line_feed = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        self.known = _Known({"\n": np.array([self.line_feed], self.dtype).tobytes()})

    def plain(self, texts: list[str]) -> list[bytes]:
        batch = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in batch]

    def _learn(self, pieces: list[str]) -> None:
        """Remembers pieces without line feeds, after those that they are made of."""
        made = []
        for piece in pieces:
            core = piece.rstrip(punctuation)
            if core != piece and core and core[-1].isalnum():
                made.append((piece, core, piece[len(core):]))
        cut = {piece for piece, _, _ in made}
        parts = dict.fromkeys(x for _, *both in made for x in both)
        rest = []
        for piece in [*parts, *(p for p in pieces if p not in cut)]:
            if piece in self.known:
                continue
            word = piece[1:] if piece[0:1] == " " else piece
            if word.isalpha():
                whole = (piece.replace(" ", self.letters[32]) if piece.isascii()
                         else "".join([self.letters[b] for b in piece.encode()]))
                self.known[piece] = array(self.dtype.char, [t.id for t in self.tokenize(whole)]).tobytes()
            else:
                rest.append(piece)
        if rest:
            self.known.update(self._encode_lines(rest))
        for piece, core, tail in made:
            self.known[piece] = self.known[core] + self.known[tail]

    def _encode_lines(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces without line feeds: encoded as the lines of one text, cut at line feeds."""
        ids = np.array(self.tokenizer.encode_batch_fast(
            ["\n".join(pieces)], add_special_tokens=False)[0].ids, self.dtype)
        cuts = np.flatnonzero(ids == self.line_feed)
        if len(cuts) != len(pieces) - 1:
            raise ValueError("the vocabulary joins line feeds with other text")
        size, raw = self.dtype.itemsize, ids.tobytes()
        starts = [0, *((cuts + 1) * size).tolist()]
        ends = [*(cuts * size).tolist(), len(raw)]
        return {p: raw[i:j] for p, i, j in zip(pieces, starts, ends)}

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts; words that are new to this worker are encoded together."""
        known, parts, out, waiting = self.known, [], [], []
        if len(known) > REMEMBERED:
            # Forget what came last: the first words met are the most frequent ones.
            for piece in list(islice(reversed(known), len(known) - KEPT)):
                del known[piece]
        of, new = known.__getitem__, known.new
        for text in texts:
            if _odd(text) or any(t in text for t in self.added):
                out.append(self.plain([text])[0])
                continue
            pieces = text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")
            before = len(new)
            out.append(b"".join(map(of, pieces)))
            if len(new) > before:
                waiting.append(len(out) - 1)
                parts.append(pieces)
        self._learn(list(dict.fromkeys(new)))
        new.clear()
        for at, pieces in zip(waiting, parts):
            out[at] = b"".join(map(of, pieces))
        return out

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of whole texts, in groups of about `GROUP` characters."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= GROUP:
                yield from self.encode_all(group)
                group, size = [], 0
        yield from self.encode_all(group)


@lru_cache(maxsize=1)
def word_memory(path: str) -> WordMemory:
    """One per worker and vocabulary file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordMemory(path)
