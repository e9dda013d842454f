"""Word-wise encoding with a public tokenizer, for whole Arrow packs of texts.

A text's ids are the ids of its pieces between blanks, one after another, as no token of a
word tokenizer spans white space.  So each distinct piece is encoded once and the ids of the
texts are gathered with numpy.  Pieces are known by two 64-bit hashes;
the ids learnt stay in a bounded table of the worker.
"""

from __future__ import annotations

import os
import unicodedata
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from lectern.llm.common import byte_table, utf8, words

#: pieces kept per Python worker; the cache starts anew beyond it
CACHE_PIECES = 800_000


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class _Letters(dict):
    """Letter -> the model's spelling of its bytes, as the vocabulary's pre-tokenizer gives it."""

    def __init__(self, pre):
        super().__init__()
        self.pre = pre

    def __missing__(self, code: int) -> str:
        self[code] = "".join(s for s, _ in self.pre.pre_tokenize_str(chr(code)))
        return self[code]


#: any byte but blank and newline is in a piece
_PIECE = byte_table(lambda b: b not in (10, 32))
_LOWER = byte_table(lambda b: True)
_LOWER[0] = 0


class PieceEncoder:
    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.letters = _Letters(self.tok.pre_tokenizer)
        self.limit = cache_pieces
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # hashes, sorted
        self.check = np.zeros(0, np.uint64)  # second hash of each
        self.at = np.zeros(0, np.int64)  # its place in the pool
        self.size = np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.uint32)

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, ids in each)."""
        # a full stop or comma after a letter or digit is a token of its own
        bare = {p: None for p in pieces}
        for p in pieces:
            if p[-1] in ".," and p[-2:-1].isalnum():
                bare[p[:-1]] = bare[p[-1]] = None
        rest, tokenize, letters = [], self.model.tokenize, self.letters
        for p in bare:
            if p.isascii() and p.isalpha() or p.isalpha() and p.islower() and unicodedata.is_normalized("NFC", p):
                # letters alone, already normalised: one word for the model
                bare[p] = array("I", [t.id for t in tokenize(p if p.isascii() else p.translate(letters))])
            elif not (p[-1] in ".," and p[-2:-1].isalnum()):
                rest.append(p)
        for p, e in zip(rest, self.tok.encode_batch_fast(rest, add_special_tokens=False)):
            bare[p] = array("I", e.ids)
        found = [bare[p] if bare[p] is not None else bare[p[:-1]] + bare[p[-1]] for p in pieces]
        return (np.frombuffer(b"".join(found), np.uint32),
                np.fromiter(map(len, found), np.int32, len(found)))

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts as uint32, n + 1 offsets of the texts)."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
        texts = pc.fill_null(texts, "")
        if len(texts) == 0:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        # strings of special tokens are looked up in the raw text, so such texts go as they are
        odd = pc.match_substring(texts, "<|")
        if pc.any(odd).as_py():
            return self._whole(texts, odd)
        buf, off = utf8(texts)
        s, e, h, first, h2 = words(buf, _PIECE, off, twice=True)
        if not len(s):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        code, seen = pd.factorize(h)
        one = np.empty(len(seen), np.int64)  # an occurrence of each piece
        one[code] = np.arange(len(code))
        lower = _LOWER[buf]
        check = h2[one]
        if (check[code] != h2).any():  # two pieces of the pack share a hash
            return self._whole(texts, pa.array([True] * len(texts)))
        if len(self.known) + len(seen) > self.limit:
            self._forget()
        place = np.searchsorted(self.known, seen)
        hit = place < len(self.known)
        hit[hit] = self.known[place[hit]] == seen[hit]
        if (self.check[place[hit]] != check[hit]).any():
            self._forget()  # two pieces with one hash: start anew
            hit[:] = False
        new = np.flatnonzero(~hit)
        if len(new):
            raw = lower.tobytes()
            pieces = [raw[a:b].decode() for a, b in zip(s[one[new]].tolist(), e[one[new]].tolist())]
            ids, size = self._ids(pieces)
            at = len(self.pool) + np.cumsum(size, dtype=np.int64) - size
            self.pool = np.concatenate([self.pool, ids])
            keys = np.concatenate([self.known, seen[new]])
            by = np.argsort(keys, kind="stable")
            self.known = keys[by]
            self.check = np.concatenate([self.check, check[new]])[by]
            self.at = np.concatenate([self.at, at])[by]
            self.size = np.concatenate([self.size, size])[by]
            place = np.searchsorted(self.known, seen)
        count = self.size[place][code]
        total = np.zeros(len(code) + 1, np.int64)
        np.cumsum(count, out=total[1:])
        idx = np.repeat((self.at[place][code] - total[:-1]).astype(np.int32), count)
        idx += np.arange(total[-1], dtype=np.int32)
        return self.pool[idx], total[first]

    def _whole(self, texts, odd) -> tuple[np.ndarray, np.ndarray]:
        ids, off = [], [0]
        for t, o in zip(texts, odd):
            one = (np.array(self.tok.encode(t.as_py(), add_special_tokens=False).ids, np.uint32) if o.as_py()
                   else self.encode(pa.array([t.as_py()]))[0])
            ids.append(one)
            off.append(off[-1] + len(one))
        return np.concatenate(ids), np.array(off, np.int64)


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
