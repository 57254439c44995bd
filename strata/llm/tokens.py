"""Token ids of whole texts with the ``tokenizers`` library, word by word through a cache.

Byte-pair models never merge across a space that stands between two other characters: the space
begins a new piece. So a text is the concatenation of its space-led words, and each distinct word
is encoded once per worker by the library and looked up afterwards. Texts with other white space
beside a space (where pieces can span several spaces), or with a special token's string, are encoded
whole by the library.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd

from strata.llm.common import byte_slices, span_hashes

#: A space inside or at the end of a run of white space: word boundaries are not plain there.
_RUN = re.compile(r"\s \s|\s \Z")
_ENCODERS: dict[str, "Encoder"] = {}
#: Words that the library gets in one string, with a special token between them.
TOGETHER = 8192


class WordTable:
    """Numbers of 64-bit hashes in the order they came, by open addressing; at least half of ``1 << bits`` slots stay free."""

    def __init__(self, bits: int):
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.number = np.zeros(1 << bits, np.int32)
        self.size, self.most = 0, 1 << (bits - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each (non-zero) hash, -1 for unknown ones."""
        out, at, todo = np.full(len(keys), -1, np.int64), self._slots(keys), np.arange(len(keys))
        while len(todo):
            held = self.keys[at]
            hit = held == keys[todo]
            out[todo[hit]] = self.number[at[hit]]
            more = ~hit & (held != 0)
            todo, at = todo[more], (at[more] + 1) & self.mask
        return out

    def add(self, keys: np.ndarray) -> int:
        """Numbers as many of the distinct, unknown hashes as there is room for, the first ones; returns how many."""
        keys = keys[: self.most - self.size]
        number = np.arange(self.size, self.size + len(keys), dtype=np.int32)
        at, todo = self._slots(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[todo[free]]  # of several for one slot the last stays
            won = self.keys[at] == keys[todo]
            self.number[at[won]] = number[todo[won]]
            todo, at = todo[~won], (at[~won] + 1) & self.mask
        self.size += len(keys)
        return len(keys)


class Encoder:
    """Encodes batches of texts; its cache holds the first ``1 << (bits - 1)`` distinct words (about 40 bytes each).

    Once it is full, other words are encoded by the library each time they come in a slice. Texts
    with a special token's string are encoded whole, as the library does by default.
    """

    def __init__(self, path: str, bits: int = 22):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = sorted((a.content, i) for i, a in self.tokenizer.get_added_tokens_decoder().items())
        self.special = re.compile("|".join(re.escape(c) for c, _ in special) or r"(?!)", re.IGNORECASE)
        self.hints = {re.match("[^\\w]*", c)[0] for c, _ in special}  # quick to look for: most texts have none
        self.mark = next(((c.encode(), i) for c, i in special if not self.tokenizer.get_added_tokens_decoder()[i].normalized), None)
        self.kind = np.uint16 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.uint32
        self.table = WordTable(bits)
        self.place = np.zeros(self.table.most, np.uint32)  # of a word's ids in ``flat``
        self.length = np.zeros(self.table.most, np.uint32)
        self.flat = np.zeros(1 << 16, self.kind)
        self.used = 0

    @classmethod
    def get(cls, path: str) -> "Encoder":
        """One encoder per worker process and file, so its cache serves all tasks there."""
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def _odd(self, text: str) -> bool:
        return not text or _RUN.search(text) is not None or any(h in text for h in self.hints) and self.special.search(text) is not None

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after another, and each word's number of ids.

        Words go to the library in long strings, parted by a special token: it never merges across
        one, and the token's id shows where a word ends.
        """
        if self.mark is None:
            found = [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]
            return np.concatenate([np.zeros(0, self.kind), *found]), np.fromiter(map(len, found), np.int64, len(found))
        name, mark = self.mark
        parts = []
        for a in range(0, len(words), TOGETHER):
            text = name.join(words[a : a + TOGETHER]) + name
            parts.append(np.array(self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, self.kind))
        ids = np.concatenate([np.zeros(0, self.kind), *parts])
        ends = np.flatnonzero(ids == mark)
        return ids[ids != mark], np.diff(ends, prepend=-1) - 1

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of texts in which every space separates two words."""
        raw = " ".join(texts).encode("utf-8", "replace")
        codes = np.frombuffer(raw, np.uint8)
        cuts = np.flatnonzero(codes == 32)
        starts = np.concatenate(([0], cuts + 1))
        ends = np.concatenate((cuts, [len(codes)]))
        words_in = np.fromiter((t.count(" ") + 1 for t in texts), np.int64, len(texts))
        first = np.zeros(len(starts), bool)
        first[np.concatenate(([0], np.cumsum(words_in)[:-1]))] = True
        keys = span_hashes(codes, starts, ends)
        keys[first] ^= np.uint64(0x5851F42D4C957F2D)  # a text's first word has no space in front
        keys[keys == 0] = 1
        place, distinct = pd.factorize(keys)
        number = self.table.find(distinct)
        new = np.flatnonzero(number < 0)
        known = np.maximum(number, 0)
        size, begin = self.length[known].astype(np.int64), self.place[known].astype(np.int64)
        if len(new):
            where = np.empty(len(distinct), np.int64)
            where[place[::-1]] = np.arange(len(place) - 1, -1, -1)  # the first occurrence of each word
            at = where[new]
            ids, more = self._words([raw[s:e] for s, e in zip((starts[at] - ~first[at]).tolist(), ends[at].tolist(), strict=True)])
            while self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
            self.flat[self.used : self.used + len(ids)] = ids
            size[new], begin[new] = more, self.used + np.cumsum(more) - more
            stay, old = self.table.add(distinct[new]), self.table.size
            self.place[self.table.size - stay : old], self.length[self.table.size - stay : old] = begin[new][:stay], more[:stay]
            self.used += int(more[:stay].sum())  # the others' ids are written over by the next slice
        size, begin = size[place], begin[place]
        done = np.cumsum(size)
        ids = self.flat[np.repeat(begin - (done - size), size) + np.arange(done[-1])]
        ends_at = np.cumsum(words_in) - 1
        return ids, np.diff(np.concatenate(([0], done[ends_at])))

    def encode(self, texts: list[str | None], most: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order as uint32, number of ids of each text); NULL is empty."""
        texts = [t or "" for t in texts]
        odd = np.fromiter(map(self._odd, texts), bool, len(texts))
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        pieces: list[np.ndarray | None] = [None] * len(texts)
        plain = np.flatnonzero(~odd)
        for a, b in byte_slices(sizes[plain], most):
            rows = plain[a:b]
            ids, n = self._plain([texts[r] for r in rows])
            for r, piece in zip(rows, np.split(ids, np.cumsum(n)[:-1]), strict=True):
                pieces[r] = piece
        for r in np.flatnonzero(odd):
            pieces[r] = np.array(self._whole(texts[r]) if texts[r] else [], np.uint32)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        return (np.concatenate(pieces) if pieces else np.zeros(0, np.uint32)).astype(np.uint32, copy=False), lengths
