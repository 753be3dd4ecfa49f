"""Byte-level BPE ids for many texts, fast: pre-tokens by array operations, each distinct one encoded once.

The pre-tokens are those of the pattern
    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
found from the runs of letters, numbers, white space and others in the text's code points. A pre-token's ids don't depend on its
neighbours, so only the distinct ones are encoded, and a table of fixed size keeps what has been seen, by the bytes. Where the file's merges are in the order of their ids, as in byte-level
vocabularies of this kind, single pre-tokens are encoded by rank, which gives the tokenizer's own ids; otherwise by the tokenizer. Texts with characters from
U+0530 on (whose class may differ between Unicode versions) or with a special token's string go to the tokenizer whole.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from itertools import chain

import numpy as np

from .words import mix

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
FAST_BELOW = 0x530
SPECIAL = "<|endoftext|>"
#: Places for pre-tokens that have been seen (a power of two), of at most 16 bytes and so many ids.
PLACES, MOST_IDS = 1 << 19, 8


def _classes(end: int) -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER, "Z": SPACE}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(end)], np.uint8)
    out[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x85]] = SPACE
    return out


_CLASS = _classes(FAST_BELOW)


_BEYOND = re.compile(f"[{chr(FAST_BELOW)}-{chr(0x10FFFF)}]")
_CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")  # fixed values of the pattern


def starts_of(code: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin, in code points; code: those of all texts, offsets: where each text begins (and the last ends)."""
    n = len(code)
    if not n:
        return np.zeros(0, np.int64)
    kind = _CLASS[code]
    edge = np.ones(n, bool)  # a run begins
    edge[1:] = kind[1:] != kind[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    edge[inner] = True
    begin = np.flatnonzero(edge)
    end = np.append(begin[1:], n)
    first_of_text = np.zeros(n + 1, bool)
    first_of_text[offsets] = True
    white = kind[begin] == SPACE
    follows = white & ~first_of_text[end]  # something of the same text comes behind
    last = code[end - 1]
    joins = follows & (last == 0x20)  # its last space belongs to what follows
    length = end - begin
    mark = np.zeros(n, bool)
    mark[begin[~white]] = True
    mark[begin[white & ~(joins & (length == 1))]] = True
    mark[end[follows] - 1] = True  # the last white character behind others stands alone or leads the next run
    after = end[joins]
    mark[after] = False
    # Contractions: an apostrophe that is a run of its own with no space joined to it, before certain letters.
    alone = begin[(code[begin] == 0x27) & (length == 1)]
    alone = alone[mark[alone]]
    for i in alone.tolist():
        stop = i + 1
        while stop < n and stop - i < 4 and kind[stop] == LETTER and not first_of_text[stop]:
            stop += 1
        tail = "".join(map(chr, code[i + 1 : stop]))
        for c in _CONTRACTIONS:
            if tail.startswith(c):
                mark[i + 1] = False
                at = i + 1 + len(c)
                if at < n and not first_of_text[at]:
                    mark[at] = mark[at] or kind[at] == LETTER
                break
    return np.flatnonzero(mark)


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, the others from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def _ranked(path: str):
    """A fast encoder of single pre-tokens, if the file's merges are in the order of their ids (then ids are ranks); else None."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    byte = _byte_of()
    vocabulary = model["vocab"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if any(vocabulary.get(a + b) != 256 + k for k, (a, b) in enumerate(merges)):
        return None
    ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items() if i < 256 + len(merges)}
    return tiktoken.Encoding("file", pat_str=r"(?s:.)+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


def split(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes, where pre-tokens begin and end in them, and where each text's pre-tokens begin."""
    every = "".join(texts)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    data = every.encode()
    if len(data) == len(every):
        begin = starts_of(np.frombuffer(data, np.uint8), offsets)
        s, e = begin, np.append(begin[1:], len(data)) if len(begin) else begin
    else:
        code = np.frombuffer(every.encode("utf-32-le"), np.uint32)
        begin = starts_of(code, offsets)
        raw = np.frombuffer(data, np.uint8)
        lead = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
        s, e = lead[begin], lead[np.append(begin[1:], len(code))] if len(begin) else begin
    return data, s, e, np.searchsorted(begin, offsets)


def _edges(data: bytes, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last eight bytes of each span, or all of a shorter one."""
    padded = np.frombuffer(bytes(8) + data + bytes(8), np.uint8)
    words = np.ndarray((len(padded) - 7,), np.uint64, padded, strides=(1,))
    short = np.minimum(e - s, 8).astype(np.uint64)
    cut = np.where(short < 8, (np.uint64(1) << (short * np.uint64(8) & np.uint64(63))) - np.uint64(1), ~np.uint64(0))
    return words[s + 8] & cut, np.where(e - s > 8, words[e], np.uint64(0))


def _key(head: np.ndarray, tail: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    return mix(head ^ mix(tail + (e - s).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def distinct(data: bytes, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each different span, and for each span which it is. Spans are told apart by their bytes, not by a hash."""
    head, tail = _edges(data, s, e)
    size = (e - s).astype(np.uint64)
    key = _key(head, tail, s, e)
    for k in np.flatnonzero(e - s > 16).tolist():  # few
        key[k] = hash(data[s[k] : e[k]]) & 0xFFFFFFFFFFFFFFFF
    order = np.argsort(key)  # any one of equals may stand for them, so it needn't be stable
    ranked = key[order]
    new = np.ones(len(key), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    first, which = order[new], np.empty(len(key), np.int64)
    which[order] = np.cumsum(new) - 1
    like = first[which]
    same = (head == head[like]) & (tail == tail[like]) & (size == size[like])
    far = np.flatnonzero(e - s > 16)
    same[far] &= np.array([data[s[k] : e[k]] == data[s[j] : e[j]] for k, j in zip(far.tolist(), like[far].tolist(), strict=True)], bool)
    if not same.all():  # two spans with one key: by the bytes themselves
        place: dict[bytes, int] = {}
        which = np.array([place.setdefault(data[a:b], len(place)) for a, b in zip(s.tolist(), e.tolist(), strict=True)], np.int64)
        first = np.unique(which, return_index=True)[1]
    return first, which


class Encoder:
    """Encodes texts with a tokenizer file; one for each worker.

    The ids of pre-tokens that it has seen are kept with their bytes in one of PLACES places each, where a later one may take their place.
    """

    _own: dict[str, Encoder] = {}

    def __init__(self, path: str):
        self.path, self._tokenizer = path, None
        self.piece = _ranked(path)
        self.forget()

    def forget(self) -> None:
        self.head = self.tail = self.bytes = self.size = self.ids = None

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._own:
            cls._own[path] = cls(path)
        return cls._own[path]

    @staticmethod
    def ids_of(path: str) -> set[int]:
        """All ids that the file's tokenizer may give."""
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        return {*file["model"]["vocab"].values(), *(t["id"] for t in file.get("added_tokens", []))}

    @property
    def tokenizer(self):
        """The tokenizer itself, loaded when a text needs it."""
        if self._tokenizer is None:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_file(self.path)
        return self._tokenizer

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def pieces(self, tokens: list[bytes]) -> list[list[int]]:
        if self.piece:
            return [self.piece(t) for t in tokens]
        return [e.ids for e in self.tokenizer.encode_batch_fast([t.decode() for t in tokens], add_special_tokens=False)]

    def known(self, data: bytes, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of these different pre-tokens, where each one's begin in them, and how many they are."""
        if self.ids is None:
            self.head, self.tail, self.bytes, self.size = np.zeros(PLACES, np.uint64), np.zeros(PLACES, np.uint64), np.zeros(PLACES, np.uint8), np.zeros(PLACES, np.uint8)
            self.ids = np.zeros((PLACES, MOST_IDS), np.uint32)
        head, tail = _edges(data, s, e)
        place = (_key(head, tail, s, e) & np.uint64(PLACES - 1)).astype(np.int64)
        seen = (self.head[place] == head) & (self.tail[place] == tail) & (self.bytes[place] == e - s)  # no pre-token is of 0 bytes; of at most 16, these tell all
        size = self.size[place].astype(np.int64)
        flat = self.ids[place[seen]][np.arange(MOST_IDS) < size[seen, None]]
        new = np.flatnonzero(~seen)
        if len(new):
            found = self.pieces([data[a:b] for a, b in zip(s[new].tolist(), e[new].tolist(), strict=True)])
            size[new] = np.fromiter(map(len, found), np.int64, len(found))
            more = np.fromiter(chain(chain.from_iterable(found), (0,) * MOST_IDS), np.uint32, int(size[new].sum()) + MOST_IDS)
            keep = (e[new] - s[new] <= 16) & (size[new] <= MOST_IDS)
            at, one = np.unique(place[new[keep]], return_index=True)  # one for each place
            one = np.flatnonzero(keep)[one]
            kept = new[one]
            self.head[at], self.tail[at], self.bytes[at], self.size[at] = head[kept], tail[kept], e[kept] - s[kept], size[kept]
            self.ids[at] = more[(np.cumsum(size[new]) - size[new])[one, None] + np.arange(MOST_IDS)]  # what is beyond a pre-token's own isn't looked at
            flat = np.concatenate((flat, more))
        begin = np.empty(len(s), np.int64)
        order = np.concatenate((np.flatnonzero(seen), new))
        begin[order] = np.cumsum(size[order]) - size[order]
        return flat, begin, size

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts, and where each text's begin."""
        slow = {i: self.whole(t) for i, t in enumerate(texts) if not t.isascii() and _BEYOND.search(t) or SPECIAL in t}
        data, s, e, at = split(["" if i in slow else t for i, t in enumerate(texts)])
        first, which = distinct(data, s, e)
        flat, head, size = self.known(data, s[first], e[first])
        n = size[which]
        ids = flat[np.repeat(head[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        id_at = np.concatenate(([0], np.cumsum(n)))[at]
        if slow:  # put the other texts' ids in their places
            pieces = [slow.get(i, ids[id_at[i] : id_at[i + 1]]) for i in range(len(texts))]
            ids, id_at = np.concatenate(pieces), np.concatenate(([0], np.cumsum([len(x) for x in pieces])))
        return ids, id_at
