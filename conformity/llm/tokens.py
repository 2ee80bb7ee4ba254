"""Token ids of whole texts by the ``tokenizers`` library, with repeated pieces encoded once.

A byte-level BPE never merges across the pieces its splitter makes, so a text's ids are its pieces' ids
in a row. Pieces repeat, hence each worker keeps the ids of pieces it has met; only new pieces reach the
library. Texts are split, and pieces looked up by their whole spelling, in arrays of code points. Texts outside
the letters the fast splitter knows, or with a special token's string, go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterable
from itertools import chain

import numpy as np

from .common import claim

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: The character classes of the byte-level splitter for code points below U+02B0.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ʯ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\t-\r \u0085 "
PIECES = re.compile(
    rf" ?[{LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+"
    rf"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
OTHER = re.compile("[^\x00-ʯ]")
#: A worker keeps pieces up to twice so many, then those of them that it has met again, so many at most. Pieces over
#: ``KEPT_CHARS`` are not kept.
KEPT_PIECES, KEPT_CHARS = 300_000, 18
#: Characters of text that are split at once, and pieces that are looked up at once.
GROUP_CHARS, LOOKED_UP = 1 << 20, 1 << 15
#: What the splitter above reproduces.
SPLITTER = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
#: Ends a text among joined ones; no text of the fast splitter has it.
END = "\u02b0"
SPACE, LETTER, ENDED = 0, 1, 4
CLASSES = np.array([0 if re.match(f"[{SPACES}]", c) else 1 if re.match(f"[{LETTERS}]", c) else 2 if re.match(f"[{NUMBERS}]", c) else 3 for c in map(chr, range(ord(END)))] + [ENDED], np.uint8)
#: The library spells bytes by characters: those that can be printed by themselves, the others by U+0100 and up.
PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTES = {b: 0x100 + k for k, b in enumerate(sorted(set(range(256)).difference(PRINTED)))}
END_BYTES = END.encode().decode("latin-1").translate(BYTES)
#: A key holds six code points of ten bits; ``HEADS[k]`` leaves its first ``k``.
HEADS = np.array([(1 << 10 * k) - 1 for k in range(7)], np.uint64)
_loaded: dict[str, PieceEncoder] = {}


def piece_starts(points: np.ndarray) -> np.ndarray:
    """Where the pieces of ``PIECES`` start in the code points of texts that each end with ``END``."""
    kind = CLASSES[points]
    start = np.ones(len(points), bool)
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == ENDED)
    # of white space before a word, the last character is apart, or the word's if it is a blank
    word = np.flatnonzero(start[1:] & (kind[1:] != ENDED) & (kind[:-1] == SPACE)) + 1
    start[word - 1] = True
    start[word[points[word - 1] == 0x20]] = False
    mark = np.flatnonzero(start & (points == ord("'")))
    first, second = points[mark + 1], points[np.minimum(mark + 2, len(points) - 1)]
    short = np.isin(first, [ord(c) for c in "stmd"])
    long = np.zeros(len(mark), bool)
    for x, y in ("re", "ve", "ll"):
        long |= (first == ord(x)) & (second == ord(y))
    for letters, some in ((1, mark[short]), (2, mark[long])):
        start[some + 1] = False
        after = some + 1 + letters
        start[after[kind[after] == LETTER]] = True
    return start


class PieceTable:
    """Ids by piece: open addressing on the code points of pieces of at most ``KEPT_CHARS``."""

    def __init__(self) -> None:
        self.keys = np.zeros((3, 1 << 12), np.uint64)
        self.at, self.many = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.met = np.zeros(1 << 12, bool)
        self.ids, self.n_ids, self.n = np.zeros(1 << 14, "<u4"), 0, 0
        self.bits = 14
        self.slots = np.full(1 << self.bits, -1, np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        h = (keys[0] * np.uint64(0x9E3779B97F4A7C15)) ^ (keys[1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (keys[2] * np.uint64(0x165667B19E3779F9))
        h ^= h >> np.uint64(32)
        return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each piece, or -1."""
        slot = self._slot(keys)
        out = self.slots[slot]
        wrong = np.flatnonzero((out >= 0) & (self.keys[:, out] != keys).any(0))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & ((1 << self.bits) - 1)
            out[wrong] = self.slots[slot[wrong]]
            held = out[wrong]
            wrong = wrong[(held >= 0) & (self.keys[:, held] != keys[:, wrong]).any(0)]
        return out

    def store(self, ids: np.ndarray) -> int:
        """Where ``ids`` are held now."""
        if self.n_ids + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(ids)), "<u4")])
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.n_ids += len(ids)
        return self.n_ids - len(ids)

    def add(self, keys: np.ndarray, at: np.ndarray, many: np.ndarray) -> np.ndarray:
        """Numbers of new pieces, all different, with their ids' places."""
        new = np.arange(self.n, self.n + len(at), dtype=np.int32)
        self.n += len(at)
        if self.n > len(self.at):
            more = max(len(self.at), len(at))
            self.keys = np.concatenate([self.keys, np.zeros((3, more), np.uint64)], axis=1)
            self.at, self.many = np.concatenate([self.at, np.zeros(more, np.int64)]), np.concatenate([self.many, np.zeros(more, np.int64)])
            self.met = np.concatenate([self.met, np.zeros(more, bool)])
        self.keys[:, new], self.at[new], self.many[new], self.met[new] = keys, at, many, False
        if 2 * self.n > len(self.slots):
            self.bits = (4 * self.n).bit_length()
            self.slots = np.full(1 << self.bits, -1, np.int32)
            self._place(np.arange(self.n, dtype=np.int32))
        else:
            self._place(new)
        return new

    def _place(self, new: np.ndarray) -> None:
        slot = self._slot(self.keys[:, new])
        while len(new):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = new[free]
            left = self.slots[slot] != new
            new, slot = new[left], (slot[left] + 1) & ((1 << self.bits) - 1)

    def spell(self, found: np.ndarray, at: np.ndarray, many: np.ndarray) -> np.ndarray:
        """The ids at these places, in a row."""
        before = np.cumsum(many) - many
        return self.ids[np.repeat(at - before, many) + np.arange(int(many.sum()))]

    def thinned(self) -> PieceTable:
        """A table of the latest ``KEPT_PIECES`` pieces that were met again."""
        keep = np.flatnonzero(self.met[: self.n])[-KEPT_PIECES:]
        out, many = PieceTable(), self.many[keep]
        out.store(self.spell(keep, self.at[keep], many))
        out.add(self.keys[:, keep], np.cumsum(many) - many, many)
        return out


class PieceEncoder:
    """Texts to ids, each id four little-endian bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            stated = json.load(f)
        splitter = stated.get("pre_tokenizer") or {}
        # with another splitter or a normalizer, texts go to the library whole
        self.by_piece = not stated.get("normalizer") and stated["model"].get("type") == "BPE" and {k: splitter.get(k, k == "use_regex") for k in SPLITTER} == SPLITTER
        self.table = PieceTable()

    def _whole(self, texts: list[str]) -> list[bytes]:
        out = []
        for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids = found.ids  # a new list each time it is asked for
            out.append(struct.pack(f"<{len(ids)}I", *ids))
        return out

    def _new(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where the table holds the ids of new pieces, and how many each has."""
        tokenize = self.tokenizer.model.tokenize  # what the library does with each piece after it has split a text
        spelled = END.join(pieces).encode().decode("latin-1").translate(BYTES).split(END_BYTES)
        found = [[token.id for token in tokenize(p)] for p in spelled]
        many = np.array([len(ids) for ids in found])
        at = self.table.store(np.fromiter(chain.from_iterable(found), "<u4", int(many.sum())))
        return at + np.cumsum(many) - many, many

    def _looked_up(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some pieces in a row, and how many each has."""
        table, sizes, base = self.table, ends - starts, int(starts[0])
        part = np.zeros(int(ends[-1]) - base + KEPT_CHARS + 5, np.uint64)
        part[: int(ends[-1]) - base] = points[base : int(ends[-1])]
        part[: int(ends[-1]) - base] += np.uint64(1)
        sixes = part[: len(part) - 5].copy()
        for k in range(1, 6):
            sixes |= part[k : len(part) - 5 + k] << np.uint64(10 * k)
        keys = np.stack([sixes[np.minimum(starts - base + 6 * k, len(sixes) - 1)] & HEADS[np.clip(sizes - 6 * k, 0, 6)] for k in range(3)])
        kept = sizes <= KEPT_CHARS
        found = np.where(kept, table.find(keys), -1)
        table.met[found[found >= 0]] = True
        held = table.n_ids
        missing = np.flatnonzero(found < 0)
        at, many = table.at[found], table.many[found]
        if len(missing):
            spelled = [points[a:b].tobytes().decode("utf-16-le", "surrogatepass") for a, b in zip(starts[missing].tolist(), ends[missing].tolist(), strict=True)]
            number: dict[str, int] = {}
            which = np.array([number.setdefault(p, len(number)) for p in spelled])
            pieces = list(number)
            _, one = np.unique(which, return_index=True)
            is_end = np.array([p == END for p in pieces])
            new_at, new_many = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
            short = kept[missing[one]]
            for some in (np.flatnonzero(short & ~is_end), np.flatnonzero(~short)):
                if len(some):
                    new_at[some], new_many[some] = self._new([pieces[i] for i in some.tolist()])
                held = held if len(some) and not short[some[0]] else table.n_ids  # ids of long pieces go again
            at[missing], many[missing] = new_at[which], new_many[which]
            table.add(keys[:, missing[one[short]]], new_at[short], new_many[short])
        ids = table.spell(found, at, many)
        table.n_ids = held
        return ids, many

    def _pieces(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that the fast splitter knows."""
        points = np.frombuffer((END.join(texts) + END).encode("utf-16-le"), "<u2")
        starts = np.flatnonzero(piece_starts(points))
        ends = np.append(starts[1:], len(points))
        ids, counts = [], []
        for a in range(0, len(starts), LOOKED_UP):
            if self.table.n > 2 * KEPT_PIECES:
                self.table = self.table.thinned()
            some, many = self._looked_up(points, starts[a : a + LOOKED_UP], ends[a : a + LOOKED_UP])
            ids.append(some), counts.append(many)
        after = (np.cumsum(np.concatenate(counts))[points[starts] == ord(END)] * 4).tolist()
        held = np.concatenate(ids).tobytes()
        return [held[a:b] for a, b in zip([0, *after[:-1]], after, strict=True)]

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text, without an end id."""
        texts = list(texts)
        out: list[bytes] = [b""] * len(texts)
        groups: dict[bool, list[int]] = {True: [], False: []}
        held = {True: 0, False: 0}

        def flush(fast: bool) -> None:
            ids = (self._pieces if fast else self._whole)([texts[i] for i in groups[fast]])
            for i, x in zip(groups[fast], ids, strict=True):
                out[i] = x
            groups[fast], held[fast] = [], 0

        for i, text in enumerate(texts):
            fast = self.by_piece and (text.isascii() or not OTHER.search(text)) and not any(s in text for s in self.special)
            groups[fast].append(i)
            held[fast] += len(text)
            if held[fast] >= GROUP_CHARS:
                flush(fast)
        for fast in (True, False):
            if groups[fast]:
                flush(fast)
        return out


def encoder(path: str) -> PieceEncoder:
    """This worker's encoder for a vocabulary file."""
    claim("tokens", _loaded.clear)
    if path not in _loaded:
        _loaded[path] = PieceEncoder(path)
    return _loaded[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
