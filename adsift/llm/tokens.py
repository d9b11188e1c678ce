"""Token ids of whole texts by a public tokenizer, many words at once.

The tokenizers library splits a text into words before it merges, so a text
may be cut where a word must begin anyway, and equal pieces have equal ids.

A text whose white space is single spaces and line breaks is cut before every
space. The texts of a batch are one byte buffer, in which numpy finds the
pieces and, in those of Latin letters, signs behind words and line breaks
alone, the words, runs of signs and breaks that the pre-tokenizer would find. Equal
units are found by a hash and compared byte by byte; each different word is
merged once per batch (``Merges``): words of as many bytes are a matrix of ids,
and a round merges the pair of least rank in every row, as the model does word
by word. All other pieces go to the library.

Other texts are cut where that can't matter, too: before every run of spaces
and line breaks if these are all their white space, else not at all; so is a
text with the string of a special token, where these count (``specials``).
Their pieces go to the library, those seen lately come from a bounded cache of
two generations.

This holds for byte-level pre-tokenizers with the usual pattern (a word takes
one space before it along) and for those that drop white space.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd

CACHE_PIECES = 20_000  # in each generation
LONGEST_CACHED = 64
LONGEST_WORD = 20       # bytes of words that are merged here; a few longer ones are not worth their steps
BUFFER_BYTES = 6 << 20  # of texts at once, or one text
OTHER_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
BY_RUN = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
# Odd multipliers of the hash of units; the next one is taken if different units meet.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
SPREAD = np.uint64(0x9E3779B97F4A7C15)    # of the table of pairs
OTHER, LETTER, SPACE, BREAK, STOP = range(5)


class Cache:
    """Ids by piece, bounded by two generations."""

    def __init__(self, most: int):
        self.most = most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def find(self, pieces: list[str]) -> tuple[list[bytes | None], list[int]]:
        """(ids or None of each piece, places of None). Known pieces are looked up in C alone."""
        found = list(map(self.young.get, pieces))
        lost = [i for i, ids in enumerate(found) if ids is None]
        if self.old and lost:
            get, still = self.old.get, []
            for i in lost:
                found[i] = ids = get(pieces[i])
                if ids is None:
                    still.append(i)
                else:
                    self.put(pieces[i], ids)
            lost = still
        return found, lost

    def put(self, piece: str, ids: bytes) -> None:
        if len(piece) > LONGEST_CACHED:
            return
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        self.young[piece] = ids


class Merges:
    """Byte-pair merges of many words at once, by the vocabulary's merge ranks.

    ``vocab`` and ``merges`` are those of the model, whose symbols stand for bytes;
    ``suffix`` is added to a word's last symbol. Ranks of pairs of bytes are in two
    square tables (the second for pairs that end a word), those of all pairs in an
    open hash table.
    """

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        shown = byte_symbols()
        pairs = (m.split(" ") if isinstance(m, str) else m for m in merges)
        rows = np.array([(vocab[a], vocab[b], k, vocab[a + b]) for k, (a, b) in enumerate(pairs)], np.int64).reshape(-1, 4)
        kind = np.uint16 if max(len(rows) + 1, max(vocab.values(), default=0)) < 1 << 16 else np.uint32
        self.none = kind(np.iinfo(kind).max)
        self.result = np.append(rows[:, 3], 0).astype(kind)    # by rank
        keys = rows[:, 0] << 32 | rows[:, 1]
        bits = max(4, (len(keys) * 4).bit_length())
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys = np.full(self.mask + 2, -1, np.int64)    # the last slot is never taken
        self.ranks = np.full(self.mask + 2, self.none, kind)
        self.probes, left, at = 0, np.arange(len(keys)), self._slot(keys)
        while len(left):    # one step along the table for all that found their slot taken
            free = left[self.keys[at[left]] == -1]
            free = free[np.unique(at[free], return_index=True)[1]]
            self.keys[at[free]], self.ranks[at[free]] = keys[free], rows[free, 2]
            left = np.setdiff1d(left, free)
            at[left] = (at[left] + 1) & self.mask
            self.probes += 1
        self.inner, self.final = (np.array([vocab.get(c + end, 0) for c in shown], kind) for end in ("", suffix))
        self.missing = np.array([c not in vocab or c + suffix not in vocab for c in shown])
        a, b = np.meshgrid(np.arange(256), np.arange(256), indexing="ij")
        self.square, self.square_end = (self._rank(self.inner[a.ravel()], last[b.ravel()]) for last in (self.inner, self.final))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * SPREAD) >> self.shift).view(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``none`` without a merge."""
        keys = left.astype(np.int64) << 32 | right
        at = self._slot(keys)
        held = self.keys[at]
        lost = np.flatnonzero((held != keys) & (held != -1))
        for _ in range(self.probes):
            if not len(lost):
                break
            at[lost] = (at[lost] + 1) & self.mask
            held = self.keys[at[lost]]
            lost = lost[(held != keys[lost]) & (held != -1)]
        at[lost] = self.mask + 1
        return self.ranks[at]

    def merge(self, raw: np.ndarray):
        """Ids of words of one length (a row of bytes each): (rows, ids) of words that end with as many ids.

        Words are columns below, so that each step is one operation on long rows.
        """
        n, m = raw.shape
        raw = np.ascontiguousarray(raw.T)
        ids = [self.inner[b] for b in raw[:-1]] + [self.final[raw[-1]]]
        pair = [a.astype(np.int32) << 8 | b for a, b in zip(raw[:-1], raw[1:], strict=True)]
        ranks = [self.square[p] for p in pair[:-1]] + [self.square_end[p] for p in pair[-1:]]
        word = np.arange(n)
        while ranks:
            least, best = ranks[0], np.zeros(len(word), np.int16)
            for k in range(1, len(ranks)):
                best[ranks[k] < least] = k
                least = np.minimum(least, ranks[k])
            active = least != self.none
            if not active.all():
                done = ~active
                yield word[done], np.stack([x[done] for x in ids], axis=1)
                word, least, best = word[active], least[active], best[active]
                ids, ranks = [x[active] for x in ids], [x[active] for x in ranks]
            if not len(word):
                return
            new = self.result[least]
            # Ids behind the merged pair move up; the pair's rank goes and those beside it are looked up again.
            ids = [np.where(best > k, ids[k], np.where(best == k, new, ids[k + 1])) for k in range(len(ids) - 1)]
            ranks = [np.where(best > k, ranks[k], ranks[k + 1]) for k in range(len(ranks) - 1)]
            for k in range(len(ranks)):
                at = np.flatnonzero((best == k) | (best == k + 1))
                ranks[k][at] = self._rank(ids[k][at], ids[k + 1][at])
        if len(word):
            yield word, np.stack(ids, axis=1)


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def _classes() -> np.ndarray:
    table = np.full(256, OTHER, np.uint8)
    table[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
    signs = [b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) != "'"]    # an apostrophe may begin a word's ending
    table[signs] = STOP
    table[[0x20, 0x0A]] = SPACE, BREAK
    return table


CLASS = _classes()


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs of such sizes that begin at ``starts``, one run after the other."""
    ends = np.cumsum(sizes)
    n = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if n < 1 << 31 and int(starts.max(initial=0)) < 1 << 31 else np.int64
    places = np.repeat((starts - ends + sizes).astype(kind), sizes)
    places += np.arange(n, dtype=kind)
    return places


def find_units(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts of units, whether each is left to the library) in a buffer of texts that begin at ``starts``.

    A unit is a word of Latin-1 letters with the space before it, a run of signs behind a word, a line
    break between words, or a whole piece (from a space to the next) that isn't made of these.
    """
    kind = CLASS[data]
    lead = np.flatnonzero(data == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]    # the signs of multiplication and division
    kind[lead] = kind[lead + 1] = LETTER
    before, after = np.empty_like(kind), np.empty_like(kind)
    before[1:], after[:-1] = kind[:-1], kind[1:]
    before[starts] = SPACE
    after[starts[1:] - 1] = SPACE
    after[-1] = SPACE
    letter, stop, line = kind == LETTER, kind == STOP, kind == BREAK
    odd = kind == OTHER
    odd |= stop & (((before != LETTER) & (before != STOP)) | ((after != BREAK) & (after != SPACE) & (after != STOP)))
    odd |= line & (((before != LETTER) & (before != STOP)) | (after != LETTER))
    begins = kind == SPACE
    begins[starts] = True
    piece = np.cumsum(begins, dtype=np.int32) - 1
    whole = np.zeros(int(piece[-1]) + 1, bool)
    whole[piece[odd]] = True
    inside = (stop & (before != STOP)) | line | (letter & (before == BREAK))
    inside &= ~whole[piece]
    at = np.flatnonzero(begins | inside)
    return at, whole[piece[at]]


def same_units(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one unit of each different one, number of its kind for every unit)."""
    for base in BASES:
        power = powers(base, len(data))
        total = data.astype(np.uint64)
        total += np.uint64(1)
        total *= power
        np.cumsum(total, out=total)
        ends = starts + sizes - 1
        h = total[ends]
        h[1:] -= total[starts[1:] - 1]
        del total
        h *= power[len(data) - 1 - starts]
        number, kinds = pd.factorize(h)
        one = np.empty(len(kinds), np.int64)
        one[number[::-1]] = np.arange(len(h) - 1, -1, -1)
        like = one[number]
        if not np.array_equal(sizes, sizes[like]):
            continue
        if np.array_equal(data[spread(starts[like], sizes)], data):
            return one, number
    raise ValueError("different words have equal hashes under all multipliers")


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the first ``n`` powers from 0, modulo 2 to the 64."""
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors, out=factors)


class Encoder:
    """``encode`` gives each text's ids as little-endian unsigned 32-bit bytes.

    With ``specials`` the strings of special tokens get these tokens' ids, as by the library's defaults; else they are ordinary text.
    """

    def __init__(self, path: str, most: int = CACHE_PIECES, specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = not specials  # else their strings are ordinary text
        spec = json.loads(self.library.to_str())
        self.specials = [t["content"] for t in spec.get("added_tokens", [])] if specials else []
        self.merges = self._merges(spec)
        self.single = {c: self._library("", [c])[c] for c in ".,\n"}
        self.first, self.spaced = Cache(most), Cache(most)  # pieces as they are, and those that follow a space

    def _merges(self, spec: dict) -> Merges | None:
        """Merges for the two kinds of pre-tokenizers whose words of letters are known; None for any other."""
        before, normal, model = spec.get("pre_tokenizer") or {}, spec.get("normalizer"), spec["model"]
        if model.get("type") != "BPE" or model.get("continuing_subword_prefix") or model.get("ignore_merges") or model.get("dropout"):
            return None
        steps = [(s["type"], s.get("behavior")) for s in before.get("pretokenizers", [])]
        lowers = [s["type"] for s in (normal or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and normal is None:
            self.lowers = False
        elif steps == [("Split", "Removed"), ("ByteLevel", None)] and lowers:
            self.lowers = True    # and spaces are dropped
        else:
            return None
        return Merges(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")

    @staticmethod
    def regular(text: str) -> bool:
        """White space is single spaces between other characters, and line breaks."""
        return not (text[0] == " " or text[-1] == " " or "  " in text or "\n \n" in text or any(c in text for c in OTHER_SPACES))

    @staticmethod
    def cut(text: str) -> tuple[list[str], list[str]]:
        """(pieces as they are, then pieces that follow a space): in this order, they make the text."""
        if not text:
            return [], []
        if any(c in text for c in OTHER_SPACES):
            return [text], []
        if not Encoder.regular(text):
            return BY_RUN.findall(text), []
        parts = text.split(" ")
        return parts[:1], parts[1:]

    def _library(self, lead: str, pieces: list[str]) -> dict[str, bytes]:
        encoded = self.library.encode_batch_fast([lead + p for p in pieces], add_special_tokens=False) if pieces else ()
        return {p: array("I", e.ids).tobytes() for p, e in zip(pieces, encoded, strict=True)}

    def _all(self, cache: Cache, lead: str, pieces: list[str]) -> list[bytes]:
        found, lost = cache.find(pieces)
        if lost:
            new = self._library(lead, list({pieces[i] for i in lost}))
            for p, ids in new.items():
                cache.put(p, ids)
            for i in lost:
                found[i] = new[pieces[i]]
        return found

    def _pieces(self, text: str) -> bytes:
        a, b = ([text], []) if any(s in text for s in self.specials) else self.cut(text)
        return b"".join(self._all(self.first, "", a) + self._all(self.spaced, " ", b))

    def _words(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """(words, ids) of words of letters, those that end with as many ids together."""
        if self.lowers:
            lead = data[starts] == 0x20
            starts, sizes = starts + lead, sizes - lead
        for size in np.unique(sizes).tolist():
            word = np.flatnonzero(sizes == size)
            raw = data[starts[word][:, None] + np.arange(size)]
            if self.lowers:
                capital = (raw >= 0x41) & (raw <= 0x5A)
                capital[:, 1:] |= (raw[:, :-1] == 0xC3) & (raw[:, 1:] >= 0x80) & (raw[:, 1:] <= 0x9E)
                raw = raw + (capital << 5).astype(np.uint8)
            for rows, ids in self.merges.merge(raw):
                yield word[rows], ids

    def _buffer(self, texts: list[bytes]) -> list[bytes]:
        """Ids of regular texts, or parts of them that begin at a space."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        bounds = np.cumsum([0, *map(len, texts)])
        at, whole = find_units(data, bounds[:-1])
        sizes = np.diff(at, append=len(data))
        one, number = same_units(data, at, sizes)
        start, size = at[one], sizes[one]
        head = CLASS[data[start]]
        signs = (head == STOP) & ((size > 1) | ((data[start] != ord(".")) & (data[start] != ord(","))))
        whole = whole[one] | signs | (size > LONGEST_WORD) | (self.merges.missing[data[start]] & (size == 1))
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for c, ids in self.single.items():
            same = np.flatnonzero(~whole & (size == 1) & (data[start] == ord(c)))
            parts.append((same, np.tile(np.frombuffer(ids, "<u4"), (len(same), 1))))
        word = np.flatnonzero(~whole & (head != STOP) & (head != BREAK))
        parts += [(word[rows], ids) for rows, ids in self._words(data, start[word], size[word])]
        left = np.flatnonzero(whole).tolist()
        asked = [data[a : a + n].tobytes().decode() for a, n in zip(start[left].tolist(), size[left].tolist(), strict=True)]
        told = self._all(self.first, "", asked)
        counts = np.zeros(len(one), np.int64)
        for units, ids in parts:
            counts[units] = ids.shape[1]
        counts[left] = [len(ids) // 4 for ids in told]
        ends = np.cumsum(counts)
        pool = np.empty(int(ends[-1]), "<u4")
        for units, ids in parts:
            pool[(ends - counts)[units][:, None] + np.arange(ids.shape[1])] = ids
        pool[spread((ends - counts)[left], counts[left])] = np.frombuffer(b"".join(told), "<u4")
        each = counts[number]
        upto = np.concatenate([[0], np.cumsum(each)])
        out = pool[spread((ends - counts)[number], each)].tobytes()
        cuts = (4 * upto[np.searchsorted(at, bounds)]).tolist()
        return [out[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[list[bytes]] = [[] for _ in texts]
        held, of, size = [], [], 0

        def flush():
            nonlocal size
            for i, ids in zip(of, self._buffer(held) if held else (), strict=True):
                out[i].append(ids)
            held.clear()
            of.clear()
            size = 0

        for i, text in enumerate(texts):
            if not text:
                continue
            if self.merges is None or any(s in text for s in self.specials) or not self.regular(text):
                out[i].append(self._pieces(text))
                continue
            data = text.encode()
            while data:
                end = len(data)
                if end > BUFFER_BYTES:    # cut before a space
                    end = data.rfind(b" ", 1, BUFFER_BYTES)
                    end = data.find(b" ", 1) if end < 0 else end
                    end = len(data) if end < 0 else end
                if size + end > BUFFER_BYTES:
                    flush()
                held.append(data[:end])
                of.append(i)
                size += end
                data = data[end:]
        flush()
        return [b"".join(parts) for parts in out]


@lru_cache(maxsize=2)
def encoder(path: str, specials: bool = False) -> Encoder:
    """This worker's encoder for a vocabulary file; its cache lives as long as the worker."""
    return Encoder(path, specials=specials)


def chunks(items: list, most_chars: int, size) -> list[list]:
    """Consecutive runs of items of at most ``most_chars`` in all, or of one item."""
    out, held = [], 0
    for x in items:
        if not out or held + size(x) > most_chars:
            out.append([])
            held = 0
        out[-1].append(x)
        held += size(x)
    return out
