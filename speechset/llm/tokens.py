"""Token ids of whole texts by a public vocabulary, with each distinct word encoded once.

Words repeat far more than texts do. Where white space certainly separates tokens, the words between
are encoded alone by the library and remembered in the Python worker; any text for which that is not
certain goes to the library whole. The ids are the same either way. Texts come an Arrow slice at a time,
so that what is done for each word, not each distinct word, is done by Arrow and numpy.
"""

from __future__ import annotations

import os
import sys
from array import array
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A task has one core: the library's own threads would only fight over it.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

REMEMBERED = 300_000  # words a worker remembers before it starts afresh, with the last such lot at hand
_BATCH = 64  # words that go through the library as one text
_PLACES = 1 << 18
_MET = 1 << 23  # bits of word hashes, a byte each; a word is remembered when it is met a second time
_open: dict[tuple[str, str], "TextEncoder"] = {}


def encoder(path: str, spaces: str) -> "TextEncoder":
    """The encoder of a vocabulary file of the tokenizers library, opened once in a Python worker.
    ``spaces`` says what becomes of white space: "dropped", or "joined" where a space belongs to the word
    after it."""
    key = (path, spaces)
    if key not in _open:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text

        _open[key] = TextEncoder(_Library(tokenizer, spaces), spaces)
    return _open[key]


class _Library:
    """Packed ids of texts by the tokenizers library. Many words go through it as one text, with a zero
    character between them that is a token of its own, which costs less than a call a word."""

    def __init__(self, tokenizer, spaces: str):
        self.tokenizer = tokenizer
        self.between = " \x00" if spaces == "joined" else " \x00 "
        self.lead = " " if spaces == "joined" else ""
        self.mark = np.array(tokenizer.encode(self.between, add_special_tokens=False).ids)

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(texts) > 3 and all(t.startswith(self.lead) and "\x00" not in t for t in texts):
            ids = np.array(self._encode([self.between.join(texts)])[0], "<u4")
            n = len(self.mark)
            ends = np.flatnonzero(ids == self.mark[-1])
            if len(ends) == len(texts) - 1:
                data = ids.tobytes()
                starts, stops = [0, *(ends + 1).tolist()], [*(ends + 1 - n).tolist(), len(ids)]
                return [data[4 * a : 4 * b] for a, b in zip(starts, stops)]
        return [packed(i) for i in self._encode(texts)]

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class TextEncoder:
    """Encodes texts with ``many``, a function from texts to their packed ids, word by word."""

    def __init__(self, many: Callable[[list[str]], list[bytes]], spaces: str):
        if spaces not in ("dropped", "joined"):
            raise ValueError(f"spaces {spaces!r}")
        self.many = many
        self.joined = spaces == "joined"
        self.known: dict[str, bytes] = {}  # by word, with the space before it where that belongs to it
        self.past: dict[str, bytes] = {}  # the lot before
        self.met, self.n_met = bytearray(_MET), 0

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit integers."""
        return self.encode_all(pa.array([text], pa.string()))[0]

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text; a null is an empty one. Arrow splits the texts and finds the distinct words;
        only those meet Python, and numpy puts their ids in place."""
        if not len(texts):
            return []
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        # A line feed is a word of its own where it counts; it is dropped like a space where spaces are.
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n " if self.joined else " "), " ")
        borders = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = coded.indices.to_numpy().astype(np.int64)
        borders -= borders[0]
        whole = np.zeros(len(texts), bool)
        if self.joined:
            alone, whole = self._places(words, at, borders)
            at = 2 * at + alone
        used = np.zeros((1 + self.joined) * len(words), bool)
        used[at[~np.repeat(whole, np.diff(borders))]] = True
        used = np.flatnonzero(used).tolist()
        keys = [words[i >> 1] if i & 1 else " " + words[i >> 1] for i in used] if self.joined else words
        own = [b""] * ((1 + self.joined) * len(words))
        for i, found in zip(used, self._learned(keys)):
            own[i] = found
        ids, ends = _joined(own, at)
        cuts = np.concatenate(([0], ends))[borders].tolist()
        out = [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
        for i in np.flatnonzero(whole).tolist():
            out[i] = self.many([texts[i].as_py()])[0]
        return out

    def rest(self) -> None:
        """Forget the lot before, at the end of a task: the worker may go on to other work."""
        self.past.clear()

    def _places(self, words: list[str], at: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words have no space before them, and which texts must be encoded whole: those that hold a word
        with white space at an end, or an empty one, since what surrounds it matters."""
        feed = np.array([w == "\n" for w in words])
        unsafe = np.array([not w or w.strip() is not w for w in words]) & ~feed
        feeds = feed[at]
        alone = feeds.copy()
        alone[1:] |= feeds[:-1]
        alone[borders[:-1]] = True
        # An empty text is one empty word, too; the library gives it no ids.
        return alone, np.add.reduceat(unsafe[at], borders[:-1]) > 0

    def _learned(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words; those not yet known are encoded."""
        found = list(map(self.known.get, words))
        new = [i for i, ids in enumerate(found) if ids is None]
        unknown, kept = [], []
        for i in new:
            found[i] = self.past.get(words[i])
            (unknown if found[i] is None else kept).append(i)
        for a in range(0, len(unknown), _BATCH):
            part = unknown[a : a + _BATCH]
            for i, ids in zip(part, self.many([words[i] for i in part])):
                found[i] = ids
        # Most new words never come again: those met once would only drive out the others.
        met = self.met
        for i in unknown:
            at = hash(words[i]) % _MET
            if met[at]:
                kept.append(i)
            else:
                met[at] = 1
                self.n_met += 1
        if self.n_met > _MET // 4:
            self.met, self.n_met = bytearray(_MET), 0
        if len(self.known) + len(kept) > REMEMBERED:
            self.past, self.known = self.known, {}
        self.known.update((words[i], found[i]) for i in kept)
        return found


def _joined(own: list[bytes], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of ``own[i]`` for each i of ``at``, one after the other, and where each of them ends."""
    sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
    starts = np.cumsum(sizes) - sizes
    pool = np.frombuffer(b"".join(own), "<u4")
    ends = np.cumsum(sizes[at])
    ids = np.empty(int(ends[-1]) if len(ends) else 0, "<u4")
    # A part of the words at a time: a place takes two 8-byte integers.
    for a in range(0, len(at), _PLACES):
        part = at[a : a + _PLACES]
        first = int(ends[a] - sizes[at[a]])
        size = sizes[part]
        shift = np.repeat(starts[part] - (ends[a : a + _PLACES] - size), size)
        shift += np.arange(first, first + len(shift))
        ids[first : first + len(shift)] = pool[shift]
    return ids, ends


def packed(ids: Iterable[int]) -> bytes:
    out = array("I", ids)
    if out.itemsize != 4:
        raise RuntimeError("unsigned ints of four bytes are assumed")
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()
