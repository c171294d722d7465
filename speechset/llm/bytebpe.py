"""Byte-level BPE by prefix dynamic programming.

For each prefix of a piece of bytes the BPE encoding is unique, and so is its last token. One number for
each prefix, that last token, is therefore the whole encoding: walking back from the end reads it off.
The last token of a prefix is the one token t that ends there, such that t and the last token of the
prefix before it would not have merged across their border.

Appending bytes only adds numbers at the end; cutting bytes only drops some. After an edit inside a text,
only the pieces near it are encoded again.

Cases: a null or empty text has no tokens. Nulls in other columns and repeated rows do not matter; each row
is encoded alone. Decoding gives back the exact bytes of any text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from speechset.llm.frames import slices, texts
from speechset.llm.tokens import TextEncoder, packed

_NEVER = 1 << 62
_NEAR = 16
_PIECES = 200_000  # pieces whose ids a worker remembers
_open: dict[tuple[str, str], "ByteBpe"] = {}


def codec(ranks_path: str, pattern: str) -> "ByteBpe":
    """The codec of a rank file, opened once in a Python worker."""
    key = (ranks_path, pattern)
    if key not in _open:
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _open[key] = ByteBpe(ranks, pattern)
    return _open[key]


class ByteBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        # \s in the rank files' libraries is the property White_Space; here it would also take 0x1C-0x1F.
        exact = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.split = regex.compile(exact).findall
        self.match = regex.compile(exact).match
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.right_edge: dict[int, tuple[int, ...]] = {}  # tokens at the right end of a token, as it grows
        self.left_edge: dict[int, tuple[int, ...]] = {}
        for token in sorted(self.bytes_of):
            self._grow(token, self.bytes_of[token])
        sizes: dict[bytes, set[int]] = {}
        for data in ranks:
            if len(data) > 2:
                sizes.setdefault(data[-3:], {2}).add(len(data))
        # By the last three bytes: lengths of the tokens that end so, longest first, that fit in a prefix of
        # each size up to _NEAR, and at last of any size; and two, for a token of the last two.
        self.lengths = {
            end: [tuple(n for n in sorted(found, reverse=True) if n <= size) for size in (*range(_NEAR), _NEVER)]
            for end, found in sizes.items()
        }
        # Tokens that merges can make; the others are only ever a whole piece.
        self.usable = {b: i for b, i in ranks.items() if i in self.left_edge}
        self._fit: dict[tuple[int, int], bool] = {}
        self._pieces: dict[str, bytes] = {}
        self._text = TextEncoder(self._many, "joined")

    def _grow(self, token: int, data: bytes) -> None:
        """Find the two tokens whose merge makes ``token``, by merging its bytes."""
        parts = [self.ranks[data[i : i + 1]] for i in range(len(data))]
        while len(parts) > 2:
            best, at = _NEVER, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(self.bytes_of[parts[i]] + self.bytes_of[parts[i + 1]], _NEVER)
                if rank < best:
                    best, at = rank, i
            if at < 0 or best >= token:
                return  # merges never make it; it can only be a whole piece
            parts[at : at + 2] = [best]
        if len(parts) == 2:
            self.left_edge[token] = (*self.left_edge.get(parts[0], (parts[0],)), token)
            self.right_edge[token] = (*self.right_edge.get(parts[1], (parts[1],)), token)
        else:
            self.left_edge[token] = self.right_edge[token] = (token,)

    def stays_apart(self, left: int, right: int) -> bool:
        """Whether two tokens side by side keep their border: while both grow from their bytes, lowest rank
        first and the left one first among equals, no merge across the border comes earlier."""
        known = self._fit.get((left, right))
        if known is None:
            a, b = self.right_edge[left], self.left_edge[right]
            i = j = 0
            known = True
            while True:
                across = self.ranks.get(self.bytes_of[a[i]] + self.bytes_of[b[j]], _NEVER)
                grow_a = a[i + 1] if i + 1 < len(a) else _NEVER
                grow_b = b[j + 1] if j + 1 < len(b) else _NEVER
                if across < grow_a and across <= grow_b:
                    known = False
                    break
                if grow_a == grow_b == _NEVER:
                    break
                if grow_a <= grow_b:
                    i += 1
                else:
                    j += 1
            if len(self._fit) > 1_000_000:
                self._fit.clear()
            self._fit[(left, right)] = known
        return known

    def extend(self, last: list[int], data: bytes) -> None:
        """Add the last token of each prefix of ``data`` that is longer than ``last``."""
        ranks, usable, lengths, known = self.ranks, self.usable, self.lengths, self._fit
        for end in range(len(last) + 1, len(data) + 1):
            options = lengths.get(data[end - 3 : end]) if end > 2 else None
            for size in options[min(end, _NEAR)] if options else (2,):
                token = usable.get(data[end - size : end]) if size <= end else None
                if token is None:
                    continue
                if size == end:
                    break
                before = last[end - size - 1]
                fits = known.get((before, token))
                if self.stays_apart(before, token) if fits is None else fits:
                    break
            else:
                token = ranks[data[end - 1 : end]]
            last.append(token)

    def read(self, last: list[int]) -> list[int]:
        """The encoding that a prefix table stands for."""
        out, at = [], len(last)
        while at:
            token = last[at - 1]
            out.append(token)
            at -= len(self.bytes_of[token])
        out.reverse()
        return out

    def piece(self, data: bytes) -> list[int]:
        """The ids of one match of the pattern."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        last: list[int] = []
        self.extend(last, data)
        return self.read(last)

    def _many(self, parts: list[str]) -> list[bytes]:
        known, out = self._pieces, []
        for part in parts:
            ids = []
            for match in self.split(part):
                own = known.get(match)
                if own is None:
                    if len(known) >= _PIECES:
                        known.clear()
                    own = known[match] = packed(self.piece(match.encode()))
                ids.append(own)
            out.append(b"".join(ids))
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return self._text.encode(text)

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        return self._text.encode_all(texts)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class EditableText:
    """A text with its pieces, their ids and prefix tables, kept up to date through appends and edits. A piece
    that keeps its first bytes keeps their part of its table: a cut drops its end, an append extends it."""

    def __init__(self, bpe: ByteBpe, text: str = ""):
        self.bpe, self.text = bpe, ""
        self.pieces: list[tuple[int, int, list[int], list[int]]] = []  # start, end, ids, last token of each prefix
        self.replace(0, 0, text)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, new: str) -> None:
        """Put ``new`` in the place of text[start:stop]. A match depends on the text from its start to a
        little past its end: pieces before that stay, and so do those after the edit from the first place
        where an old and a new piece begin together."""
        shift = len(new) - (stop - start)
        self.text = self.text[:start] + new + self.text[stop:]
        kept = 0
        for a, b, *_ in self.pieces:
            if max(b + 2, a + 3) > start:
                break
            kept += 1
        later = {a + shift: i for i, (a, *_) in enumerate(self.pieces) if a >= stop}
        opened = {a: (b, last) for a, b, _, last in self.pieces[kept:] if a < start}
        fresh, at = [], self.pieces[kept - 1][1] if kept else 0
        while at < len(self.text) and not (at >= start + len(new) and at in later):
            end = self.bpe.match(self.text, at).end()
            b, last = opened.get(at, (at, []))
            del last[len(self.text[at : min(b, start, end)].encode()) :]
            data = self.text[at:end].encode()
            self.bpe.extend(last, data)
            whole = self.bpe.ranks.get(data)
            fresh.append((at, end, self.bpe.read(last) if whole is None else [whole], last))
            at = end
        rest = self.pieces[later[at] :] if at in later and at < len(self.text) else []
        self.pieces = self.pieces[:kept] + fresh + [(a + shift, b + shift, *own) for a, b, *own in rest]

    @property
    def ids(self) -> list[int]:
        return [i for _, _, ids, _ in self.pieces for i in ids]


def encoded(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the ids of each text (little-endian unsigned 32-bit integers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(ranks_path, pattern).encode_all
        for part in slices(batches):
            ids = encode(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id bigint, ids binary")


def decoded(ids: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, the ids as decimals joined by spaces (hashed) and the decoded bytes (hashed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = codec(ranks_path, pattern).decode
        for part in slices(batches, "ids"):
            rows = [np.frombuffer(b, "<u4").tolist() for b in part.column("ids").to_pylist()]
            digest = lambda data: hashlib.sha256(data).hexdigest()
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(r) for r in rows], pa.int64()),
                 pa.array([digest(" ".join(map(str, r)).encode()) for r in rows]), pa.array([digest(decode(r)) for r in rows])],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return ids.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
