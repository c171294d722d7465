"""Encoders, byte-level BPE, range coder, token files and packing against the public libraries."""

import array
import base64
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from speechset.llm import tokens
from speechset.llm.bytebpe import EditableText, codec, decoded, encoded
from speechset.llm.packing import best_fit_moves, pack
from speechset.llm.rangecoder import decode_blocks, encode_blocks
from speechset.llm.tokenfile import read_blocks, read_documents, write_tokens
from speechset.session import new_folder
from tests.llm.conftest import ODD_TEXTS, documents

PARTS = ["a", "b", "The", " ", "  ", "\n", "\n\n", "\t", "'s", "'ll", "é", "é", "ß", "İ", "中", "😀", "1", "22", "!", "...", ",",
         "\x1c", "\x85", "\xa0", "<|endoftext|>", "\x00", " word", " more", "\nLine", "\r\n"]
some_text = st.lists(st.sampled_from(PARTS), max_size=30).map("".join)
WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def library(path):
    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True
    return lambda text: found.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@pytest.mark.parametrize("path, spaces", [(WORDS, "dropped"), (BYTES, "joined")])
def test_words_at_a_time_give_the_ids_of_whole_texts(path, spaces, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 20)
    monkeypatch.setattr(tokens, "_open", {})
    encode, whole = tokens.encoder(path, spaces).encode, library(path)
    r = random.Random(1)
    for _ in range(1500):
        text = "".join(r.choice(PARTS) for _ in range(r.randrange(40)))
        assert np.frombuffer(encode(text), "<u4").tolist() == whole(text)


@pytest.mark.parametrize("path, spaces", [(WORDS, "dropped"), (BYTES, "joined")])
def test_a_slice_of_texts_is_encoded_at_once(path, spaces, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 20)
    monkeypatch.setattr(tokens, "_open", {})
    words, whole = tokens.encoder(path, spaces), library(path)
    calls, many = [], words.many
    words.many = lambda parts: calls.extend(parts) or many(parts)
    r = random.Random(2)
    for _ in range(60):
        texts = [r.choice([None, "", "".join(r.choice(PARTS) for _ in range(r.randrange(40)))]) for _ in range(r.randrange(20))]
        got = words.encode_all(pa.array(["cut off", *texts], pa.string()).slice(1))
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [whole(t or "") for t in texts]
    calls.clear()
    words.encode_all(pa.array(["never seen before\nnever seen before"] * 500))
    assert len(calls) == len(set(calls)) <= 5  # each distinct word once


@settings(max_examples=300, deadline=None)
@given(some_text)
def test_byte_bpe_equals_the_library(reference, text):
    bpe = codec(RANKS, public_tokenizers.PATTERN)
    ids = np.frombuffer(bpe.encode(text), "<u4").tolist()
    assert ids == reference(text) and bpe.decode(ids) == text.encode()


@settings(max_examples=150, deadline=None)
@given(some_text, st.lists(st.tuples(st.integers(0, 60), st.integers(0, 20), some_text), max_size=4), some_text)
def test_edits_and_appends_stay_exact(reference, text, edits, tail):
    held = EditableText(codec(RANKS, public_tokenizers.PATTERN), text)
    for at, size, new in edits:
        start = min(at, len(held.text))
        held.replace(start, min(start + size, len(held.text)), new)
        assert held.ids == reference(held.text)
    held.append(tail)
    assert held.ids == reference(held.text)


def test_open_pieces_keep_their_prefix_tables(reference):
    held = EditableText(codec(RANKS, public_tokenizers.PATTERN), "internationalis")
    table = held.pieces[-1][3]
    before = list(table)
    held.append("ationalaaaa")
    assert held.pieces[-1][3] is table and table[: len(before)] == before and held.ids == reference(held.text)
    held.replace(7, len(held.text), "")
    assert held.pieces[-1][3] is table and table == before[:7] and held.ids == reference(held.text)


def test_prefix_tables_grow_byte_by_byte(reference):
    bpe, last = codec(RANKS, public_tokenizers.PATTERN), []
    data = b"internationalisationalaaaaaaaab"
    for end in range(1, len(data) + 1):
        bpe.extend(last, data[:end])
        assert bpe.read(last) == reference(data[:end].decode())


def test_encoded_and_decoded_tables(llm, reference):
    import hashlib

    ids = encoded(documents(llm, ODD_TEXTS), RANKS, public_tokenizers.PATTERN)
    got = {r.doc_id: r for r in decoded(ids, RANKS, public_tokenizers.PATTERN).collect()}
    for i, text in enumerate(ODD_TEXTS):
        own = reference(text or "")
        assert got[i].n_tokens == len(own)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, own)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.sampled_from([0, 1, 2, 255, 256, 49407, 65535]), max_size=150), min_size=1, max_size=5))
def test_range_coder_round_trip(blocks):
    given_blocks = [np.array(b, np.int64) for b in blocks]
    back = decode_blocks(encode_blocks(given_blocks), [len(b) for b in blocks])
    assert [b.tolist() for b in back] == blocks


def test_range_coder_learns():
    r = np.random.default_rng(3)
    words = [r.integers(0, 49408, 6) for _ in range(20)]
    told = np.concatenate([words[i] for i in r.integers(0, 20, 600)])
    (payload,) = encode_blocks([told])
    assert len(payload) < 0.6 * len(told) and (decode_blocks([payload], [len(told)])[0] == told).all()


def test_token_files(llm, monkeypatch):
    from speechset.llm import tokenfile

    texts = ODD_TEXTS + ["w" * i + " tail" for i in range(1, 60)]
    df = documents(llm, texts).withColumn("doc_id", F.when(F.col("doc_id") == 3, F.lit(None)).otherwise(100 - F.col("doc_id")))
    path, encode = new_folder(llm, "file"), library(WORDS)
    write_tokens(df, path, WORDS, end=2, parts=3)
    got = {r.doc_id: r for r in read_documents(llm, path, ids=True).collect()}
    at = 0
    order = sorted(((None if i == 3 else 100 - i), t) for i, t in enumerate(texts) if i != 3)
    for doc_id, text in [(None, texts[3]), *order]:
        ids = encode(text or "") + [2]
        row = got[doc_id]
        assert (row.start, row.n_tokens, np.frombuffer(row.ids, "<u4").tolist()) == (at, len(ids), ids)
        assert row.ids_crc32 == zlib.crc32(array.array("I", ids).tobytes())
        at += len(ids)
    assert sum(len(r.ids) for r in read_blocks(llm, path).collect()) == at
    broken = new_folder(llm, "file")
    llm.read.parquet(path).withColumn("checksum", F.col("checksum") + 1).write.parquet(broken)
    with pytest.raises(Exception, match="checksum"):
        read_blocks(llm, broken).collect()
    empty = new_folder(llm, "file")
    write_tokens(df.where("false"), empty, WORDS, end=2)
    assert read_documents(llm, empty).count() == 0 and tokenfile.BLOCK == 4096


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=120))
def test_moves_place_every_rank_once_and_fit(sizes):
    counts = {s: sizes.count(s) for s in set(sizes)}
    moves, opened = best_fit_moves(counts, 64)
    filled, placed = {}, []
    for size, low, high, first, offset in moves:
        for rank in range(low, high + 1):
            assert filled.get(first + rank - low, 0) == offset
            filled[first + rank - low] = offset + size
            placed.append((size, rank))
    assert sorted(placed) == sorted((s, r) for s, n in counts.items() for r in range(n))
    assert len(filled) == opened and max(filled.values()) <= 64
    # No two sequences could be one, as a document only opens one where it fits in no other.
    assert opened <= 2 * sum(sizes) / 64 + 1
    assert all(a + b > 64 for a, b in zip(sorted(filled.values()), sorted(filled.values())[1:]))


def test_packed_documents(llm):
    texts = ODD_TEXTS + [f"text number {i} " + "word " * (i * 37 % 900) for i in range(60)] + ["equal length"] * 30
    got = pack(documents(llm, texts), BYTES, capacity=256, ids=True).collect()
    encode, ids, places = library(BYTES), {}, {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.piece)):
        own = np.frombuffer(r.ids, "<u4")
        assert len(own) == r.length and zlib.crc32(own.tobytes()) == r.ids_crc32 and r.start == len(ids.setdefault(r.doc_id, []))
        assert r.piece == 0 or r.length == 256
        ids[r.doc_id] += own.tolist()
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert ids == {i: encode(t or "") + [0] for i, t in enumerate(texts)}
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 256
    assert pack(documents(llm, ["x"]).where("false"), BYTES).count() == 0


def test_packing_moves_the_ids_once(llm, monkeypatch):
    from speechset.llm import packing

    ranked = []
    positions = packing.dense_positions
    monkeypatch.setattr(packing, "dense_positions", lambda df, *more: ranked.append(df.columns) or positions(df, *more))
    # Repeated and null ids are documents of their own, also where their ids come back to them.
    texts = [f"text number {i} " + "word " * i for i in range(40)]
    df = documents(llm, texts).withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") % 3))
    got = pack(df, BYTES, capacity=64, ids=True)
    assert "ids" not in ranked[0]
    rows, encode = got.collect(), library(BYTES)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    assert sum(r.length for r in rows) == sum(len(encode(t)) + 1 for t in texts)
    spans = {}
    for r in rows:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.offset + r.length))
    assert all([a for a, _ in sorted(s)] == [0, *[b for _, b in sorted(s)][:-1]] for s in spans.values())
