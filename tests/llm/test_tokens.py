"""Chunked encoding, the automaton, grammar shards: all against the library and round trips."""

from __future__ import annotations

import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martloom.llm import repair_grammar, token_shards
from martloom.llm.bpe_automaton import (
    ArcLabels,
    AutomatonEncoder,
    TokenAutomaton,
    decode_ids,
    encode_with_automaton,
    load_labels,
)
from martloom.llm.chunk_encoder import ChunkEncoder, byte_bpe, word_bpe
from martloom.llm.common import byte_view, scratch_dir
from martloom.llm.repair_grammar import compress, pack, unpack
from martloom.llm.spans import hash_spans
from martloom.llm.token_shards import read_stretch, read_token_shards, write_token_shards
from tests.llm.data import edge_docs, empty_docs, texts, words

PIECES = [
    *" \n\t\r.,;:?!-'", "  ", "a", "B", "é", "É", "'s", "'RE", "1", "²", "\x1c", "\x85", "\xa0",
    " ", "　", "​", "́", "İ", "Σ", "ß", "µ", "日", "🙂", "<|", "<|endoftext|>",
    "<|startoftext|>", "the", " the", "ing",
]


def strange_texts(n: int = 4000) -> list[str]:
    r = random.Random(3)
    out = ["".join(r.choice(PIECES) for _ in range(r.randrange(30))) for _ in range(n)]
    out += ["".join(r.choice("aab") for _ in range(r.randrange(40))) for _ in range(n)]
    return out + ["a" * k for k in range(40)] + ["-=" * 40, "hahaha" * 20]


def library(name: str) -> Tokenizer:
    return Tokenizer.from_file(public_tokenizers.path(name))


@pytest.mark.parametrize(
    ("name", "make"),
    [
        ("byte_bpe_50k.json", lambda: ChunkEncoder(byte_bpe())),
        ("word_bpe_49k.json", lambda: ChunkEncoder(word_bpe())),
        ("byte_bpe_50k.json", lambda: AutomatonEncoder(byte_bpe())),
    ],
)
def test_encoders_equal_the_library(name, make):
    encoder, known = make(), library(name)
    some = strange_texts() + [t or "" for _, t in texts()]
    for text, found in zip(some, encoder.encode(some), strict=True):
        assert found.tolist() == known.encode(text, add_special_tokens=False).ids, text


def test_a_full_table_starts_anew():
    encoder, known = ChunkEncoder(byte_bpe(), most=50), library("byte_bpe_50k.json")
    some = [f"word{k} again {k % 7}" for k in range(300)]
    for at in range(0, 300, 10):
        for text, found in zip(some[at : at + 10], encoder.encode(some[at : at + 10]), strict=True):
            assert found.tolist() == known.encode(text, add_special_tokens=False).ids


def thue_morse(n: int, a: str, b: str) -> str:
    """Two such texts with their letters changed have one polynomial hash modulo 2^64, any odd base."""
    return "".join((a, b)[k.bit_count() & 1] for k in range(n))


ENCODERS = [
    ("byte_bpe_50k.json", lambda: ChunkEncoder(byte_bpe())),
    ("word_bpe_49k.json", lambda: ChunkEncoder(word_bpe())),
    ("byte_bpe_50k.json", lambda: AutomatonEncoder(byte_bpe())),
]


@pytest.mark.parametrize(("name", "make"), ENCODERS)
@pytest.mark.parametrize("together", [True, False])
def test_words_with_one_polynomial_hash_have_ids_of_their_own(name, make, together):
    encoder, known = make(), library(name)
    some = []
    for n in (1024, 2048, 4096):
        for letters in ("ab", "ba", "xq", "qx"):
            some.append(f"one two {thue_morse(n, *letters)} three")
    batches = [some] if together else [[x] for x in some]
    found = [ids.tolist() for batch in batches for ids in encoder.encode(batch)]
    assert found == [known.encode(x, add_special_tokens=False).ids for x in some]


@pytest.mark.parametrize(("name", "make"), ENCODERS)
@pytest.mark.parametrize("most", [700_000, 60])
def test_chunks_with_one_hash_have_ids_of_their_own(name, make, most):
    """Hashes cut to two bits: nearly all chunks meet others, in a batch and in the table."""
    encoder, known = make(), library(name)
    encoder.most, encoder.LONGEST = most, 12
    encoder._hashes = lambda data, lane, begins, sizes: hash_spans(data, lane, begins, sizes) & np.uint64(3)
    some = strange_texts(150) + [t or "" for i, t in texts() if i not in (12, 13)]
    for at in range(0, len(some), 40):
        for text, found in zip(some[at : at + 40], encoder.encode(some[at : at + 40]), strict=True):
            assert found.tolist() == known.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize(("name", "make"), ENCODERS)
def test_long_texts_are_encoded_part_by_part(name, make):
    encoder, known = make(), library(name)
    encoder.GROUP = 50
    r = random.Random(6)
    long = ["".join(r.choice([*PIECES, "word", " more", "x y"]) for _ in range(400)) for _ in range(60)]
    some = ["", "short", *long, words(3, 200), "a b " * 50, "", "日本語" * 40, "x" * 300]
    for text, found in zip(some, encoder.encode(some), strict=True):
        assert found.tolist() == known.encode(text, add_special_tokens=False).ids
    data, starts = byte_view(pa.array(some))
    parts, owner = encoder._parts(data, starts)
    assert len(parts) > len(starts) + 100
    assert set(starts.tolist()) <= set(parts.tolist())
    assert len(owner) == len(parts) - 1


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 4000, "abcdefghij" * 700, thue_morse(8192, "a", "b")])
def test_long_words_take_the_same_path(text):
    known = library("byte_bpe_50k.json")
    r = random.Random(len(text))
    mixed = "".join(r.choice("etaoinshrdlu") for _ in range(20_000))
    encoder = AutomatonEncoder(byte_bpe())
    for word in (text, mixed, mixed[:2049], text + "é" * 2100):
        assert encoder.encode([word])[0].tolist() == known.encode(word, add_special_tokens=False).ids


def test_one_arc_is_looked_up_as_many_are():
    automaton = AutomatonEncoder(byte_bpe()).automaton
    r = np.random.default_rng(2)
    state, token = r.integers(0, 50256, (2, 20_000))
    many = automaton._looked_up(state, token)
    assert [automaton._arc(int(a), int(t)) for a, t in zip(state, token, strict=True)] == many.tolist()
    assert 0 < many.sum() < len(many)


def test_a_long_word_takes_time_that_goes_with_its_length():
    r = random.Random(4)
    word = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000))
    encoder = AutomatonEncoder(byte_bpe())
    encoder.encode([word[:5000]])
    began = time.perf_counter()
    encoder.encode([word])
    assert time.perf_counter() - began < 5


def test_automaton_of_random_merges_accepts_what_bpe_makes():
    """Merges made up at random, with BPE done naively: merge after merge, left to right."""
    r = random.Random(9)
    for _ in range(30):
        labels = {k: bytes([97 + k]) for k in range(3)}
        merges = []
        while len(merges) < 12:
            u, v = r.choice(list(labels)), r.choice(list(labels))
            label = labels[u] + labels[v]
            if label not in labels.values():
                labels[len(labels)] = label
                merges.append((u, v, len(labels) - 1))
        automaton = TokenAutomaton(labels, merges)
        for _ in range(40):
            word = [r.randrange(3) for _ in range(r.randrange(1, 14))]
            data = np.array([97 + x for x in word], np.uint8)
            want = list(word)
            for u, v, uv in merges:
                k = 0
                while k + 1 < len(want):
                    if want[k] == u and want[k + 1] == v:
                        want[k : k + 2] = [uv]
                    k += 1
            found, counts = automaton.encode(data, np.array([0]), np.array([len(data)]))
            assert found.tolist() == want
            assert counts.tolist() == [len(want)]
            assert ArcLabels(labels).decode(found) == data.tobytes()


def test_labels_decode_as_the_library():
    labels, known = load_labels(byte_bpe().file), library("byte_bpe_50k.json")
    r = random.Random(1)
    for _ in range(200):
        ids = [r.randrange(50257) for _ in range(r.randrange(30))]
        text = labels.text(np.array(ids, np.uint32))
        assert text == known.decode(ids, skip_special_tokens=False)


def test_encoding_and_decoding_tables(spark):
    known, docs = library("byte_bpe_50k.json"), edge_docs(spark)
    rows = decode_ids(encode_with_automaton(docs, byte_bpe()), byte_bpe()).collect()
    want = [
        (i, known.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in texts()
    ]
    found = [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in rows]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert encode_with_automaton(empty_docs(spark), byte_bpe()).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert decode_ids(nothing, byte_bpe()).first().decoded == ""


@pytest.mark.parametrize("alphabet", [1, 2, 4, 300])
def test_grammar_round_trip_and_random_access(alphabet):
    r = np.random.default_rng(alphabet)
    for n in (0, 1, 2, 5, 1000, 5000):
        ids = np.repeat(r.integers(0, alphabet, n), r.integers(1, 4, n)).astype(np.uint32)
        grammar = compress(ids, alphabet, least=2, share=0.1, worth=0)
        shard = unpack(pack(grammar))
        assert (shard.grammar.expand() == ids).all()
        assert shard.grammar.n_ids == len(ids)
        assert len(grammar.sequence) <= len(ids)
        lengths = [g.n_ids for g in [grammar]]
        assert lengths == [len(ids)]
        for a, b in ((0, 3), (len(ids) // 2, len(ids) // 2 + 700), (len(ids) - 2, len(ids) + 9)):
            a = max(a, 0)
            assert shard.ids(a, b).tolist() == ids[a:b].tolist()


def test_no_frequent_pair_is_left_of_random_ids():
    ids = np.random.default_rng(5).integers(0, 6, 4000).astype(np.uint32)
    grammar = compress(ids, 6, least=20, worth=0)
    left = grammar.sequence
    pairs, counts = np.unique(np.stack([left[:-1], left[1:]]), axis=1, return_counts=True)
    different = pairs[0] != pairs[1]
    assert counts[different].max() < 20


@pytest.mark.parametrize("size", [1 << 19, 1000, 7])
def test_shards_hold_every_document_in_order(spark, monkeypatch, size):
    """With small shards, documents are cut into several."""
    monkeypatch.setattr(token_shards, "SHARD_IDS", size)
    path = f"{scratch_dir(spark)}/shards"
    write_token_shards(edge_docs(spark), path, byte_bpe(), end_id=2)
    known = library("byte_bpe_50k.json")
    rows = read_token_shards(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted((i for i, _ in texts()), key=lambda x: (x is not None, x or 0))
    at, stream = 0, []
    by_crc = sorted(
        zlib.crc32(np.array(known.encode(t or "", add_special_tokens=False).ids + [2], "<u4"))
        for _, t in texts()
    )
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert r.start == at
        assert ids[-1] == 2
        at += len(ids)
        stream += ids.tolist()
    assert sorted(zlib.crc32(r.ids) for r in rows) == by_crc
    shards = spark.read.parquet(path)
    assert shards.agg(F.max("n_ids")).first()[0] < 2 * size
    assert shards.where("more").isEmpty() == (size == 1 << 19)
    part = read_stretch(spark, path, 100, 900).orderBy("place").collect()
    assert [r.token_id for r in part] == stream[100:900]
    assert [r.place for r in part] == list(range(100, 900))


def test_no_documents_make_an_empty_table(spark):
    path = f"{scratch_dir(spark)}/shards"
    write_token_shards(empty_docs(spark), path, byte_bpe(), end_id=2)
    assert read_token_shards(spark, path).count() == 0
    assert read_token_shards(spark, path).select(F.sum("start")).first()[0] is None


def test_no_frequent_pair_is_left():
    r = np.random.default_rng(3)
    ids = np.minimum(r.zipf(1.3, 60_000), 3000).astype(np.uint32)
    grammar = compress(ids, 3001)
    assert (grammar.expand() == ids).all()
    pairs = Counter(zip(grammar.sequence[:-1].tolist(), grammar.sequence[1:].tolist(), strict=True))
    assert max(pairs.values()) < 16


@pytest.mark.parametrize("alphabet", [1, 2, 5, 60])
def test_counts_kept_from_round_to_round_are_those_of_a_new_count(monkeypatch, alphabet):
    r = np.random.default_rng(alphabet)
    seen = []
    recount, places = repair_grammar._recounted, repair_grammar._places

    def placed(sequence, chosen, top):
        at, rule = places(sequence, chosen, top)
        after = sequence.copy()
        after[at] = (top + rule).astype(np.uint32)
        seen.append(np.delete(after, at + 1))
        return at, rule

    def counted(keys, counts, lost, new, least):
        keys, counts = recount(keys, counts, lost, new, least)
        left = seen[-1].tolist()
        pairs = Counter((a << 32 | b) for a, b in zip(left[:-1], left[1:], strict=True))
        want = {k: n for k, n in pairs.items() if n >= least}
        assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == want
        assert counts.tolist() == sorted(counts.tolist(), reverse=True)
        return keys, counts

    monkeypatch.setattr(repair_grammar, "_places", placed)
    monkeypatch.setattr(repair_grammar, "_recounted", counted)
    for n in (2, 3, 50, 4000):
        ids = np.repeat(r.integers(0, alphabet, n), r.integers(1, 5, n)).astype(np.uint32)
        grammar = compress(ids, alphabet, least=2, share=0.1)
        assert (grammar.expand() == ids).all()
    assert len(seen) > 8
