"""Tokens, plane shards and packing against the tokenizer itself and plain Python."""

import io
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orderloom.llm import packing, tokenbin, tokens
from orderloom.llm.planes import BITS, BYTES, PlaneReader, PlaneWriter
from orderloom.llm.queries import QUERIES, tokenizer
from orderloom.llm.tokens import encoder

NAMES = ("word_bpe_49k.json", "byte_bpe_50k.json")
PLAIN = {name: Tokenizer.from_file(public_tokenizers.path(name)) for name in NAMES}

TRICKY = ["a", "Be", "é", "É", "e\u0301", "ß", "Σ", "İ", " ", "  ", "\n", "\t", "\x1c", "\x85",
          "\xa0", "\u3000", "'s", "'ll", "'", "12", "3", "!", ".", ",", "##", "<|endoftext|>", "漢字",
          "👍", "\x00", "\r\n", "\u200b"]


def plain_ids(name, text):
    return PLAIN[name].encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", NAMES)
@settings(max_examples=400, deadline=None)
@given(parts=st.lists(st.sampled_from(TRICKY) | st.characters(codec="utf-8"), max_size=14))
def test_pieces_give_the_ids_of_the_whole_text(name, parts):
    text = "".join(parts)
    found = np.frombuffer(encoder(tokenizer(name)).ids([text])[0], "<u4").tolist()
    assert found == plain_ids(name, text)


@pytest.mark.parametrize("planes", [BITS, BYTES])
@pytest.mark.parametrize("block", [8, 64, 65536])
def test_planes_round_trip(planes, block):
    rng = np.random.default_rng(block)
    docs = [(None if i == 3 else i, rng.integers(0, 2 ** (32 if i % 5 == 0 else 15), n).astype("<u4"))
            for i, n in enumerate([0, 1, 7, 8, 9, 200, 0, 65, 3])]
    out = io.BytesIO()
    writer = PlaneWriter(out, planes, block)
    for doc_id, ids in docs:
        writer.add(doc_id, ids.tobytes())
    writer.close()
    reader = PlaneReader(io.BytesIO(out.getvalue()), len(out.getvalue()))
    start, want = 0, []
    for doc_id, ids in docs:
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert list(reader.documents()) == want
    whole = np.concatenate([ids for _, ids in docs])
    for a, n in [(0, 5), (7, 60), (100, 10_000), (len(whole), 4)]:
        assert reader.ids(a, n).tolist() == whole[a:a + n].tolist()


def test_empty_shard():
    out = io.BytesIO()
    writer = PlaneWriter(out)
    writer.close()
    assert list(PlaneReader(io.BytesIO(out.getvalue()), out.tell()).documents()) == []


def given_docs(spark):
    rows = [(5, "Hello world, it's"), (2, None), (9, ""), (None, "no id"), (2, "again"),
            (7, "x" * 3000 + " y" * 3000), (9, "")]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows],
                                 "doc_id bigint, text string, start string, n_tokens int"), rows


def test_shards_of_awkward_rows(spark):
    df, rows = given_docs(spark)
    name = NAMES[0]
    found = tokenbin.token_shards(df, tokenizer(name), block_ids=64).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, want = 0, []
    for doc_id, text in order:
        ids = np.array([*plain_ids(name, text), 1], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(repr, (tuple(r)[:4] for r in found))) == sorted(map(repr, want))
    assert tokenbin.token_shards(df.limit(0), tokenizer(name)).count() == 0


def test_shards_of_the_documents(spark):
    sf = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in QUERIES["op2_token_planes"](spark, sf).collect()}
    start = 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array([*plain_ids(NAMES[0], r.text), 1], "<u4")
        got = found.pop(r.doc_id)
        assert (got.start, got.n_tokens, got.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not found


def assert_packed(rows, docs, name, cap):
    """Pieces cover each document's ids, and sequences are filled without gaps."""
    by_seq, by_doc = {}, {}
    for r in rows:
        assert 1 <= r.length <= cap
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= cap
    for doc_id, text in docs:
        ids = np.array([*plain_ids(name, text), 2], "<u4")
        at = 0
        for i, r in enumerate(sorted(by_doc[doc_id], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (i, at) and (i == 0 or r.length == cap)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    return len(by_seq)


def test_packing_of_the_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = QUERIES["op10_pack"](spark, sf).collect()
    n = assert_packed(rows, docs, NAMES[1], 1024)
    least = -(-sum(r.length for r in rows) // 1024)
    assert n <= least + 3


def test_packing_of_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, "word " * 700), (4, "a"), (5, "b c " * 64)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, length string")
    found = packing.packed_digest(df, tokenizer(NAMES[1]), cap=64).collect()
    assert_packed(found, rows, NAMES[1], 64)
    twice = packing.packed_digest(df.unionByName(df), tokenizer(NAMES[1]), cap=64)
    assert twice.count() == 2 * len(found)
    assert twice.groupBy("sequence_id", "offset").count().where("count > 1").count() == 0
    with_ids = packing.pack_documents(df, tokenizer(NAMES[1]), cap=64)
    assert all(len(r.ids) == 4 * r.length for r in with_ids.collect())
    assert packing.packed_digest(df.limit(0), tokenizer(NAMES[1])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.sampled_from([1, 2, 7, 500, 10 ** 9]), max_size=40))
def test_plans_hold_every_length(histogram):
    runs = packing.plan(histogram, 64)
    held: dict[int, int] = {}
    for run in runs:
        assert run.free >= 0 and sum(n * k for n, k in run.parts) + run.free == 64
        for length, times in run.parts:
            held[length] = held.get(length, 0) + run.n * times
    assert held == histogram


def test_configurations_reach_the_optimum():
    """Three sizes that fit only together: 512 + 341 + 171 = 1024."""
    runs = packing.plan({512: 600, 341: 600, 171: 600}, 1024)
    assert sum(run.n for run in runs) == 600


@pytest.mark.parametrize("name", NAMES)
def test_control_strings_are_ids_as_in_the_library(name):
    rnd = random.Random(4)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|endoftext", "|>", " ", "a", "Word's", "\n\n", "é", "<|EndOfText|>"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9))) for _ in range(400)]
    made = tokens.Encoder(tokenizer(name)).ids(texts)
    library = Tokenizer.from_file(tokenizer(name))
    for text, ids in zip(texts, made, strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text
    library.encode_special_tokens = True
    literal = tokens.Encoder(tokenizer(name), literal=True).ids(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in literal] == [
        library.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.integers(1, 256), st.sampled_from([1, 2, 7, 50]), min_size=1, max_size=60))
def test_plans_are_no_worse_than_best_fit(histogram):
    alone = packing.best_fit([], sorted(histogram.items(), reverse=True), 256)
    assert sum(r.n for r in packing.plan(histogram, 256)) <= sum(r.n for r in alone)


def test_plan_of_the_documents_is_no_worse_than_best_fit(spark):
    rows = QUERIES["op10_pack"](spark, "/root/testdata/sf0.01").select("length", "sequence_id").collect()
    histogram = Counter(r.length for r in rows)
    alone = packing.best_fit([], sorted(histogram.items(), reverse=True), 1024)
    assert len({r.sequence_id for r in rows}) <= sum(r.n for r in alone)
