import collections
import os
import random
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from casewright.llm import packing
from casewright.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(docs, got, tokenizer, most_padding):
    """docs: {doc_id: text}; got: rows of the query. Every id in exactly one piece, sequences gapless."""
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in docs.items()}
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(ids)
    for i, rows in by_doc.items():
        at = 0
        for r in sorted(rows, key=lambda r: r.start):
            part = ids[i][r.start:r.start + r.length]
            assert r.start == at and len(part) == r.length and r.doc_tokens == len(ids[i])
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            at += r.length
        assert at == len(ids[i])
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    tokens = sum(map(len, ids.values()))
    assert len(by_sequence) * 2048 <= tokens * (1 + most_padding) + 2048


def test_query(spark, sf, tokenizer):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    check(docs, QUERIES["op1_packing"](spark, sf).collect(), tokenizer, 0.02)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t  \x1c\x85a1'sé.<|>"), max_size=30), max_size=4))
def test_encoder_cuts_where_the_tokenizer_does(texts):
    plain = packing._encoder(PATH)._tokenizer
    for _ in range(2):
        got = packing._encoder(PATH)(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "a", "b.", "<|endoftext|>", "<|end", "oftext|>", "\t"]), max_size=14))
def test_special_token_in_a_text(parts):
    """Its literal form is the token, as in the tokenizer's plain call."""
    text = "".join(parts)
    encoder, plain = packing._encoder(PATH), Tokenizer.from_file(PATH)
    assert np.frombuffer(encoder([text])[0], "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert plain.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 5000), max_size=64))
def test_plan_holds_the_histogram(histogram):
    held = collections.Counter()
    for often, contents in packing.plan(histogram, 64):
        assert often > 0 and sum(n * k for n, k in contents) <= 64
        for n, k in contents:
            held[n] += often * k
    assert held == histogram


def test_plan_stays_small():
    rng = random.Random(1)
    patterns = packing.plan({n: rng.randint(1, 10**9) for n in range(1, 2049)})
    assert sum(len(c) for _, c in patterns) < 2048 * 63
    patterns = packing.plan({1: 10**9, 2: 3, 2048: 10**9})
    assert len(patterns) < 10


def test_odd_rows_and_round_trip(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "_BUCKET", 3)
    texts = [None, "", "a", "a", " ", "two  spaces \n and <|endoftext|> here", "é" * 3000, "long word " * 3000, *["same text"] * 20]
    rows = [(i if i else None, t, -1, "x") for i, t in enumerate(texts)] + [(2, "a", -1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length long, sequence_id string").repartition(3)
    packed = packing.pack(docs, PATH, keep_ids=True)
    found = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    wanted = collections.Counter((i, *tokenizer.encode(t or "", add_special_tokens=False).ids, 1) for i, t, *_ in rows)
    parts = collections.defaultdict(list)
    for r in packed.collect():
        ids = found[r.sequence_id].input_ids[r.offset:r.offset + r.length]
        parts[r.id].append((r.start, ids))
    assert sum(r.n_tokens for r in found.values()) == sum((len(k) - 1) * n for k, n in wanted.items())
    assert all(len(r.input_ids) == 2048 or len(r.input_ids) == r.n_tokens and r.n_tokens & (r.n_tokens - 1) == 0 for r in found.values())
    for i, t, *_ in rows:
        if i != 2:
            assert sum((p for _, p in sorted(parts[i])), []) == [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
    assert len(parts[2]) == 2
    assert packing.pack(docs.limit(0), PATH).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n'aésTªß²1_%.,|<>-\u0301\u0416"), max_size=30), max_size=4))
def test_letters_before_a_sign_are_cut_as_the_tokenizer_does(texts):
    encoder = packing._encoder(PATH)
    assert [np.frombuffer(g, "<u4").tolist() for g in encoder(texts)] == [encoder._tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_letters_are_encoded_once_whatever_sign_follows(monkeypatch):
    """And no call of the tokenizer holds many encodings at a time."""
    sent = []
    encoder = packing._Encoder(PATH)
    plain = encoder._tokenizer

    class Counted:
        def encode_batch_fast(self, parts, **how):
            sent.append(parts)
            return plain.encode_batch_fast(parts, **how)

    encoder._tokenizer = Counted()
    text = "first " + " ".join(f"longword{sign}" for sign in (*".,;:%$#", ".\nnext"))
    assert encoder([text])[0] == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert sum(p.count("longword") for parts in sent for p in parts) == 1
    encoder([f"w{i} x" for i in range(2000)])
    assert max(map(len, sent)) <= packing._TOGETHER


def test_frequent_words_stay_known(monkeypatch):
    """A full memory loses its latest words, which are the rarest, and the ids stay the same."""
    monkeypatch.setattr(packing, "_REMEMBERED", 100)
    encoder = packing._Encoder(PATH)
    texts = ["the " + " ".join(f"common{i}" for i in range(40)), *(" ".join(f"rare{k}x{i}" for i in range(60)) for k in range(5))]
    got = [encoder([t])[0] for t in texts]
    assert {f"common{i}" for i in range(40)} <= set(encoder._known) and len(encoder._known) <= 160
    assert got == [encoder._encode([t])[0] for t in texts]


def test_memory_of_a_batch_is_given_back():
    """A worker that waits for its next task must not keep what large batches took: it kept 62 MB here before, 29 now."""
    code = """
import re
import numpy as np, pyarrow as pa, pyarrow.compute
from casewright.llm.common import slices

def held():
    return sum(map(int, re.findall(r"\\nPrivate_Dirty: +(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

def batches():
    for _ in range(3):
        yield pa.RecordBatch.from_arrays([pa.array([str(i) * 40 for i in range(100_000)])], names=["text"])

before = held()
for batch in slices(batches()):
    parts = [x.encode() for x in batch.column("text").to_pylist()]
    del parts, batch
print(held() - before)
"""
    root = Path(__file__).resolve().parents[2]
    found = subprocess.run([sys.executable, "-c", code], cwd=root, env=os.environ | {"PYTHONPATH": str(root)}, capture_output=True, text=True, check=True)
    assert float(found.stdout) < 40
