import collections
import hashlib
import random

import numpy as np
import pytest

from casewright.llm import substring_dedup
from casewright.llm.queries import QUERIES


def plain(texts, length=200):
    """Row -> (bytes, removed, spans, kept), by looking at every window."""
    raw = [(t or "").encode() for t in texts]
    count = collections.Counter(hashlib.blake2b(b[i:i + length], digest_size=12).digest() for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if count[hashlib.blake2b(b[i:i + length], digest_size=12).digest()] > 1:
                gone[i:i + length] = True
        spans = int((gone[1:-1] & ~gone[:-2]).sum() + gone[0]) if len(b) > 1 else int(gone[0])
        out.append((len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])))
    return out


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").toPandas()
    want = {i: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for i, w in zip(docs["doc_id"], plain(docs["text"]))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op3_substring_dedup"](spark, sf).collect()}
    assert got == want
    assert sum(w[1] for w in want.values()) > 0


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, long_ = prose(60), prose(900)
    texts = [prose(rng.randint(5, 150)) for _ in range(40)]
    texts += [f"{prose(rng.randint(0, 40))} {passage} {prose(rng.randint(0, 40))}" for _ in range(120)]
    texts += [long_] * 3 + [long_[:700] + "X" + long_[701:], long_[100:299], long_[100:300], long_[5:206], passage[:199]]
    texts += ["a" * 1000, "ab" * 300, "a" * 199, "a" * 200, "", None, "é" * 100, "é" * 101, passage + passage, "\x00" * 250]
    return texts


@pytest.mark.parametrize("hot, shard, part", [(4000, 1 << 20, 4 << 20), (4000, 300, 250), (3, 1 << 20, 4 << 20)])
def test_against_plain(spark, monkeypatch, hot, shard, part):
    monkeypatch.setattr(substring_dedup, "_HOT_SEGMENTS", hot)
    monkeypatch.setattr(substring_dedup, "_PART", part)
    texts = corpus(hot + shard)
    merge = substring_dedup.shared_prefixes
    for strings in ([t.encode() for t in texts if t][:60], [b"aa", b"aab", b"", b"a"]):
        got = merge(strings, 200, shard)
        for i, s in enumerate(strings):
            for k in range(0, len(s), 37):
                best = max((common(s[k:], o[m:]) for j, o in enumerate(strings) for m in ([x for x in range(len(o)) if o[x:x + 1] == s[k:k + 1]] if len(o) < 40 else []) if (i, k) != (j, m)), default=0)
                assert got[i][k] >= min(best, 200) // 8 * 8
    docs = spark.createDataFrame([(i, t, -1, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_bytes int, spans string").repartition(5)
    # The shard size must reach the tasks, which do not see a patched module.
    got = {r.id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in substring_dedup.dedup_substrings(docs).collect()}
    want = dict(enumerate(plain(texts)))
    assert {i for i in want if got[i] != want[i]} == set()


def common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def test_merged_transforms_by_brute_force():
    rng = random.Random(4)
    for round_ in range(90):
        step = (None, 1, 2)[round_ % 3]
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 6))]
        got = substring_dedup.shared_prefixes(strings, 12, rng.choice([5, 20, 1000]), step)
        width = step or 4
        for i, s in enumerate(strings):
            want = [max((min(common(s[k:], o[m:]), 12) for j, o in enumerate(strings) for m in range(len(o)) if (i, k) != (j, m)), default=0) for k in range(len(s))]
            assert got[i].tolist() == [w // width * width for w in want], (strings, i)


def test_repeated_rows_and_null_ids(spark):
    text = "".join(chr(97 + i * i % 26) + str(i) for i in range(120))
    rows = [(None, text), (None, text), (1, "q" + text), (1, None), (1, None), (2, text[:150])]
    got = collections.Counter((r.id, r.n_bytes, r.n_removed, r.n_spans) for r in substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    n = len(text)
    assert got == {(None, n, n, 1): 2, (1, n + 1, n, 1): 1, (1, 0, 0, 0): 2, (2, 150, 0, 0): 1}
    assert substring_dedup.dedup_substrings(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_segments_that_cannot_share_a_window_are_not_merged():
    """Against all windows: none that two segments share is lost, and segments that share only the gram go."""
    rng = random.Random(7)
    for length in (64, 97, 200):
        gram = bytes(rng.choices(range(256), k=32))
        reach = length - 32
        segments = {}
        for _ in range(60):
            left, right = rng.randint(0, reach), rng.randint(0, reach)
            before, after = b"xy"[rng.randint(0, 1):][:1] * 9 + b"x" * reach, b"z" * (reach - 9) + bytes(rng.choices(b"yz", k=9))
            segments[before[len(before) - left:] + gram + after[:max(right, reach - left)]] = left
        windows = {s: {s[a:a + length] for a in range(max(0, p - reach), min(p, len(s) - length) + 1)} for s, p in segments.items()}
        count = collections.Counter(w for found in windows.values() for w in found)
        got = substring_dedup.may_share(list(segments), list(segments.values()), length)
        want = np.array([any(count[w] > 1 for w in found) for found in windows.values()])
        assert want.any() and not (want & ~got).any()
    apart = [bytes([65 + i]) * 168 + gram + bytes([97 + i]) * 168 for i in range(9)]
    assert not substring_dedup.may_share(apart, [168] * 9, 200).any()


def test_texts_looked_at_together_have_the_segments_of_each_alone():
    rng = random.Random(11)
    texts = [bytes(rng.choices(b"abc ", k=n)) for n in [0, 5, 199, 200, 201, 3000, 64, 900, 200, 70_000, 400] * 4]
    together = list(zip(*substring_dedup.anchors(texts, 200)))
    alone = [(i, *row[1:]) for i, t in enumerate(texts) for row in zip(*substring_dedup.anchors([t], 200))]
    assert together == alone
    for i, start, windows, place, gram in together:
        assert 0 <= start <= place and start + windows - 1 <= place <= start + 168 and start + windows + 199 <= len(texts[i])
    assert [sum(n for i, _, n, _, _ in together if i == k) for k in range(len(texts))] == [max(0, len(t) - 199) for t in texts]


def test_full_prefixes_are_those_of_the_whole_merge():
    """Read from fewer suffixes, in every way to deal the strings to shards; shorter strings and copies included."""
    rng = random.Random(5)
    for round_ in range(90):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 6))]
        shard, step = rng.choice([5, 20, 1000]), (None, 1, 2)[round_ % 3]
        want = [(x >= 12).tolist() for x in substring_dedup.shared_prefixes(strings, 12, shard, step)]
        assert [(x >= 12).tolist() for x in substring_dedup.shared_prefixes(strings, 12, shard, step, full=True)] == want
