import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from casewright.llm import simhash
from casewright.llm.common import table
from casewright.llm.queries import QUERIES
from casewright.session import stage

CLASSIC = {"words_per_shingle": 4, "n_parts": 1, "probe_bits": 4, "max_bits": 4}


def plain_fingerprint(text, k):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, max_bits):
    """Row -> root row, by comparing all pairs."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= max_bits:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def smallest(ids, roots):
    best = {}
    for i, r in zip(ids, roots):
        if i is not None:
            best[r] = min(best.get(r, i), i)
    return [best.get(r) for r in roots]


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").toPandas()
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op9_simhash"](spark, sf).collect()}
    fps = [plain_fingerprint(t, 4) for t in docs["text"]]
    ids = docs["doc_id"].tolist()
    want = {i: (f"{f:016x}", c) for i, f, c in zip(ids, fps, smallest(ids, plain_components(fps, 4)))}
    assert got == want


def test_spark_has_the_same_hash(spark):
    text = "zażółć gęślą jaźń and so on"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % 2**64 == xxhash.xxh64(text.encode(), seed=42).intdigest()


@pytest.mark.parametrize("leaf, side", [(16, 8192), (16, 8), (100_000, 64)])
def test_links_on_dense_and_sparse_fingerprints(spark, monkeypatch, leaf, side):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 150, dtype=np.uint64)
    flips = rng.integers(0, 64, (250, 3)).astype(np.uint64)
    near = base[rng.integers(0, 150, 250)] ^ (np.uint64(1) << flips).sum(axis=1, dtype=np.uint64)
    hot = np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64))
    fps = np.unique(np.concatenate([base, near, hot, np.zeros(1, np.uint64)])).tolist()
    monkeypatch.setattr(simhash, "_LEAF", {1: leaf, 4: leaf})
    monkeypatch.setattr(simhash, "_SIDE", {1: side, 4: side})
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    forest_rows = spark.createDataFrame([(i, 0, f) for i, f in enumerate(signed)], "id long, version long, part0 long")
    got = {r.id: r.component_id for r in simhash.classes(forest_rows, 4, 4).collect()}
    assert got == dict(zip(range(len(fps)), smallest(range(len(fps)), plain_components(fps, 4))))


def test_odd_rows(spark):
    rows = [(1, "one two three four five six", "x"), (2, "ONE  two\tthree four five six", None), (2, "ONE  two\tthree four five six", None),
            (3, None, "x"), (4, "", "x"), (5, " \n ", "x"), (None, "one two three four five six", "x"), (None, "alone here", "x"), (6, "w " * 200_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part0 string")
    got = sorted(((r.id, r.component_id) for r in simhash.near_duplicates(docs, **CLASSIC).collect()), key=repr)
    assert got == sorted([(1, 1), (2, 1), (2, 1), (None, 1), (3, 3), (4, 3), (5, 3), (None, None), (6, 6)], key=repr)
    assert simhash.near_duplicates(docs.limit(0), **CLASSIC).count() == 0


def shingles(text, k=5):
    words = text.lower().split()
    return {" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def test_near_copies(spark, sf):
    """Of the pairs whose five-word shingles have a Jaccard similarity of 0.85 or more, most are linked; of those under 0.6 none."""
    docs = table(spark, sf, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    sets = {i: shingles(t) for i, t in texts.items()}
    by_gram = {}
    for i, s in sets.items():
        for g in s:
            by_gram.setdefault(g, []).append(i)
    shared = {}
    for ids in by_gram.values():
        for x in range(len(ids)):
            for y in ids[:x]:
                shared[y, ids[x]] = shared.get((y, ids[x]), 0) + 1
    near = {p: n / (len(sets[p[0]]) + len(sets[p[1]]) - n) for p, n in shared.items()}
    component = {r.id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    alike = [p for p, j in near.items() if j >= 0.85 and min(len(sets[p[0]]), len(sets[p[1]])) > 20]
    assert len(alike) > 20
    assert sum(component[a] == component[b] for a, b in alike) >= 0.95 * len(alike)
    close = plain_components_by(near, texts, 0.6)
    assert all(close[i] == close[c] for i, c in component.items() if len(sets[i]) > 20)
    kept = {r.doc_id for r in simhash.keep_one(docs).collect()}
    assert kept == set(component.values())


def plain_components_by(near, ids, least):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for (a, b), j in near.items():
        if j >= least:
            parent[find(a)] = find(b)
    return {i: find(i) for i in ids}


def test_keep_one_of_repeated_rows(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (1, "A b c d e f", "y"), (None, None, "z"), (None, "", "z"), (None, None, "z"), (2, "q", "x")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, __note string")).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 2]


def pairs_at(rng, n_pairs, low, high):
    """Pairs of texts whose five-word shingle sets have a similarity within [low, high)."""
    out = []
    while len(out) < n_pairs:
        words = rng.integers(0, 10**6, int(rng.integers(40, 300))).astype(str)
        other = words.copy()
        while (j := (lambda a, b: len(a & b) / len(a | b))(shingles(" ".join(words)), shingles(" ".join(other)))) >= high:
            other[rng.integers(0, len(words))] = str(rng.integers(10**6, 10**7))
        if j >= low:
            out.append((" ".join(words), " ".join(other)))
    return out


@pytest.mark.parametrize("piece", [1024, 8])
def test_the_line_is_at_a_similarity_of_eight_tenths(spark, monkeypatch, piece):
    """Pairs just above 0.8 are linked, pairs below it never; also when candidate groups are cut into pieces."""
    monkeypatch.setattr(simhash, "_PIECE", piece)
    rng = np.random.default_rng(3)
    above, below = pairs_at(rng, 400, 0.8, 0.85), pairs_at(rng, 400, 0.7, 0.8)
    words = rng.integers(0, 10**6, 200).astype(str)
    group = [" ".join([*words[:-k - 1], *(f"{k}x{i}" for i in range(k + 1))]) for k in range(30)]  # neighbours alike, ends not
    texts = [t for p in above + below for t in p] + group
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    component = {r.id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    joined = [component[2 * i] == component[2 * i + 1] for i in range(800)]
    print("recall at 0.80-0.85:", np.mean(joined[:400]))
    assert np.mean(joined[:400]) >= 0.985 and not any(joined[400:])
    sets = [shingles(t) for t in group]
    near = {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in range(30) for j in range(i)}
    want = plain_components_by(near, range(30), 0.8)
    got = [component[1600 + i] for i in range(30)]
    assert all((got[i] == got[j]) == (want[i] == want[j]) for i in range(30) for j in range(i))


def test_keep_one_leaves_untouched_rows_and_repeats_alone(spark):
    """Rows of other texts stay as they are; of equal rows, equal texts and null ids one stays; columns keep their order."""
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text, "a"), (5, text, "a"), (9, text, "b"), (None, text, "c"), (1, "alone here", "d"), (2, None, "e"), (3, "", "f"), (2, None, "e")]
    got = sorted(map(str, map(tuple, simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)).collect())))
    assert got == sorted(map(str, [(5, text, "a"), (1, "alone here", "d"), (2, None, "e")]))
    assert simhash.keep_one(spark.createDataFrame(rows[4:5], "doc_id long, text string, source string")).count() == 1


def test_short_texts_at_eight_tenths_are_all_linked(spark):
    """Fingerprints of few shingles are noisy; pairs that they miss are found by their shingles."""
    rng = np.random.default_rng(11)
    texts = []
    for n in (8, 12, 16, 20, 44):
        for _ in range(80):
            words = rng.integers(0, 10**6, n).astype(str).tolist()
            # Words at the ends cost a shingle each; as many as 0.8 allows.
            more = (n - 4) // 4
            texts += [" ".join(words), " ".join([*words, *(f"x{w}" for w in words[:more])])]
    alike = [len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) >= 0.8 for a, b in zip(texts[::2], texts[1::2])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    component = {r.id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert all(alike) and len({*component.values()}) == len(alike)
    assert [component[2 * i + 1] for i in range(len(alike))] == [2 * i for i in range(len(alike))]


def test_trees_are_asked_in_rounds_of_bounded_copies(spark, monkeypatch):
    """Deeper trees copy a fingerprint more often; what one round shuffles does not grow with them, and the links are the same."""
    rng = np.random.default_rng(2)
    per_fp, most = [], []
    for n in (2_000, 20_000, 200_000):
        weight = np.bincount(rng.integers(0, 1 << 16, n), minlength=1 << 16).astype(np.int64)
        forest = simhash.Forest(*map(list, zip(*[simhash._tree(weight, 1, 512)] * 16)))
        copies = simhash._copies(forest, 1024)
        rounds = simhash._rounds(copies, 24 * n)
        assert sorted(b for r in rounds for b in r) == list(range(16))
        per_fp.append(sum(copies) / n)
        most.append(max(sum(copies[b] for b in r) for r in rounds) / n)
    assert per_fp[2] > 3 * per_fp[0] and max(most) <= 24
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, base ^ np.uint64(1 << 7), base ^ np.uint64(3 << 40)])).tolist()
    rows = spark.createDataFrame([(i, 0, f) for i, f in enumerate(fps)], "id long, version long, part0 long")
    monkeypatch.setattr(simhash, "_LEAF", {1: 16, 4: 16})
    monkeypatch.setattr(simhash, "_COPIES", 1)
    got = {r.id: r.component_id for r in simhash.classes(rows, 4, 4).collect()}
    assert got == dict(zip(range(len(fps)), smallest(range(len(fps)), plain_components(fps, 4))))


def test_staged_writes_leave_no_shuffle_files(spark):
    held = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").count(".data")
    before = held()
    stage(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), "test-shuffles").count()
    for _ in range(50):
        if held() <= before + 1:  # that of the count itself
            break
        time.sleep(0.1)
    assert held() <= before + 1


def test_pieces_of_a_large_group_meet_in_rounds(spark, monkeypatch):
    """A group of many pieces is compared in several rounds, each with a shuffle of its own, and none of its pairs is lost."""
    names, plain_stage = [], simhash.stage
    monkeypatch.setattr(simhash, "stage", lambda df, name: (names.append(name), plain_stage(df, name))[1])
    monkeypatch.setattr(simhash, "_PIECE", 8)
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join([*words, *(f"{k}y{i}" for i in range(3))]) for k in range(64)] + [" ".join([*words[:40], *(f"z{i}" for i in range(60))])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    component = {r.id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert component == {**dict.fromkeys(range(64), 0), 64: 64}
    assert sum(n.startswith("simhash-confirmed-") for n in names) >= 2
