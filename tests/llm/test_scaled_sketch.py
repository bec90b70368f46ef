"""Fingerprints against a plain version with the same seeded hashes, and estimates against exact shares."""

import hashlib
import random
import re
import statistics

import pytest
import xxhash
from pyspark.sql import functions as F

from casewright.llm import scaled_sketch
from casewright.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def shingles(text, n=5):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return [tuple(words[i:i + n]) for i in range(max(len(words) - n, 0) + 1)] if words else []


def hash_of(shingle):
    seed = 42
    for word in shingle:
        seed = xxhash.xxh64_intdigest(word.encode(), seed)
    return seed & (2**63 - 1)


def plain_sketch(text, fraction=1 / 8):
    hashes = {hash_of(s) for s in shingles(text)}
    return sorted(h for h in hashes if h < 2**63 * fraction) or sorted(hashes)[:1]


def plain_containment(a, b):
    return len(set(a) & set(b)) / len(a) if a else float(not b)


def signed_hash(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - 2**64 if h >= 2**63 else h


def plain_rows(rows):
    rows = sorted(((i is not None, i or 0, signed_hash(t or "")), i, t or "") for i, t in rows)[::-1]
    printed = lambda sketch: "".join(f"{h:016x}" for h in sketch)
    out = []
    for k, (_, i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][2]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        own, other, following = plain_sketch(text), plain_sketch(edited), plain_sketch(after)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), printed(own), printed(other), plain_containment(own, other),
                    plain_containment(own, following)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture()
def docs():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)] + ["ä", "漢字", "😀"]
    rows = []
    for i in rng.sample(range(-50, 1000), 120):
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 5, 40, 200])))))
    return rows + [(5, None), (5, ""), (6, " \n "), (None, "no id " * 9), (None, None), (7, "long " * 100_000)]


def test_matches_plain_version(spark, docs):
    assert rows_of(scaled_sketch.edited_and_next(spark.createDataFrame(docs, SCHEMA).repartition(6))) == plain_rows(docs)


def test_repeated_rows(spark, docs):
    """A third of all rows are one row, others repeat a few times; ids repeat with other texts."""
    rows = docs + [(3, "a b c d e f g h i")] * 150 + [(None, "no id " * 9)] * 60 + docs[:20] + [(3, f"other {i}") for i in range(30)]
    assert rows_of(scaled_sketch.edited_and_next(spark.createDataFrame(rows, SCHEMA).repartition(9))) == plain_rows(rows)


def test_odd_tables(spark):
    assert scaled_sketch.edited_and_next(spark.createDataFrame([], SCHEMA)).count() == 0
    for rows in [[(1, "one two three four five six seven")], [(None, None)], [(1, "a")] * 3, [(1, None), (2, "x y z " * 30)]]:
        assert rows_of(scaled_sketch.edited_and_next(spark.createDataFrame(rows, SCHEMA))) == plain_rows(rows)
    clash = spark.createDataFrame([(1, "a b c d e f", 3, "q", 9), (2, "b c d e f g", 4, "r", 8)], SCHEMA + ", version int, next_text string, id int")
    assert rows_of(scaled_sketch.edited_and_next(clash)) == plain_rows([(1, "a b c d e f"), (2, "b c d e f g")])


def test_ids_of_text(spark):
    got = scaled_sketch.edited_and_next(spark.createDataFrame([("b", "x y z"), ("a", "p q r"), (None, "s t u")], "doc_id string, text string"))
    nexts = {"b": "p q r", "a": "s t u", None: "x y z"}
    own = {"b": "x y z", "a": "p q r", None: "s t u"}
    for row in got.collect():
        text = own[row["id"]]
        assert row["edited_sha256"] == hashlib.sha256((text[:4] + nexts[row["id"]][:1]).encode()).hexdigest()


def test_merging_and_estimates(spark):
    """A short text in a long one; the merged sketch is the sketch of both."""
    rng = random.Random(1)
    rows = []
    for i in range(60):
        small = [f"a{rng.randrange(10**6)}" for _ in range(800)]
        share = i / 60
        inside = small[:int(share * 800)]
        big = inside + [f"b{rng.randrange(10**6)}" for _ in range(12_000)]
        rows.append((" ".join(small), " ".join(big), share))
    df = spark.createDataFrame(rows, "small string, big string, share double")
    a, b = scaled_sketch.sketch(F.col("small")), scaled_sketch.sketch(F.col("big"))
    got = df.select(a.alias("a"), b.alias("b"), "small", "big", "share").select(
        "*", scaled_sketch.merged(F.col("a"), F.col("b")).alias("m"), scaled_sketch.containment(F.col("a"), F.col("b")).alias("c"),
        scaled_sketch.resemblance(F.col("a"), F.col("b")).alias("r")).collect()
    for row in got:
        assert row["m"] == sorted(set(row["a"]) | set(row["b"]))
        exact = set(shingles(row["small"])) & set(shingles(row["big"]))
        assert abs(row["c"] - len(exact) / len(set(shingles(row["small"])))) < 0.2
        assert row["r"] <= 0.1
    assert statistics.mean(abs(r["c"] - r["share"]) for r in got) < 0.05


def test_native(spark, sf):
    found = QUERIES["op12_document_fingerprints"](spark, sf)
    plan = found._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_query(spark, sf):
    rows = list(map(tuple, spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()))
    assert rows_of(QUERIES["op12_document_fingerprints"](spark, sf)) == plain_rows(rows)
