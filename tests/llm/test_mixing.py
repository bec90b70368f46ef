import math
import re

import numpy as np
import pytest

from casewright.llm import mixing
from casewright.llm.queries import QUERIES


def plain_targets(sizes, share=1.5, most=2, weights=(5, 2, 1)):
    """Source -> target, by taking out one capped source after another."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > most * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in free}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        free -= over
    return out


def plain_rates(words, target, most=2):
    """The balanced rates of one source by bisection."""
    words = np.asarray(words, float)
    if target >= most * words.sum():
        return np.full(len(words), float(most))
    low, high = -1e4, 1e4
    for _ in range(200):
        tilt = (low + high) / 2
        rates = np.minimum(np.exp(np.minimum(tilt * words / words.mean(), 50)), most)
        low, high = (tilt, high) if (words * rates).sum() < target else (low, tilt)
    return rates


def check(docs, got):
    """docs: (doc_id, text, source); got: rows of the query."""
    sizes = {i: len([w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]) for i, t, _ in docs}
    source = {i: s for i, _, s in docs}
    by_source = {}
    for i, s in source.items():
        by_source.setdefault(s, []).append(i)
    whole = {s: sum(sizes[i] for i in ids) for s, ids in by_source.items()}
    aims = plain_targets(whole)
    assert len(got) == len(docs)
    for r in got:
        assert r.size == sizes[r.doc_id] and r.source_size == whole[source[r.doc_id]]
        assert math.isclose(r.target, aims[source[r.doc_id]], rel_tol=1e-12)
        assert 0 <= r.taken <= 2 * r.size and (r.taken == 0 or r.taken % r.size == 0)
    copies = {r.doc_id: r.taken // r.size if r.size else 0 for r in got}
    for s, ids in by_source.items():
        words = [sizes[i] for i in ids]
        largest = max(words)
        assert abs(sum(copies[i] * sizes[i] for i in ids) - aims[s]) <= 2 * largest + 1
        # Copies follow the tilted rates over each run of sizes.
        ids.sort(key=lambda i: (sizes[i], i))
        with_words = [i for i in ids if sizes[i]]
        if with_words and len(ids) <= 4096:
            rates = plain_rates([sizes[i] for i in with_words], aims[s]) if len(with_words) == len(ids) else None
            if rates is not None:
                assert np.abs(np.cumsum(rates) - np.cumsum([copies[i] for i in with_words])).max() <= 0.51


def test_query(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()]
    first = QUERIES["op4_mixing"](spark, sf).collect()
    check(docs, first)
    assert sorted(first) == sorted(QUERIES["op4_mixing"](spark, sf).collect())


def test_hot_source_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(["w"] * int(rng.integers(1, 400))), "hot" if i % 3 else ["a", None, "", "é", "zz"][i // 3 % 5]) for i in range(3000)]
    docs += [(5000, None, "a"), (5001, "", "b"), (5002, " \n\t", None), (5003, "x " * 100_000, "long"), (5004, "no\x85break here", "c")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(7)
    from pyspark.sql import functions as F
    got = mixing.mix(frame).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken").collect()
    check(docs, got)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "a b", "s"), (1, "a b", "s"), (None, "a b", "s")]])
def test_small_tables(spark, rows):
    frame = spark.createDataFrame([(*r, 0, 0) for r in rows], "doc_id long, text string, source string, size long, target long")
    got = mixing.mix(frame).collect()
    assert len(got) == len(rows)
    assert sum(r.taken for r in got) in {0: [0], 1: [0], 3: [8, 10]}[len(rows)]


@pytest.mark.parametrize("counts, target", [({20: 90_000, 20_000: 10_000}, 0.0005 * 201_800_000), ({1: 10_000, 10_000_000: 100}, 5.0), ({20: 90_000, 20_000: 10_000}, 1.99999 * 201_800_000)])
def test_far_tilts_are_solved(spark, counts, target):
    """Sources with many short and some very long texts, whose targets need tilts far from 0."""
    sizes = spark.createDataFrame([(s, n) for s, n in counts.items()], "size long, n int").selectExpr("'=s' AS source_key", "size", "explode(sequence(1, n))").drop("col")
    size, n_docs = sum(s * n for s, n in counts.items()), sum(counts.values())
    aims = spark.createDataFrame([("=s", size, n_docs, target)], "source_key string, source_size long, n_docs long, target double")
    row = mixing.tilts(sizes, aims).first()
    words = sum(n * s * min(math.exp(min(row.tilt * s / row.mean, 50)), 2) for s, n in counts.items())
    assert abs(words - target) <= 0.5
    with pytest.raises(RuntimeError):
        mixing.tilts(sizes, aims, most_rounds=1)
