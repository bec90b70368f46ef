"""Calls to embedders and responders: exact batches, halving of a failing batch, the vote of the examples."""

import json
import random
from collections import Counter

from pyspark.sql import functions as F

from casewright.functions import models
from casewright.operators import baseline


def test_batches_are_full_and_one_bad_text_loses_one_row(spark):
    """137 texts in one partition, in Arrow batches of 10: calls of 50, 50 and 37, and halves where a text is refused."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    sizes = spark.sparkContext.accumulator(0)
    calls = spark.sparkContext.accumulator(0)

    def embedder(texts):
        calls.add(1)
        if "bad" in texts:
            raise ValueError("refused")
        sizes.add(len(texts))
        return [[float(len(t))] for t in texts]

    texts = [None if i == 3 else "bad" if i == 60 else "x" * i for i in range(137)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    try:
        rows = {r.i: r.e for r in df.withColumn("e", models.embed(F.col("t"), embedder)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(rows) == 137 and rows[60].vector is None and rows[60].error == "refused"
    assert all(rows[i].vector == [float(len(texts[i] or ""))] and rows[i].error is None for i in rows if i != 60)
    assert sizes.value == 136 and 3 < calls.value <= 3 + 12


def test_wrong_number_of_vectors_is_an_error(spark):
    """A call that gives too few vectors is halved like one that fails; alone, each text is right or has the error."""
    df = spark.createDataFrame([(i, f"t{i}") for i in range(7)], "i int, t string").coalesce(1)
    short = lambda texts: [[1.0] for t in texts if t != "t5"]
    rows = df.withColumn("e", models.embed(F.col("t"), short, 4)).collect()
    assert {r.i: r.e.error for r in rows if r.e.error} == {5: "0 answers for 1 inputs"}
    assert all(r.e.vector == [1.0] for r in rows if r.i != 5)
    assert spark.createDataFrame([], "t string").select(models.embed(F.col("t"), lambda texts: 1 / 0)).collect() == []


def test_vote_weighs_by_place():
    example = lambda label: f'Ticket:\n```x```\nOutput:\n{{"complaint_type": "{label}", "severity": "Low"}}\n'
    ask = lambda *labels: json.loads(json.loads(models.vote_call_responder(
        ["head\n" + "".join(map(example, labels)) + "\nNow classify:\n```y```\n"])[0])["choices"][0]["message"]["function_call"]["arguments"])
    assert ask("A") == {"complaint_type": "A", "severity": "Low"}
    assert ask("A", "B", "B")["complaint_type"] == "A"
    assert ask("A", "B", "B", "B")["complaint_type"] == "B"
    assert ask() == {}


def test_vocabulary_is_exact_in_two_passes(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(400)], k=rng.choice([0, 1, 30, 90]))) for _ in range(120)] + [None, "", "a b c", "w1 " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(5)
    terms = Counter()
    rows = Counter()
    for t in texts:
        found = [w for w in (t or "").split() if len(w) > 1]
        found += [f"{a} {b}" for a, b in zip(found, found[1:])]
        terms.update(found)
        rows.update(set(found))
    ranked = sorted(terms.items(), key=lambda x: (-x[1], x[0]))
    for size, buckets in ((50, 1 << 20), (50, 64), (50, 2), (50, 1), (1, 16), (300, 4096), (10**6, 64)):
        got = baseline.vocabulary(df, "t", size, buckets)
        assert sorted(((r.term, r.tf) for r in got.collect()), key=lambda x: (-x[1], x[0])) == ranked[:size], (size, buckets)
    both = {(r.term, r.tf, r.df) for r in baseline.document_frequency(df, "t", baseline.vocabulary(df, "t", 70, 512)).collect()}
    assert both == {(t, n, rows[t]) for t, n in ranked[:70]}
    assert baseline.vocabulary(df.limit(0), "t").count() == 0


def test_prompts_are_not_copied_as_a_batch(spark):
    """While calls run, a worker's Arrow memory holds the prompts of one call beside the batch that came."""
    import pyarrow as pa
    size, n = 100_000, 200
    prompts = spark.range(n, numPartitions=1).select("id", F.when(F.col("id") != 7, F.repeat(F.lit("x"), size)).alias("prompt"))

    def responder(sent):
        return [f"{len(sent)} {pa.total_allocated_bytes()}" for _ in sent]

    found = prompts.select("id", models.respond(F.col("prompt"), responder, 20).alias("r")).select("id", "r.*").orderBy("id").collect()
    assert [r.raw is None for r in found] == [r.id == 7 for r in found] and not any(r.error for r in found)
    answers = [tuple(map(int, r.raw.split())) for r in found if r.raw]
    assert [k for k, _ in answers] == [20] * 180 + [19] * 19
    assert max(held for _, held in answers) < n * size / 2


def test_fit_reads_staged_rows_in_bounded_partitions(spark, monkeypatch):
    """The rows were cached beside the fit's own blocks, and partitions, each with a gradient an iteration, grew with the rows."""
    seen = []
    fit = baseline.LogisticRegression.fit
    monkeypatch.setattr(baseline.LogisticRegression, "fit", lambda self, rows: seen.append(len(spark.sparkContext._jsc.getPersistentRDDs())) or fit(self, rows))
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    rows = spark.createDataFrame([(i, f"word{i % 3} thing", "ab"[i % 2]) for i in range(20)], "id long, text string, target string")
    baseline.logreg_fit(rows, "id", "text", "target", max_iter=3)
    assert seen == [before]
    assert [baseline.fit_partitions(n, 12) for n in (0, 1, 2_001, 40_000, 1_200_000, 6_000_000)] == [1, 1, 2, 20, 48, 120]
