"""The pipeline stage by stage, each against a plain version run on the stage's own input."""

import collections
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from casewright.llm import quality
from tests.llm.test_line_dedup import plain_dedup
from tests.llm.test_mixing import plain_targets
from tests.llm.test_packing import check as check_packing
from tests.llm.test_simhash import shingles

STAGES = dict(corpus_pipeline.STAGES)


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


@pytest.fixture(scope="module")
def steps(spark, sf):
    """Stage name -> its rows, and its input under ''."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = {"": docs.collect()}
    for name, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(step(spark, docs, sf), "test-pipeline")
        found[name] = docs.collect()
    return found


def test_columns(steps):
    names = steps[""][0].__fields__
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert steps[name][0].__fields__ == names, name


def test_quality_rules(steps):
    kept = {r.doc_id for r in steps["quality rules"]}
    for r in steps[""]:
        counts = quality.measure(r.text.encode())
        assert (r.doc_id in kept) == (counts[0] >= 10 and 100 * counts[4] <= 20 * counts[0])


def test_line_dedup(steps):
    before = {r.doc_id: r.text for r in steps["quality rules"]}
    want = {i: text for i, (text, _, _) in plain_dedup(before).items()}
    assert {r.doc_id: r.text for r in steps["line dedup"]} == want
    assert all(r.n_chars == len(r.text) for r in steps["line dedup"])


def test_near_duplicates(steps):
    before = {r.doc_id: r.text for r in steps["line dedup"]}
    kept = {r.doc_id: r.text for r in steps["near duplicates"]}
    assert kept.items() <= before.items()
    exact = collections.defaultdict(list)
    for i, t in before.items():
        exact[" ".join(words(t)).lower()].append(i)
    assert all(len(set(ids) & set(kept)) <= 1 for ids in exact.values())
    # What went has a near copy that was there.
    sets = {i: shingles(t) for i, t in before.items()}
    by_gram = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            by_gram[g].append(i)
    for i in set(before) - set(kept):
        shared = collections.Counter(j for g in sets[i] for j in by_gram[g] if j != i)
        assert not sets[i] or any(n / (len(sets[i]) + len(sets[j]) - n) >= 0.6 for j, n in shared.items()) or len(sets[i]) <= 20


def test_mixing(steps):
    rows = {r.doc_id: r for r in steps["near duplicates"]}
    copies = collections.Counter(r.doc_id for r in steps["mixing"])
    assert set(copies) <= set(rows) and max(copies.values()) <= 2
    sizes, taken = collections.Counter(), collections.Counter()
    for i, r in rows.items():
        sizes[r.source] += len(words(r.text))
        taken[r.source] += copies[i] * len(words(r.text))
    for source, target in plain_targets(sizes).items():
        assert abs(taken[source] - target) <= 0.05 * target + 2 * 7000


def test_packing(steps):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = steps["packing"]
    # Copies of a document are told apart by the order of their sequences.
    number, copies = {}, collections.Counter()
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start, r.sequence_id, r.offset)):
        copies[r.doc_id, r.start] += 1
        number[id(r)] = copies[r.doc_id, r.start]
    Row = collections.namedtuple("Row", rows[0].__fields__)
    again = [Row(**(r.asDict() | {"doc_id": (r.doc_id, number[id(r)])})) for r in rows]
    docs, seen = {}, collections.Counter()
    for r in steps["mixing"]:
        seen[r.doc_id] += 1
        docs[r.doc_id, seen[r.doc_id]] = r.text
    check_packing(docs, again, tokenizer, 0.02)


def test_odd_rows(spark, sf):
    rows = [(1, "one two three four five six seven eight nine ten", None, None, None), (1, "one two three four five six seven eight nine ten", None, None, None),
            (None, "a quite different text with more than enough words to stay in here", "en", "t", 5), (2, None, "en", "s", 0), (3, "", "en", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for sample in (rows, []):
        docs = spark.createDataFrame(sample, schema)
        for name, step in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stage(step(spark, docs, sf), "test-odd")
            if name != "packing":
                assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            if name == "near duplicates":
                assert docs.count() == (2 if sample else 0)
    assert docs.count() == 0 or {r.doc_id for r in docs.collect()} <= {1, None}
