import collections
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from casewright.llm import quality
from casewright.llm.queries import ORACLES, QUERIES
from tests.compare import difference


def plain_measure(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = collections.Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab \n\t\x0b\x1c\x85#é"), max_size=80))
def test_measure(text):
    assert quality.measure(text.encode()) == plain_measure(text)


def test_query(spark, sf, con):
    name = "op5_quality_rules"
    assert difference(QUERIES[name](spark, sf).toPandas(), con.sql(ORACLES[name]).df()) is None


def _docs(spark):
    good = "these are ten plain words that make a fine text number {}"
    rows = [(i, good.format(i), "fine") for i in range(300)]
    rows += [(1000 + i, "bad" if i % 10 else good.format(i), "junk") for i in range(200)]
    rows += [(2000, "bad", "tiny"), (2001, good.format(1), "tiny"), (2002, None, None), (2003, "", None), (2004, good.format(7), None), (None, good.format(8), "fine")]
    rows += [(3000, good.format(3), "fine")] * 2
    return spark.createDataFrame([(*r, 1, True) for r in rows], "doc_id long, text string, source string, n_words int, bad boolean")


def test_hosts(spark):
    judged = quality.judge(_docs(spark)).collect()
    kept = collections.Counter(r.id for r in judged if r.kept)
    assert len(judged) == 508 and kept[None] == 1 and kept[3000] == 2
    assert all(kept[i] for i in range(300)) and not any(kept[i] for i in range(1000, 1200))
    assert kept[2001] and not kept[2000] and not kept[2002]
    rates = {r.id: r.host_rate for r in judged}
    assert 0.5 < rates[1000] < 0.9 and 0.3 < rates[2000] < 0.9


@pytest.mark.parametrize("max_rate", [0.5, 1.0])
def test_keep_agrees_with_judge(spark, max_rate):
    docs = _docs(spark)
    want = sorted(r.id or 0 for r in quality.judge(docs, max_rate=max_rate).filter("kept").collect())
    got = quality.keep(docs, max_rate=max_rate)
    assert sorted(r.doc_id or 0 for r in got.collect()) == want and got.columns == docs.columns
    assert quality.keep(docs.limit(0)).count() == 0 and quality.judge(docs.limit(0)).count() == 0
    assert quality.keep(docs.filter(F.col("source") == "fine").withColumn("source", F.lit(None).cast("string"))).count() == 303
