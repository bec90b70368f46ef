import collections
import hashlib

import pytest

from casewright.llm import line_dedup
from casewright.llm.queries import ORACLES, QUERIES
from tests.compare import difference

_LOWER = {c: c + 32 for c in range(65, 91)}


def plain_dedup(texts):
    """{id: text} -> {id: (text, lines, dropped)}; ids are distinct."""
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(_LOWER)
    holders = collections.defaultdict(set)
    for i, t in texts.items():
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(i)
    out = {}
    for i, t in texts.items():
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 3 or i == max(holders[key(x)])]
        out[i] = "\n".join(kept), len(lines), len(lines) - len(kept)
    return out


def test_query(spark, sf, con):
    name = "op2_line_dedup"
    assert difference(QUERIES[name](spark, sf).toPandas(), con.sql(ORACLES[name]).df()) is None


@pytest.mark.parametrize("bits", [None, 512])
def test_against_plain(spark, bits):
    """Hot lines, look-alikes, white space and letters beyond ASCII; a filter that is far too small only costs time."""
    hot = "This line is in a third of all documents"
    texts = {i: "\n".join([f"line number {i % 150} of this kind of text", (hot.upper() + "\t") if i % 3 == 0 else "short", "É" * 20 if i < 3 else "é" * 20,
                           "\x85padded by what is no ascii space\xa0" if i % 50 == 0 else "padded by what is no ascii space", "", f"only here {i} " * 3]) for i in range(600)}
    texts |= {900: None, 901: "", 902: "\n", 903: "x" * 19, 904: "x" * 19, 905: "x" * 19, 906: (hot + "\n") * 5000}
    docs = spark.createDataFrame([(i, t, -1, "k") for i, t in texts.items()], "doc_id long, text string, n_lines int, key string").repartition(9)
    got = {r.doc_id: (r.text or "", r.n_lines, r.n_dropped, r.key) for r in line_dedup.dedup_lines(docs, filter_bits=bits).collect()}
    assert got == {i: (*x, "k") for i, x in plain_dedup(texts).items()}


def test_repeated_rows_and_null_ids(spark):
    line = "a line of more than twenty characters"
    docs = spark.createDataFrame([(1, line), (1, line), (None, line), (None, line), (2, "other\n" + line), (2, "other\n" + line)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.text, r.n_dropped) for r in line_dedup.dedup_lines(docs).collect())
    assert got == [(0, "", 1), (0, "", 1), (1, "", 1), (1, "", 1), (2, "other\n" + line, 0), (2, "other\n" + line, 0)]
    two = docs.filter("doc_id IS NOT NULL")
    assert [r.n_dropped for r in line_dedup.dedup_lines(two).collect()] == [0] * 4  # four rows, but two documents
    nulls = spark.createDataFrame([(None, line)] * 4, "doc_id long, text string")
    assert [r.n_dropped for r in line_dedup.dedup_lines(nulls).collect()] == [0] * 4
    assert line_dedup.dedup_lines(nulls.limit(0)).count() == 0


def test_the_query_counts_documents_as_its_sql_does(spark, tmp_path):
    import duckdb
    line = "A line of more than twenty characters"
    spark.createDataFrame([(1, line), (1, line), (2, line), (3, line + "2"), (4, line.upper() + "2"), (5, line + "2\n" + line + "2"), (5, "x")],
                          "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op2_line_dedup"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.n_dropped) for r in rows) == [(1, 0), (1, 0), (2, 0), (3, 1), (4, 1), (5, 0), (5, 0)]
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = {r[0]: r[2] for r in db.sql(ORACLES["op2_line_dedup"]).fetchall()}
    assert want == {1: 0, 2: 0, 3: 1, 4: 1, 5: 0}


def test_a_very_long_text(spark):
    line = "one line that the long text shares"
    docs = spark.createDataFrame([(1, (line + "\n") * 200_000), (2, line), (3, line), (4, "x" * 5_000_000)], "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: (200_001, 200_000), 2: (1, 1), 3: (1, 0), 4: (1, 0)}


def test_digest_of_nothing(spark):
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).selectExpr("sha2(cast('' as binary), 256) AS h").first().h
