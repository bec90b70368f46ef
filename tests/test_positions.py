"""Distributed positions equal a global row_number, also when one key or class dominates."""

import hashlib

from pyspark.sql import functions as F

from casewright.operators import baseline, labels, positions, prepare


def test_key_position_with_hot_key(spark):
    rows = [(7 if i % 3 == 0 else i * 5 % 97, i) for i in range(600)]
    df = spark.createDataFrame(rows, "k bigint, v bigint").repartition(5)
    got = positions.key_position(df, "k", "pos", rows_per_bucket=20).orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(600))
    assert [r.k for r in got] == sorted(k for k, _ in rows)
    whole = positions.key_position(df, "k", "pos").orderBy("pos").collect()
    assert [(r.k, r.v) for r in got] == [(r.k, r.v) for r in whole]


def test_shuffled_rank_splits_a_large_class(spark):
    rows = [("big" if i % 10 else f"c{i % 30}", i) for i in range(500)]
    df = spark.createDataFrame(rows, "c string, id bigint")
    got = {(r.c, r.id): (r["rank"], r.group_size)
           for r in positions.shuffled_rank(df, "c", "id", 42, rows_per_bucket=10).collect()}
    for name in {c for c, _ in rows}:
        ids = sorted((i for c, i in rows if c == name), key=lambda i: hashlib.md5(f"{i}:42".encode()).hexdigest())
        assert [got[name, i] for i in ids] == [(n + 1, len(ids)) for n in range(len(ids))]


def test_limit_rows_both_ways(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7).repartition(4)
    for heap in (10, 10_000):
        assert sorted(r.id for r in positions.limit_rows(df, 321, "id", heap_rows=heap).collect()) == list(range(321))


def test_limit_and_position_with_null_and_repeated_keys(spark):
    rows = [(None, 1), (3, 2), (1, 3), (1, 4), (1, 4), (None, 5), *[(7, i) for i in range(60)], *[(None, i) for i in range(60)]]
    df = spark.createDataFrame(rows, "k bigint, v int").repartition(5)
    order = [tuple(r) for r in positions.key_position(df, "k", "pos").orderBy("pos").select("k", "v").collect()]
    split = [tuple(r) for r in positions.key_position(df, "k", "pos", rows_per_bucket=10).orderBy("pos").select("k", "v").collect()]
    assert sorted(order, key=repr) == sorted(rows, key=repr) and order == split
    assert [k for k, _ in order] == sorted((k for k, _ in rows if k is not None)) + [None] * 62
    for n in (2, 5, 40, 90):
        small, large = (sorted(map(tuple, positions.limit_rows(df, n, "k", heap_rows=h).collect()), key=repr) for h in (1000, 1))
        assert small == large == sorted(order[:n], key=repr)
    nulls = df.filter("k IS NULL")
    assert positions.key_position(nulls, "k", "pos", rows_per_bucket=10).agg({"pos": "max"}).first()[0] == 61


def test_ranges_beyond_2_53_and_of_copies_are_bounded(spark, monkeypatch):
    hot = 2**53 + 1
    rows = [(hot, f"v{i}") for i in range(200)] + [(hot + 1, "same")] * 200 + [(hot - 1, "x"), (2**53 + 2, "y"), (None, "z"), (-5, "w")]
    df = spark.createDataFrame(rows, "k bigint, v string").repartition(4)
    tagged = df.withColumn("__tie", F.xxhash64(*df.columns))
    sizes = [r["count"] for r in positions._ranges(tagged, "k", 20).groupBy(F.shiftright("__at", 33)).count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 60, sizes
    got = [tuple(r) for r in positions.key_position(df, "k", "pos", rows_per_bucket=20).orderBy("pos").select("pos", "k", "v").collect()]
    assert [p for p, _, _ in got] == list(range(len(rows)))
    assert [k for _, k, _ in got] == sorted(k for k, _ in rows if k is not None) + [None]
    plain = [tuple(r) for r in positions.key_position(df, "k", "pos").orderBy("pos").select("pos", "k", "v").collect()]
    assert got == plain
    for n in (1, 150, 300, 403, 404, 999):
        many = sorted(((r.k, r.v) for r in positions.limit_rows(df, n, "k", heap_rows=0, rows_per_bucket=20).collect()), key=repr)
        assert many == sorted([(k, v) for _, k, v in plain[:n]], key=repr), n
    monkeypatch.setattr(positions, "BYTES_PER_BUCKET", 4 << 20)
    wide = spark.range(24).select("id", F.repeat(F.lit("x"), 1 << 20).alias("v"))
    seen = []
    ranges = positions._ranges
    monkeypatch.setattr(positions, "_ranges", lambda *a: seen.append(a[-1]) or ranges(*a))
    assert [r.id for r in positions.key_position(wide, "id", "pos").orderBy("pos").select("id").collect()] == list(range(24)) and seen == [7]


def test_file_position_over_many_files(spark, tmp_path):
    path = str(tmp_path / "t")
    for start in (0, 100, 150):
        spark.range(start, start + 40).coalesce(1).write.mode("append").csv(path)
    read = spark.read.schema("id bigint").csv(path)
    got = positions.file_position(read, "pos").select("pos", "id").orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(120))
    for block in range(3):  # each file stays together and in order
        ids = [r.id for r in got[block * 40:block * 40 + 40]]
        assert ids == list(range(ids[0], ids[0] + 40))


def test_small_side_is_checked(spark):
    small, large = spark.range(5), spark.range(50)
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(positions.small_side(small, 10))
    assert not hinted(positions.small_side(large, 10))
    assert positions.small_side(large, 10).count() == 50


def test_folds_never_fail_and_stay_balanced(spark):
    rows = [("a", i) for i in range(10)] + [("lonely", 99)]
    df = spark.createDataFrame(rows, "y string, id bigint")
    folds = baseline.stratified_folds(df, "y", "id", 3).groupBy("y", "fold").count().collect()
    assert sorted(r["count"] for r in folds if r.y == "a") == [3, 3, 4]
    assert [r["count"] for r in folds if r.y == "lonely"] == [1]


def test_class_operators(spark):
    df = spark.createDataFrame([("a", i) for i in range(12)] + [("b", 20), ("b", 21), (None, 30)], "y string, id bigint")
    got = {r.id: r.label_complaint_collapsed for r in labels.collapse_rare_classes(df, "y").collect()}
    assert got[0] == "a" and got[20] == "Other" and got[30] is None and len(got) == 15
    weights = {r.y: r.class_weight for r in labels.class_weights(df, "y").collect()}
    assert weights == {"a": 14 / (2 * 12), "b": 14 / (2 * 2)}
    assert [r.y for r in labels.small_classes(df, "y").collect()] == ["b"]
    assert [r.y for r in labels.distinct_classes(df, "y").collect()] == ["a", "b"]
    for bad in (lambda: labels.filter_labeled(df.limit(3), "y"), lambda: labels.filter_labeled(df, "nope")):
        try:
            bad()
            raise AssertionError("no error")
        except ValueError:
            pass


def test_prepare(spark, tmp_path):
    assert prepare.detect_id_col(["x", "ID", "ticket_id"]) == "ID"
    assert prepare.detect_id_col(["x"]) is None
    df = spark.createDataFrame([("1", "s", None, "d")], "id string, text string, subject string, description string")
    assert prepare.select_text_cols(df) == ["subject", "description", "text"]
    assert prepare.select_text_cols(df.select("id", F.lit(1).alias("n"), F.lit("q").alias("z"))) == ["id", "z"]
    assert df.select(prepare.concat_text(df)).first()[0] == " d s"
    numbers = spark.createDataFrame([(1, 2.5)], "a int, b double")
    assert numbers.select(prepare.concat_text(numbers)).first()[0] == "1 2.5"
    ids = spark.createDataFrame([("007",), ("12.0",)], "TicketID string")
    got = sorted((r.ticket_id, r.orig_ticket_id) for r in prepare.assign_ticket_id(ids).collect())
    assert got == [(7, "7"), (12, "12.0")]
    bad = spark.createDataFrame([("x9",)], "id string")
    assert prepare.assign_ticket_id(bad, strict=False).first().ticket_id is None
    try:
        prepare.assign_ticket_id(bad).collect()
        raise AssertionError("no error")
    except Exception as failure:
        assert "CAST_INVALID_INPUT" in str(failure)
    numbered = spark.createDataFrame([(30, "c"), (10, "a"), (20, "b")], "seq bigint, text string")
    placed = prepare.prepare_tickets(numbered, order_key="seq").orderBy("ticket_id").collect()
    assert [(r.ticket_id, r.clean_text) for r in placed] == [(1, "a"), (2, "b"), (3, "c")]
