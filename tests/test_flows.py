"""Sources, sinks, resume, streaming, classification with failing models, and the baseline model."""

import json
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from casewright import fixed_values as fv
from casewright.functions.models import keyword_call_responder
from casewright.operators import baseline, joins, vectors
from casewright.plans import flows
from casewright.sources import readers, writers
from casewright.streaming.resume import resume_incremental

TEXTS = ["i was charged twice", "cannot login", "parcel not received", "app is slow", "question about details", "hello"]


@pytest.fixture()
def tickets(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "ticket_id bigint, clean_text string")
    return vectors.hashed_embedding(df, "clean_text")


@pytest.fixture()
def index(spark):
    rows = [(100 + i, t, "Billing" if i == 0 else None) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "row_index bigint, text string, label_complaint_type string")
    return vectors.hashed_embedding(df, "text")


# ---- sources ---------------------------------------------------------------------------------


def test_csv_reading(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,subject,n\n1,"line one\nline ""two"", x",NA\n2,  kept  ,\n3,null,N/A\n', encoding="utf-8")
    rows = readers.read_tickets_csv(spark, str(path)).orderBy("id").collect()
    assert [r.subject for r in rows] == ['line one\nline "two", x', "  kept  ", None]
    assert [r.n for r in rows] == [None, None, None]
    with pytest.raises(ValueError, match="available columns"):
        readers.read_labels_csv(spark, str(path), ["clean_text"])
    assert readers.read_predictions(spark, str(tmp_path / "none.parquet")) is None
    with pytest.raises(FileNotFoundError):
        readers.read_vector_index(spark, str(tmp_path / "none"))


def test_label_mappings(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text(json.dumps(fv.LABEL_DICTIONARY, indent=2))
    read = {tuple(r) for r in readers.read_label_mappings(spark, str(path)).collect()}
    assert read == {tuple(r) for r in readers.label_mappings(spark).collect()} and len(read) == 28


def test_partials_survive_a_broken_file(spark, tmp_path):
    path = tmp_path / "p"
    assert readers.read_partials(spark, str(path)).count() == 0
    writers.write_partial(spark.createDataFrame([(1, "Login")], "ticket_id bigint, complaint_pred string"), str(path))
    (path / "part-broken.parquet").write_bytes(b"PAR1 nothing useful PAR1")
    got = readers.read_partials(spark, str(path)).collect()
    assert [(r.ticket_id, r.complaint_pred, r.error) for r in got] == [(1, "Login", None)]


def test_nested_columns_become_json_in_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, [1, 2], " pad ")], "id int, xs array<int>, s string")
    writers.write_parquet_csv(df, str(tmp_path / "p"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "p")).first().xs == [1, 2]
    back = readers.read_csv(spark, str(tmp_path / "c")).first()
    assert (back.xs, back.s) == ("[1,2]", " pad ")


# ---- joins -------------------------------------------------------------------------------------


def test_join_labels_tickets_keeps_one_text(spark):
    tickets = spark.createDataFrame([(1, "t1"), (2, "t2")], "ticket_id int, clean_text string")
    labels = spark.createDataFrame([(1, None, "a"), (2, "own", "b"), (3, None, "c")],
                                   "ticket_id int, clean_text string, y string")
    got = {r.ticket_id: r.clean_text for r in joins.join_labels_tickets(labels, tickets).collect()}
    assert got == {1: "t1", 2: "own", 3: None}
    keyless = tickets.withColumnRenamed("ticket_id", "row_index")
    by_row = joins.join_labels_tickets(labels.select(F.col("ticket_id").alias("row_index"), "y"), keyless, "row_index")
    assert {r.row_index: r.clean_text for r in by_row.collect()} == {1: "t1", 2: "t2", 3: None}
    with pytest.raises(ValueError):
        joins.join_labels_tickets(labels.select("y"), tickets)


def test_align_truncates_to_the_shorter_side(spark):
    gold = spark.createDataFrame([(5, "a"), (9, "b"), (11, "c")], "g int, y string")
    preds = spark.createDataFrame([(2, "p"), (1, "q")], "index int, y string")
    got = joins.align_by_position(gold, preds, "g", "index").orderBy("row_position").collect()
    assert [(r.y, r.y_pred) for r in got] == [("a", "q"), ("b", "p")]


# ---- classification, resume, stream ----------------------------------------------------------------


def test_classify_rag_marks_failures(spark, tickets, index):
    def responder(prompts):
        return [RuntimeError("over quota") if "```hello```" in p else r
                for p, r in zip(prompts, keyword_call_responder(prompts))]

    failing = tickets.withColumn("embedding_error", F.when(F.col("ticket_id") == 3, "no vector"))
    got = {r.ticket_id: r for r in flows.classify_rag(failing, index, responder, k=2).collect()}
    assert got[0].complaint_pred == "Billing" and got[0].severity_pred == "High" and got[0].error is None
    assert got[1].complaint_pred == "Login" and got[4].sentiment_pred == "Neutral"
    for number, message in ((5, "over quota"), (3, "no vector")):
        row = got[number]
        assert (row.complaint_pred, row.severity_pred, row.root_cause_pred, row.complaint_pred_raw, row.error) == (
            "Other", "Unknown", "Unknown", None, message)


def test_prompt_has_examples_nearest_first(spark, tickets, index):
    rows = {r.ticket_id: r.prompt for r in flows.fewshot_prompts(tickets, index, 2, "cheap").collect()}
    assert rows[0].startswith(fv.INFER_HEADER_CHEAP + "\nTicket:\n```i was charged twice```\nOutput:\n"
                              '{"complaint_type": "Billing", "severity": "Unknown"')
    assert rows[0].count("Output:") == 2 and rows[0].endswith("\nNow classify:\n```i was charged twice```\n")


def test_resume_retries_errors_and_calls_nothing_twice(spark, tickets, index, tmp_path):
    path = str(tmp_path / "partials")
    calls = str(tmp_path / "calls")

    def flaky(fail):
        def classify(pending):
            pending.select("ticket_id").write.mode("append").parquet(calls)

            def responder(prompts):
                return [RuntimeError("down") if fail and "slow" in p.rsplit("```", 2)[1] else r
                        for p, r in zip(prompts, keyword_call_responder(prompts))]

            return flows.classify_rag(pending, index, responder, k=2, mode="full")
        return classify

    flows.enrich_pending(tickets.filter("ticket_id < 4"), path, flaky(True), slices=2)
    first = flows.enrich_tickets(tickets, path, flaky(False))
    again = flows.enrich_tickets(tickets, path, flaky(False))
    assert sorted(first.collect()) == sorted(again.collect())
    assert {r.ticket_id: r.pred_complaint_type for r in again.collect()} == {
        0: "Billing", 1: "Login", 2: "Delivery", 3: "Performance", 4: "Other", 5: "Other"}
    counts = {r.ticket_id: r["count"] for r in spark.read.parquet(calls).groupBy("ticket_id").count().collect()}
    assert counts == {0: 1, 1: 1, 2: 1, 3: 2, 4: 1, 5: 1}


def test_stream_resumes(spark, tickets, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    plain = tickets.select("ticket_id", "clean_text")

    def classify(rows):
        return flows.classify_zero_shot(rows, fv.ZERO_SHOT_TEMPLATE, lambda ps: ['{"complaint_type": "X"}'] * len(ps))

    for low, high in ((0, 3), (3, 6), (6, 6)):
        part = plain.filter((F.col("ticket_id") >= low) & (F.col("ticket_id") < high))
        if low < high:
            part.write.mode("append").parquet(source)
        resume_incremental(spark, source, plain.schema, out, state, classify, 2).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert sorted(r.ticket_id for r in rows) == list(range(6)) and {r.complaint_type_pred for r in rows} == {"X"}


# ---- baseline ----------------------------------------------------------------------------------------


def test_tfidf_by_hand(spark):
    rows = spark.createDataFrame([(1, "red red blue"), (2, "blue green"), (3, "")], "id int, t string")
    model = baseline.tfidf_stages(rows, "t", max_features=3)  # blue 2, red 2, then "blue green" before others
    out = {r.id: sorted(x for x in r.v if x)
           for r in model.transform(rows).select("id", vector_to_array("features").alias("v")).collect()}
    idf = lambda df: math.log((1 + 3) / (1 + df)) + 1
    one = np.array([2 * idf(1), 1 * idf(2)])
    two = np.array([1 * idf(2), 1 * idf(1)])
    assert out[1] == pytest.approx(sorted(one / np.linalg.norm(one)))
    assert out[2] == pytest.approx(sorted(two / np.linalg.norm(two)))
    assert out[3] == []


@pytest.fixture(scope="module")
def labelled(spark):
    words = {"Billing": "invoice refund money", "Login": "password account enter", "Other": "hello day nice"}
    rows = [(i, " ".join(np.random.default_rng(i).permutation(words[y].split())[:2]), y)
            for i, y in enumerate(["Billing"] * 24 + ["Login"] * 9 + ["Other"] * 4)]
    return spark.createDataFrame(rows, "id bigint, t string, y string")


def test_logreg_is_at_the_optimum(spark, labelled):
    """The gradient of the summed, balanced C = 1 objective is almost zero."""
    model = baseline.logreg_fit(labelled, "id", "t", "y", tol=1e-9)
    rows = model.transform(labelled).select("y", vector_to_array("features").alias("x")).collect()
    x = np.array([r.x for r in rows])
    lr, names = model.stages[-2], model.stages[-1].getLabels()
    y = np.array([[n == r.y for n in names] for r in rows], dtype=float)
    weight = len(rows) / (len(names) * y.sum(axis=0))
    coef, intercept = lr.coefficientMatrix.toArray(), lr.interceptVector.toArray()
    z = x @ coef.T + intercept
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    gradient = ((p - y) * (y @ weight)[:, None]).T @ x + coef
    assert np.abs(gradient).max() < 1e-2


def test_cross_validation_save_and_load(spark, labelled, tmp_path):
    for refit in (True, False):
        out = baseline.cross_val_predict(labelled, "id", "t", "y", 3, refit_features=refit, max_iter=20).collect()
        assert sorted(r.id for r in out) == list(range(37))
        assert np.mean([r.y == r.complaint_pred_raw for r in out]) > 0.9
    model = baseline.logreg_fit(labelled, "id", "t", "y", max_iter=20)
    baseline.save_model(model, str(tmp_path / "m"))
    loaded = baseline.load_model(str(tmp_path / "m"))
    before, after = (sorted(baseline.predict(m, labelled, "id").collect()) for m in (model, loaded))
    assert before == after


def test_staged_tables_go_to_the_named_folder(spark):
    from casewright import session
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert not named or session.shared_dir(spark) == named.rstrip("/")
    staged = session.stage(spark.range(3), "x")
    assert staged.count() == 3
    assert all(session.shared_dir(spark).removeprefix("file:") in f for f in staged.inputFiles())


# ---- row identity, drifting partials, dead letters ----------------------------------------------------


def test_row_keys_are_unique_and_repeatable(spark):
    from casewright.operators.identity import with_row_key
    rows = [(1, "a")] * 25 + [(1, "b"), (None, "a"), (None, None), (None, ""), (2, None)] + [(None, None)] * 6
    df = spark.createDataFrame(rows, "ticket_id bigint, clean_text string")
    keyed = with_row_key(df.repartition(7), copies_per_task=4)
    keys = sorted(r.row_key for r in keyed.collect())
    assert len(set(keys)) == len(rows) == keyed.count()
    assert sorted(map(str, keyed.drop("row_key").collect())) == sorted(map(str, df.collect()))
    assert keys == sorted(r.row_key for r in with_row_key(df.orderBy("clean_text").withColumn("embedding", F.lit(1.0))).collect())
    assert with_row_key(df.limit(0)).collect() == []


def test_enrichment_answers_each_row_once(spark, index, tmp_path):
    """Equal and null ticket ids, equal rows, a resume after a failure; old partials without a row key still count."""
    path, calls = str(tmp_path / "partials"), str(tmp_path / "calls")
    rows = [(1, "i was charged twice"), (1, "cannot login"), (None, "parcel not received"), (None, "app is slow"), (None, "app is slow"), (4, "hello")]
    tickets = vectors.hashed_embedding(spark.createDataFrame(rows, "ticket_id bigint, clean_text string"), "clean_text")

    def flaky(fail):
        def classify(pending):
            pending.select("row_key", "clean_text").write.mode("append").parquet(calls)

            def responder(prompts):
                return [RuntimeError("down") if fail and "slow" in p.rsplit("```", 2)[1] else r for p, r in zip(prompts, keyword_call_responder(prompts))]

            return flows.classify_rag(pending, index, responder, k=2, mode="full")
        return classify

    writers.write_partial(spark.createDataFrame([(4, "Old", "hello")], "ticket_id bigint, complaint_pred string, input_text string"), path)
    first = flows.enrich_tickets(tickets, path, flaky(True), slices=2)
    assert sorted(r.pred_complaint_type for r in first.collect()) == ["Billing", "Delivery", "Login", "Old", "Other", "Other"]
    again = flows.enrich_tickets(tickets, path, flaky(False))
    got = sorted((str(r.ticket_id), r.clean_text, r.pred_complaint_type) for r in again.collect())
    assert got == sorted([("1", "i was charged twice", "Billing"), ("1", "cannot login", "Login"), ("None", "parcel not received", "Delivery"),
                          ("None", "app is slow", "Performance"), ("None", "app is slow", "Performance"), ("4", "hello", "Old")])
    counts = {r.clean_text: r["count"] for r in spark.read.parquet(calls).groupBy("clean_text").count().collect()}
    assert counts == {"i was charged twice": 1, "cannot login": 1, "parcel not received": 1, "app is slow": 4}


def test_partials_of_other_types_keep_their_rows(spark, tmp_path):
    path = str(tmp_path / "p")
    writers.write_partial(spark.createDataFrame([(1, "Login")], "ticket_id bigint, complaint_pred string"), path + "/a")
    writers.write_partial(spark.createDataFrame([("2", "Billing"), ("T-3", "Other")], "ticket_id string, complaint_pred string"), path + "/b")
    writers.write_partial(spark.createDataFrame([(4, 7, "x")], "ticket_id int, complaint_pred int, more string"), path + "/c")
    (tmp_path / "p" / "part-broken.parquet").write_bytes(b"PAR1 nothing useful PAR1")
    (tmp_path / "p" / "part-short.parquet").write_bytes(b"PAR1")
    rows, quarantine = readers.checked_partials(spark, path, latest=False)
    assert sorted((str(r.ticket_id), r.complaint_pred) for r in rows.collect()) == [("1", "Login"), ("2", "Billing"), ("4", "7"), ("None", "Other")]
    assert sorted(r.path.rsplit("/", 1)[1] for r in quarantine.collect()) == ["part-broken.parquet", "part-short.parquet"]
    assert all(r.reason for r in quarantine.collect())
    merged = readers.read_partials(spark, path, schema=None, latest=False)
    assert sorted(r.ticket_id for r in merged.collect()) == ["1", "2", "4", "T-3"] and "more" in merged.columns
    assert readers.checked_partials(spark, str(tmp_path / "none"))[0].count() == 0


def test_stream_retries_dead_letters(spark, tmp_path):
    from casewright.streaming.resume import dead_letters
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "ticket_id bigint, clean_text string"
    struct = spark.createDataFrame([], schema).schema
    down = {"app is slow", "hello"}

    def classify(rows):
        def responder(prompts):
            return [RuntimeError("down") if any(d in p for d in down) else '{"complaint_type": "X"}' for p in prompts]

        return flows.classify_zero_shot(rows, "{text}", responder)

    def run(rows, most=5):
        if rows:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        resume_incremental(spark, source, struct, out, state, classify, 2, most).awaitTermination()
        done = sorted((str(r.ticket_id), r.clean_text) for r in spark.read.parquet(out).collect())
        letters = sorted((r.clean_text, r["__attempts"], r["__error"]) for r in dead_letters(spark, out, struct).collect())
        return done, letters

    assert run([(1, "app is slow"), (2, "fine"), (None, "app is slow")]) == (
        [("2", "fine")], [("app is slow", 1, "down"), ("app is slow", 1, "down")])
    done, letters = run([(1, "app is slow"), (5, "ok")])  # the old letters are tried at the start and with the new files
    assert done == [("2", "fine"), ("5", "ok")] and len(letters) == 3 and max(n for _, n, _ in letters) == 3
    down.discard("app is slow")
    done, letters = run([])  # nothing new: the letters alone
    assert done == [("1", "app is slow"), ("1", "app is slow"), ("2", "fine"), ("5", "ok"), ("None", "app is slow")] and letters == []
    assert run([(9, "hello")], most=2)[1] == [("hello", 1, "down")]
    assert run([], most=2)[1] == [("hello", 2, "down")] == run([], most=2)[1]
    assert "batch" in spark.read.parquet(out).columns


def test_modes_of_one_search(spark):
    """Several modes give the rows of a call for each, and tickets are embedded once for those that show the same examples."""
    index = spark.createDataFrame([(i, [float(i), 1.0], f"text {i}", "Billing") for i in range(6)],
                                  "row_index bigint, embedding array<double>, text string, label_complaint_type string")
    calls = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def embed(v):
        calls.add(1)
        return [float(v), 1.0]

    plain = spark.createDataFrame([(i, f"ticket {i}") for i in range(9)], "ticket_id bigint, clean_text string")
    for size in (64 << 20, 0):
        tickets = plain.withColumn("embedding", embed.asNondeterministic()("ticket_id"))
        before = calls.value
        got = flows.fewshot_prompts(tickets, index, 2, ["full", "cheap"], broadcast_bytes=size).select("mode", "ticket_id", "prompt").collect()
        assert calls.value - before == 9
        want = [(m, r.ticket_id, r.prompt) for m in ("full", "cheap") for r in flows.fewshot_prompts(tickets, index, 2, m, broadcast_bytes=size).collect()]
        assert sorted(map(tuple, got)) == sorted(want)
    assert flows.fewshot_prompts(tickets, index, 2, ["rag", "cheap"]).groupBy("mode").count().count() == 2
