"""The jobs in a row, from a raw CSV to calibrated and evaluated tickets."""

import csv

import pytest

from casewright import fixed_values as fv
from casewright.functions.models import keyword_call_responder, keyword_text_responder
from casewright.plans import jobs

KINDS = {
    "Billing": "my invoice has a wrong charge {n}", "Login": "password reset fails, login page {n}",
    "Product Defect": "the product is broken {n}",
}


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("jobs")
    rows = [(i, kind, text.format(n=f"case{i}")) for i, (kind, text) in enumerate(list(KINDS.items()) * 8)]
    with open(folder / "raw.csv", "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(["Subject line", "subject", "description", "created_at"])
        writer.writerows(["x", t, f"Write to me\nat u{i}@mail.com", "2024-01-02"] for i, _, t in rows)
    with open(folder / "labels.csv", "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(["clean_text", "label_complaint_type", "label_severity", "label_sentiment"])
        writer.writerows([t, kind if i else "", "Medium", "Negative"] for i, kind, t in rows)
    return str(folder)


def test_jobs(spark, base):
    jobs.clean_job(spark, f"{base}/raw.csv", f"{base}/tickets")
    first = spark.read.parquet(f"{base}/tickets").orderBy("ticket_id").first()
    assert first.ticket_id == 1 and first.created_at.year == 2024
    assert first.clean_text == "my invoice has a wrong charge case0 write to me at [REDACTED_EMAIL]"

    target = "label_complaint_type"
    jobs.baseline_job(spark, f"{base}/labels.csv", target, f"{base}/baseline", max_iter=30)
    assert spark.read.json(f"{base}/baseline/summary").first().n == 23
    jobs.baseline_job(spark, f"{base}/labels.csv", target, f"{base}/split", cv=0, max_iter=30)
    assert spark.read.json(f"{base}/split/summary").first().n == 1 + 2 + 2  # a fifth of 7, 8 and 8 rows

    jobs.index_job(spark, f"{base}/labels.csv", f"{base}/index")
    jobs.zero_shot_job(spark, f"{base}/tickets", f"{base}/labels.csv", f"{base}/zero", keyword_text_responder)
    assert set(spark.read.option("header", True).csv(f"{base}/zero/evaluation").columns) <= set(fv.COMPARE_COLUMNS)
    jobs.rag_eval_job(spark, f"{base}/labels.csv", f"{base}/index", f"{base}/rag", keyword_call_responder)

    slow = jobs.embed_with(lambda texts: [[float(len(t)), 1.0] for t in texts])
    with pytest.raises(Exception):  # vectors of another model than the index
        jobs.enrich_job(spark, f"{base}/tickets", f"{base}/index", f"{base}/bad", keyword_call_responder, slow)
    jobs.enrich_job(spark, f"{base}/tickets", f"{base}/index", f"{base}/full", keyword_call_responder, limit=5)
    jobs.enrich_job(spark, f"{base}/tickets", f"{base}/index", f"{base}/full", keyword_call_responder, cheap_mode=True)
    summary = spark.read.json(f"{base}/full/inference_summary").first()
    assert (summary.n_input_tickets, summary.n_processed) == (24, 24)

    jobs.calibrate_job(spark, f"{base}/full/tickets_enriched.parquet", f"{base}/full")
    calibrated = spark.read.parquet(f"{base}/full/tickets_enriched_calibrated.parquet")
    assert {r.calib_severity for r in calibrated.filter("pred_complaint_type = 'Billing'").collect()} == {"High"}

    jobs.evaluate_job(spark, f"{base}/labels.csv", {
        "baseline": f"{base}/baseline/baseline_preds.csv", "zero_shot": f"{base}/zero/responses.parquet",
        "rag": f"{base}/rag/responses.parquet", "rag_k5": f"{base}/nothing.parquet"}, f"{base}/eval")
    scores = {r.run: r for r in spark.read.json(f"{base}/eval/summary_all").collect()}
    assert {k: v.n for k, v in scores.items()} == {"baseline": 23, "zero_shot": 24, "rag": 24}
    assert scores["rag"].accuracy == pytest.approx(23 / 24) and scores["baseline"].accuracy > 0.9


def test_index_job_fails_on_a_failed_embedding(spark, base):
    def broken(texts):
        raise RuntimeError("no service")

    with pytest.raises(Exception, match="no service"):
        jobs.index_job(spark, f"{base}/labels.csv", f"{base}/none", jobs.embed_with(broken))


def test_runs_are_paired_by_key_or_refused(spark, tmp_path):
    gold = spark.createDataFrame([(10, 0), (20, 1), (30, 2)], "ticket_id long, row_index long")
    run = spark.createDataFrame([("30", "Login"), ("10", "Billing")], "ticket_id string, prediction string")
    keyed = jobs._keyed_run(run, gold, "x.parquet")
    assert {r.row_index: r.prediction for r in keyed.collect()} == {2: "Login", 0: "Billing"}
    with pytest.raises(ValueError, match="neither an index"):
        jobs._keyed_run(run.drop("ticket_id"), gold, "x.parquet")
