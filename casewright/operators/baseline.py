"""TF-IDF + logistic regression baseline on Spark ML, with deterministic stratified folds."""

from __future__ import annotations

import math
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    IDF, CountVectorizer, ElementwiseProduct, IndexToString, NGram, Normalizer, RegexTokenizer,
    SQLTransformer, StringIndexer,
)
from pyspark.sql import Column, DataFrame, functions as F

from casewright.functions.text import TOKEN_PATTERN, tokens, unigrams_and_bigrams
from casewright.operators.labels import class_weights
from casewright.operators.positions import shuffled_rank
from casewright.session import stage

MAX_FEATURES = 20_000
#: Hash buckets of the first pass over the terms.
TERM_BUCKETS = 1 << 20
#: Rows of a partition of the fit: of a small table, and at most.
ROWS_PER_PARTITION, MOST_ROWS_PER_PARTITION = 2_000, 50_000


# ---- terms -------------------------------------------------------------------------------


def _terms(df: DataFrame, text: str) -> DataFrame:
    """One column ``terms``: the unigrams and bigrams of each row."""
    return df.select(unigrams_and_bigrams(tokens(F.coalesce(F.col(text), F.lit("")))).alias("terms"))


def _exploded(terms: DataFrame, values: Column) -> DataFrame:
    """One row per element. The outer form: for the inner one the optimizer adds a filter that computes the terms twice."""
    return terms.select(F.explode_outer(values).alias("term")).filter("term IS NOT NULL")


def term_statistics(terms: DataFrame) -> DataFrame:
    """(term, tf, df) of a column ``terms`` of term arrays: corpus and document frequency.

    Each document adds its terms once more without repeats, so one aggregation
    gives both counts, and only one row per term and task is shuffled.
    """
    counted = F.concat(
        F.transform("terms", lambda t: F.struct(t.alias("term"), F.lit(1).alias("tf"), F.lit(0).alias("df"))),
        F.transform(F.array_distinct("terms"),
                    lambda t: F.struct(t.alias("term"), F.lit(0).alias("tf"), F.lit(1).alias("df"))),
    )
    return terms.select(F.explode(counted).alias("c")).groupBy("c.term").agg(
        F.sum("c.tf").alias("tf"), F.sum("c.df").alias("df"))


def vocabulary(df: DataFrame, text: str, max_features: int = MAX_FEATURES, buckets: int = TERM_BUCKETS) -> DataFrame:
    """(term, tf): the most frequent terms of the corpus; ties go to the alphabetically first.

    A first pass counts occurrences by hash bucket: no term is more frequent than its bucket, so at most ``buckets`` rows leave a
    task. A second pass counts the terms of the buckets that reach a floor, and only those. If ``max_features`` of them reach the
    floor themselves, all other terms lie below these, and the counts decide; else the floor is halved. The first floor is
    set a little below the bucket at the cut, less what rare terms put into the middle bucket.
    """
    terms = _exploded(_terms(df, text), F.col("terms")).withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"))
    loads = stage(terms.groupBy("bucket").agg(F.count(F.lit(1)).alias("load")), "term-buckets")
    n, cut = loads.orderBy(F.desc("load")).limit(max_features).agg(F.count(F.lit(1)), F.min("load")).first()
    middle = loads.agg(F.percentile_approx("load", 0.5)).first()[0]
    floor = max(1, (cut - middle) * 4 // 5) if n >= max_features else 1
    while True:
        heavy = loads.filter(F.col("load") >= floor).select("bucket")
        counts = stage(terms.join(F.broadcast(heavy), "bucket", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("tf")), "term-counts")
        if floor == 1 or counts.filter(F.col("tf") >= floor).count() >= max_features:
            return _top(counts, max_features)
        floor //= 2


def document_frequency(df: DataFrame, text: str, chosen: DataFrame) -> DataFrame:
    """``chosen`` (term, and a bounded number of rows) with ``df``, the number of rows that have the term."""
    listed = F.broadcast(stage(chosen, "vocabulary"))
    found = _exploded(_terms(df, text), F.array_distinct("terms")).join(listed, "term")
    return found.groupBy(*chosen.columns).agg(F.count(F.lit(1)).alias("df"))


def _top(counts: DataFrame, max_features: int) -> DataFrame:
    """The first ``max_features`` rows by (tf descending, term) of a staged table.

    The frequency at the cut is found first, from the number of terms per
    frequency, so that the final sort sees the chosen terms and the ties at the
    cut, not the candidates of every partition.
    """
    levels = counts.groupBy("tf").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("tf")).limit(max_features).collect()
    cut, total = 0, 0
    for level in levels:
        cut, total = level["tf"], total + level["n"]
        if total >= max_features:
            break
    return counts.filter(F.col("tf") >= cut).orderBy(F.desc("tf"), "term").limit(max_features)


# ---- pipeline ----------------------------------------------------------------------------


def tfidf_stages(train: DataFrame, text: str, max_features: int = MAX_FEATURES) -> PipelineModel:
    """Fitted stages text -> L2-normalised tf * (ln((1 + n) / (1 + df)) + 1) over the training rows."""
    chosen = vocabulary(train, text, max_features).select(F.array("term").alias("terms"))
    counter = CountVectorizer(vocabSize=max_features, inputCol="terms", outputCol="counts").fit(chosen)
    filled = SQLTransformer(statement=f"SELECT *, coalesce({text}, '') AS filled_text FROM __THIS__")
    words = RegexTokenizer(inputCol="filled_text", outputCol="words", pattern=TOKEN_PATTERN, gaps=False)
    pairs = NGram(n=2, inputCol="words", outputCol="pairs")
    grams = SQLTransformer(statement="SELECT *, concat(words, pairs) AS terms FROM __THIS__")
    counted = PipelineModel([filled, words, pairs, grams, counter])
    idf = IDF(inputCol="counts", outputCol="ignored").fit(counted.transform(train))
    smoothed = ElementwiseProduct(
        scalingVec=[w + 1.0 for w in idf.idf.toArray()], inputCol="counts", outputCol="weighted")
    unit = Normalizer(p=2.0, inputCol="weighted", outputCol="features")
    tidy = SQLTransformer(statement="SELECT * EXCEPT (filled_text, words, pairs, terms, counts, weighted) FROM __THIS__")
    return PipelineModel([filled, words, pairs, grams, counter, smoothed, unit, tidy])


def fit_partitions(n: int, cores: int) -> int:
    """Partitions of ``n`` rows for the fit. Every iteration is a job in which each adds a gradient of classes x features, so few
    rows belong in few partitions, and many in no more than keep the cores busy and the partitions bounded."""
    return max(1, min(math.ceil(n / ROWS_PER_PARTITION), max(4 * cores, math.ceil(n / MOST_ROWS_PER_PARTITION))))


def logreg_fit(
    train: DataFrame, key: str, text: str, target: str, max_features: int = MAX_FEATURES,
    max_iter: int = 2000, tol: float = 1e-6, featurizer: PipelineModel | None = None,
) -> PipelineModel:
    """TF-IDF and balanced logistic regression with an L2 penalty of strength C = 1.

    The usual C = 1 objective sums the losses; Spark averages them, hence
    regParam = 1 / n (balanced weights sum to n).
    """
    # Staged once: the vocabulary, the IDF, the weights and the features all read these rows.
    train = stage(train.select(key, target, text), "train-rows")
    featurizer = featurizer or tfidf_stages(train, text, max_features)
    # Staged, not cached: the fit caches its own blocks of these rows.
    rows = stage(featurizer.transform(class_weights(train, target)).select(key, target, "class_weight", "features"), "train-features")
    n = rows.count()
    indexer = StringIndexer(inputCol=target, outputCol="target_index", stringOrderType="alphabetAsc").fit(rows)
    packed = rows.coalesce(fit_partitions(n, train.sparkSession.sparkContext.defaultParallelism))
    model = LogisticRegression(
        featuresCol="features", labelCol="target_index", weightCol="class_weight", predictionCol="predicted_index",
        regParam=1.0 / n, elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=tol,
    ).fit(indexer.transform(packed))
    names = IndexToString(inputCol="predicted_index", outputCol="complaint_pred_raw", labels=indexer.labels)
    return PipelineModel([*featurizer.stages, model, names])


def predict(model: PipelineModel, rows: DataFrame, *keep: str) -> DataFrame:
    return model.transform(rows).select(*keep, "complaint_pred_raw")


# ---- folds and splits --------------------------------------------------------------------


def stratified_folds(labels: DataFrame, target: str, key: str, k: int = 3, seed: int = 42) -> DataFrame:
    """Add ``fold``: rows of each class dealt round-robin in shuffled order; never fails for tiny classes."""
    ranked = shuffled_rank(labels, target, key, seed, "__rank")
    return ranked.withColumn("fold", ((F.col("__rank") - 1) % k).cast("int")).drop("__rank", "group_size")


def stratified_split(
    labels: DataFrame, target: str, key: str, test_size: float = 0.2, seed: int = 42,
) -> DataFrame:
    """Add ``split``: the first ``test_size`` share of each class in shuffled order is ``test``."""
    ranked = shuffled_rank(labels, target, key, seed, "__rank")
    cut = F.floor(F.col("group_size") * F.lit(test_size) + 0.5)
    return ranked.withColumn("split", F.when(F.col("__rank") <= cut, "test").otherwise("train")).drop(
        "__rank", "group_size")


def cross_val_predict(
    labels: DataFrame, key: str, text: str, target: str, k: int = 3, seed: int = 42, refit_features: bool = True,
    **fit_options,
) -> DataFrame:
    """Out-of-fold prediction of every row: (key, target, fold, complaint_pred_raw).

    ``refit_features=False`` fits the TF-IDF once on all rows, held-out ones
    included, which is how the published baseline figures were made.
    """
    folds = stage(stratified_folds(labels.select(key, text, target), target, key, k, seed), "folds")
    shared = None if refit_features else tfidf_stages(folds, text)
    present = [r["fold"] for r in folds.select("fold").distinct().orderBy("fold").collect()]  # at most k

    def predict_fold(fold: int) -> DataFrame:
        train = folds.filter(F.col("fold") != fold)
        model = logreg_fit(train, key, text, target, featurizer=shared, **fit_options)
        return predict(model, folds.filter(F.col("fold") == fold), key, target, "fold")

    # The fits are independent; each leaves cores idle between its iterations.
    with ThreadPool(len(present)) as pool:
        parts = pool.map(inheritable_thread_target(labels.sparkSession)(predict_fold), present)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
