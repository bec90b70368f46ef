"""Quality rules judged for whole hosts (operator 5)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from casewright.llm import bloom
from casewright.llm.common import as_bytes, join_unique, nullable_key, slices
from casewright.session import stage

_SYMBOLS = b"#*$%&|<>"
_WINDOW = 5
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], np.uint64)


def _repeated_words(words: list[bytes]) -> int:
    """Words inside a five-word window that the text holds twice or more."""
    n = len(words) - _WINDOW + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = sum(hashes[i:i + n] * _MIX[i] for i in range(_WINDOW))
    order = np.argsort(windows)
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    # Equal hashes only name candidates; the words themselves decide.
    candidates = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    places: dict[tuple, int] = {}
    for i in candidates.tolist():
        gram = tuple(words[i:i + _WINDOW])
        places[gram] = places.get(gram, 0) + 1
    covered = np.zeros(len(words), bool)
    for i in candidates.tolist():
        if places[tuple(words[i:i + _WINDOW])] > 1:
            covered[i:i + _WINDOW] = True
    return int(covered.sum())


def measure(text: bytes) -> tuple[int, ...]:
    """The counts named in ``_COUNTS`` of one text."""
    words = text.split()
    characters = len(text) if text.isascii() else len(text.decode())
    spaces = sum(map(text.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    lines = text.split(b"\n")
    seen, repeats, filled = set(), 0, 0
    for line in lines:
        if line and not line.isspace():
            filled += 1
            repeats += line in seen
            seen.add(line)
    symbols = sum(text.count(bytes([c])) for c in _SYMBOLS)
    return len(words), characters - spaces, symbols, repeats, _repeated_words(words), filled


def text_counts(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """id, host and the counts of every text; a null text has none of anything."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"), F.xxhash64(text_col).alias("version"),
                         F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = np.array([measure(t) for t in as_bytes(batch.column("text"))], np.int64).reshape(-1, len(_COUNTS))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("host"), batch.column("version"), *(pa.array(rows[:, i]) for i in range(len(_COUNTS)))],
                                             names=["id", "host", "version", *_COUNTS])

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, host string, version long, " + ", ".join(f"{c} long" for c in _COUNTS))


def failures() -> dict[str, Column]:
    """Rules on one document. The first two reject it by themselves; all of them count against its host."""
    return {
        "too_short": F.col("n_words") < 10,
        "repetitive": 100 * F.col("n_repeat_words") > 20 * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "dup_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 15 * F.col("n_words")),
    }


def _any(rules: dict[str, Column]) -> Column:
    return reduce(Column.__or__, rules.values())


def _prior(n: int, bad: int, n_hosts: int, squares: float) -> tuple[float, float]:
    """Mean and weight (in documents) of the beta prior; ``squares`` is the sum of bad^2 / n over the hosts."""
    mean = bad / n
    # The spread of the rates, sum n (rate - mean)^2, less the (hosts - 1) mean (1 - mean) that chance gives.
    between = max(squares - n * mean * mean - (n_hosts - 1) * mean * (1 - mean), 0.0) / n
    return mean, min(max(mean * (1 - mean) / between - 1, 2.0), 10_000.0) if between > 0 else 10_000.0


def host_rates(counted: DataFrame, max_rate: float) -> DataFrame:
    """One row per host: documents, failing ones, the rate shrunk towards a beta prior, and the verdict.

    The prior's mean is the corpus rate; its weight comes from the spread of the hosts' rates beyond what chance gives
    (method of moments, weighted by documents), kept between 2 and 10,000 documents.
    """
    hosts = counted.groupBy("host_key").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    n, bad, n_hosts, squares = hosts.agg(F.sum("n"), F.sum("bad"), F.count("*"), F.sum(F.col("bad") * F.col("bad") / F.col("n"))).first()
    mean, weight = _prior(n, bad, n_hosts, squares) if n else (0.0, 2.0)
    rate = (F.col("bad") + mean * weight) / (F.col("n") + weight)
    return hosts.select("host_key", F.col("n").alias("host_docs"), F.col("bad").alias("host_bad"), rate.alias("host_rate"),
                        (rate <= max_rate).alias("host_kept"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_rate: float = 0.5) -> DataFrame:
    """id, version (a hash of the text), the counts, base_failed, the host's shrunk rate and verdict, and ``kept`` for every row.

    Failing documents are counted by host and the rate is shrunk with an empirical beta prior, so a host with few
    documents is not condemned by chance. A host is rejected, with all its documents, when its shrunk rate is above
    ``max_rate``; that is meant for hosts whose documents are mostly junk, so clean hosts keep their clean documents.

    A null text has no words and fails; a null host is a host of its own; every row counts, also repeated ones; an empty
    table gives an empty table. Only the three named columns are read.
    """
    rules = failures()
    counted = stage(text_counts(docs, id_col, text_col, host_col).withColumn("base_failed", rules["too_short"] | rules["repetitive"])
                    .withColumn("bad", _any(rules)).withColumn("host_key", nullable_key(F.col("host"))), "quality-counts")
    hosts = stage(host_rates(counted, max_rate), "quality-hosts")
    return (join_unique(counted, hosts, "host_key", "host_docs", counted.count()).drop("host_key", "host")
            .withColumn("kept", ~F.col("base_failed") & F.col("host_kept")))


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_rate: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns.

    The rules on a document are judged where its text is read, so texts are not shuffled. Rejected hosts are handed out
    as a Bloom filter; only documents whose host may be among them are joined to the exact list.
    """
    counted = stage(text_counts(docs, id_col, text_col, host_col).withColumn("host_key", nullable_key(F.col("host")))
                    .select("host_key", _any(failures()).alias("bad")), "quality-counts")
    rejected = stage(host_rates(counted, max_rate).filter(~F.col("host_kept")).select("host_key"), "quality-rejected")
    n = rejected.count()
    hashed = rejected.select(F.xxhash64("host_key").alias("h"))
    words = bloom.build(hashed, lambda b: b.column("h").to_numpy().view(np.uint64), bloom.bits_for(n), "quality-filter")[0] if n else np.zeros(1, np.uint64)
    shared = bloom.share(docs, words)
    names, at = docs.columns, docs.columns.index(text_col)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            rows = np.array([measure(t) for t in as_bytes(batch.column(at))], np.int64).reshape(-1, len(_COUNTS))
            good = (rows[:, 0] >= 10) & (100 * rows[:, 4] <= 20 * rows[:, 0])
            maybe = bloom.holds(shared.value, batch.column(len(names)).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(maybe)], names=[*names, "__maybe"]).filter(pa.array(good))

    passed = docs.withColumn("__h", F.xxhash64(nullable_key(F.col(host_col)))).mapInArrow(run, f"{kinds}, __maybe boolean")
    if not n:
        return passed.drop("__maybe")
    doubtful = (passed.filter("__maybe").drop("__maybe").withColumn("__host", nullable_key(F.col(host_col)))
                .join(rejected.withColumnRenamed("host_key", "__host"), "__host", "left_anti").select(*names))
    return passed.filter("NOT __maybe").drop("__maybe").unionByName(doubtful)
