"""Removes lines that many documents share, with a once-seen and a twice-seen Bloom filter (operator 2)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from casewright.llm import bloom
from casewright.llm.common import SPACES, as_bytes, join_unique, slices
from casewright.session import stage

_HASH = xxhash.xxh64_intdigest
#: Expected long lines in a document, for the size of the filters only.
_LINES = 12


def _keys(text: bytes, least: int) -> set[bytes]:
    """Distinct keys of a text's lines with at least ``least`` code points."""
    found = set()
    for line in text.split(b"\n"):
        if len(line) >= least:
            key = line.strip(SPACES).lower()  # bytes.lower() changes A-Z alone
            if len(key) >= least and (key.isascii() or len(key.decode()) >= least):
                found.add(key)
    return found


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3,
                filter_bits: int | None = None) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text_col``, plus ``n_lines`` (before) and ``n_dropped``.

    A line's key is the line stripped of ASCII white space, A-Z lower-cased. A key of ``min_chars`` code points or more
    that ``min_docs`` documents or more hold stays only in the largest id among them. Pass one fills the two filters task by
    task; pass two sends only the lines whose hash was probably seen twice to the exact count, by the key itself; the
    last pass rewrites the texts. False hits of the filters drop out in the count.

    A null text is empty and has one line; it stays null. A document is an id: rows of one id, those of the null id too,
    count once, and all rows of the largest id keep the line. A null id is smaller than any other. Input columns named
    ``n_lines`` or ``n_dropped`` are replaced; other columns pass through, but none may be named ``__id``, ``__version`` or
    ``__keys``. Texts of any length are read whole, in steps of bounded size; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_lines", "n_dropped")
    schema = docs.schema
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("version"))
    bits = filter_bits or bloom.bits_for(narrow.count() * _LINES)

    def hashes(batch: pa.RecordBatch) -> np.ndarray:
        texts = as_bytes(batch.column("text"))
        return np.fromiter((_HASH(k) for t in texts for k in _keys(t, min_chars)), np.uint64)

    twice = bloom.share(docs, bloom.build(narrow.select("text"), hashes, bits, "line-filters")[1])

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, rows = [], []
            for i, text in enumerate(as_bytes(batch.column("text"))):
                own = _keys(text, min_chars)
                keys += own
                rows += [i] * len(own)
            if keys:
                hit = np.flatnonzero(bloom.holds(twice.value, np.fromiter(map(_HASH, keys), np.uint64, len(keys))))
                at = pa.array(np.asarray(rows)[hit])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(at), batch.column("version").take(at), pa.array([keys[i] for i in hit], pa.binary())],
                    names=["id", "version", "key"])

    kind = narrow.schema["id"].dataType.simpleString()
    suspected = stage(narrow.mapInArrow(suspects, f"id {kind}, version long, key binary"), "line-suspects")
    total = suspected.count()
    # Rows of one id are one document: they merge before the shuffle where they meet, and a key of many ids is summed in two steps.
    documents = suspected.groupBy("key", "id").agg(F.count("*").alias("rows"))
    counted = stage(documents.groupBy("key").agg(F.count("*").alias("n_docs"), F.sum("rows").alias("n"), F.max("id").alias("keeper"))
                    .filter(F.col("n_docs") >= min_docs), "line-counts")
    dropped = (join_unique(suspected, counted, "key", "n", total, "inner").filter(~F.col("id").eqNullSafe(F.col("keeper")))
               .groupBy("id", "version").agg(F.collect_set("key").alias("__keys"))
               .select(F.col("id").alias("__id"), F.col("version").alias("__version"), "__keys"))

    names = docs.columns
    at, n_columns = names.index(text_col), len(names)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            texts, lines, gone = [], [], []
            for text, keys in zip(batch.column(at).cast(pa.large_binary()).to_pylist(), batch.column(n_columns).to_pylist()):
                parts = (text or b"").split(b"\n")
                lines.append(len(parts))
                if keys:
                    keys = set(keys)
                    parts = [p for p in parts if len(p) < min_chars or p.strip(SPACES).lower() not in keys]
                    text = b"\n".join(parts)
                gone.append(lines[-1] - len(parts))
                texts.append(text)
            columns = batch.columns[:n_columns]
            columns[at] = pa.array(texts, pa.large_binary()).cast(pa.large_string()).cast(batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lines, pa.int64()), pa.array(gone, pa.int64())],
                                             names=[*names, "n_lines", "n_dropped"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return (docs.join(dropped, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__version")), "left")
            .drop("__id", "__version").mapInArrow(rewrite, f"{kinds}, n_lines long, n_dropped long"))
