"""Bloom filters over 64-bit hashes, built per task, merged block by block, and handed out by broadcast.

A filter is an array of 64-bit words; a hash picks one word and four bits in it. Its size is a parameter with an upper
bound, so what is merged, collected and broadcast never exceeds that bound whatever the input; a fuller filter only
passes more rows on to the exact step that follows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, functions as F

from casewright.llm.common import release
from casewright.session import stage

#: Largest filter: 2**30 bits, 128 MB.
MOST_BITS = 1 << 30
_BLOCK = 8192
_FAN_IN = 64
_SCHEMA = "lane long, block int, once binary, twice binary"


def bits_for(keys: int) -> int:
    """Sixteen bits a key, rounded up to a power of two, from 2**19 to ``MOST_BITS``."""
    return min(MOST_BITS, 1 << max(19, (16 * max(keys, 1) - 1).bit_length()))


def places(hashes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Word and four-bit mask of each hash."""
    h = hashes.astype(np.uint64, copy=False)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    word = ((h >> np.uint64(24)) & np.uint64(words - 1)).astype(np.int64)
    one = np.uint64(1)
    mask = np.zeros(len(h), np.uint64)
    for shift in (0, 6, 12, 18):
        mask |= one << ((h >> np.uint64(shift)) & np.uint64(63))
    return word, mask


def holds(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    word, mask = places(hashes, len(bits))
    return (bits[word] & mask) == mask


def add(once: np.ndarray, twice: np.ndarray | None, hashes: np.ndarray) -> None:
    """Enter hashes; those that were there before, or come twice in this call, also enter ``twice``."""
    if not len(hashes):
        return
    if twice is not None:
        distinct, counts = np.unique(hashes, return_counts=True)
        again = distinct[(counts > 1) | holds(once, distinct)]
        np.bitwise_or.at(twice, *places(again, len(twice)))
        hashes = distinct
    np.bitwise_or.at(once, *places(hashes, len(once)))


def _pack(lane: int, block: int, once: np.ndarray, twice: np.ndarray) -> tuple:
    return lane, block, zlib.compress(once.tobytes(), 1), zlib.compress(twice.tobytes(), 1)


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    once = twice = None
    for a, b in zip(rows["once"], rows["twice"]):
        a, b = (np.frombuffer(zlib.decompress(x), np.uint64) for x in (a, b))
        if once is None:
            once, twice = a.copy(), b.copy()
        else:
            twice |= b | (once & a)
            once |= a
    return pd.DataFrame([_pack(int(rows["lane"].iloc[0]), int(rows["block"].iloc[0]), once, twice)], columns=["lane", "block", "once", "twice"])


def build(df: DataFrame, hashes_of: Callable[[pa.RecordBatch], np.ndarray], bits: int, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(once-seen words, twice-seen words) over all rows of ``df``.

    Every task fills its own two filters and gives their non-empty blocks; 64 tasks' blocks at a time are merged. A bit
    seen by two tasks counts as seen twice, which can only add candidates.
    """
    words = bits // 64
    size = min(_BLOCK, words)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
        for batch in batches:
            add(once, twice, hashes_of(batch))
            release()
        lane = TaskContext.get().partitionId()
        for at in range(0, words, size):
            if once[at:at + size].any():
                lanes, blocks, a, b = zip(_pack(lane, at // size, once[at:at + size], twice[at:at + size]))
                yield pa.RecordBatch.from_arrays([pa.array(lanes, pa.int64()), pa.array(blocks, pa.int32()), pa.array(a, pa.binary()), pa.array(b, pa.binary())],
                                                 names=["lane", "block", "once", "twice"])

    parts = stage(df.mapInArrow(partial, _SCHEMA), name)
    lanes = (parts.agg(F.max("lane")).first()[0] or 0) + 1
    merged = lanes > 1
    while lanes > 1:
        parts = parts.withColumn("lane", F.floor(F.col("lane") / _FAN_IN)).groupBy("block", "lane").applyInPandas(_merge, _SCHEMA)
        lanes = -(-lanes // _FAN_IN)
    if merged:
        parts = stage(parts, f"{name}-merged")  # the shuffle of the tasks' filters goes with the write
    once, twice = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
    for row in parts.toLocalIterator():  # at most one row per block: the filter's own bounded size
        at = row["block"] * size
        once[at:at + size] = np.frombuffer(zlib.decompress(row["once"]), np.uint64)
        twice[at:at + size] = np.frombuffer(zlib.decompress(row["twice"]), np.uint64)
    return once, twice


def share(df: DataFrame, words: np.ndarray) -> Broadcast:
    return df.sparkSession.sparkContext.broadcast(words)
