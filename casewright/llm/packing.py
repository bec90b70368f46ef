"""Packs token pieces into sequences: shortest-pack-first over the length histogram (operator 1)."""

from __future__ import annotations

import heapq
import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from casewright.llm.common import slices
from casewright.session import stage

MAX_LENGTH = 2048
#: Pieces of one length numbered together, about.
_BUCKET = 500
#: Words whose ids a Python worker remembers, from task to task, and the longest such word.
_REMEMBERED, _LONGEST = 200_000, 32
#: Bytes of text encoded together.
_STEP_BYTES = 2 << 20
#: Words encoded as one text.
_TOGETHER = 128
#: Letters before a sign or white space that is neither a letter nor a number in any version of Unicode.
_HEAD = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+(?=[!-/:-@\[-`{-~\t-\r])")


class _Encoder:
    """Ids of whole texts as little-endian 32-bit bytes; ids of words that were seen before are not computed again.

    The tokenizer never joins characters across a single space that stands between two non-space characters, and such a
    space belongs to what follows. So a text is cut there, and each part is encoded by itself, with its space. Of a part that
    starts with letters and goes on with a sign, the letters are remembered, as the byte-level pattern cuts between them.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_file(path)
        self._known: dict[str, bytes] = {}
        #: Whether the letters of a word end a token whatever sign follows, as in the byte-level pattern (`` ?\\p{L}+``).
        self._parts = (self._tokenizer.normalizer is None and self._tokenizer.pre_tokenizer is not None
                       and json.loads(self._tokenizer.pre_tokenizer.__getstate__()).items() >= {"type": "ByteLevel", "use_regex": True}.items()
                       and not any(t.content[0].isalpha() or t.content[0].isspace() for t in self._tokenizer.get_added_tokens_decoder().values()))
        #: Ids whose token starts with a space.
        self._spaced = np.array([(self._tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(self._tokenizer.get_vocab_size())])

    def _parted(self, words: list[str]) -> list[bytes]:
        """``_words``, but only of heads that are not known, which are kept; ends that follow a head are encoded by themselves."""
        cuts = [_HEAD.match(w) for w in words] if self._parts else [None] * len(words)
        heads = [m[0] if m else w for m, w in zip(cuts, words)]
        ends = [w[m.end():] if m else "" for m, w in zip(cuts, words)]
        new = [h for h in dict.fromkeys(heads) if h not in self._known]
        self._known.update(zip(new, self._words(new)))
        follow = list(dict.fromkeys(ends))
        after = dict(zip(follow, self._encode(follow)))
        out = [self._known[h] + after[e] for h, e in zip(heads, ends)]
        for h in new:
            if len(h) > _LONGEST:
                del self._known[h]
        return out

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of each word with a space before it; the words have no space in them, so only their first tokens start with one."""
        out = []
        for at in range(0, len(words), _TOGETHER):
            part = words[at:at + _TOGETHER]
            found = self._encode([" " + " ".join(part)])[0]
            starts = np.flatnonzero(self._spaced[np.frombuffer(found, "<u4")]) * 4
            if len(starts) != len(part):
                out += self._encode([" " + p for p in part])
            else:
                out += [found[a:b] for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(found)])]
        return out

    def _encode(self, parts: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(parts), _TOGETHER):  # an encoding takes far more memory than its ids
            out += [np.array(e.ids, "<u4").tobytes() for e in self._tokenizer.encode_batch_fast(parts[at:at + _TOGETHER], add_special_tokens=False)]
        return out

    def __call__(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text; a null is an empty text. Words are told apart and put together again by Arrow, so Python sees each distinct one once."""
        if len(self._known) > _REMEMBERED:  # the latest words are the rarest
            for word in list(islice(reversed(self._known), len(self._known) - _REMEMBERED // 2)):
                del self._known[word]
        if not len(texts):
            return []
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        cut = pa.compute.split_pattern(column.cast(pa.large_string()).fill_null(""), " ")
        firsts = cut.offsets.to_numpy()[:-1]
        coded = cut.flatten().dictionary_encode()
        codes, words = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()

        # Parts that meet at more white space than one space are one unit.
        odd = [i for i, w in enumerate(words) if w == "" or w.strip() != w]
        before, after = np.zeros(len(words), bool), np.zeros(len(words), bool)
        before[odd], after[odd] = [w == "" or w[0].isspace() for w in map(words.__getitem__, odd)], [w == "" or w[-1].isspace() for w in map(words.__getitem__, odd)]
        joined = before[codes]
        joined[1:] |= after[codes[:-1]]
        joined[firsts] = False
        at = np.flatnonzero(~joined)
        ends = np.append(at[1:], len(codes))
        first = np.searchsorted(at, firsts)  # of each text, among the units
        unit = codes[at].astype(np.int64)
        several = ends - at > 1
        alone = ~several
        alone[first] = False
        several[first] = False

        def whole(i: int) -> str:
            return " ".join([words[c] for c in codes[at[i]:ends[i]].tolist()])

        needed = np.zeros(len(words), bool)
        needed[unit[alone]] = True
        known, odd = self._known, set(odd)
        values = list(map(known.get, words))
        missing = [i for i in np.flatnonzero(needed).tolist() if values[i] is None]
        plain, mixed = [i for i in missing if i not in odd], [i for i in missing if i in odd]
        for i, found in zip(plain, self._parted([words[i] for i in plain])):
            values[i] = found
        for i, found in zip(mixed, self._encode([" " + words[i] for i in mixed])):
            values[i] = found
        runs = np.flatnonzero(several)
        unit[runs] = len(values) + np.arange(len(runs))
        values += self._encode([" " + whole(i) for i in runs.tolist()])
        unit[first] = len(values) + np.arange(len(first))
        values += self._encode([whole(i) for i in first.tolist()])
        ids = pa.array(values, pa.large_binary()).take(pa.array(unit))
        starts = np.frombuffer(ids.buffers()[1], np.int64)[:len(unit) + 1]
        data, bounds = memoryview(ids.buffers()[2] or b""), np.append(starts[first], starts[-1]).tolist()
        return [bytes(data[a:b]) for a, b in zip(bounds, bounds[1:])]


@lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", max_length: int = MAX_LENGTH,
           end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """id, start, length, ids_crc32 and doc_tokens of the pieces of every text, and with ``keep_ids`` the ids as bytes.

    A document is its ids and then ``end_id``; it is cut every ``max_length`` ids. A null text is an empty one. The file
    ``tokenizer`` must be there on every executor.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    end = np.array([end_id], "<u4").tobytes()
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * keep_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, step_bytes=_STEP_BYTES):
            rows, start, length, crc, whole, ids = [], [], [], [], [], []
            for i, found in enumerate(_encoder(tokenizer)(batch.column("text"))):
                found += end
                for at in range(0, len(found), 4 * max_length):
                    part = found[at:at + 4 * max_length]
                    rows.append(i), start.append(at // 4), length.append(len(part) // 4), whole.append(len(found) // 4)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        ids.append(part)
            columns = [batch.column("id").take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, whole))]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.binary())] * keep_ids, names=names)

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * keep_ids)


def plan(histogram: dict[int, int], max_length: int = MAX_LENGTH) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (how often, [(length, how many), ...]) that hold exactly the pieces of the histogram.

    Lengths are placed from the longest on, each into the pattern that is filled least, as often as that pattern
    occurs; what does not fit opens a new one. A step ends a length or a pattern, so their number is bounded by the lengths.
    """
    emptiest: list[tuple[int, int, int, list]] = []  # (-room, tie, how often, contents)
    ended, tie = [], 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if emptiest and -emptiest[0][0] >= length:
                room, _, often, contents = heapq.heappop(emptiest)
                used = min(often, left)
                if often > used:
                    tie += 1
                    heapq.heappush(emptiest, (room, tie, often - used, contents))
                times = 1
                if used == often and left >= 2 * often:  # the whole pattern takes this length; more of it while it stays the emptiest
                    following = -emptiest[0][0] if emptiest else 0
                    times = max(1, min(left // often, -room // length, (-room - max(following, length - 1)) // length))
                if contents and contents[-1][0] == length:
                    contents = [*contents[:-1], (length, contents[-1][1] + times)]
                else:
                    contents = [*contents, (length, times)]
                room = -room - times * length
            else:
                used, times = left, 1
                contents, room = [(length, 1)], max_length - length
            left -= used * times
            tie += 1
            if room:
                heapq.heappush(emptiest, (-room, tie, used, contents))
            else:
                ended.append((used, contents))
    return ended + [(often, contents) for _, _, often, contents in sorted(emptiest)]


def _slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> pd.DataFrame:
    """For each length, which of its ranks go to which sequences and offset; one row per pattern and length in it."""
    rows, used, sequence = [], {}, 0
    for often, contents in patterns:
        offset = 0
        for length, times in contents:
            start = used.get(length, 0)
            rows.append((length, start, start + often * times, often, sequence, offset))
            used[length] = start + often * times
            offset += length * times
        sequence += often
    return pd.DataFrame(rows, columns=["slot_length", "slot_from", "slot_to", "often", "first_sequence", "first_offset"], dtype="int64")


def place(found: DataFrame, max_length: int = MAX_LENGTH) -> DataFrame:
    """``found`` with ``sequence_id`` (from 0 on) and ``offset``; ``length`` must be between 1 and ``max_length``.

    Only the histogram reaches the driver, ``max_length`` counts at most; the patterns come back as a table of at most
    some sixty rows per length. Pieces of one length are numbered in buckets, so no task holds a frequent length.
    """
    spark = found.sparkSession
    found = stage(found.withColumn("row", F.monotonically_increasing_id()), "pack-pieces")
    histogram = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}
    slots = spark.createDataFrame(_slots(plan(histogram, max_length)), "slot_length long, slot_from long, slot_to long, often long, first_sequence long, first_offset long")
    counts = spark.createDataFrame(pd.DataFrame({"length": list(histogram), "buckets": [-(-n // _BUCKET) for n in histogram.values()]}, dtype="int64"), "length long, buckets long")
    narrow = (found.select("row", "length").join(F.broadcast(counts), "length")
              .withColumn("bucket", F.pmod(F.xxhash64("row"), F.col("buckets"))))
    sizes = narrow.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    starts = sizes.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("start_rank"))
    bucketed = found.join(F.broadcast(counts), "length").withColumn("bucket", F.pmod(F.xxhash64("row"), F.col("buckets")))
    ranked = bucketed.join(starts, ["length", "bucket"]).withColumn(
        "rank", F.col("start_rank") + F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row")) - 1)
    nth = F.col("rank") - F.col("slot_from")
    return (ranked.join(F.broadcast(slots), (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("slot_from")) & (F.col("rank") < F.col("slot_to")))
            .withColumn("sequence_id", F.col("first_sequence") + nth % F.col("often"))
            .withColumn("offset", F.col("first_offset") + F.floor(nth / F.col("often")) * F.col("length"))
            .select(*[c for c in found.columns if c != "row"], "sequence_id", "offset"))


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", max_length: int = MAX_LENGTH,
         end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and offset.

    A null or empty text is the end id alone; repeated rows are packed each; an empty table gives an empty one. Only the
    two named columns are read.
    """
    return place(pieces(docs, tokenizer, id_col, text_col, max_length, end_id, keep_ids), max_length)


def sequences(packed: DataFrame, max_length: int = MAX_LENGTH, pad_id: int = 0) -> DataFrame:
    """sequence_id, n_tokens and input_ids (array) of pieces packed with ``keep_ids``; padded, unless full to a power of two."""
    rows = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            filled = []
            for parts in batch.column("parts").to_pylist():
                ids = np.frombuffer(b"".join(p["ids"] for p in parts), "<u4").astype(np.int32)
                short = max_length - len(ids) if len(ids) & (len(ids) - 1) else 0
                filled.append(np.concatenate([ids, np.full(short, pad_id, np.int32)]))
            yield pa.RecordBatch.from_arrays([batch.column("sequence_id"), batch.column("n_tokens"), pa.array(filled, pa.list_(pa.int32()))],
                                             names=["sequence_id", "n_tokens", "input_ids"])

    return rows.mapInArrow(run, "sequence_id long, n_tokens long, input_ids array<int>")
