"""Counts of many keywords in one pass over a text."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, functions as F


def _automaton(lists: Mapping[str, Sequence[str]]) -> tuple[ahocorasick.Automaton, int]:
    """All words in one prefix tree, each with its number, its length and [(list, times it stands there)]; and how many there are."""
    distinct = sorted({word for words in lists.values() for word in words})
    tree = ahocorasick.Automaton()
    for number, word in enumerate(distinct):
        tree.add_word(word, (number, len(word), [(at, words.count(word)) for at, words in enumerate(lists.values()) if word in words]))
    tree.make_automaton()
    return tree, len(distinct)


def keyword_counts(text: Column, lists: Mapping[str, Sequence[str]]) -> Column:
    """struct of a count per list: the non-overlapping occurrences of each word, from the left, summed over the list.

    Words may overlap each other, and each counts: ``cannot`` is ``cannot``, ``not`` and ``no``. Case matters. A null text has a null struct, an empty one zeros. The
    text is read once, whatever the number of words; only it goes to the Python worker, in Arrow batches. Words must not be empty.
    """
    lists = {name: list(words) for name, words in lists.items()}
    if any(not word for words in lists.values() for word in words):
        raise ValueError("empty keyword")
    names = list(lists)

    @F.arrow_udf(", ".join(f"`{name}` long" for name in names))
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tree, n_words = _automaton(lists)
        for batch in batches:
            counts = [[0] * len(batch) for _ in names]
            for row, value in enumerate(batch.to_pylist()):
                if value and n_words:
                    free = [0] * n_words  # where the next occurrence of each word may start
                    for last, (number, length, members) in tree.iter(value):
                        if last + 1 - length >= free[number]:
                            free[number] = last + 1
                            for at, times in members:
                                counts[at][row] += times
            yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in counts], names, mask=batch.is_null())

    return count(text)
