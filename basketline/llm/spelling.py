"""Spelling variants: words one edit apart, found over a reduced alphabet and grouped under their most frequent form.

Letters are hashed to ``SYMBOLS`` symbols. Each word's reduced word is changed in every way that one edit allows, over those few
symbols only; the keys are joined with the reduced words of the vocabulary. Words one letter apart have reduced words at
most one symbol apart, so no link is missed; pairs that met are verified on the words themselves. Keys are rolling
hashes of the changed words, made without writing them out, so a word of any length costs its length.

Words come from whole texts, after ``variant`` has deleted a letter of some. A word is known by an id from the written vocabulary, so
frequent words cost no more than rare ones. Forms point to a word at least ``RATIO`` times as frequent, so paths are short;
roots are found by doubling.

A null text has no words; a null id counts as an empty one in the hash. Repeated rows count each. Ties between near words go to
the smallest in code-point order. Empty tables and texts give no words. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketline.llm.batches import spread, starts_of
from basketline.llm.tallies import tallied
from basketline.session import cut_lineage

RUN = re.compile("[a-zÀ-ÿ]+")  # after A-Z are lower-cased
LEAST_LETTERS, LEAST_TIMES, RATIO, ONE_IN = 6, 5, 5, 199
SYMBOLS = 8
KEY_LETTERS = 100_000  # letters whose keys are made at once
STEP = np.uint64(0x9E3779B97F4A7C15)


def variant(run: str, doc_crc: int) -> str:
    """The run as it is counted: where 199 divides the hash of id and run, the letter it points to is deleted."""
    h = crc32(run.encode(), doc_crc)
    if h % ONE_IN:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count(held: dict, piece: pa.RecordBatch, texts: list[bytes]) -> None:
    words = held.setdefault("words", Counter())
    for doc, text in zip(piece["doc_id"].to_pylist(), texts, strict=True):
        doc_crc = crc32(f"{'' if doc is None else doc}:".encode())
        for run, n in Counter(RUN.findall(text.decode())).items():
            if len(run) >= LEAST_LETTERS:
                words[variant(run, doc_crc)] += n


def _batches(held: dict) -> Iterator[pa.RecordBatch]:
    words = {w: n for w, n in held.pop("words", {}).items() if len(w) >= LEAST_LETTERS}
    yield pa.record_batch([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], names=["word", "n"])


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words that occur often enough in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from tallied(batches, _count, _batches)

    parts = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_TIMES)


def symbols(letters: np.ndarray) -> np.ndarray:
    """Code points to 1 .. ``SYMBOLS``."""
    return (letters.astype(np.uint64) * STEP >> np.uint64(40)) % np.uint64(SYMBOLS) + np.uint64(1)


class Reduced:
    """Rolling hashes of ragged words over the reduced alphabet: those of the words, and of all their one-edit neighbours."""

    def __init__(self, words: list[str]):
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.starts = starts_of(self.lengths)
        self.row = np.repeat(np.arange(len(words)), self.lengths)
        self.at = spread(np.zeros(len(words), np.int64), self.lengths)
        self.symbol = symbols(letters)
        longest = int(self.lengths.max(initial=0)) + 2
        self.power = np.concatenate(([np.uint64(1)], np.cumprod(np.full(longest, STEP))))
        # a letter counts with the power of its distance to the end, so a suffix hashes alike whatever stands before it
        self.weight = self.power[(self.lengths[self.row] - 1 - self.at)]
        total = np.concatenate(([np.uint64(0)], np.cumsum(self.symbol * self.weight)))
        self.whole = total[self.starts[1:]] - total[self.starts[:-1]]
        self.suffix = total[self.starts[self.row + 1]] - total[1:] if len(letters) else total[:0]  # after each letter
        own = self.symbol * self.weight
        self.prefix = self.whole[self.row] - self.suffix - own  # before each letter, in the places it has in the word

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, key): the word itself, and each different reduced word one deletion, replacement or insertion away."""
        rows, keys = [np.arange(len(self.lengths))], [self.whole]
        first = self.at == 0
        same_as_last = np.concatenate(([False], self.symbol[1:] == self.symbol[:-1])) & ~first if len(self.symbol) else first
        # one power of STEP divides a prefix's places when a letter is gone, and is multiplied when one more comes
        gone = self.prefix * INVERSE + self.suffix
        rows.append(self.row[~same_as_last])
        keys.append(gone[~same_as_last])
        for s in range(1, SYMBOLS + 1):
            other = self.symbol != s
            rows.append(self.row[other])
            keys.append((self.whole[self.row] + (np.uint64(s) - self.symbol) * self.weight)[other])
            # before a letter that differs; before an equal one the same word comes from behind its run
            before = self.prefix * STEP + np.uint64(s) * self.weight * STEP + self.suffix + self.symbol * self.weight
            rows.append(self.row[other])
            keys.append(before[other])
            rows.append(np.arange(len(self.lengths)))
            keys.append(self.whole * STEP + np.uint64(s))
        return np.concatenate(rows), np.concatenate(keys)


INVERSE = np.uint64(pow(int(STEP), -1, 2**64))


def _sliced(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = np.cumsum([len(w) for w in batch[column].to_pylist()])
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = max(int(np.searchsorted(ends, before + KEY_LETTERS, "right")), start + 1)
            yield batch.slice(start, end - start)
            start = end


def _own_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _sliced(batches, "word"):
        key = Reduced(batch["word"].to_pylist()).whole.view(np.int64)
        yield pa.record_batch([pa.array(key), batch["id"]], names=["key", "met"])


def _all_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _sliced(batches, "word"):
        row, key = Reduced(batch["word"].to_pylist()).neighbours()
        ids = batch["id"].to_numpy()
        for a in range(0, len(row), 1_000_000):
            part = slice(a, a + 1_000_000)
            yield pa.record_batch([pa.array(key[part].view(np.int64)), pa.array(ids[row[part]])], names=["key", "id"])


def near_words(words: DataFrame) -> DataFrame:
    """(id, met) of all ordered pairs of (id, word) rows exactly one letter edit apart."""
    rows = words.select("id", "word")
    own = rows.mapInArrow(_own_keys, "key long, met long")
    keys = rows.mapInArrow(_all_keys, "key long, id long")
    # the vocabulary is the small side: hashed, so that the many keys need no sort
    pairs = keys.join(own.hint("shuffle_hash"), "key").filter("id <> met").select("id", "met")
    spelt = rows.select(F.col("id").alias("met"), F.col("word").alias("other"))
    both = pairs.join(rows, "id").join(spelt, "met")
    return both.filter(F.levenshtein("word", "other", 1) == 1).select("id", "met").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) for (id, form) rows: forms are followed to the last, twice as far in each round."""
    state = cut_lineage(forms.select("id", F.col("form").alias("root")))
    while True:
        onward = state.select(F.col("id").alias("root"), F.col("root").alias("next"))
        step = cut_lineage(state.join(onward, "root", "left").select("id", "root", "next"))
        state = step.select("id", F.coalesce("next", "root").alias("root"))
        if step.filter("next is not null").limit(1).count() == 0:
            return state


def grouped(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary."""
    words = cut_lineage(cut_lineage(vocabulary(docs)).withColumn("id", F.monotonically_increasing_id()))
    near = near_words(words)
    other = words.select(F.col("id").alias("met"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form", "met")).alias("best")
    told = near.join(other, "met").groupBy("id").agg(F.count("*").alias("n_near"), best)
    listed = words.join(told, "id", "left")
    has = F.col("best").isNotNull() & (-F.col("best.less") >= RATIO * F.col("n"))
    listed = cut_lineage(
        listed.select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has, F.col("best.form")).alias("form"), F.when(has, F.col("best.met")).alias("form_id"),
            F.when(has, -F.col("best.less")).alias("form_n"),
        )
    )
    last = roots(listed.filter("form_id is not null").select("id", F.col("form_id").alias("form")))
    spelt = words.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    named = last.withColumnRenamed("root", "root_id").join(spelt, "root_id").select("id", "root")
    out = listed.join(named, "id", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
