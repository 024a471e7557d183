"""Helpers that run inside Python tasks: bounded pieces of a batch, and ids for repeated tokens."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

PIECE_CHARS = 2_000_000

#: Texts are long: Spark's 10,000 rows of a batch would be a whole split of them, held at once by the JVM and by Python, on either way.
BATCH_ROWS, ROWS_SETTING = 1_000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """From now on the session sends Python ``BATCH_ROWS`` rows at once, or fewer if that was set; results are the same."""
    if not 0 < int(spark.conf.get(ROWS_SETTING)) <= BATCH_ROWS:
        spark.conf.set(ROWS_SETTING, BATCH_ROWS)


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A column of a batch, or else of the rows packed in its ``row``, so that a text need not be sent twice."""
    return batch[name] if name in batch.schema.names else batch["row"].field(name)


def pieces(batches: Iterable[pa.RecordBatch], text: str = "text", chars: int = PIECE_CHARS) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``chars`` of text, or one longer row.

    At the end of the task Arrow's unused memory goes back, as the worker lives on for the next stage.
    """
    for batch in batches:
        column = column_of(batch, text)
        sizes = np.frombuffer(np.asarray(column.cast(pa.large_string()).buffers()[1]), np.int64)
        offsets = sizes[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + chars, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end
    pa.default_memory_pool().release_unused()


#: Besides its characters, a kept token costs about so many bytes.
TOKEN_BYTES = 160


class TokenIds(dict):
    """Tokens numbered as they are met, and about how many bytes they take. ``index`` gives numbers and the tokens that are new."""

    size = 0

    def __missing__(self, token):
        number = self[token] = len(self)
        self.size += len(token) + TOKEN_BYTES
        return number

    def index(self, tokens: list) -> tuple[np.ndarray, list]:
        known = len(self)
        numbers = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        return numbers, list(islice(self, known, None))


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Offsets of ragged rows: one more than there are rows."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each ragged row; 0 where a row is empty."""
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... for each of the ragged rows, one after the other."""
    offsets = starts_of(lengths)
    return np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
