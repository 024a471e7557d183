"""Counting tokens of whole texts inside tasks, with what is held at a time bounded."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa

from basketline.llm.batches import pieces

#: A task hands on its counts when it holds so many, or has read so many bytes of text since it last did.
MOST_COUNTS, MOST_BYTES = 800_000, 48_000_000


def lowered(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The texts in UTF-8 with A-Z alone lower-cased; null is empty."""
    return [(text or b"").lower() for text in column.cast(pa.large_binary()).to_pylist()]


def tallied(
    batches: Iterator[pa.RecordBatch],
    count: Callable[[dict[Hashable, Counter], pa.RecordBatch, list[bytes]], None],
    batches_of: Callable[[dict[Hashable, Counter]], Iterator[pa.RecordBatch]],
) -> Iterator[pa.RecordBatch]:
    """Partial counts: ``count`` adds a piece's texts to the counters, ``batches_of`` writes the counters out and may empty them."""
    held: dict[Hashable, Counter] = {}
    read = 0
    for piece in pieces(batches):
        texts = lowered(piece["text"])
        count(held, piece, texts)
        read += sum(map(len, texts))
        if read > MOST_BYTES or sum(map(len, held.values())) > MOST_COUNTS:
            yield from batches_of(held)
            held, read = {}, 0
    yield from batches_of(held)
