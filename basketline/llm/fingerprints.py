"""Document fingerprints by a randomised edit embedding, and near pairs from their bands.

A text is walked with shared random steps: at each step the character under the pointer is written down, and a shared hash of
(step, character) says whether the pointer moves on. Texts that differ by few edits fall into step again, so
edit distance shows as Hamming distance of what was written. Walks start afresh every ``BLOCK`` characters, so that many
blocks of many texts are walked at once. Eight steps make one coordinate. ``SLOTS`` coordinates are
sampled, each the one with the lowest shared random number of those that the text has; a byte of each makes the
fingerprint, two hex digits a slot. Likeness is the share of equal slots.

Near pairs: bands of ``BAND`` slots, each key linking its members to its smallest and largest one only, verified by
likeness of the fingerprints and then joined into classes.

A null text is empty; an empty text has the fingerprint of dots. Equal texts have equal fingerprints. Repeated rows are
neighbours in order of id, then hash of the text; null ids come first. An empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketline.llm.batches import pieces, starts_of
from basketline.llm.groups import components
from basketline.llm.tables import text_of
from basketline.session import cut_lineage

BLOCK, WORD, SLOTS, BAND, LEAST, SEED = 1024, 8, 128, 8, 0.8, 23
LANES = 4096
EMPTY = "." * (2 * SLOTS)
NEXT_MUL = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h):
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def walk(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of each block: (blocks, steps / WORD) bytes, and the number that a block of its size has.

    A block of n characters has ceil(2 n / WORD) coordinates, at least one, the steps that a walk takes on average; a
    pointer past the end writes 0.
    """
    counts = np.maximum((2 * sizes + WORD - 1) // WORD, 1)
    order = np.argsort(-sizes, kind="stable")
    width = int(counts.max())
    out = np.zeros((len(sizes), width), np.uint8)
    base, left, need = starts[order], sizes[order], counts[order]
    at = np.zeros(len(sizes), np.int64)
    word = np.zeros(len(sizes), np.uint64)
    for step in range(width * WORD):
        live = int(np.searchsorted(-need, -(step // WORD), "left"))
        p = at[:live]
        inside = p < left[:live]
        symbol = np.where(inside, codes[np.minimum(base[:live] + p, len(codes) - 1)] + 1, 0).astype(np.uint64)
        x = symbol * NEXT_MUL + np.uint64(step * 2654435761 + SEED)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        at[:live] = p + ((x >> np.uint64(40)) & np.uint64(1)).astype(np.int64)
        word[:live] = (word[:live] + symbol + np.uint64(1)) * NEXT_MUL
        if step % WORD == WORD - 1:
            out[order[:live], step // WORD] = (_mixed(word[:live]) & np.uint64(255)).astype(np.uint8)
            word[:] = 0
    return out, counts


class Coordinates:
    """Which coordinates texts with so many of them have sampled: the running minimum of shared random numbers."""

    def __init__(self):
        self.size, self.best, self.where = 0, np.full(SLOTS, 2**64 - 1, np.uint64), [[] for _ in range(SLOTS)]

    def grow(self, size: int) -> None:
        slots = np.arange(SLOTS, dtype=np.uint64)[:, None] * NEXT_MUL
        while self.size < size:
            at = np.arange(self.size, self.size + 4096, dtype=np.uint64)
            x = _mixed(_mixed(at * NEXT_MUL + np.uint64(SEED))[None, :] ^ slots)
            low = np.minimum.accumulate(np.concatenate((self.best[:, None], x), 1), 1)
            rows, cols = np.nonzero(low[:, 1:] < low[:, :-1])
            for r, c in zip(rows.tolist(), cols.tolist(), strict=True):
                self.where[r].append(self.size + c)
            self.best, self.size = low[:, -1], self.size + 4096
        self.records = [np.array(w) for w in self.where]

    def of(self, counts: np.ndarray) -> np.ndarray:
        if counts.max() > self.size:
            self.grow(int(counts.max()))
        return np.stack([w[np.searchsorted(w, counts, "left") - 1] for w in self.records], 1)


def fingerprints_of(texts: list[str], coordinates: Coordinates) -> list[str]:
    out = [EMPTY] * len(texts)
    some = [i for i, t in enumerate(texts) if t]
    if not some:
        return out
    sizes = np.array([len(texts[i]) for i in some], np.int64)
    codes = np.frombuffer("".join(texts[i] for i in some).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    blocks = (sizes + BLOCK - 1) // BLOCK
    first = starts_of(blocks)
    nth = np.arange(first[-1]) - np.repeat(first[:-1], blocks)
    starts = np.repeat(starts_of(sizes)[:-1], blocks) + nth * BLOCK
    lengths = np.minimum(np.repeat(sizes, blocks) - nth * BLOCK, BLOCK)
    full = 2 * BLOCK // WORD
    made = np.zeros((int(first[-1]), full), np.uint8)
    counts = np.zeros(int(first[-1]), np.int64)
    for a in range(0, int(first[-1]), LANES):
        got, n = walk(codes, starts[a : a + LANES], lengths[a : a + LANES])
        made[a : a + LANES, : got.shape[1]], counts[a : a + LANES] = got, n
    totals = (blocks - 1) * full + counts[first[1:] - 1]
    at = coordinates.of(totals)
    chosen = made[first[:-1, None] + at // full, at % full]
    for i, row in zip(some, chosen, strict=True):
        out[i] = row.tobytes().hex()
    return out


def likeness(a: str, b: str) -> float:
    """Share of equal slots of two fingerprints."""
    return sum(a[i : i + 2] == b[i : i + 2] for i in range(0, 2 * SLOTS, 2)) / SLOTS


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as much of the next text's beginning."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _ordered(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").alias("doc_id"), text_of().alias("text"))
    return rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"), "text")


FIELDS = "doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next".split(", ")


def _row(text: str, following: str, own: str, other: str, changed: str, of_changed: str) -> tuple:
    return len(text), hashlib.sha256(changed.encode()).hexdigest(), own, of_changed, likeness(own, of_changed), likeness(own, other)


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprint of every document and of its edited text, and the likeness to that and to the next document.

    Documents are range-partitioned and sorted by id. Each task looks one row ahead; the last row of a partition and the first of
    each are kept aside with their texts, two for a partition, and finished in a second, small job.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, coordinates = TaskContext.get().partitionId(), Coordinates()
        held, begun, kind_ = None, False, None  # the row still waiting for its next one
        names = [*FIELDS, "part", "role", "text"]
        for piece in pieces(batches):
            ids, texts = piece["doc_id"].to_pylist(), piece["text"].to_pylist()
            kind_ = piece["doc_id"].type
            prints = fingerprints_of(texts, coordinates)
            rows = []
            if not begun:
                rows.append((ids[0], None, None, prints[0], None, None, None, part, "first", texts[0]))
                begun = True
            all_ids = [held[0], *ids] if held else ids
            all_texts = [held[1], *texts] if held else texts
            all_prints = [held[2], *prints] if held else prints
            held = (all_ids[-1], all_texts[-1], all_prints[-1])
            changed = [edited(a, b) for a, b in zip(all_texts[:-1], all_texts[1:], strict=True)]
            for i, of_changed in enumerate(fingerprints_of(changed, coordinates)):
                done = _row(all_texts[i], all_texts[i + 1], all_prints[i], all_prints[i + 1], changed[i], of_changed)
                rows.append((all_ids[i], *done, part, "done", None))
            yield _batch(rows, kind_, names)
        if held:
            yield _batch([(held[0], None, None, held[2], None, None, None, part, "last", held[1])], kind_, names)

    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, part int, role string, text string"
    made = cut_lineage(_ordered(docs).mapInArrow(run, schema))
    parts = sorted(r[0] for r in made.filter("role = 'first'").select("part").collect())  # one number per partition
    done = made.filter("role = 'done'").select(*FIELDS)
    if not parts:
        return done
    spark = docs.sparkSession
    order = spark.createDataFrame([(p, parts[(i + 1) % len(parts)]) for i, p in enumerate(parts)], "part int, following int")
    ends = made.filter("role = 'last'").select("part", "doc_id", "fingerprint", "text").join(order, "part")
    begin = made.filter("role = 'first'").select(F.col("part").alias("following"), F.col("fingerprint").alias("other"), F.col("text").alias("next_text"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coordinates = Coordinates()
        for piece in pieces(batches):
            rows = []
            for r in piece.to_pylist():
                changed = edited(r["text"], r["next_text"])
                of_changed = fingerprints_of([changed], coordinates)[0]
                rows.append((r["doc_id"], *_row(r["text"], r["next_text"], r["fingerprint"], r["other"], changed, of_changed)))
            yield _batch(rows, piece["doc_id"].type, FIELDS)

    closed = ends.join(begin, "following").select("doc_id", "fingerprint", "other", "text", "next_text")
    return done.unionAll(closed.mapInArrow(finish, schema.split(", part")[0]))


def _batch(rows: list[tuple], id_type: pa.DataType, names: list[str]) -> pa.RecordBatch:
    types = [id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types, strict=False)], names=names)


def near_classes(prints: DataFrame, least: float = LEAST) -> DataFrame:
    """(fingerprint, root) of the distinct fingerprints that are linked to another by a band and by likeness."""
    rows = prints.select("fingerprint").distinct().filter(F.col("fingerprint") != EMPTY)
    bands = rows.select("fingerprint", F.posexplode(F.array(*[F.substring("fingerprint", 2 * BAND * b + 1, 2 * BAND) for b in range(SLOTS // BAND)])).alias("at", "bits"))
    ends = bands.groupBy("at", "bits").agg(F.min("fingerprint").alias("lo"), F.max("fingerprint").alias("hi")).filter("lo < hi")
    met = bands.join(ends, ["at", "bits"])
    pairs = met.select(F.col("lo").alias("a"), F.col("fingerprint").alias("b")).union(met.select("fingerprint", "hi")).filter("a < b").distinct()
    equal = F.size(F.filter(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda i: F.substring(F.col("a"), 2 * i + 1, F.lit(2)) == F.substring(F.col("b"), 2 * i + 1, F.lit(2))))
    links = pairs.filter(equal >= least * SLOTS)
    return components(links).select(F.col("key").alias("fingerprint"), "root")
