"""Encode texts into the pieces of a SentencePiece model by Unigram Viterbi, and decode ids again.

White space becomes the marker, words are cut before each run of markers, and every distinct word of a piece of
the batch is solved once: best scores by byte position, walked for all words at the same time through the double
array. A character that no piece covers costs the unknown score and is written as byte pieces where the model has
them. Of equal paths the one found first is kept. Decoding joins pieces and bytes, and turns markers into spaces.

A null text is the empty text and has no ids. Repeated rows are encoded alike; an empty table gives an empty result; all
columns are kept, packed while they pass, so that none can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketline.llm.batches import TokenIds, column_of, pieces, spread, starts_of
from basketline.llm.pieces_model import BYTE, CONTROL, SPACE, UNKNOWN, load
from basketline.llm.tables import unpacked, whole_row

#: Bytes of words and ids that an encoder keeps, and characters that it takes at once.
KEPT_BYTES, CHARS = 24_000_000, 500_000


def solve(words: list[bytes], model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after the other, and how many each has."""
    base, check, value, scores = model["base"], model["check"], model["value"], model["scores"]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(-sizes, kind="stable")
    sorted_sizes = sizes[order]
    offsets = starts_of(sizes)
    raw = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    end = offsets[1:]
    # node of position p of word w: offsets[w] + w + p, as a word has one position more than bytes
    first = offsets[:-1] + np.arange(len(words))
    total = int(offsets[-1]) + len(words)
    best, came, by = np.full(total, -np.inf), np.full(total, -1, np.int64), np.full(total, -1, np.int64)
    best[first] = 0.0
    wide = np.where(raw < 0x80, 1, np.where(raw < 0xE0, 2, np.where(raw < 0xF0, 3, 4)))
    wide[(raw >= 0x80) & (raw < 0xC0)] = 1
    limit = len(check)
    longest = int(sorted_sizes[0]) if len(words) else 0
    for p in range(longest):
        live = order[: int(np.searchsorted(-sorted_sizes, -p, "left"))]
        live = live[np.isfinite(best[first[live] + p])]
        if not len(live):
            continue
        at, node, score = offsets[live] + p, first[live] + p, best[first[live] + p]
        stop, step, width = end[live], 0, wide[at]
        single = np.zeros(len(live), bool)
        rows, state = np.arange(len(live)), np.zeros(len(live), np.int64)
        while len(rows):
            inside = at[rows] + step < stop[rows]
            rows, state = rows[inside], state[inside]
            child = base[state] + raw[at[rows] + step] + 1
            good = (child < limit) & (check[np.minimum(child, limit - 1)] == state)
            rows, state = rows[good], child[good]
            step += 1
            piece = value[state]
            hit = piece >= 0
            r, piece = rows[hit], piece[hit]
            single[r[width[r] == step]] = True
            new, target = score[r] + scores[piece], node[r] + step
            better = new > best[target]
            best[target[better]], came[target[better]], by[target[better]] = new[better], p, piece[better]
        r = np.flatnonzero(~single)
        new, target = score[r] + model["unknown_score"], node[r] + width[r]
        better = new > best[target]
        best[target[better]], came[target[better]], by[target[better]] = new[better], p, -2
    ids, counts = [], np.zeros(len(words), np.int64)
    for w in range(len(words)):
        p, own = int(sizes[w]), []
        while p > 0:
            n = first[w] + p
            start, piece = int(came[n]), int(by[n])
            if piece >= 0:
                own.append(piece)
            elif model["bytes"] is not None:
                own += model["bytes"][raw[offsets[w] + start : offsets[w] + p][::-1]].tolist()
            elif not own or own[-1] != model["unknown"] or by[first[w] + p] != -2:
                own.append(model["unknown"])
            p = start
        counts[w] = len(own)
        ids += own[::-1]
    return np.array(ids, np.int64), counts


def words_of(text: str, model: dict) -> list[str]:
    """The normalised text cut before each run of markers."""
    if model["squeeze"]:
        text = regex.sub(" +", " ", text.strip(" "))
    if not text:
        return []
    if model["prefix"]:
        text = " " + text
    if model["marked"]:
        text = text.replace(" ", SPACE)
    return regex.findall(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+", text)


class Decoder:
    """Decodes ids: the bytes of all pieces lie in one array, from which those of many texts are gathered at once."""

    def __init__(self, model: dict):
        self.prefix = model["prefix"]
        spelt = {BYTE: lambda name: bytes([int(name[1:-1], 16)]), UNKNOWN: lambda _: model["unknown_text"].encode(), CONTROL: lambda _: b""}
        named = zip(model["names"], model["kinds"].tolist(), strict=True)
        raw = [spelt.get(kind, str.encode)(name) for name, kind in named]
        self.flat, self.starts = np.frombuffer(b"".join(raw), np.uint8), starts_of(np.fromiter(map(len, raw), np.int64, len(raw)))

    def __call__(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        """The texts whose ids begin at the offsets ``at``."""
        sizes = self.starts[ids + 1] - self.starts[ids]
        joined = self.flat[spread(self.starts[ids], sizes)].tobytes()
        ends = starts_of(sizes)[at].tolist()
        texts = [joined[a:b].decode("utf-8", "replace").replace(SPACE, " ") for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return [t.removeprefix(" ") for t in texts] if self.prefix else texts


def decode(ids: list[int], model: dict) -> str:
    return Decoder(model)(np.array(ids, np.int64), np.array([0, len(ids)]))[0]


class Encoder:
    """Encodes lists of texts; ids of words met before are kept, up to ``KEPT_BYTES`` in all."""

    def __init__(self, model: dict):
        self.model, self.known = model, TokenIds()
        self.flat, self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the offsets of the texts."""
        if self.known.size + self.flat.nbytes > KEPT_BYTES:
            self.__init__(self.model)
        words = [words_of(t, self.model) for t in texts]
        numbers, new = self.known.index([w for own in words for w in own])
        if new:
            ids, sizes = solve([w.encode() for w in new], self.model)
            self.starts = np.concatenate((self.starts, len(self.flat) + starts_of(sizes)[:-1]))
            self.sizes, self.flat = np.concatenate((self.sizes, sizes)), np.concatenate((self.flat, ids))
        ids = self.flat[spread(self.starts[numbers], self.sizes[numbers])] if len(numbers) else np.zeros(0, np.int64)
        at = starts_of(self.sizes[numbers])[starts_of(np.fromiter(map(len, words), np.int64, len(words)))]
        return ids, at


def encode(docs: DataFrame, path: str, decoded: bool = True) -> DataFrame:
    """``row`` (all columns), ids, and with ``decoded`` the text that the ids give back."""
    model = docs.sparkSession.sparkContext.broadcast(load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(model.value), Decoder(model.value) if decoded else None
        for piece in pieces(batches, chars=CHARS):
            ids, at = encoder([text or "" for text in column_of(piece, "text").to_pylist()])
            columns = {"row": piece["row"], "ids": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))}
            if decoded:
                columns["decoded"] = pa.array(decoder(ids, at), pa.string())
            yield pa.record_batch(list(columns.values()), names=list(columns))

    packed = docs.select(whole_row(docs))
    back = [F.lit("").alias("decoded")] if decoded else []
    schema = packed.select("row", F.array().cast("array<int>").alias("ids"), *back).schema
    return packed.mapInArrow(run, schema)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """All columns, with the ids in ``piece_ids``."""
    out = encode(docs, path, decoded=False)
    return out.select(*unpacked(out, docs.columns), F.col("ids").alias("piece_ids"))
