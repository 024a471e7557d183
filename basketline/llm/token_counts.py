"""Count the tokens that a word-end BPE vocabulary file gives for each text.

Texts are cut at the file's added tokens, normalised and split into pre-tokens the way the file says.
New pre-tokens of a piece are held as one ragged array of symbols. In each round every pre-token
merges its own lowest-rank pair, all of them at once, until no pair of any has a rank; the surviving
symbols are the tokens. The counts of pre-tokens already met are kept, up to ``KEPT``, then forgotten.

A null text counts as the empty text: no bytes, no tokens. Rows keep to themselves, so ties, repeated
rows, an empty table and other columns change nothing; a long text is one piece of its own.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketline.llm.batches import TokenIds, pieces, row_sums, starts_of
from basketline.llm.tables import text_of

KEPT = 400_000
#: The white space that the normaliser's and the splitter's \s stand for.
SPACE = r"\t-\r \x85\xa0  -     　"
NONE = np.iinfo(np.int64).max


def load(path: str) -> dict:
    """What counting needs of a vocabulary file, as plain values and arrays. Other kinds of file are refused."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
    split, level = spec["pre_tokenizer"]["pretokenizers"]
    if (
        model["type"] != "BPE"
        or steps != ["NFC", "Replace", "Lowercase"]
        or not (split["type"] == "Split" and split["behavior"] == "Removed" and split["invert"])
        or not (level["type"] == "ByteLevel" and not level["add_prefix_space"] and not level["use_regex"])
        or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
    ):
        raise ValueError(f"{path} is not a lower-casing BPE vocabulary with word ends")
    vocab, end = model["vocab"], model["end_of_word_suffix"]
    # bytes that print stand for themselves in the file, the others for characters from 256 on, in order
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    letters = [chr(b) if b in plain else chr(next(other)) for b in range(256)]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    pairs = np.array([vocab[a] * 2**32 + vocab[b] for a, b in merges], np.int64)
    order = np.argsort(pairs)
    return {
        "inner": np.array([vocab[c] for c in letters], np.int64),
        "last": np.array([vocab[c + end] for c in letters], np.int64),
        "pairs": pairs[order],
        "ranks": order.astype(np.int64),
        "merged": np.array([vocab[a + b] for a, b in merges], np.int64),
        "split": split["pattern"]["Regex"].replace(r"\s", SPACE),
        "added": sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True),
    }


def survivors(words: list[bytes], model: dict) -> np.ndarray:
    """Symbols left of each word after all merges."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    raw = np.frombuffer(b"".join(words), np.uint8)
    symbols, offsets = model["inner"][raw], starts_of(lengths)
    symbols[offsets[1:] - 1] = model["last"][raw[offsets[1:] - 1]]
    counts, rows = lengths.copy(), np.arange(len(words))
    while len(symbols):
        key = symbols[:-1] * 2**32 + symbols[1:]
        at = np.minimum(np.searchsorted(model["pairs"], key), len(model["pairs"]) - 1)
        rank = np.full(len(symbols), NONE)
        rank[:-1] = np.where(model["pairs"][at] == key, model["ranks"][at], NONE)
        rank[offsets[1:] - 1] = NONE  # the last symbol of a row has no partner in it
        lowest = np.minimum.reduceat(rank, offsets[:-1])
        lengths = np.diff(offsets)
        hit = (rank == np.repeat(lowest, lengths)) & (rank != NONE)
        # in a run of overlapping hits every second one merges, from the left
        place = np.arange(len(symbols))
        run_start = hit & ~np.concatenate(([False], hit[:-1]))
        hit &= (place - np.maximum.accumulate(np.where(run_start, place, 0))) % 2 == 0
        symbols[hit] = model["merged"][rank[hit]]
        stays = ~np.concatenate(([False], hit[:-1]))
        lengths = row_sums(stays.astype(np.int64), offsets)
        counts[rows] = lengths
        live = (lowest != NONE) & (lengths > 1)
        symbols = symbols[stays & np.repeat(live, np.diff(offsets))]
        rows, offsets = rows[live], starts_of(lengths[live])
    return counts


def _words(text: str, model: dict, cut, split, space) -> tuple[list[str], int]:
    parts, added = [text], 0
    if any(a in text for a in model["added"]):
        parts = cut.split(text)
        added = len(parts) - 1
    out: list[str] = []
    for part in parts:
        # the file's lower-casing looks at single characters: a final sigma is no exception
        part = space.sub(" ", unicodedata.normalize("NFC", part)).replace("Σ", "σ").lower()
        out += split.findall(part)
    return out, added


def count_tokens(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every row."""
    model = docs.sparkSession.sparkContext.broadcast(load(path))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = model.value
        cut = regex.compile("|".join(map(regex.escape, tools["added"])))
        split, space = regex.compile(tools["split"]), regex.compile(f"[{SPACE}]+")
        known, counts = TokenIds(), np.zeros(0, np.int64)
        for piece in pieces(batches):
            words: list[str] = []
            n_words, n_added, n_bytes = [], [], []
            for text in piece["text"].to_pylist():
                own, added = _words(text, tools, cut, split, space)
                words += own
                n_words.append(len(own))
                n_added.append(added)
                n_bytes.append(len(text.encode()))
            if len(known) > KEPT:
                known, counts = TokenIds(), np.zeros(0, np.int64)
            numbers, new = known.index(words)
            if new:
                counts = np.concatenate((counts, survivors([w.encode() for w in new], tools)))
            total = row_sums(counts[numbers], starts_of(np.array(n_words, np.int64))) + np.array(n_added, np.int64)
            yield pa.record_batch(
                [piece["id"], pa.array(n_bytes, pa.int64()), pa.array(total, pa.int64())],
                names=["id", "n_bytes", "n_tokens"],
            )

    rows = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    kind = dict(rows.dtypes)["id"]
    out = rows.mapInArrow(counted, f"id {kind}, n_bytes long, n_tokens long")
    return out.withColumnRenamed("id", id_column)
