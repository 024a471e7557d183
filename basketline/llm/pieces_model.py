"""A SentencePiece model file as arrays: pieces with log scores in a double-array trie.

Only the wire format of the published protobuf schema is read (pieces and the two spec messages), so no
generated code is needed.
"""

from __future__ import annotations

import numpy as np

#: Fixed values of the schema: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
SPACE = "▁"
UNKNOWN_PENALTY = 10.0


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at += 1
        if byte < 128:
            return value, at
        shift += 7


def fields(data: bytes):
    """(number, value) of each field: whole numbers, or bytes for the fixed and length-prefixed kinds."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def double_array(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value): the child of state s by byte b is base[s] + b + 1 if check there is s.

    ``value`` is the number of the key that ends in a state, or -1. Keys must be distinct and not empty.
    """
    tree: dict = {}
    for number, key in enumerate(keys):
        node = tree
        for byte in key:
            node = node.setdefault(byte, {})
        node[-1] = number
    room = 4096
    base, check, value = [0] * room, [-1] * room, [-1] * room
    check[0] = 0
    free = bytearray(b"\0" * room)  # 1 where taken
    free[0] = 1
    holes, front, todo = 1, 1, [(tree, 0)]
    while todo:
        node, state = todo.pop()
        value[state] = node.get(-1, -1)
        labels = sorted(b + 1 for b in node if b >= 0)
        if not labels:
            continue
        # a lone child fills the first hole; families look from a front that moves on, so no search is long
        at = free.find(0, holes if len(labels) == 1 else front, len(free))
        while True:
            if at < 0 or at + 512 > len(free):
                at = len(free) - 600 if at < 0 else at
                grown = len(free)
                base += [0] * grown
                check += [-1] * grown
                value += [-1] * grown
                free += b"\0" * grown
                at = free.find(0, at)
            start = at - labels[0]
            if start >= 0 and not any(free[start + b] for b in labels):
                break
            at = free.find(0, at + 1)
        if len(labels) == 1:
            holes = at
        elif at > front + 64:
            front = at - 64
        base[state] = start
        for b in labels:
            free[start + b] = 1
            check[start + b] = state
            todo.append((node[b - 1], start + b))
    return tuple(np.array(x, np.int32) for x in (base, check, value))


def load(path: str) -> dict:
    """Trie, scores and the settings that encoding and decoding follow.

    Scores of a unigram file are its log probabilities. A file made by pair merging holds minus the merge rank
    instead; its pieces get log(1 / (rank + 1)) less the log of the sum of these, so that they are the
    log probabilities of a Zipf law over the ranks. Files with a character map, or with pieces that cross
    from one word into the next, are refused.
    """
    with open(path, "rb") as file:
        return parse(file.read())


def parse(data: bytes) -> dict:
    pieces, trainer, normalizer = [], {}, {}
    for number, value in fields(data):
        if number == 1:
            piece = dict(fields(value))
            score = np.frombuffer(piece.get(2, b"\0\0\0\0"), np.float32)[0]
            pieces.append((piece[1].decode(), float(score), piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(fields(value))
        elif number == 3:
            normalizer = dict(fields(value))
    if normalizer.get(2):
        raise ValueError("character maps are not supported; use an identity model")
    names, scores = [p[0] for p in pieces], np.array([p[1] for p in pieces])
    kinds = np.array([p[2] for p in pieces])
    plain = np.flatnonzero((kinds == NORMAL) | (kinds == USER_DEFINED))
    if any(SPACE in names[i].lstrip(SPACE) for i in plain):
        raise ValueError("pieces that cross word limits are not supported")
    if trainer.get(3, UNIGRAM) == BPE:
        rank = np.maximum(-scores, 0.0)
        weight = np.log1p(np.minimum(rank, 1e9))
        scores = -weight - np.log(np.exp(-weight[plain]).sum())
    base, check, value = double_array([names[i].encode() for i in plain])
    bytes_of = {int(names[i][1:-1], 16): int(i) for i in np.flatnonzero(kinds == BYTE)}
    on = lambda number: bool(normalizer.get(number, 1))
    return {
        "base": base, "check": check, "value": np.where(value >= 0, plain[value], -1).astype(np.int32),
        "scores": scores.astype(np.float64), "names": names, "kinds": kinds,
        "unknown": int(np.flatnonzero(kinds == UNKNOWN)[0]),
        "unknown_score": float(scores[plain].min()) - UNKNOWN_PENALTY,
        "unknown_text": trainer.get(44, b" \xe2\x81\x87 ").decode(),
        "bytes": np.array([bytes_of.get(b, -1) for b in range(256)]) if len(bytes_of) == 256 else None,
        "prefix": on(3), "squeeze": on(4), "marked": on(5),
    }
