"""Top-k search, spelling variants and source divergence against plain versions, and on awkward rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketline.llm import divergence, spelling, topk_search
from basketline.llm.queries import ORACLE_SQL, QUERIES
from suite.compare import differences

VECTORS = "vec_id long, embedding array<float>, id int, score double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0.5) for i, v in rows], VECTORS)


def plain_top(rows, k, every):
    """Of rows as the search sees them: those that take part, one for each id."""
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q = [min(max(math.floor(256 * float(np.float32(x))), -(2**63)), 2**63 - 1) for x in v]
            whole[i] = min(whole.get(i, q), q)
    out = set()
    for q in (i for i in whole if i % every == 0):
        scores = [(sum(a * b for a, b in zip(whole[q], whole[i], strict=False)), i) for i in whole if i != q]
        scores = sorted((-min(max(s, -(2**63)), 2**63 - 1), i) for s, i in scores)[:k]
        out |= {(q, place + 1, i, -s) for place, (s, i) in enumerate(scores)}
    return out


def found_top(frame, **settings):
    return {tuple(r) for r in topk_search.top_k(frame, **settings).collect()}


AWKWARD = [
    (None, [1.0, 2.0]), (0, [0.5, 0.25]), (1, None), (2, [1.0, None]), (3, [math.inf, 1.0]), (4, [math.nan, 1.0]),
    (5, []), (50, [0.5]), (50, [0.5]), (51, [0.5, 0.25, 1.0]), (52, [-0.5, 0.001]), (53, [0.5, 0.25]), (53, [0.5, 0.3]),
    (-50, [-1.0, -1.0]), (100, [3e38, -3e38]), (101, [3e38, 1e30]), (102, [2e9, 2e9, 2e9]),
]


@pytest.mark.parametrize("parts", [1, 2, 3])
def test_top_k_of_awkward_rows(spark, parts):
    assert found_top(vectors(spark, AWKWARD), k=3, parts=parts) == plain_top(AWKWARD, 3, 50)
    assert found_top(vectors(spark, AWKWARD), k=50, parts=parts) == plain_top(AWKWARD, 50, 50)
    assert found_top(vectors(spark, []), parts=parts) == set()
    assert found_top(vectors(spark, [(7, [1.0])]), parts=parts) == set()


def test_top_k_with_copies_ties_and_many_cells(spark, monkeypatch):
    """A third of all rows share one vector, scores tie often, and cells hold a few rows only."""
    monkeypatch.setattr(topk_search, "CELL", 200)
    rng = random.Random(5)
    rows = [(i, [rng.randint(-3, 3) / 8 for _ in range(6)]) for i in range(240)]
    rows = [(i, [0.25] * 6) if i % 3 == 0 else (i, v) for i, v in rows] * 2
    rng.shuffle(rows)
    for parts in (2, 4):
        assert found_top(vectors(spark, rows), k=4, every=7, parts=parts) == plain_top(rows, 4, 7)


def test_top_k_equals_its_sql(spark, sf_dir, duck):
    assert differences(QUERIES["op11_top_k"](spark, sf_dir), duck, ORACLE_SQL["op11_top_k"]) == []


def test_the_cutoff_spares_most_entries(spark, sf_dir, monkeypatch):
    """Phase 3 resolves a small part of all (query, vector) pairs."""
    resolved, plain = [], topk_search._resolved
    monkeypatch.setattr(topk_search, "_resolved", lambda g, q, v, pairs: resolved.append(pairs.count()) or plain(g, q, v, pairs))
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    asked = table.filter("vec_id % 50 = 0").count()
    assert topk_search.top_k(table).count() == 5 * asked
    assert max(resolved) < 0.5 * asked * table.count()


def plain_spelling(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(x.lower() if "A" <= x <= "Z" else x for x in run)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    letters, near = sorted({x for w in n for x in w}), {}
    for w in n:
        cut = [(w[:i], w[i:]) for i in range(len(w) + 1)]
        edits = {a + b[1:] for a, b in cut if b}
        edits |= {a + x + b[1:] for a, b in cut if b for x in letters} | {a + x + b for a, b in cut for x in letters}
        near[w] = (edits & n.keys()) - {w}
    best = {w: min(near[w], key=lambda x: (-n[x], x)) for w in n if near[w]}
    form = {w: f for w, f in best.items() if n[f] >= 5 * n[w]}
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None)
    return out


def found_spelling(frame):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.grouped(frame).collect()}


DOCS = "doc_id long, text string, word string, n long, id long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "w", 1, 2) for i, t in rows], DOCS)


def test_spelling_of_the_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert found_spelling(docs) == plain_spelling([(r.doc_id, r.text) for r in docs.collect()])


def test_spelling_of_awkward_rows(spark):
    """Nulls, empty texts, repeated rows, ties, chains of forms, letters that count as none, and a very long word."""
    long = "ab" * 3000
    times = {
        "committee": 700, "comittee": 130, "comitee": 25, "comitees": 5, "Comitees": 0, "committees": 130, "straße": 40, "strasse": 5,
        "aaaaaaa": 6, "aaaaaa": 5, "aaaaaab": 5, "baaaaaa": 5, "àçéñþÿ": 9, "àçéñþý": 9, "ÀÇÉÑÞß": 5, "seven7letters": 9, long: 30, long + "a": 5, "x" * 5: 99,
    }
    words = [w for w, n in times.items() for _ in range(n)]
    random.Random(3).shuffle(words)
    rows = [(i, " ".join(words[i * 7 : i * 7 + 7])) for i in range(len(words) // 7 + 1)]
    rows += [(None, "Committee COMITTEE"), (3, None), (4, ""), (5, "no\tone, 12 µ Ā")] + rows[:3]
    expected = plain_spelling(rows)
    assert expected["comitee"][:2] == ("comittee", "committee") and expected[long + "a"][0] == long
    assert found_spelling(documents(spark, rows)) == expected
    assert found_spelling(documents(spark, [])) == {}


def test_no_edit_is_missed_by_the_keys():
    """Keys of a word are those of all its reduced neighbours, each once."""
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefé") for _ in range(rng.randint(1, 9))) for _ in range(60)] + ["aaaa", "abab"]
    own = spelling.Reduced(words)
    row, key = own.neighbours()
    met = defaultdict(list)
    for r, k in zip(row.tolist(), key.tolist(), strict=True):
        met[r].append(k)
    for i, word in enumerate(words):
        s = spelling.symbols(np.array([ord(x) for x in word])).tolist()
        all_symbols = range(1, spelling.SYMBOLS + 1)
        edits = {tuple(s)} | {tuple(s[:j] + s[j + 1 :]) for j in range(len(s))}
        edits |= {tuple([*s[:j], x, *s[j + 1 :]]) for j in range(len(s)) for x in all_symbols}
        edits |= {tuple([*s[:j], x, *s[j:]]) for j in range(len(s) + 1) for x in all_symbols}

        def rolling(symbols):
            h = 0
            for x in symbols:
                h = (h * int(spelling.STEP) + x) % 2**64
            return h

        assert int(own.whole[i]) == rolling(s)
        assert sorted(met[i]) == sorted(map(rolling, edits))


ROWS = "doc_id long, text string, lang string, source string, term string, n long, value long"


def corpus(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, "t", 1, 2) for i, (t, lang, s) in enumerate(rows)], ROWS)


def plain_audit(rows, least_docs=10, top=10):
    term = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = ["".join(x.lower() if "A" <= x <= "Z" else x for x in t) for t in term.findall(text or "")]
        groups[lang].add(source)
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = set()
    for lang, sources in groups.items():
        kept = [t for t in docs[lang] if docs[lang][t] >= least_docs]
        whole = Counter({t: sum(counts[lang, s][t] for s in sources) for t in kept})

        def rates(c, kept=kept):
            below = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // below for t in kept}

        p, q = {s: rates(counts[lang, s]) for s in sources}, rates(whole)

        def price(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources:
            pairs = [(o, sum(price(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, price(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)}
    return out


def found_audit(frame, **settings):
    return {tuple(r) for r in divergence.audit(frame, **settings).collect()}


def test_divergence_equals_its_sql(spark, sf_dir, duck):
    assert differences(QUERIES["op13_divergence"](spark, sf_dir), duck, ORACLE_SQL["op13_divergence"]) == []


@pytest.mark.parametrize("slice_size", [1, 3, 1000])
def test_divergence_of_awkward_rows(spark, slice_size):
    """Nulls and empty texts, a group without terms, a language without kept terms, ties, a hot source, repeated rows."""
    rng = random.Random(2)
    words = ["Alpha", "beta", "gamma", "été", "日本", "x", "rare", "a1b", "\U0001f389"]
    rows = []
    for i in range(160):
        text = " ".join(rng.choice(words[: 3 + i % 7]) for _ in range(rng.randint(0, 9)))
        rows.append((text, rng.choice(["en", "en", None, ""]), "hot" if i % 3 == 0 else rng.choice(["s1", "s2", None, "ü"])))
    rows += [("one of its kind", "xx", "s1"), (None, "xx", "s2"), ("", "xx", None), ("12 34", "yy", "s1")] + rows[:20]
    expected = plain_audit(rows)
    assert {r[0] for r in expected} == {"en", "", "xx"}
    assert found_audit(corpus(spark, rows), slice_size=slice_size) == expected
    assert found_audit(corpus(spark, [])) == set()


def test_rates_are_exact_beyond_64_bits():
    counts = np.array([0, 1, 12_345_678_901, 999_999_999_999_998], np.int64)
    whole = 1_000_000_000_000_007
    assert divergence.rates(counts, whole).tolist() == [1 + 10**9 * (int(c) + 2) // whole for c in counts]


def test_rates_in_sql_agree(spark):
    rows = [(0, 5, 1), (12_345_678_901, 10**15 + 1, 3), (10**15, 10**15, 7)]
    frame = spark.createDataFrame(rows, "n long, total long, v long")
    got = [r[0] for r in frame.select(divergence.rate(F.col("n"), F.col("total"), F.col("v"))).collect()]
    assert got == [1 + 10**9 * (n + 2) // (total + 2 * v) for n, total, v in rows]
