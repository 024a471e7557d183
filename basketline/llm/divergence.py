"""How far the sources of a language diverge in their words.

Terms of whole texts are counted by (language, source), and with them the documents they are in. A language keeps the terms of
at least ``LEAST_DOCS`` of its documents. Kept terms are dealt to slices of about ``SLICE`` by hash and numbered in order
within, so that a group is a sorted (term id, count) array for each slice, and none grows with the vocabulary.
Every unordered pair of sources is a task for each slice: the two arrays meet in a cogroup, the shorter is searched in the longer, and
terms of both, of one only and of none are priced. The price is the same both ways, so it is told to both.

With N the kept terms' occurrences of a group and V the kept terms of its language, a term met ``count`` times has
``p = 1 + floor(SCALE * (count + 2) / (N + 2 V))``; two such differ by ``floor((p - q)^2 / (p + q))``. All in whole numbers.

Null texts, languages and sources are empty texts. Repeated rows count each. A group without terms is a group; a language without
kept terms has values of 0 and no terms. Ties go by the item's bytes. An empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketline.llm.tables import text_of
from basketline.llm.tallies import tallied
from basketline.session import cut_lineage

TERM = re.compile(rb"[a-z\x80-\xff]+")  # in UTF-8, after A-Z are lower-cased
LEAST_DOCS, TOP, SCALE, SLICE = 10, 10, 1_000_000_000, 50_000


def _count(held: dict, piece: pa.RecordBatch, texts: list[bytes]) -> None:
    for lang, source, text in zip(piece["lang"].to_pylist(), piece["source"].to_pylist(), texts, strict=True):
        terms = TERM.findall(text)
        held.setdefault((lang, source, "n"), Counter()).update(terms)
        held.setdefault((lang, source, "docs"), Counter()).update(set(terms))


def _batches(held: dict) -> Iterator[pa.RecordBatch]:
    """The counts of one group after the other; each has a row without a term besides, so that no group is lost."""
    for lang, source in {key[:2] for key in held}:
        counts, docs = held.pop((lang, source, "n")), held.pop((lang, source, "docs"))
        rows = {
            "lang": pa.array([lang] * (len(counts) + 1), pa.string()),
            "source": pa.array([source] * (len(counts) + 1), pa.string()),
            "term": pa.array([None, *(t.decode() for t in counts)], pa.string()),
            "n": pa.array([0, *counts.values()], pa.int64()),
            "docs": pa.array([0, *(docs[t] for t in counts)], pa.int64()),
        }
        yield pa.record_batch(list(rows.values()), names=list(rows))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs), with a row of a null term for each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from tallied(batches, _count, _batches)

    named = docs.select(text_of("lang").alias("lang"), text_of("source").alias("source"), "text")
    parts = named.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, n) of the terms that enough documents of the language have."""
    totals = counts.filter("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return totals.filter(F.col("docs") >= least_docs).select("lang", "term", "n")


def numbered(kept: DataFrame, most: int, slice_size: int = SLICE) -> DataFrame:
    """(lang, term, slice, id): terms in slices by hash, numbered in order within their slice.

    ``most`` is the number of terms of the language that has most; the others' slices are as many and smaller.
    """
    slices = F.lit(max(1, -(-most // slice_size)))
    dealt = kept.select("lang", "term", F.pmod(F.xxhash64("term"), slices).cast("int").alias("slice"))
    place = F.row_number().over(Window.partitionBy("lang", "slice").orderBy("term"))
    return dealt.withColumn("id", place)


def rate(n: Column, total: Column, v: Column) -> Column:
    """``p`` of a count, in decimals wide enough for any of them."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(18,0)")
    return F.call_function("div", top, (total + 2 * v).cast("decimal(19,0)")) + 1


def price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def rates(counts: np.ndarray, whole: int) -> np.ndarray:
    """``rate`` of many counts: a long division in steps of a thousand, which 64 bits can hold."""
    left, out = counts + 2, np.zeros(len(counts), np.int64)
    for _ in range(3):
        left = left * 1000
        out, left = out * 1000 + left // whole, left % whole
    return out + 1


def prices(p: np.ndarray, q: np.ndarray | int) -> int:
    return int(((p - q) * (p - q) // (p + q)).sum())


def merged(ids: np.ndarray, p: np.ndarray, absent_p: int, others: np.ndarray, q: np.ndarray, absent_q: int, terms: int) -> int:
    """Price of two sorted arrays over ``terms`` terms, those that neither has included."""
    if len(ids) > len(others):
        ids, p, absent_p, others, q, absent_q = others, q, absent_q, ids, p, absent_p
    at = np.searchsorted(others, ids)
    both = at < len(others)
    both[both] = others[at[both]] == ids[both]
    alone = np.ones(len(others), bool)
    alone[at[both]] = False
    absent = terms - len(ids) - int(alone.sum())
    none = np.full(1, absent_p)
    return prices(p[both], q[at[both]]) + prices(p[~both], absent_q) + prices(q[alone], absent_p) + absent * prices(none, absent_q)


def _pair(left: pa.Table, right: pa.Table) -> pa.Table:
    """One slice of one pair of sources."""
    sides = []
    for side in (left, right):
        whole = side["total"][0].as_py() + 2 * side["v"][0].as_py()
        ids, n = (side[c].combine_chunks().flatten().to_numpy() for c in ("ids", "counts"))
        sides += [ids, rates(n, whole), int(rates(np.zeros(1, np.int64), whole)[0])]
    value = merged(*sides, left["terms"][0].as_py())
    names = ("lang", "a", "b")
    return pa.table({**{c: left[c].slice(0, 1) for c in names}, "value": pa.array([value], pa.int64())})


def pair_values(groups: DataFrame, arrays: DataFrame) -> DataFrame:
    """(lang, a, b, value) of each unordered pair of sources of a language, a before b.

    ``arrays`` has every group in every slice of its language; a pair's two arrays are sent to the pair, one for each
    other source, which is what the result has rows for.
    """
    ours = groups.select("lang", F.col("source").alias("a"))
    pairs = ours.join(groups.select("lang", F.col("source").alias("b")), "lang").filter("a < b")
    key = ["lang", "a", "b", "slice"]
    left = arrays.withColumnRenamed("source", "a").join(pairs, ["lang", "a"]).groupBy(*key)
    right = arrays.withColumnRenamed("source", "b").join(pairs, ["lang", "b"])
    right = right.select(*[F.col(c).alias(c) for c in right.columns]).groupBy(*key)  # columns of its own for the cogroup
    parts = left.cogroup(right).applyInArrow(_pair, "lang string, a string, b string, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, slice_size: int = SLICE) -> DataFrame:
    """(lang, source, part, item, value, rank): every other source, and the ``top`` terms a source has more than its language."""
    counts = cut_lineage(term_counts(docs))
    kept = cut_lineage(kept_terms(counts, least_docs))
    langs = counts.select("lang").distinct().join(kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_total")), "lang", "left")
    langs = cut_lineage(langs.na.fill(0, ["v", "lang_total"]))
    most = langs.agg(F.max("v")).first()[0] or 0
    numbers = cut_lineage(numbered(kept, most, slice_size))
    entries = cut_lineage(counts.select("lang", "source", "term", "n").join(numbers, ["lang", "term"]))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.filter("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang")
    groups = cut_lineage(groups.na.fill(0, ["total"]))

    # a language without kept terms has one slice without terms
    slices = langs.select("lang", "v").join(numbers.groupBy("lang", "slice").agg(F.count("*").alias("terms")), "lang", "left")
    slices = slices.na.fill(0, ["slice", "terms"]).filter("v > 0")
    listed = entries.groupBy("lang", "source", "slice").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("entries"))
    # two plain arrays take a third of the room of one of pairs
    listed = listed.select("lang", "source", "slice", F.col("entries.id").alias("ids"), F.col("entries.n").alias("counts"))
    arrays = groups.select("lang", "source", "total", "v").join(slices.drop("v"), "lang")
    arrays = arrays.join(listed, ["lang", "source", "slice"], "left")
    none_here = {"ids": F.array().cast("array<int>"), "counts": F.array().cast("array<bigint>")}
    arrays = cut_lineage(arrays.withColumns({c: F.coalesce(c, empty) for c, empty in none_here.items()}))
    bare = groups.filter("v = 0").select("lang", F.col("source").alias("a"))
    none = bare.join(bare.withColumnRenamed("a", "b"), "lang").filter("a < b").withColumn("value", F.lit(0).cast("long"))
    pairs = cut_lineage(pair_values(groups.select("lang", "source"), arrays).unionByName(none))
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").union(
        pairs.select("lang", F.col("b"), F.col("a"), "value")
    )

    own = rate(F.col("n"), F.col("total"), F.col("v"))
    usual = rate(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    used = entries.join(kept.select("lang", "term", F.col("n").alias("lang_n")), ["lang", "term"]).join(groups, ["lang", "source"])
    used = used.select("lang", "source", F.col("term").alias("item"), own.alias("p"), usual.alias("q")).filter("p > q")
    terms = used.select("lang", "source", "item", price(F.col("p"), F.col("q")).alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked_terms = terms.withColumn("rank", place).filter(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    told = both.withColumn("rank", place).withColumn("part", F.lit("pair")).select(*columns)
    return told.unionByName(ranked_terms.withColumn("part", F.lit("term")).select(*columns))
