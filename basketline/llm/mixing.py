"""Mix sources to target weights by entropy balancing.

Each source gets a target number of words. Document rates are those nearest to 1 in relative entropy
that meet their source's target and stay at or below ``MOST`` copies. They have the form
``min(MOST, exp(lambda_source * size / mean size))``; the lambdas maximise a concave dual, found by Newton steps
kept inside a bracket. A step is one distributed sum over (source, size) counts for all sources at
once; only one error figure reaches the driver. Rates become whole copies by passing on the rounding
error from the longest document to the shortest, in slices of a source that one task can hold.

Nulls: a null text has size 0, a null source is a source of its own, last in order. Empty documents
are never taken. Repeated rows are rounded each on its own. An empty table gives an empty result. Equal
input gives equal output: ties go by size, hash of id and text, and id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketline.llm.tables import text_of, unpacked, whole_row, word_count
from basketline.session import cut_lineage

#: Source weights in the order of source names, repeating.
WEIGHTS = (5, 2, 1)
MOST = 3
SLICE_DOCS, SLICE_WORDS = 1024, 2_000_000
MAX_STEPS, TOLERANCE = 80, 1e-9


def _sized(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    packed = whole_row(docs.select(*keep) if keep else docs)
    return docs.select(
        packed,
        F.col("source").alias("source"),
        word_count(text_of()).alias("size"),
        F.xxhash64("doc_id", "text").alias("tie"),
        F.col("doc_id").alias("id"),
    )


def source_targets(counts: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, sid, words, docs, target) from (source, size, n). The excess over ``most`` times a source's words is
    shared again by weight until no target is above; each round needs two sums."""
    spark = counts.sparkSession
    sources = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.sum("n").alias("docs"))
    ordered = cut_lineage(sources).orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex()
    numbered = spark.createDataFrame(
        ordered.map(lambda pair: (*pair[0], pair[1])), "source string, words long, docs long, sid long"
    )
    share = F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights) + 1).cast("int")).cast("long")
    numbered = cut_lineage(numbered.withColumn("weight", share).withColumn("cap", most * F.col("words")))
    total, weight = numbered.agg(F.sum("words"), F.sum("weight")).first()
    total, level = total or 0, (total or 0) / (weight or 1)
    while True:
        above = F.lit(level) * F.col("weight") > F.col("cap")
        full, rest = numbered.agg(F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("weight")))).first()
        raised = (total - (full or 0)) / rest if rest else level
        if raised <= level:
            break
        level = raised
    target = F.least(F.lit(level) * F.col("weight"), F.col("cap").cast("double"))
    return numbered.select("source", "sid", "words", "docs", target.alias("target"))


def _rate(size, mean, tilt, most):
    return F.exp(F.least(tilt * size / mean, F.lit(float(np.log(most)))))


def balance(counts: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """``targets`` with the tilt of each source that meets its target."""
    counts = cut_lineage(
        counts.join(targets.select(F.col("source").alias("s"), "sid"), F.col("source").eqNullSafe(F.col("s")))
        .filter("size > 0")
        .select("sid", "size", "n")
    )
    full = F.col("target") >= F.col("words") * most * (1 - 1e-12)
    state = cut_lineage(
        targets.select(
            "*",
            F.greatest(F.col("words") / F.col("docs"), F.lit(1.0)).alias("mean"),
            full.alias("full"),
            F.lit(0.0).alias("tilt"),
            F.lit(None).cast("double").alias("low"),
            F.lit(None).cast("double").alias("high"),
            F.lit(None).cast("double").alias("error"),
        )
    )
    tilt, low, high = F.col("tilt"), F.col("low"), F.col("high")
    for _ in range(MAX_STEPS):
        rate = _rate(F.col("size"), F.col("mean"), tilt, most)
        mass = F.col("n") * F.col("size") * rate
        curve = F.when(rate < most * (1 - 1e-12), mass * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = (
            counts.join(state.select("sid", "mean", "tilt"), "sid")
            .groupBy("sid")
            .agg(F.sum(mass).alias("got"), F.sum(curve).alias("curve"))
        )
        got = F.coalesce(F.col("got"), F.lit(0.0))
        gap = F.col("target") - got
        step = F.when(F.col("curve") > 0, tilt + gap / F.col("curve"))
        next_low, next_high = F.when(gap > 0, tilt).otherwise(low), F.when(gap < 0, tilt).otherwise(high)
        moved = state.join(sums, "sid", "left").select(
            *targets.columns, "mean", "full", tilt.alias("was"), step.alias("step"), gap.alias("gap"),
            next_low.alias("low"), next_high.alias("high"),
        )
        inside = (F.col("step") > F.coalesce(low, F.col("step") - 1)) & (F.col("step") < F.coalesce(high, F.col("step") + 1))
        halved = F.when(low.isNotNull() & high.isNotNull(), (low + high) / 2).otherwise(
            F.col("was") + F.signum("gap") * (1 + F.abs("was"))
        )
        error = F.when(F.col("full") | (F.col("target") <= 0), 0.0).otherwise(F.abs("gap") / F.col("target"))
        done = error <= TOLERANCE
        state = cut_lineage(
            moved.select(
                *targets.columns, "mean", "full",
                F.when(done, F.col("was")).when(inside, F.col("step")).otherwise(halved).alias("tilt"),
                "low", "high", error.alias("error"),
            )
        )
        if (state.agg(F.max("error")).first()[0] or 0.0) <= TOLERANCE:
            break
    return state.select(*targets.columns, "mean", "full", F.round("tilt", 9).alias("tilt"))


def _copies(size: np.ndarray, rate: np.ndarray, most: int) -> np.ndarray:
    """Whole copies for documents in descending size, so that words taken stay near the sum of rate * size."""
    copies, carried = np.zeros(len(size), np.int64), 0.0
    for i, (words, want) in enumerate(zip(size.tolist(), rate.tolist(), strict=True)):
        if words:
            due = want * words + carried
            copies[i] = min(max(round(due / words), int(want)), min(most, int(np.ceil(want))))
            carried = due - copies[i] * words
    for i, words in enumerate(size.tolist()):  # what is left over goes to any document that it fits
        if words and abs(carried) > words / 2:
            new = min(max(int(copies[i]) + (1 if carried > 0 else -1), 0), most)
            carried -= (new - copies[i]) * words
            copies[i] = new
    return copies


def mix(docs: DataFrame, keep: list[str] | None = None, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """Every document with its size, source's words and target, rate and copies: columns ``row`` (the columns in
    ``keep``, or all), size, source_size, target, rate, copies."""
    sized = _sized(docs, keep)
    counts = cut_lineage(sized.groupBy("source", "size").agg(F.count("*").alias("n")))
    state = balance(counts, source_targets(counts, weights, most), most)
    state = cut_lineage(state.withColumnRenamed("source", "s"))
    rate = F.when(F.col("full"), float(most)).otherwise(_rate(F.col("size"), F.col("mean"), F.col("tilt"), most))
    slices = F.ceil(F.greatest(F.col("docs") / SLICE_DOCS, F.col("words") / SLICE_WORDS, F.lit(1)))
    rated = sized.join(state, F.col("source").eqNullSafe(F.col("s"))).select(
        "row", "size", F.col("words").alias("source_size"), "target", rate.alias("rate"), "tie", "id", "sid",
        F.pmod(F.xxhash64("tie", "sid"), slices).alias("slice"),
    )
    kept = ["row", "size", "source_size", "target", "rate"]

    def rounded(group: pa.Table) -> pa.Table:
        order = np.lexsort(
            [group[c].to_pandas().fillna(-1).to_numpy() for c in ("id", "tie")] + [-group["size"].to_numpy()]
        )
        group = group.select(kept).take(pa.array(order))
        copies = _copies(group["size"].to_numpy(), group["rate"].to_numpy(), most)
        return group.append_column("copies", pa.array(copies, pa.int64()))

    schema = rated.select(*kept, F.lit(0).cast("long").alias("copies")).schema
    return rated.groupBy("sid", "slice").applyInArrow(rounded, schema)


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: the documents with all columns, each as often as its copies say."""
    out = mix(docs)
    repeated = out.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(*unpacked(repeated, docs.columns))
