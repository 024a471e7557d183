"""Quality rules whose cutoffs carry a guarantee: few good documents are rejected, stratum by stratum.

Each rule is a measure of the text, and a text goes if any rule's measure lies above the cutoff of its stratum. Labelled
documents say how many good ones a cutoff would reject, by all rules together. The cutoffs of a grid are tested from the
loosest to the strictest, each by the exact binomial (Clopper-Pearson) upper bound of the share of good texts lost: it has to be
at most ``MOST_LOST``. The first that fails ends the sequence, and the last that passed is taken. A sequence in fixed order
needs no correction of its own; ``ERROR`` is shared by Bonferroni among the strata. So with a probability of at least
1 - ``ERROR`` no stratum loses more than ``MOST_LOST`` of its good texts to the rules. Equal texts are one label. A stratum
with too few labels gets no cutoff and loses nothing.

Built-in functions only; a text's measures are computed once, within its row, and written. No text is shuffled: the labelled rows
are picked from the written measures, which hold two hashes of the text.

Nulls: a null text is empty, a null stratum is one of its own. A null label is ignored. Repeated rows are
judged alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketline.llm.tables import GAP, WORD, text_of
from basketline.session import cut_lineage

SYMBOLS = "#*$%&|<>"
MOST_LOST, ERROR = 0.05, 0.05
#: Measures by rule, and the grid of cutoffs that are tested.
RULES = {
    "symbols": "n_symbols / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "word_length": "word_chars / greatest(n_words, 1) / 20",
}
GRID = [0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.7, 0.9]


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The ``keep`` columns with the counts of every text."""
    text = F.col("_text")
    rows = docs.select(*[F.col(c) for c in keep], text_of().alias("_text"))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    rows = rows.select(*keep, "_text", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)).alias("_w"), lines.alias("_lines"))
    n = F.size("_w")
    windows = F.when(
        n >= 3,
        F.transform(
            F.arrays_zip(
                F.slice("_w", F.lit(1), n - 2).alias("a"), F.slice("_w", F.lit(2), n - 2).alias("b"), F.slice("_w", F.lit(3), n - 2).alias("c")
            ),
            lambda x, i: F.struct(F.xxhash64(x["a"], x["b"], x["c"]).alias("h"), i.alias("i")),
        ),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    rows = rows.select(
        *keep,
        n.cast("long").alias("n_words"),
        F.length(F.regexp_replace(text, GAP, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(windows).alias("_s"),
    )
    same = lambda a, b: a["h"] == b["h"]
    again = F.filter(
        "_s",
        lambda x, i: F.coalesce(same(x, F.get("_s", i - 1)), F.lit(False)) | F.coalesce(same(x, F.get("_s", i + 1)), F.lit(False)),
    )
    rows = rows.withColumn("_d", F.sort_array(F.transform(again, lambda x: x["i"])))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate(
        "_d", start,
        lambda s, i: F.struct((i + 3).alias("end"), (s["n"] + F.least(F.lit(3), i + 3 - s["end"])).alias("n")),
        lambda s: s["n"].cast("long"),
    )
    return rows.withColumn("n_repeat_words", covered).drop("_s", "_d")


def log_tail(k: Column, n: Column, p: float) -> Column:
    """log P(Binomial(n, p) <= k) for k < n p; 0 (that is, P = 1) from there on."""
    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    log_choose = F.aggregate(steps, F.lit(0.0), lambda s, i: s + F.log((n - i + 1) / i))
    # the sum below the last term, relative to it: 1 + k/(n-k+1) * q/p * (1 + ...), from the inside out
    below = F.aggregate(steps, F.lit(1.0), lambda s, i: 1 + s * (i / (n - i + 1)) * ((1 - p) / p))
    exact = log_choose + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p)) + F.log(below)
    return F.when(k < n * p, exact).otherwise(F.lit(0.0))


def worst(rules=RULES) -> Column:
    """The largest of a text's measures: the strictest cutoff that it does not pass."""
    return F.greatest(*[F.expr(e).cast("double") for e in rules.values()])


def hashed(docs: DataFrame, stratum: str) -> DataFrame:
    """(doc_id, stratum) and the measures of every text, with two hashes of it."""
    text = text_of()
    rows = docs.select("doc_id", F.col(stratum).alias("stratum"), "text", F.xxhash64(text).alias("hash1"), F.xxhash64(F.lit(7), text).alias("hash2"))
    return measured(rows, ["doc_id", "stratum", "hash1", "hash2"])


def cutoffs(rows: DataFrame, labels: DataFrame, rules=RULES, grid=GRID, most=MOST_LOST, error=ERROR) -> DataFrame:
    """(stratum, cutoff) of each stratum in which at least the loosest cutoff has its guarantee, from ``hashed`` rows."""
    good = labels.filter("quality = 1").select(F.col("doc_id").alias("_id")).distinct()
    held = rows.join(good, F.col("doc_id") == F.col("_id"), "left_semi")
    value = held.select("stratum", "hash1", "hash2", worst(rules).alias("value")).distinct()
    levels = sorted(grid, reverse=True)
    lost = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(g).alias("cutoff"), F.count_if(F.col("value") > g).alias("k")) for i, g in enumerate(levels)])
    counts = value.groupBy("stratum").agg(F.count("*").alias("n"), lost.alias("levels"))
    strata = counts.agg(F.count("*").alias("strata"))  # one row
    tested = counts.join(F.broadcast(strata)).select("stratum", "n", "strata", F.inline("levels"))
    sure = log_tail(F.col("k"), F.col("n"), most) <= F.log(F.lit(error) / F.col("strata"))
    passed = tested.select("stratum", "i", "cutoff", F.coalesce(sure, F.lit(False)).alias("sure"))
    first_failed = F.coalesce(F.min(F.when(~F.col("sure"), F.col("i"))), F.lit(len(levels)))
    by_level = F.array_sort(F.collect_list(F.struct("i", "cutoff")))
    ended = passed.groupBy("stratum").agg(first_failed.alias("failed"), by_level.alias("levels")).filter("failed > 0")
    return ended.select("stratum", F.element_at("levels", F.col("failed"))["cutoff"].alias("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """Measures of every document, base_failed and kept."""
    rows = cut_lineage(hashed(docs, stratum))
    cut = cutoffs(rows, labels).select(F.col("stratum").alias("_stratum"), F.col("cutoff").alias("_cutoff"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rejected = F.coalesce(worst() > F.col("_cutoff"), F.lit(False))
    joined = rows.join(cut, F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~rejected).alias("kept"), "stratum",
    )
