"""Drop lines that repeat an earlier line, or differ from one by a single word; keep the earliest.

A line is its words; lines of fewer than ``MIN_WORDS`` words (blank ones too) always stay. Texts are read once into a table of hashes
and places, a row for each line, from which distinct lines are found, each with its first place (document order key, line number).
Two lines within one word of each other share their first or their last half
(cut by the longer one's length), so a line whose halves no other line has is done; the others know on which side a word may
differ, and only their words are fetched from the documents again. Each of them emits its deletion variants on that side as hashed keys: one for each word left out, with the place of that word (equal keys: one word replaced), and one without it beside the
whole line (equal to a variant: one word added). A key keeps only its earliest whole line and earliest variant, so
that no group is paired out or gathered. A line that some key puts behind an earlier one is held against that one word by
word before it goes. Tables between the steps lie in the shared checkpoint folder until the numbers of the lines to drop are known.

The hash of a variant is a sum over its word pairs, changed by the three pairs at the gap, so a line of n words costs
O(n). Documents are ordered by doc_id, null last, then by text. A null text stays null. Rows
equal in id and text are one document and stay once. A document that had words and has
none left is dropped. An empty table gives an empty result. All columns are kept; text and n_chars are brought up to
date. Built-in functions only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketline.llm.tables import WORD, unpacked, whole_row
from basketline.session import checkpoint_dir, cut_lineage, written

MIN_WORDS = 5
#: Pair hashes keep this many bits, so that sums over a line of millions of words fit a long.
DROPPED_BITS = 22
#: Kinds of key: a word left out, with its place; the same without; the line itself.
REPLACED, LEFT_OUT, WHOLE = 0, 1, 2


#: A gap between words that is not one space already.
ODD_GAP = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"


def one_spaced(line: Column) -> Column:
    """The words of a line with one space between them."""
    return F.trim(F.regexp_replace(line, ODD_GAP, " "))


def words_of(line: Column) -> Column:
    """The words of a line that has one space between them."""
    return F.split(line, " ")


def _pair(a: Column, b: Column, seed: int) -> Column:
    return F.shiftright(F.xxhash64(F.lit(seed), a, b), DROPPED_BITS)


def numbered(packed: DataFrame, text: Column) -> DataFrame:
    """(h1, h2, place, halves) of every line of ``MIN_WORDS`` words or more: two hashes of it, its place and hashes of its halves.

    Where the longer of two lines has L words and they differ by one, their common beginning or their common end has
    ``L // 2`` words or more. A line may be the longer one (L = n), as long, or the shorter one (L = n + 1): the first two halves
    are beginnings, the last two ends.
    """
    lines = packed.select("doc", F.posexplode(F.transform(F.split(text, "\n", -1), one_spaced)).alias("at", "norm"))
    n = F.length("norm") - F.length(F.replace("norm", F.lit(" "), F.lit(""))) + 1

    def half(head: bool, longer: Column) -> Column:
        k = F.floor(longer / 2).cast("int")
        return F.xxhash64(F.lit(head), longer, F.call_function("substring_index", "norm", F.lit(" "), k if head else -k))

    halves = F.array(*[half(head, longer) for head in (True, False) for longer in (n, n + 1)]).alias("halves")
    h1, h2 = F.xxhash64("norm").alias("h1"), F.xxhash64(F.lit(7), "norm").alias("h2")
    return lines.filter(n >= MIN_WORDS).select(h1, h2, F.struct("doc", "at").alias("place"), halves)


def with_shared_half(distinct: DataFrame) -> DataFrame:
    """(h1, h2, first) of the distinct lines that have a half in common with another, and which: head, tail."""
    each = distinct.select("h1", "h2", F.posexplode("halves").alias("i", "half"))
    common = each.groupBy("half").agg(F.count("*").alias("n")).filter("n > 1").select("half")
    sides = each.join(common, "half").groupBy("h1", "h2").agg(F.bool_or(F.col("i") < 2).alias("head"), F.bool_or(F.col("i") >= 2).alias("tail"))
    return distinct.select("h1", "h2", "first").join(sides, ["h1", "h2"])


def with_words(lines: DataFrame, packed: DataFrame, text: Column) -> DataFrame:
    """``lines`` with their text, from the documents of their first places."""
    of = F.collect_list(F.struct("h1", "h2", "first", "head", "tail"))
    wanted = lines.groupBy(F.col("first.doc").alias("doc")).agg(of.alias("of"))
    # a generated column is split once for each document, however many of its lines are taken
    docs = packed.select("doc", text.alias("text")).join(wanted, "doc").select("of", F.explode(F.array(F.split("text", "\n", -1))).alias("all"))
    taken = F.transform("of", lambda x: F.struct(x.alias("of"), F.get("all", x["first"]["at"]).alias("text")))
    found = docs.select(F.explode(taken).alias("e")).select("e.of.*", one_spaced(F.col("e.text")).alias("text"))
    return found.dropDuplicates(["h1", "h2"])  # a document may be there several times


def keys(lines: DataFrame) -> DataFrame:
    """(key, kind, first) from (text, first, head, tail): the variants of every line on the sides where a word may differ."""
    w = F.col("_p")
    padded = lines.select("first", "head", "tail", F.concat(F.array(F.lit("\n")), words_of(F.col("text")), F.array(F.lit("\n"))).alias("_p"))
    n = F.size(w) - 2

    def total(seed: int) -> Column:
        each = F.zip_with(F.slice(w, F.lit(1), n + 1), F.slice(w, F.lit(2), n + 1), lambda a, b: _pair(a, b, seed))
        return F.aggregate(each, F.lit(0).cast("long"), lambda t, x: t + x).alias(f"_s{seed}")

    rows = padded.select("first", "head", "tail", "_p", total(1), total(2))
    half = F.floor(n / 2).cast("int")
    places = F.filter(F.sequence(F.lit(1), n), lambda i: (F.col("head") & (i > half)) | (F.col("tail") & (i <= n - half)))
    gap = lambda i, s: (
        F.col(f"_s{s}") - _pair(F.get(w, i - 1), F.get(w, i), s) - _pair(F.get(w, i), F.get(w, i + 1), s) + _pair(F.get(w, i - 1), F.get(w, i + 1), s)
    )
    entry = lambda key, kind: F.struct(key.alias("key"), F.lit(kind).cast("tinyint").alias("kind"))
    without = F.transform(places, lambda i: F.struct(gap(i, 1).alias("a"), gap(i, 2).alias("b"), i.alias("i")))
    rows = rows.withColumn("_v", without)
    replaced = F.transform("_v", lambda v: entry(F.xxhash64(v["a"], v["b"], v["i"]), REPLACED))
    added = F.array_distinct(F.transform("_v", lambda v: entry(F.xxhash64(v["a"], v["b"]), LEFT_OUT)))
    itself = F.array(entry(F.xxhash64("_s1", "_s2"), WHOLE))
    return rows.select("first", F.explode(F.concat(replaced, added, itself)).alias("e")).select("first", "e.*")


def within_one(a: Column, b: Column) -> Column:
    """True where two arrays of words are at edit distance 0 or 1."""
    shorter = F.least(F.size(a), F.size(b))
    other = F.array_position(F.zip_with(F.slice(a, F.lit(1), shorter), F.slice(b, F.lit(1), shorter), lambda x, y: x == y), F.lit(False))
    head = F.when(other == 0, shorter).otherwise(other - 1).cast("int")
    cut = F.least(head + 1, F.size(a) + 1), F.least(head + 1, F.size(b) + 1)
    rest = lambda c, at: F.slice(c, at + 1, F.greatest(F.size(c) - at, F.lit(0)))
    return (
        (a == b)
        | ((F.size(a) == F.size(b)) & (rest(a, cut[0]) == rest(b, cut[1])))
        | ((F.size(a) == F.size(b) + 1) & (rest(a, cut[0]) == rest(b, head)))
        | ((F.size(b) == F.size(a) + 1) & (rest(a, head) == rest(b, cut[1])))
    )


def repeated(lines: DataFrame, folder: str) -> DataFrame:
    """(h1, h2) of the lines, given as (h1, h2, first, head, tail, text), that lie within one word of an earlier one."""
    made = keys(lines)
    shared = (
        made.groupBy("key")
        .agg(F.min(F.when(F.col("kind") == WHOLE, F.col("first"))).alias("of_whole"), F.min(F.when(F.col("kind") < WHOLE, F.col("first"))).alias("of_variant"),
             F.min("first").alias("lo"), F.max("first").alias("hi"), F.max("kind").alias("most"))
        # variants without a place say nothing of each other: such a key counts only with its whole line
        .filter(F.col("lo") < F.col("hi")).filter(F.col("most") != LEFT_OUT)
        .select("key", "of_whole", "of_variant")
    )
    shared = written(shared, f"{folder}/shared")
    met = made.join(shared, "key").select(
        "first", F.when(F.col("kind") == LEFT_OUT, F.col("of_whole")).otherwise(F.col("of_variant")).alias("earlier")
    )
    pairs = met.filter("earlier < first").select("first", "earlier").distinct()
    a = lines.select("h1", "h2", "first", words_of(F.col("text")).alias("_a"))
    b = lines.select(F.col("first").alias("earlier"), words_of(F.col("text")).alias("_b"))
    return pairs.join(a, "first").join(b, "earlier").filter(within_one(F.col("_a"), F.col("_b"))).select("h1", "h2").distinct()


def lines_to_drop(packed: DataFrame, text: Column, folder: str) -> DataFrame:
    """(doc, gone): the numbers of the lines that go, for each document that has some."""
    lines = written(numbered(packed, text), f"{folder}/lines")
    first = lines.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.first("halves").alias("halves"), F.count("*").alias("n"))
    distinct = written(first, f"{folder}/distinct")
    halved = written(with_shared_half(distinct), f"{folder}/halved")
    worded = written(with_words(halved, packed, text), f"{folder}/worded")
    near = written(repeated(worded, folder), f"{folder}/near")
    bad = distinct.drop("halves").join(near.withColumn("near", F.lit(True)), ["h1", "h2"], "left").filter("near or n > 1")
    bad = bad.select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near"))
    gone = lines.select("h1", "h2", "place").join(bad, ["h1", "h2"]).filter("near or place > first").select("place").distinct()
    return written(gone.groupBy("place.doc").agg(F.collect_set("place.at").alias("gone")), f"{folder}/gone")


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without repeated lines; same columns."""
    text = F.col(f"row.{text_column}")
    place = F.struct(F.col(f"row.{id_column}").isNull().alias("n"), F.col(f"row.{id_column}").alias("id"), F.xxhash64(text).alias("h"))
    packed = docs.select(whole_row(docs)).select("row", place.alias("doc"))
    spark = docs.sparkSession
    folder = f"{checkpoint_dir(spark)}/lines/{uuid.uuid4()}"
    gone = cut_lineage(lines_to_drop(packed, text, folder))
    spark.range(0).write.mode("overwrite").parquet(folder)  # the tables between the steps are done with
    # the join has dealt rows out by doc already, so folding equal documents costs no shuffle
    out = packed.join(gone, "doc", "left").dropDuplicates(["doc"]).select("row", "gone")
    kept = F.filter(F.split(text, "\n", -1), lambda _, i: ~F.array_contains("gone", i))
    out = out.select("row", F.when(F.col("gone").isNull(), text).otherwise(F.array_join(kept, "\n")).alias("left"), "gone")
    out = out.filter(F.col("gone").isNull() | F.col("left").rlike(WORD))
    columns = {c: v for c, v in zip(docs.columns, unpacked(out, docs.columns), strict=True)}
    columns[text_column] = F.col("left").alias(text_column)
    if "n_chars" in columns:
        same = F.col("gone").isNull()
        columns["n_chars"] = F.when(same, F.col("row.n_chars")).otherwise(F.length("left").cast(docs.schema["n_chars"].dataType)).alias("n_chars")
    return out.select(*columns.values())
