"""Find secrets, and link the parts of credentials that are too weak to report alone.

Base kinds (assign, access, hex) are reported wherever they match. Weak kinds are a login, a long key-like run and
an endpoint. A weak one is reported only if a complementary part starts within ``SCOPE`` characters in the same
text: a login needs a secret (assign, key or hex), a key needs an identifier or endpoint (access, login, endpoint),
an endpoint needs a secret or an access id.

The interval join works on bins of ``SCOPE`` characters: each (text, bin, kind) keeps its first and last start, and a
candidate looks at its own bin and the two beside it, so that parts in one scope never make pairs.
Positions come from the lengths of what lies between matches. Built-in functions only.

A null text is empty. Equal rows get equal results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketline.llm.tables import text_of
from basketline.session import cut_lineage

SCOPE = 400
QUOTE = "[\"']?"
VALUE = r"[A-Za-z0-9+/_.=-]+"
#: kind and pattern. The first three are the base; a value of assign must have 8 characters besides. Runs of hex
#: and access characters are matched whole, so asking for their least length in the pattern changes nothing.
KINDS: list[tuple[str, str]] = [
    ("assign", rf"((?i:password|passwd|secret|token|api_?key)){QUOTE}\x20*[:=]\x20*{QUOTE}({VALUE})"),
    ("access", r"AKIA[A-Z0-9]{12,}"),
    ("hex", r"[0-9a-f]{32,}"),
    ("login", rf"\b(?i:user(?:name)?|login|client_id|account_id){QUOTE}\x20*[:=]\x20*{QUOTE}[A-Za-z0-9_.@-]{{3,}}"),
    ("key", r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}(?![A-Za-z0-9+/])"),
    ("endpoint", r"\b[a-z][a-z0-9+]{1,15}://[^\x20\x09-\x0D\"'<>]+"),
]
BASE = ("assign", "access", "hex")
NEEDS = {
    "login": ("assign", "key", "hex"),
    "key": ("access", "login", "endpoint"),
    "endpoint": ("assign", "access", "key", "hex"),
}
SPAN = "array<struct<start:bigint,ord:int,end:bigint>>"


def _matches(kind: str, text: Column, pattern: str) -> Column:
    """Spans (start, ord, end) of the good matches; the rare kinds skip texts without their mark."""
    order = [k for k, _ in KINDS].index(kind)
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    good = {
        "assign": lambda m: F.length(F.regexp_extract(m, f"^(?:{pattern})$", 2)) >= 8,
    }.get(kind, lambda m: F.lit(True))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(s, x):
        begin = s["at"] + F.length(x["gap"])
        end = begin + F.length(x["m"])
        span = F.array(F.struct(begin.cast("long").alias("start"), F.lit(order).alias("ord"), end.cast("long").alias("end")))
        spans = F.when(good(x["m"]), F.concat(s["spans"], span)).otherwise(s["spans"])
        return F.struct(end.cast("long").alias("at"), spans.alias("spans"))

    zipped = F.zip_with(found, F.slice(between, 1, F.size(found)), lambda m, gap: F.struct(m.alias("m"), gap.alias("gap")))
    some = {"hex": text.rlike("[0-9a-f]{32}"), "access": text.contains("AKIA")}.get(kind, text.rlike(pattern))
    return F.when(some, F.aggregate(zipped, start, step, lambda s: s["spans"])).otherwise(F.array().cast(SPAN))


def _listed(spans: Column) -> Column:
    name = lambda o: F.element_at(F.array(*[F.lit(k) for k, _ in KINDS]), o + 1)
    return F.array_join(
        F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", name(s["ord"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def linked(found: DataFrame) -> DataFrame:
    """(row1, row2, added): the weak spans of each text that have a complementary part in scope."""
    names = [k for k, _ in KINDS]
    weak = found.filter(F.size("login") + F.size("key") + F.size("endpoint") > 0)
    parts = weak.select("row1", "row2", F.explode(F.concat(*names)).alias("s")).select("row1", "row2", "s.*").distinct()
    parts = parts.withColumn("bin", F.expr(f"start div {SCOPE}"))
    ends = parts.groupBy("row1", "row2", "bin", "ord").agg(F.min("start").alias("first"), F.max("start").alias("last"))
    beside = ends.select(
        "row1", "row2", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)).alias("bin"), "ord", "first", "last"
    )
    around = beside.groupBy("row1", "row2", "bin").agg(F.collect_list(F.struct("ord", "first", "last")).alias("near"))
    # the own bin is in reach as a whole; of the bin before the last start counts, of the one after the first
    reach = lambda e: F.least(F.abs(e["first"] - F.col("start")), F.abs(e["last"] - F.col("start"))) <= SCOPE
    good = F.lit(False)

    def complemented(others: tuple[str, ...]) -> Column:
        wanted = [names.index(o) for o in others]
        return F.exists("near", lambda e: e["ord"].isin(wanted) & reach(e))

    for kind, others in NEEDS.items():
        good = good | ((F.col("ord") == names.index(kind)) & complemented(others))
    kept = parts.filter(F.col("ord") >= len(BASE)).join(around, ["row1", "row2", "bin"]).filter(good)
    return kept.groupBy("row1", "row2").agg(F.collect_list(F.struct("start", "ord", "end")).alias("added"))


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) of every row."""
    rows = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    text = F.col("text")
    found = cut_lineage(
        rows.select(
            "id", F.xxhash64("id", "text").alias("row1"), F.xxhash64("text", "id").alias("row2"),
            *[_matches(k, text, p).alias(k) for k, p in KINDS],
        )
    )
    base = F.concat(*BASE)
    out = found.join(linked(found), ["row1", "row2"], "left")
    added = F.coalesce("added", F.array().cast(SPAN))
    return out.select(
        F.col("id").alias(id_column),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.concat(base, added)).alias("spans"),
    )
