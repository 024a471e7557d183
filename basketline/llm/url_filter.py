"""Judge urls by host and path rules, and the rest by a logistic regression on hashed character n-grams.

A rule (host, path, verdict) fits its host and all subdomains where the url's path starts with the rule's path;
the longest rule wins. Other urls are scored: the mean weight of the hashed n-grams of host and of path, plus
the intercept, is the log odds of a block. Weights come from a small labelled table of urls. Everything is
built-in functions; weights are one constant array of ``BUCKETS`` numbers, so scoring needs no join.

A null url or one without ``://`` has empty host and path, fits no rule and gets the intercept's verdict.
Repeated rows are judged alike, an empty table gives an empty result, other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketline.session import cut_lineage

BUCKETS, SHORTEST, LONGEST = 1024, 3, 5
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: The labelled table: 1 is a url to block.
BAD_HOSTS = ["spam-farm.example.org", "www.cheap-pills.example.com", "casino-bonus.example.net", "free-pills.example.org",
             "win-casino.example.org", "adult-cams.example.net", "link-farm.example.org", "cheap-loans.example.net"]
GOOD_HOSTS = ["news.example.org", "blog.writing.example.net", "www.library.example.org", "m.weather.example.net",
              "science.example.org", "docs.garden.example.com", "blog.history.example.org", "www.museum.example.net"]
PATHS = ["/en/12", "/de/345.html", "/fr/67/", "/es/890"]
LABELLED = [(f"https://{h}{p}", bad) for hosts, bad in ((BAD_HOSTS, 1), (GOOD_HOSTS, 0)) for h in hosts for p in PATHS]

PARTS = r"^(?s)(.*?)://([^/?#]*)([^?#]*)"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit("")), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 3), F.lit(""))


def _grams(text: Column, seed: int) -> list[Column]:
    """Hash buckets of the n-grams of ``text``, one array for each n; texts shorter than n give none."""
    size = F.length(text)

    def of_length(n: int) -> Column:
        starts = F.when(size >= n, F.sequence(F.lit(1), size - n + 1)).otherwise(F.array().cast("array<int>"))
        gram = lambda at: F.xxhash64(F.lit(seed), F.substring(text, at, F.lit(n)))
        return F.transform(starts, lambda at: F.pmod(gram(at), F.lit(BUCKETS)).cast("int"))

    return [of_length(n) for n in range(SHORTEST, LONGEST + 1)]


def buckets(host: Column, path: Column) -> Column:
    around = lambda c: F.concat(F.lit("^"), c, F.lit("$"))
    return F.concat(*_grams(around(host), 1), *_grams(around(path), 2))


def train(labelled: DataFrame) -> tuple[list[float], float]:
    """Weights by bucket and the intercept from a small table (url, label)."""
    hit = labelled.select(buckets(host_of(F.col("url")), path_of(F.col("url"))).alias("b"), F.col("label").cast("double").alias("label"))
    hit = cut_lineage(hit.coalesce(1))  # small by contract; each of the training steps would hash it again
    share = F.transform(
        F.sequence(F.lit(0), F.lit(BUCKETS - 1)),
        lambda i: F.size(F.filter("b", lambda x: x == i)) / F.greatest(F.size("b"), F.lit(1)),
    )
    model = LogisticRegression(featuresCol="x", labelCol="label", regParam=1e-4, standardization=False, maxIter=200).fit(
        hit.select(array_to_vector(share).alias("x"), "label")
    )
    return [round(float(w), 6) for w in model.coefficients.toArray()], round(float(model.intercept), 6)


def judge(pages: DataFrame, labelled: DataFrame, rules=RULES, url: str = "url", keep: tuple = ("page_id",)) -> DataFrame:
    """The ``keep`` columns with host, path, rule, verdict and score of every url."""
    weights, intercept = train(labelled)
    parts = pages.select(*[F.col(c) for c in keep], host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    host, path = F.col("host"), F.col("path")
    rule = verdict = F.lit(None).cast("string")
    for its_host, its_path, its_verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == its_host) | host.endswith("." + its_host)) & path.startswith(its_path)
        rule = F.when(fits, its_host + its_path).otherwise(rule)
        verdict = F.when(fits, its_verdict).otherwise(verdict)
    table = F.array(*map(F.lit, weights))
    scored = parts.withColumns({"rule": rule, "ruled": verdict, "grams": buckets(host, path)})
    total = F.aggregate("grams", F.lit(0.0), lambda s, b: s + F.get(table, b))
    odds = total / F.greatest(F.size("grams"), F.lit(1)) + intercept
    return scored.select(
        *keep, "host", "path", "rule",
        F.coalesce("ruled", F.when(odds > 0, "block").otherwise("allow")).alias("verdict"),
        (1 / (1 + F.exp(-odds))).alias("score"),
    )
