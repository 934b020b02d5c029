"""URL verdicts: rules first, then boosted trees on what a URL looks like.

A rule names a host and the beginning of a path; it fits the host and its subdomains, and the
longest that fits decides. All other URLs are judged by gradient-boosted trees on lexical
numbers: lengths, depth, digits, entropy, parameters, and how often the URLs of the same suffix
were bad among the labelled ones. The trees learn from labelled URLs, a bounded sample of them.

Labels are a frame (url, bad). Where none is at hand, ``seed_labels`` marks hosts by a
list of words that is a parameter; the trees never see words, only the numbers, so they reach hosts
that the list does not name.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no rule and is
judged by its numbers like any other. Without labels of both kinds everything is allowed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.frames import bounded_sample
from tallyfold.session import materialize

#: Verdict, host and beginning of the path of each rule.
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
#: Words of hosts whose URLs count as bad where no labels are given.
SEED_WORDS = ("pills", "casino", "bets", "spam", "adult", "ads")
NUMBERS = (
    "url_length", "host_length", "path_length", "depth", "labels", "longest_label", "digit_ratio",
    "host_digits", "hyphens", "host_entropy", "path_entropy", "parameters", "fragment", "escapes", "suffix_rate",
)
#: Labelled URLs of each kind that a fit takes at most.
SAMPLE = 8000
#: Weight, in URLs, of the overall share of bad ones in a suffix's share.
PRIOR = 20
TREES, DEPTH = 20, 3
BAD_FROM = 0.5


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _entropy(text: Column) -> Column:
    """Bits for each character."""
    letters = F.split(text, "")
    total = F.length(text)

    def part(done: Column, letter: Column) -> Column:
        share = F.size(F.filter(letters, lambda x: x == letter)) / total
        return done - share * F.log2(share)

    return F.when(total > 0, F.aggregate(F.array_distinct(letters), F.lit(0.0), part)).otherwise(F.lit(0.0))


def parsed(urls: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path: after the first ``://``, and from there up to ``?``, ``#`` or the end."""
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise(F.lit(""))
    return urls.withColumn("_rest", F.coalesce(rest, F.lit(""))).withColumns({
        "host": _lower(F.regexp_extract("_rest", r"^[^/?#]*", 0)),
        "path": F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1),
    }).drop("_rest")


def fitting_rule(rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits host and path; null if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Built from the inside, so the longest is asked first.
    for kind, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        fits &= F.col("path").startswith(path)
        text = F.when(fits, F.lit(host + path)).otherwise(text)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def measured(urls: DataFrame, url: str = "url") -> DataFrame:
    """Adds host, path, suffix and all numbers but ``suffix_rate``."""
    whole = F.coalesce(F.col(url), F.lit(""))
    host, path = F.col("host"), F.col("path")
    labels = F.split(host, r"\.")
    query = F.regexp_extract(whole, r"\?([^#]*)", 1)
    digits = F.length(F.regexp_replace(whole, "[^0-9]", ""))
    return parsed(urls, url).withColumns({
        "suffix": F.array_join(F.slice(F.concat(F.array(F.lit(""), F.lit("")), labels), -2, 2), "."),
        "url_length": F.length(whole), "host_length": F.length(host), "path_length": F.length(path),
        "depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")),
        "labels": F.size(labels), "longest_label": F.array_max(F.transform(labels, lambda x: F.length(x))),
        "digit_ratio": digits / F.greatest(F.length(whole), F.lit(1)),
        "host_digits": F.length(F.regexp_replace(host, "[^0-9]", "")),
        "hyphens": F.length(F.regexp_replace(host, "[^-]", "")),
        "host_entropy": _entropy(host), "path_entropy": _entropy(path),
        "parameters": F.when(query == "", F.lit(0)).otherwise(F.size(F.split(query, "&"))),
        "fragment": F.contains(whole, F.lit("#")).cast("int"),
        "escapes": F.length(F.regexp_replace(whole, "[^%]", "")),
    })


def seed_labels(urls: DataFrame, words=SEED_WORDS, url: str = "url") -> DataFrame:
    """url, bad: whether a label of the host, cut at hyphens, is one of ``words``."""
    parts = F.split(F.col("host"), r"[.\-]")
    return parsed(urls.filter(F.col(url).isNotNull()).select(F.col(url).alias("url"))).select(
        "url", F.arrays_overlap(parts, F.array(*map(F.lit, words))).cast("int").alias("bad"))


@dataclass(frozen=True)
class Model:
    """Trees and the shares of bad URLs by suffix; None for trees if there was one kind of label only."""

    trees: GBTClassificationModel | None
    rates: dict[str, float]
    rate: float


def train(labels: DataFrame) -> Model:
    """Learns from labelled URLs: of each kind up to ``SAMPLE`` distinct ones, by hash of the URL."""
    one_each = materialize(
        labels.filter("bad is not null").groupBy("url").agg(F.max("bad").alias("bad")), "labels")
    shares = one_each.agg(F.count("*").alias("n"), F.sum("bad").alias("bad")).first()
    if not shares["n"] or shares["bad"] in (0, shares["n"]):
        return Model(None, {}, 0.0)
    drawn = bounded_sample(one_each.filter("bad = 1"), SAMPLE, "url").union(
        bounded_sample(one_each.filter("bad = 0"), SAMPLE, "url")).coalesce(1)
    drawn = materialize(measured(drawn), "sample")
    rows = drawn.groupBy("suffix").agg(F.count("*").alias("n"), F.sum("bad").alias("bad")).collect()
    total, bad = sum(r["n"] for r in rows), sum(r["bad"] for r in rows)
    rates = {r["suffix"]: (r["bad"] + PRIOR * bad / total) / (r["n"] + PRIOR) for r in rows}
    weighed = _vectors(drawn, rates, bad / total).withColumn(
        "weight", F.when(F.col("bad") == 1, total / (2 * bad)).otherwise(total / (2 * (total - bad))))
    trees = GBTClassifier(
        featuresCol="numbers", labelCol="bad", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3,
        seed=17)
    return Model(trees.fit(weighed), rates, bad / total)


def _vectors(rows: DataFrame, rates: dict[str, float], rate: float) -> DataFrame:
    """Adds the vector of numbers. There are at most as many rates as rows in the sample."""
    known = rows.sparkSession.createDataFrame(list(rates.items()) or [("", rate)], "suffix string, suffix_rate double")
    joined = rows.join(F.broadcast(known), "suffix", "left").fillna({"suffix_rate": rate})
    return VectorAssembler(inputCols=list(NUMBERS), outputCol="numbers").transform(joined)


def judged(urls: DataFrame, model: Model, rules=RULES, url: str = "url") -> DataFrame:
    """Adds host, path, rule (null if none fits), bad (probability) and verdict."""
    text, verdict = fitting_rule(rules)
    keep = [*urls.columns, "host", "path"]
    rows = measured(urls, url)
    if model.trees is None:
        rows = rows.select(*keep).withColumn("bad", F.lit(0.0))
    else:
        scored = model.trees.transform(_vectors(rows, model.rates, model.rate))
        rows = scored.select(*keep, vector_to_array("probability")[1].alias("bad"))
    own = F.when(F.col("bad") >= BAD_FROM, F.lit("block")).otherwise(F.lit("allow"))
    return rows.withColumns({"rule": text, "verdict": F.coalesce(verdict, own)})
