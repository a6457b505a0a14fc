"""URL filters, in DataFrame operations only: listed rules first, then a logistic regression.

A rule names a host, its subdomains with it, and a start of the path; the longest rule that fits decides. Other
URLs are judged by a logistic regression on hashed character n-grams of host and path, trained from a small
labelled table: a DataFrame, the path of a Parquet table, or a short list. Rules are a short list of the caller's.

Defined results: a null URL, and one without "://", has an empty host and path and fits no rule; the
regression judges it by the n-grams of empty strings; without labelled URLs of both classes the method allows
all, with a null score; repeated rows each give their own row.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed by the contract: verdict, host, start of the path.
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
#: A small labelled table for use without one's own: host, path, 1 for unwanted. Invented, from general words alone.
LABELLED = tuple(
    (host, path, label)
    for label, hosts in (
        (1, "cheap-meds.test m.spam-links.test www.ads-click.test blog.free-spins.test www.casino-bonus.test adult-cams.test best-casino-bets.test pills-online.test win-free-prizes.test xxx-adult.test track-ads.test discount-pills.test spam-offers.test lucky-bets.test"),
        (0, "news.test www.library.test blog.gardening.test m.history.test docs.test theatre.test weather.test www.museum.test cooking.test science.test travel-notes.test open-data.test town-hall.test blog.mathematics.test"),
    )
    for host in hosts.split()
    for path in ("", "/en/12", "/de/340.html", "/fr/7/", "/es/915")
)
SIZES = (3, 4, 5)
BUCKETS = 1 << 14
SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    whole = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(whole, SPLIT, 1), string.ascii_uppercase, string.ascii_lowercase), F.regexp_extract(whole, SPLIT, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule, as its index in `rules`, or null."""
    order = sorted(range(len(rules)), key=lambda k: -len(rules[k][1] + rules[k][2]))
    fits = [F.when(((host == rules[k][1]) | F.endswith(host, F.lit("." + rules[k][1]))) & F.startswith(path, F.lit(rules[k][2])), F.lit(k)) for k in order]
    return F.coalesce(*fits, F.lit(None).cast("int"))


def _grams(text: Column, mark: str) -> Column:
    marked = F.concat(F.lit("^"), text, F.lit("$"))
    # bound once as a variable, so the concatenation isn't repeated for each n-gram
    return F.flatten(F.transform(F.array(marked), lambda t: F.concat(*[F.when(F.length(t) >= n, F.transform(F.sequence(F.lit(1), F.length(t) - n + 1), lambda i: F.concat(F.lit(mark), F.substring(t, i, F.lit(n))))).otherwise(F.array().cast("array<string>")) for n in SIZES])))  # noqa: B023


def with_grams(urls: DataFrame, host: str = "host", path: str = "path") -> DataFrame:
    return HashingTF(inputCol="_grams", outputCol="_x", numFeatures=BUCKETS, binary=True).transform(urls.withColumn("_grams", F.concat(_grams(F.col(host), "h"), _grams(F.col(path), "p"))))


def labelled_table(spark: SparkSession, labelled=LABELLED) -> DataFrame:
    """The labelled URLs (host, path, label 0 or 1) of a table, of the Parquet table at a path, or of a short list of tuples.

    A null host or path is empty; rows with other labels don't count."""
    if isinstance(labelled, str):
        rows = spark.read.parquet(labelled)
    elif isinstance(labelled, DataFrame):
        rows = labelled
    else:
        rows = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(y).alias("label")) for h, p, y in labelled])))
    return rows.where("label in (0, 1)").select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("host", "path")], F.col("label").cast("double").alias("label"))


def fit(spark: SparkSession, labelled=LABELLED, strength: float = 0.01) -> LogisticRegressionModel | None:
    """The regression of the labelled URLs; none where they aren't of both classes."""
    table = labelled_table(spark, labelled)
    if table.select("label").distinct().count() < 2:
        return None
    return LogisticRegression(featuresCol="_x", regParam=strength, maxIter=50, probabilityCol="_p", predictionCol="_y", rawPredictionCol="_r").fit(with_grams(table))


def judged(pages: DataFrame, rules=RULES, labelled=LABELLED, block_from: float = 0.5, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict and block_score; one map over the pages, nothing is shuffled."""
    model = fit(pages.sparkSession, labelled)
    host, path = host_and_path(F.col(url))
    parts = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    found = model.transform(with_grams(parts)) if model else parts
    found = found.withColumn("_k", rule_of(F.col("host"), F.col("path"), rules))
    names = F.array(*[F.lit(h + p) for _, h, p in rules])
    verdicts = F.array(*[F.lit(v) for v, _, _ in rules])
    score = vector_to_array("_p")[1] if model else F.lit(None).cast("double")
    method = F.when(score >= block_from, "block").otherwise("allow")
    return found.select("page_id", "host", "path", F.get(names, F.col("_k")).alias("rule"), F.coalesce(F.get(verdicts, F.col("_k")), method).alias("verdict"), F.round(score, 6).alias("block_score"))
