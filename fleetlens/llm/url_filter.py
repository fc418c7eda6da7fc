"""URL filters by association rules.

A URL is a set of tokens: the labels of its host, the words of its path and its
query's pairs.  Labelled URLs are transactions.  Spark's FP-growth mines the
combinations that ``MIN_COUNT`` unwanted ones share, a number that does not grow
with the input; each is then counted over all transactions, and the rules
``tokens -> unwanted`` that reach the confidence stay.
Rules are matched by an inverted index: each rule stands under its rarest
token, a URL's tokens look their rules up, and a rule fires when the URL has
all its tokens.  Listed rules (host and path) go before mined ones; the
longest that fits wins.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import bounded, others, read, written
from fleetlens.llm.urls import host_of, path_of

#: (verdict, host, path) in force for the host and all its subdomains.
LISTED = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: A combination counts as frequent in so many unwanted transactions (and in a share of all transactions, if one is asked for).
MIN_COUNT = 20
MIN_SUPPORT = 0.0
MIN_CONFIDENCE = 0.6


def url_tokens(url: Column) -> Column:
    """Distinct tokens: ``h:`` host labels, ``p:`` path words that are not numbers, ``q:`` query pairs."""
    def marked(parts: Column, mark: str) -> Column:
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(mark), x))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    path = F.filter(F.split(F.lower(path_of(url)), r"[/.]+"), lambda x: ~x.rlike(r"^[0-9]+$"))
    return F.array_distinct(F.concat(marked(F.split(host_of(url), r"\."), "h:"), marked(path, "p:"), marked(F.split(F.lower(query), "&"), "q:")))


def document_of(url: Column) -> Column:
    """The document a URL names: the number in its path."""
    return F.regexp_extract(path_of(url), r"/([0-9]{1,18})(?:[/.]|$)", 1)


def mine(pages: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (rule, tokens, key, confidence, support) that mark a URL as unwanted.

    ``labels``: doc_id, quality, toxic; a document is unwanted if its quality
    is 0 or it is toxic.  Every labelled page is a transaction.  Without
    labelled pages there are no rules.
    """
    wanted = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__id")) \
        .agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("__bad"))
    url = F.col("url").cast("string")
    named = pages.where(F.col("url").isNotNull()).select(url_tokens(url).alias("tokens"), document_of(url).alias("number")) \
        .where("number <> ''").withColumn("__id", F.col("number").cast("bigint")).drop("number")
    joined = named.join(wanted, "__id")
    items = written(joined.select("tokens", "__bad").where("size(tokens) > 0"), "url-transactions")
    spark = pages.sparkSession
    n, bad = items.agg(F.count("*"), F.coalesce(F.sum("__bad"), F.lit(0))).first()
    need = max(MIN_COUNT, math.ceil(min_support * n))
    if bad < need:
        return spark.createDataFrame([], "rule long, tokens array<string>, key string, confidence double, support double")
    # Half a page less: FP-growth rounds the share times the rows up, which must give ``need``.
    model = FPGrowth(itemsCol="tokens", minSupport=(need - 0.5) / bad,
                     numPartitions=int(spark.conf.get("spark.sql.shuffle.partitions"))).fit(items.where("__bad = 1").select("tokens"))
    sets = written(model.freqItemsets.select(F.array_sort("items").alias("tokens"), F.col("freq").alias("hits")), "url-itemsets")
    # Equal token sets together; each frequent set stands under its token that is rarest among all transactions.
    have = written(items.groupBy(F.array_sort("tokens").alias("have")).agg(F.count("*").alias("times")), "url-token-sets")
    spread = have.select("have", "times", F.explode("have").alias("token"))
    frequent = sets.where("size(tokens) = 1").select(F.element_at("tokens", 1).alias("token"))
    single = spread.join(bounded(frequent), "token", "left_semi").groupBy("token").agg(F.sum("times").alias("freq"))
    keyed = written(sets.select("*", F.explode("tokens").alias("token")).join(single, "token").groupBy("tokens", "hits")
                    .agg(F.min(F.struct("freq", "token"))["token"].alias("key")), "url-keyed-itemsets")
    met = spread.join(bounded(keyed), F.col("token") == F.col("key")).where(F.size(F.array_except("tokens", "have")) == 0)
    counted = met.groupBy("tokens", "hits", "key").agg((F.col("hits") / F.sum("times")).alias("confidence"))
    return counted.where(F.col("confidence") >= min_confidence) \
        .select(F.xxhash64("tokens").alias("rule"), "tokens", "key", "confidence", (F.col("hits") / n).alias("support"))


def fired(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, mined_rule, confidence): the strongest mined rule of each distinct url that has one."""
    index = written(rules, "url-rules")
    looked = urls.where(F.col("url").isNotNull()).select(F.col("url").cast("string").alias("url")).distinct() \
        .withColumn("have", url_tokens(F.col("url"))).select("url", "have", F.explode("have").alias("key"))
    met = looked.join(bounded(index), "key").where(F.size(F.array_except("tokens", "have")) == 0)
    best = F.max(F.struct("confidence", F.array_join("tokens", " ").alias("mined_rule")))
    return met.groupBy("url").agg(best.alias("best")).select("url", "best.mined_rule", "best.confidence")


def judge(pages: DataFrame, labels: DataFrame, listed=LISTED, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (the listed one, or null), ``mined_rule`` (or null) and ``verdict``.

    A URL that is null or has no ``://`` has an empty host and path; no listed
    rule fits it and, without tokens, no mined one.  ``listed`` is a short
    tuple: it becomes one expression.  Repeated rows are judged alike; an
    empty table gives an empty one.  Columns called like an output are replaced.
    """
    names = ("host", "path", "rule", "mined_rule", "verdict")
    url = F.col("url").cast("string")
    cols = others(pages, names)
    hits = bounded(written(fired(pages, mine(pages, labels, min_support, min_confidence)), "url-hits").select(F.col("url").alias("__url"), "mined_rule"))
    out = pages.select(*[F.col(f"`{c}`") for c in cols], host_of(url).alias("host"), path_of(url).alias("path"), url.alias("__own")) \
        .join(hits, F.col("__own") == F.col("__url"), "left")
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")
    for what, host, path in sorted(listed, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return out.select(*[F.col(f"`{c}`") for c in cols], "host", "path", rule.alias("rule"), "mined_rule", verdict.alias("verdict"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(read(spark, sf_dir, "pages").select("page_id", "url"), read(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "mined_rule")
