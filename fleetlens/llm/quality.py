"""Quality rules: base heuristics and a hashed n-gram log-likelihood ratio.  DataFrame functions only.

*Base rules* are computed inside each row with array functions, so no word is
shuffled.  *The method*: words and word pairs are hashed into ``BUCKETS``
buckets; two multinomials over the buckets are counted, one over the trusted
documents (``quality`` = 1) and one over the raw corpus, all documents; a
document's score is the mean over its n-grams of
``log p_trusted(bucket) - log p_raw(bucket)``, and it passes at
``min_score`` or more.  The score depends on the document and the counts
alone, so the verdict is deterministic.

Counting is a map-side sum into ``BUCKETS`` keys.  The ratios are one row with
an array of ``BUCKETS`` doubles (512 KB), which is broadcast.  The trusted
documents are the ``trusted_rows`` labelled ones whose ids hash lowest: that
bounds their broadcast (8 bytes each); everything else covers all rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import keep, others, read

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
BUCKETS = 1 << 16
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Documents of the trusted model, at most (the bound of a broadcast of ids).
TRUSTED_ROWS = 20_000
#: Mean log ratio per n-gram that a document has to reach.
MIN_SCORE = -0.12
#: Added to every bucket count.
SMOOTHING = 1.0


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often lambdas inside ``body`` use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def without(text: Column, chars: str, instead: str = "") -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(instead))
    return text


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a non-null text, in order."""
    return F.transform(F.array_remove(F.split(without(text, SPACES[1:], " "), " ", -1), ""), lambda w: F.xxhash64(w))


def joined_runs(h: str, n: int) -> Column:
    """Hash of each run of ``2 n`` words from column ``h``, which has those of ``n`` (nulls hash like nothing at the end)."""
    return F.transform(F.col(h), lambda x, i: F.xxhash64(x, F.get(F.col(h), i + n)))


def covered_words(windows: Column) -> Column:
    """Words lying in windows that occur twice or more; ``windows`` has the hash of the window at each word."""
    indexed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = let(indexed, lambda s: F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                                            | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))))
    starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(starts, zero, lambda acc, p: F.struct(
        (p + WINDOW).alias("end"), (acc["n"] + WINDOW - F.greatest(F.lit(0), acc["end"] - p)).alias("n")))["n"]


def repeated_words() -> Column:
    """Words in 8-word windows found twice or more; column ``__h4`` has the hashes of four-word runs."""
    windows = F.slice(joined_runs("__h4", 4), 1, F.size("__h") - (WINDOW - 1))
    none = F.lit(0).cast("long")
    return F.when(F.size("__h") <= WINDOW, none).otherwise(
        let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), none).otherwise(covered_words(w))))


def grams(df: DataFrame) -> DataFrame:
    """``df`` (``__text``) with ``__h``, ``__h2`` and ``__grams``, the hashes of its words and adjacent pairs."""
    df = df.withColumn("__h", word_hashes(F.col("__text"))).withColumn("__h2", joined_runs("__h", 1))
    pairs = F.when(F.size("__h") < 2, F.array().cast("array<bigint>")).otherwise(
        F.slice("__h2", 1, F.greatest(F.size("__h") - 1, F.lit(1))))
    return df.withColumn("__grams", F.concat("__h", pairs))


def log_ratios(docs: DataFrame, labels: DataFrame, n_buckets: int = BUCKETS, trusted_rows: int = TRUSTED_ROWS,
               smoothing: float = SMOOTHING) -> DataFrame:
    """One row with ``ratios``: the bucket log ratios in bucket order (all 0 without trusted documents)."""
    trusted = labels.where(F.col("quality") == 1).select(F.col("doc_id").alias("__id")).dropna().distinct() \
        .orderBy(F.xxhash64("__id"), "__id").limit(trusted_rows).withColumn("__trusted", F.lit(1))
    flagged = docs.join(F.broadcast(trusted), docs["doc_id"] == trusted["__id"], "left") \
        .select(F.coalesce("text", F.lit("")).alias("__text"), F.coalesce("__trusted", F.lit(0)).alias("t"))
    # The outer form: a plain explode would evaluate its array a second time, in a filter.
    found = grams(flagged).select("t", F.explode_outer("__grams").alias("g")) \
        .select("t", F.pmod("g", F.lit(n_buckets)).cast("int").alias("bucket"))
    counts = found.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("t").alias("t")).where(F.col("bucket").isNotNull())
    # Every bucket, also those without n-grams, in one row of a bounded size.
    counted = counts.groupBy().agg(F.map_from_entries(F.collect_list(F.struct("bucket", F.struct("n", "t")))).alias("m"),
                                   F.sum("n").alias("raw"), F.sum("t").alias("target"),
                                   F.coalesce(F.min(F.pmod("bucket", F.lit(1))), F.lit(0)).alias("model"))
    total = smoothing * n_buckets
    ratio = lambda e: (F.log((e["value"]["t"] + smoothing) / (F.col("target") + total))
                       - F.log((e["value"]["n"] + smoothing) / (F.col("raw") + total)))
    known = F.transform(F.map_entries("m"), lambda e: F.struct(e["key"].alias("b"), ratio(e).alias("r")))
    missing = F.transform(F.array_except(F.sequence(F.lit(0), F.lit(n_buckets - 1)), F.map_keys("m")),
                          lambda b: F.struct(b.alias("b"), F.lit(0.0).alias("r")))
    filled = F.transform(F.array_sort(F.concat(known, missing)), lambda x: x["r"])
    nothing = F.transform(filled, lambda r: r * 0)
    return counted.select("model", F.when(F.coalesce("target", F.lit(0)) == 0, nothing).otherwise(filled).alias("ratios"))


def quality_rules(docs: DataFrame, labels: DataFrame, min_score: float = MIN_SCORE, n_buckets: int = BUCKETS,
                  trusted_rows: int = TRUSTED_ROWS) -> DataFrame:
    """``docs`` (doc_id, text) with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``score`` and ``kept``.

    Null and empty texts have no words: every measure and the score are 0 and
    they fail the base rules.  Repeated rows are judged alike (and each counts
    in the raw corpus); an id labelled more than once is trusted once.
    Without trusted documents every score is 0.  Empty table: empty result.
    Columns called like an output are replaced.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")
    model = log_ratios(docs.select("doc_id", "text"), labels, n_buckets, trusted_rows)
    kept = [f"`{c}`" for c in others(docs, names)]
    base = grams(docs.select(*kept, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))) \
        .withColumn("__h4", joined_runs("__h2", 2))
    # Every row meets the one row of the model: a broadcast equi-join that makes one row of each row.
    joined = base.join(F.broadcast(model), F.pmod(F.length("__text"), F.lit(1)) == model["model"], "left")
    ratios, text = model["ratios"], F.col("__text")
    total = F.aggregate("__grams", F.lit(0.0), lambda acc, g: acc + F.get(ratios, F.pmod(g, F.lit(n_buckets)).cast("int")))
    with_word = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    measured = joined.select(
        *kept, F.size("__h").cast("long").alias("n_words"), F.length(without(text, SPACES)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words().alias("n_repeat_words"),
        F.when(F.size("__grams") == 0, 0.0).otherwise(total / F.size("__grams")).alias("score"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= min_score))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return keep(quality_rules(docs, read(spark, sf_dir, "labels")), ["text"])
