"""Benchmark decontamination by spaced seeds.  DataFrame functions only.

Texts become lower-case runs of letters and digits.  A seed is the hash of the
tokens at the 1s of a fixed mask; the 0s are ignored, so a substituted token
there does not matter.  Every position of every benchmark item and every
document has a seed for each of ``MASKS``.  An item too short for any mask has
one seed over all its tokens, and documents have one for every run of such a
length, so a short item is found where it stands word for word.  Items in which one other
token takes the score below the threshold have seeds over their first and their last half as well,
one of which a single substitution leaves whole.  The seeds of the documents meet
those of the benchmark in an equi-join.  Around each hit, document and item
are laid over each other along the hit's diagonal, equal tokens count 1,
others ``-MISMATCH``, and the best stretch must reach ``min_score`` (or the
item's own length, if that is less), or all tokens but one must agree.

Documents are only scanned: their seeds are exploded into a hash join with the
benchmark's seeds (broadcast while there are at most ``common.BROADCAST_ROWS``
of them, else shuffled).  A hit is three numbers; hits are summed per diagonal
on the map side, and only documents with a hit are read again to lay items
over them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import bounded, bounded_lists, others, read, written

#: Masks of three token pairs, as offsets of the pairs: 11011011, 1101100011, 1100011011.
MASKS = ((0, 3, 6), (0, 3, 8), (0, 5, 8))
#: Tokens of the narrowest mask; shorter items are compared whole.
NARROWEST = min(map(max, MASKS)) + 2
MISMATCH = 3
MIN_SCORE = 10


def mask_text(offsets: tuple[int, ...]) -> str:
    return "".join("1" if any(i - o in (0, 1) for o in offsets) else "0" for i in range(max(offsets) + 2))


def tokens(text: Column) -> Column:
    """Hashes of the tokens of a non-null text."""
    return F.transform(F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), ""), lambda w: F.xxhash64(w))


def tolerant(n: Column, min_score: int) -> Column:
    """Whether items of ``n`` tokens need the seeds of their halves to be found with one token substituted."""
    return n.between(NARROWEST, min_score + MISMATCH)


def seeds(df: DataFrame, lengths: Sequence[int] = (), item_score: int | None = None) -> DataFrame:
    """``df`` with ``__h`` (token hashes), and ``__mask``, ``__pos``, ``__seed`` for every position and mask (null without any).

    Every run of ``lengths`` tokens has a seed as well; with ``item_score`` only one that is a whole short item
    or one half of an item that is ``tolerant``.
    """
    df = df.withColumn("__h", tokens(F.coalesce(F.col("__text"), F.lit("")))) \
        .withColumn("__pairs", F.transform("__h", lambda x, i: F.xxhash64(x, F.get(F.col("__h"), i + 1))))

    def of_mask(k: int) -> Column:
        a, b, c = MASKS[k]
        every = F.transform("__pairs", lambda x, i: F.xxhash64(
            x, F.get(F.col("__pairs"), i + b), F.get(F.col("__pairs"), i + c), F.lit(k)))
        return F.slice(every, 1, F.greatest(F.size("__h") - (c + 1), F.lit(0)))

    def of_run(n: int) -> Column:
        every = F.transform("__h", lambda x, i: F.xxhash64(x, *[F.get(F.col("__h"), i + j) for j in range(1, n)], F.lit(-n)))
        every, size = F.slice(every, 1, F.greatest(F.size("__h") - (n - 1), F.lit(0))), F.size("__h")
        if item_score is None:
            return every
        half = tolerant(size, item_score) & (F.floor(size / 2) == n)
        return F.transform(every, lambda x, i: F.when(((size == n) & (size < NARROWEST)) | (half & ((i == 0) | (i == size - n))), x))

    # One array per mask, so the index within an array is the position.
    df = df.select(*df.columns, F.array(*[of_mask(k) for k in range(len(MASKS))], *[of_run(n) for n in lengths]).alias("__masks"))
    df = df.select(*[c for c in df.columns if c not in ("__masks", "__pairs", "__text")], F.posexplode_outer("__masks").alias("__mask", "__of"))
    return df.select(*[c for c in df.columns if c != "__of"], F.posexplode_outer("__of").alias("__pos", "__seed"))


def best_stretch(left: Column, right: Column) -> Column:
    """Largest sum of +1 for equal and -MISMATCH for other elements over any stretch of two arrays laid side by side."""
    gain = F.zip_with(left, right, lambda x, y: F.when(x.eqNullSafe(y), 1).otherwise(-MISMATCH))
    zero = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"))
    return F.aggregate(gain, zero, lambda acc, g: F.struct(
        F.greatest(acc["run"] + g, F.lit(0)).alias("run"),
        F.greatest(acc["best"], acc["run"] + g).alias("best")))["best"]


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, min_score: int = MIN_SCORE, text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, item_id, score, n_hits) for every document and benchmark item that overlap.

    ``text_key`` (hash of the text) tells rows with one doc_id apart; ids may
    be null.  ``n_hits`` is the number of mask hits
    on one diagonal, the largest (1 where only halves hit, and for an item shorter than ``NARROWEST``
    tokens, which must stand there whole; one substituted token is tolerated in
    all longer ones).  Items with a null id match like others.  Texts are compared whole, however long.  Null and empty texts have no seeds
    and match nothing.  Repeated documents or
    items each match; an empty table on either side gives an empty result.
    """
    items = benchmark.select(F.col("item_id").alias("__item"), F.col("text").cast("string").alias("__text"))
    size = F.size(tokens(F.coalesce("__text", F.lit(""))))
    run = F.when(F.col("n").between(1, NARROWEST - 1), F.col("n")).when(tolerant(F.col("n"), min_score), F.floor(F.col("n") / 2).cast("int"))
    # At most NARROWEST + (min_score + MISMATCH) / 2 different numbers.
    lengths = sorted(r[0] for r in items.select(size.alias("n")).select(run.alias("n")).where("n is not null").distinct().collect())
    known = written(seeds(items, lengths, item_score=min_score).select(F.col("__item"), F.size("__h").alias("__n"), F.col("__pos").alias("__at"),
                                        (F.col("__mask") >= len(MASKS)).alias("__run"), F.col("__seed").alias("__key")).where(F.col("__key").isNotNull()).distinct(), "benchmark-seeds")
    text = F.col(f"`{text_col}`").cast("string")
    wanted = docs.select(F.col("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("__text"))
    met = seeds(wanted, lengths).select("doc_id", "text_key", "__pos", "__seed").join(bounded(known), F.col("__seed") == F.col("__key"))
    # Diagonals with a hit, gathered per document (few: a document's length bounds them).
    # A short item is there or not: its first place is enough.
    shift, short = F.col("__pos") - F.col("__at"), F.col("__n") < NARROWEST
    laid = met.groupBy("doc_id", "text_key", "__item", "__n", F.when(~short, shift).alias("__diagonal")) \
        .agg(F.min(shift).alias("__shift"), F.count(F.when(~F.col("__run"), 1)).alias("__hits")) \
        .withColumn("__hits", F.greatest("__hits", F.lit(1).cast("bigint")))
    per_doc = laid.groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__tk")) \
        .agg(F.collect_list(F.struct("__item", "__n", "__shift", "__hits")).alias("__laid"))
    per_doc = written(per_doc, "benchmark-diagonals")
    full = wanted.join(bounded_lists(per_doc, "__laid"), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__tk")))
    facing = F.transform("__laid", lambda c: F.struct(
        c["__item"].alias("item_id"), c["__shift"].alias("shift"), c["__hits"].alias("hits"),
        F.slice(F.col("__h"), F.greatest(c["__shift"], F.lit(0)) + 1, c["__n"]).alias("tokens")))
    pieces = full.withColumn("__h", tokens(F.coalesce("__text", F.lit("")))).withColumn("__laid", F.when(F.size("__h") > 0, F.col("__laid"))) \
        .select("doc_id", "text_key", F.explode_outer(facing).alias("c")).select("doc_id", "text_key", "c.*")
    own = benchmark.select(F.col("item_id").alias("__item"), tokens(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("__item_h")).distinct()
    own = written(own, "benchmark-items")
    scored = pieces.join(bounded_lists(own, "__item_h"), F.col("item_id").eqNullSafe(F.col("__item")))
    n = F.size("__item_h")
    laid_over = F.slice("__item_h", F.greatest(-F.col("shift"), F.lit(0)) + 1, n)
    score = best_stretch(laid_over, F.col("tokens"))
    equal = F.size(F.filter(F.zip_with(laid_over, "tokens", lambda x, y: x.eqNullSafe(y)), lambda e: e))
    return scored.select("doc_id", "text_key", "item_id", n.alias("n"), "hits", score.alias("score"), equal.alias("equal")) \
        .where((F.col("score") >= F.least(F.lit(min_score), F.col("n"))) | ((F.col("n") >= NARROWEST) & (F.col("equal") >= F.col("n") - 1))) \
        .groupBy("doc_id", "text_key", "item_id").agg(F.max("score").alias("score"), F.max("hits").alias("n_hits"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, min_score: int = MIN_SCORE, text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that overlap a benchmark item (other rows as they are)."""
    found = benchmark_hits(docs, benchmark, min_score, text_col).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    found = bounded(written(found, "contaminated"))
    same = [docs["doc_id"].eqNullSafe(found["__id"]), F.xxhash64(docs[text_col].cast("string")) == found["__key"]]
    return docs.join(found, reduce(lambda a, b: a & b, same), "left_anti").select(*[F.col(f"`{c}`") for c in others(docs, ())])


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = benchmark_hits(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "item_id", "score", "n_hits")
