"""Source divergence audit by in-mapper stripes.

Every map task folds whole documents into hash stripes, one per language and
term: the term's document frequency and its occurrences per source.  A task
emits its stripes when they outgrow ``held`` entries and at its end; Spark's
shuffle merges them by (language, term).  A merged stripe holds all that a
term contributes to the divergence between the sources of its language, so
divergences are sums over stripes.

With count ``c`` of a term in a source whose kept terms occur ``N`` times, and
``V`` kept terms in the language, ``p = 1 + floor(1e9 (c + 1) / (N + V))`` and
``f(p, q) = floor((p - q)^2 / q)``.  Most terms occur in few sources, so the sum
of ``f`` over all terms is split: with ``p0`` the value of an absent term,

    sum f(p, q) = sum over terms in both sources  f(p,q) - f(p,q0) - f(p0,q) + f(p0,q0)
                + sum over terms of the first     f(p,q0) - f(p0,q0)
                + sum over terms of the second    f(p0,q) - f(p0,q0)
                + V f(p0,q0)

Only the first line looks at pairs within a stripe; the next two need how many
terms of a source have each value.  All of it is integer arithmetic.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import read, written

#: Documents of a language that a kept term occurs in, and ranks of the term part.
MIN_DOCUMENTS = 3
TOP_TERMS = 200
#: (term, source) entries that a map task holds before it emits its stripes.
HELD = 200_000
#: Bytes of text that are split into terms at once, and stripes of an emitted batch.
SPLIT_BYTES = 4 << 20
BATCH_STRIPES = 20_000

#: Bytes of terms (A-Z become a-z), everything else separates.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
#: Key of the document frequency in a stripe (sources are text), and the term that marks a source's existence.
_DF, _MARK = None, b""

_STRIPES = "lang string, term string, df long, stripe map<string,long>"
_EXACT = "decimal(38,0)"


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term of one UTF-8 text."""
    flat = text.translate(_TERM_BYTES)
    if len(flat) <= SPLIT_BYTES:
        return Counter(flat.split())
    out, at = Counter(), 0
    while at < len(flat):
        end = flat.find(b" ", at + SPLIT_BYTES)
        end = len(flat) if end < 0 else end
        out.update(flat[at:end].split())
        at = end
    return out


def _batches(stripes: dict[str, dict[bytes, dict]]) -> Iterator[pa.RecordBatch]:
    for lang, mine in stripes.items():
        terms = list(mine)
        for at in range(0, len(terms), BATCH_STRIPES):
            some = terms[at:at + BATCH_STRIPES]
            df, ends, sources, counts = [], [0], [], []
            for t in some:
                stripe = mine[t]
                df.append(stripe.pop(_DF))
                sources += stripe.keys()
                counts += stripe.values()
                ends.append(len(sources))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pc.cast(pa.array(some, pa.binary()), pa.string(), safe=False),
                 pa.array(df, pa.int64()), pa.MapArray.from_arrays(pa.array(ends, pa.int32()), pa.array(sources, pa.string()), pa.array(counts, pa.int64()))],
                names=["lang", "term", "df", "stripe"])


def _fold(held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes: dict[str, dict[bytes, dict]] = {}
        entries = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i) for i in range(3))):
                lang, source, text = lang.as_py(), source.as_py(), text.as_py()
                mine = stripes.setdefault(lang, {})
                # The mark has no document and no occurrence; it says that the source exists.
                mine.setdefault(_MARK, {_DF: 0})[source] = 0
                for term, n in term_counts(text).items():
                    stripe = mine.get(term)
                    if stripe is None:
                        mine[term] = {_DF: 1, source: n}
                        entries += 1
                    else:
                        stripe[_DF] += 1
                        if source in stripe:
                            stripe[source] += n
                        else:
                            stripe[source] = n
                            entries += 1
                    if entries >= held:                 # within a document as well: its terms are distinct here
                        yield from _batches(stripes)
                        stripes, entries = {}, 0
                        mine = stripes.setdefault(lang, {})
        yield from _batches(stripes)
    return run


def term_stripes(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, held: int = HELD) -> DataFrame:
    """(lang, term, df, total, stripe): the merged stripe of every term in ``min_documents`` documents of its language.

    ``stripe`` is array<struct<source, n>>.  Besides, the term '' of each
    language lists its sources with n = 0.  Null lang, source and text count
    as ''.  Other columns of ``docs`` are not read.  The tasks' stripes are shuffled by
    (lang, term) once; a source's counts are summed by hash aggregates that spill,
    so no list outgrows the language's number of sources.
    """
    def text(c: str) -> Column:
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))

    found = docs.select(text("lang").alias("lang"), text("source").alias("source"), text("text").cast("binary").alias("text")) \
        .mapInArrow(_fold(held), _STRIPES)
    dealt = found.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "lang", "term")
    cells = dealt.select("lang", "term", "df", F.posexplode("stripe").alias("i", "source", "n")) \
        .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("i") == 0, F.col("df")).otherwise(F.lit(0))).alias("df"))
    return cells.groupBy("lang", "term") \
        .agg(F.sum("df").alias("df"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("stripe")) \
        .where((F.col("df") >= min_documents) | (F.col("term") == ""))


def _scaled(count: str, whole: str) -> str:
    """SQL of p: 1 + floor(1e9 (count + 1) / whole); the product has up to 31 digits."""
    return f"(1 + (cast({count} + 1 as decimal(20,0)) * 1000000000) div {whole})"


def _gap(p: str, q: str) -> str:
    """SQL of f(p, q): both are at most 1e9 + 1, their difference squared fits a long."""
    return f"((({p}) - ({q})) * (({p}) - ({q})) div ({q}))"


def _groups(stripes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, source, v, whole, zero) per group; (lang, lang_whole, of) per language, ``of`` its groups by source.

    ``whole`` is N + V (1 where both are 0), ``zero`` the p of an absent term.
    """
    kept = F.col("term") != ""
    langs = stripes.groupBy("lang").agg(F.sum(kept.cast("long")).alias("v"), F.sum(F.when(kept, F.col("total")).otherwise(F.lit(0))).alias("n"))
    sources = stripes.select("lang", F.explode("stripe").alias("x")).groupBy("lang", "x.source").agg(F.sum("x.n").alias("n"))
    groups = sources.join(langs.select("lang", "v"), "lang").withColumn("whole", F.greatest(F.col("n") + F.col("v"), F.lit(1))) \
        .select("lang", "source", "v", "whole", F.expr(_scaled("0", "whole")).alias("zero"))
    groups = written(groups, "audit-groups")
    of = groups.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("source", F.struct("whole", "zero")))).alias("of"))
    return groups, langs.select("lang", F.greatest(F.col("n") + F.col("v"), F.lit(1)).alias("lang_whole")).join(of, "lang")


def divergences(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS, held: int = HELD) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) group of ``docs``.

    Part ``pair``: ``item`` is each other source of the language, ``value`` the
    sum of f(p of the group, p of the item) over the language's kept terms.
    Part ``term``: the ``top`` kept terms that the group uses more than its
    language does, ``value`` f(p of the group, p of the language).  Ranks go by
    value descending, then item ascending in UTF-8.

    Null lang, source and text count as ''; a document without terms still
    makes its group occur; repeated rows count each time; an empty table gives
    an empty result.  Whole texts of any length count.  Group sums beyond 9e18 raise an error.
    """
    stripes = written(term_stripes(docs, min_documents, held), "audit-stripes")
    groups, langs = _groups(stripes)
    groups_of, langs = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("item_zero")), written(langs, "audit-languages")
    valued = stripes.where("term <> ''").join(langs, "lang").select(
        "lang", "term", F.expr(_scaled("total", "lang_whole")).alias("q"),
        F.expr(f"transform(stripe, x -> struct(x.source as source, {_scaled('x.n', 'of[x.source].whole')} as p, of[x.source].zero as zero))").alias("stripe"))

    both = valued.where(F.size("stripe") > 1).select("lang", "stripe", F.explode("stripe").alias("a")) \
        .select("lang", "a", F.explode("stripe").alias("b")).where("a.source <> b.source") \
        .select("lang", F.col("a.source").alias("source"), F.col("b.source").alias("item"), F.expr(
            f"{_gap('a.p', 'b.p')} - {_gap('a.p', 'b.zero')} - {_gap('a.zero', 'b.p')} + {_gap('a.zero', 'b.zero')}").cast(_EXACT).alias("value")) \
        .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    levels = valued.select("lang", F.explode("stripe").alias("x")).groupBy("lang", "x.source", "x.p", "x.zero").agg(F.count("*").alias("k"))
    facing = levels.join(groups_of, "lang").where("source <> item")
    firsts = facing.select("lang", "source", "item", F.expr(f"k * cast({_gap('p', 'item_zero')} - {_gap('zero', 'item_zero')} as {_EXACT})").alias("value"))
    seconds = facing.select("lang", F.col("item").alias("source"), F.col("source").alias("item"),
                            F.expr(f"k * cast({_gap('item_zero', 'p')} - {_gap('item_zero', 'zero')} as {_EXACT})").alias("value"))
    absent = groups.join(groups_of, "lang").where("source <> item") \
        .select("lang", "source", "item", F.expr(f"v * cast({_gap('zero', 'item_zero')} as {_EXACT})").alias("value"))
    sums = [x.withColumn("value", F.col("value").cast(_EXACT)) for x in (both, firsts, seconds, absent)]
    pairs = sums[0].unionByName(sums[1]).unionByName(sums[2]).unionByName(sums[3]) \
        .groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))

    terms = valued.select("lang", "term", "q", F.explode("stripe").alias("x")).where("x.p > q") \
        .select("lang", F.col("x.source").alias("source"), F.col("term").alias("item"), F.expr(_gap("x.p", "q")).alias("value"))

    def ranked(df: DataFrame, part: str) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
        return df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    return ranked(pairs, "pair").unionByName(ranked(terms, "term").where(F.col("rank") <= top))


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(read(spark, sf_dir, "documents").select("text", "lang", "source"))


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
words AS (SELECT d, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 3),
cells AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
grps AS (
  SELECT g.lang, g.source, coalesce(l.v, 0)::HUGEINT AS v, coalesce(c.n, 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN langs l ON g.lang = l.lang
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM cells GROUP BY ALL) c ON g.lang = c.lang AND g.source = c.source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.n + g.v) AS p,
         1 + (1000000000::HUGEINT * (k.total + 1)) // (l.n + l.v)::HUGEINT AS q
  FROM grps g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang
  LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
          FROM grps a JOIN grps b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pairs
UNION ALL
SELECT * FROM (SELECT lang, source, 'term' AS part, item, value,
                      row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM terms) WHERE rank <= 200
"""
