"""Sharding by extendible hashing.

Every document hashes to 60 bits.  A bucket is a prefix of those bits; it
starts as the empty prefix, and only a bucket whose documents exceed the byte
limit splits on one more bit, until every bucket fits.  A document's shard is
thus its shortest hash prefix whose documents fit the limit together.

The directory is grown in rounds of ``ROUND_BITS`` bits.  A round sums the
bytes of the still open buckets by their next bits (map-side sums, at most
``2 ** ROUND_BITS`` rows per open bucket and task), decides the shortest
fitting prefix of each cell, and leaves only oversized cells to the next
round, which reads only their rows.  Directory and rows meet in a plain
equi-join on the cell, whose keys are hash bits and hence even.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import keep, others, read, written

HASH_BITS = 60
ROUND_BITS = 12
#: Production limit of a shard.
SHARD_BYTES = 16 << 20


def hash_bits(df: DataFrame, keys: list[str]) -> Column:
    """60 bits of MD5 over the key columns, each as text; null counts as ``\\N``."""
    parts = [F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("\\N")) for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[F.md5(p.cast("binary")) for p in parts]).cast("binary")), 1, 15),
                  16, 10).cast("long")


def prefix(h: Column, depth) -> Column:
    return F.call_function("shiftright", h, F.lit(HASH_BITS) - depth)


def directory(rows: DataFrame, limit: int) -> tuple[list[tuple[int, DataFrame]], DataFrame]:
    """Rounds of (bits, cells of these bits with depth and shard bytes); and the cells left open at the end."""
    rounds = []
    live, done = rows, 0
    while done < HASH_BITS:
        top = min(done + ROUND_BITS, HASH_BITS)
        cells = live.groupBy(prefix(F.col("h"), F.lit(top)).alias("cell")).agg(F.sum("bytes").alias("bytes"))
        depths = F.sequence(F.lit(done), F.lit(top)) if not done else F.sequence(F.lit(done + 1), F.lit(top))
        levels = cells.select("cell", "bytes", F.explode(depths).alias("depth")) \
            .withColumn("bucket", F.call_function("shiftright", "cell", F.lit(top) - F.col("depth")))
        sums = levels.groupBy("depth", "bucket").agg(F.sum("bytes").alias("shard_bytes"))
        fits = levels.select("cell", "depth", "bucket").join(sums, ["depth", "bucket"])
        chosen = fits.groupBy("cell").agg(F.min(F.when((F.col("shard_bytes") <= limit) | (F.col("depth") == HASH_BITS),
                                                       F.struct("depth", "bucket", "shard_bytes"))).alias("s"))
        chosen = written(chosen.select("cell", "s.*"), "shard-directory")
        rounds.append((top, chosen))
        still_open = chosen.where(F.col("depth").isNull()).select("cell")
        if top == HASH_BITS or still_open.isEmpty():
            break
        live = live.join(still_open, prefix(live.h, F.lit(top)) == still_open.cell, "left_semi")
        done = top
    return rounds, live


def shard_documents(docs: DataFrame, limit: int = SHARD_BYTES, keys: tuple[str, ...] = ("doc_id", "text"),
                    text_col: str = "text") -> DataFrame:
    """``docs`` with ``shard`` (its bits as text, '' for the one-shard directory), ``depth``,
    ``shard_bytes`` and ``fits``.

    Bytes are those of the UTF-8 text; null and empty texts have none.  The
    hash covers ``keys``, so a key held by many rows still spreads by the
    texts.  No hash can tell rows apart that agree in all keys: such a group,
    and a single text, larger than the limit keeps a shard of its own
    with ``fits`` false.  Empty table: empty result.  Columns called like an
    output are replaced.
    """
    names = ("shard", "depth", "shard_bytes", "fits")
    hashed = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others(docs, names))],
                         hash_bits(docs, list(keys)).alias("h"),
                         F.coalesce(F.octet_length(F.col(f"`{text_col}`").cast("string")), F.lit(0)).cast("long").alias("bytes"))
    rounds, _ = directory(hashed.select("h", "bytes"), limit)
    parts, live = [], hashed
    for top, chosen in rounds:
        joined = live.join(chosen.withColumnRenamed("cell", "cell_"), prefix(live.h, F.lit(top)) == F.col("cell_"))
        parts.append(joined.where(F.col("depth").isNotNull()))
        live = joined.where(F.col("depth").isNull()).select(*live.columns)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    bits = F.lpad(F.conv(F.col("bucket").cast("string"), 10, 2), F.col("depth"), F.lit("0"))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(others(docs, names))],
                      F.when(F.col("depth") == 0, "").otherwise(bits).alias("shard"), F.col("depth").cast("int"),
                      F.col("shard_bytes"), (F.col("shard_bytes") <= limit).alias("fits"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; each shard's rows are gathered by hash of the shard, so it makes few files."""
    sharded.repartition(F.col("shard")).write.partitionBy("shard").parquet(path)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return keep(shard_documents(docs), ["text"])


SQL = f"""
WITH hashed AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS bytes,
         CAST('0x' || substr(md5(md5(coalesce(CAST(doc_id AS VARCHAR), '\\N')) || '|' || md5(coalesce(text, '\\N'))), 1, 15) AS BIGINT) AS h
  FROM documents),
levels AS (
  SELECT doc_id, bytes, depth, h >> ({HASH_BITS} - depth) AS bucket
  FROM hashed, (SELECT unnest(range(0, {HASH_BITS} + 1))::INT AS depth)),
sums AS (SELECT depth, bucket, CAST(sum(bytes) AS BIGINT) AS shard_bytes FROM levels GROUP BY ALL),
chosen AS (
  SELECT l.doc_id, min({{'depth': l.depth, 'bucket': l.bucket, 'shard_bytes': s.shard_bytes}}) AS c
  FROM levels l JOIN sums s USING (depth, bucket)
  WHERE s.shard_bytes <= {SHARD_BYTES} OR l.depth = {HASH_BITS}
  GROUP BY l.doc_id)
SELECT doc_id, CASE WHEN c.depth = 0 THEN '' ELSE lpad(bin(c.bucket), c.depth, '0') END AS shard,
       c.depth AS depth, c.shard_bytes AS shard_bytes, c.shard_bytes <= {SHARD_BYTES} AS fits
FROM chosen
"""
