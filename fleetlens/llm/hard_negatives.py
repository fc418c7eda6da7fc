"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Candidates are laid along a Hilbert curve through the box of all vectors and
written as Parquet blocks, one row each, of at most ``block_rows`` vectors.  A
block's zone map (smallest and largest value of every dimension, its labels,
its smallest id) stands in columns of its own, which are read without the
vectors.  For an anchor ``a`` interval arithmetic bounds all inner products with a block:

    sum of min(a_i lo_i, a_i hi_i)  <=  score  <=  sum of max(a_i lo_i, a_i hi_i)

An anchor looks for the best few rows in a window of scores.  What it finds in its
own block narrows the window from below; then it reads the
blocks whose bounds meet the window, and no others.  That happens twice:
for its positives (one window open to both sides, rows of its label) and for the
negatives of each positive (window ``[0.8 positive, positive]``, rows of other labels).

Anchors and zone maps meet in chunks, an equi-join on the chunk's number, so
the bounds cost a matrix product per pair of chunks; anchors and blocks meet in an equi-join on the block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import read, written

POSITIVES, NEGATIVES = 5, 5
#: Vectors of a block, zone maps that meet a chunk of anchors at once, anchors of a chunk.
BLOCK_ROWS, ZONE_BLOCKS, CHUNK_ANCHORS = 512, 256, 256
#: Bits of a dimension in the Hilbert key.
CURVE_BITS = 4
#: Candidates that a task holds before it keeps the best of each window.
HELD = 200_000

_LOW, _HIGH = -(1 << 63), (1 << 63) - 1
_WINDOW = "array<struct<lo: bigint, hi: bigint, before: bigint>>"
_ANCHOR = f"struct<block: bigint, at: int, id: bigint, label: bigint, vec: binary, wins: {_WINDOW}>"
_BLOCK = "block bigint, n int, ids binary, labels binary, vecs binary, lo binary, hi binary, kinds binary, least bigint"
_FOUND = "block bigint, at int, win int, score bigint, id bigint"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of each row of ``cells`` (unsigned integers of ``bits`` bits), as big-endian bits packed into bytes."""
    x = [c.copy() for c in cells.T]
    q = 1 << (bits - 1)
    while q > 1:                                        # undo the rotations of each level
        p = cells.dtype.type(q - 1)
        for i in range(len(x)):
            there = (x[i] & cells.dtype.type(q)) != 0
            swap = np.where(there, 0, (x[0] ^ x[i]) & p).astype(cells.dtype)
            x[0] ^= np.where(there, p, swap).astype(cells.dtype)
            x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):                          # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros(len(cells), cells.dtype)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[-1] & cells.dtype.type(q), q - 1, 0).astype(cells.dtype)
        q >>= 1
    grid = np.stack(x, axis=1) ^ turn[:, None]
    levels = [(grid >> cells.dtype.type(b)) & cells.dtype.type(1) for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(levels, axis=1).astype(np.uint8), axis=1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; one beyond a long raises OverflowError."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 2.0**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return np.array(a.astype(object) @ b.T.astype(object), dtype=np.int64).reshape(len(a), len(b))


def zone_bounds(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) inner product of each row of ``a`` with any vector between ``lo`` and ``hi`` of each zone."""
    most = float(np.abs(a).max(initial=0)) * max(float(np.abs(lo).max(initial=0)), float(np.abs(hi).max(initial=0))) * max(a.shape[1], 1)
    if most >= 2.0**53:                                 # not exact in doubles: everything is possible
        shape = (len(a), len(lo))
        return np.full(shape, _LOW, np.int64), np.full(shape, _HIGH, np.int64)
    up, down = np.maximum(a, 0).astype(np.float64), np.minimum(a, 0).astype(np.float64)
    lo, hi = lo.T.astype(np.float64), hi.T.astype(np.float64)
    return (up @ lo + down @ hi).astype(np.int64), (up @ hi + down @ lo).astype(np.int64)


def _ranks(*keys: np.ndarray) -> np.ndarray:
    """Rank from 0 within runs of equal ``keys`` (sorted)."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    at = np.arange(len(new))
    return at - np.maximum.accumulate(np.where(new, at, 0))


def _matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """Rows of an array of lists of longs, padded with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), dims), np.int64)
    at = np.repeat(np.arange(len(vectors)), sizes)
    out[at, np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def _extent(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of each dimension (a shorter vector has zeros there).

    Each task sends one row per dimension; the driver gets as many as the longest vector has.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lo = hi = np.zeros(0, np.int64)
        seen = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            v = batch.column(0)
            own = _matrix(v, int(max(np.diff(v.offsets.to_numpy()))))
            dims = max(len(lo), own.shape[1])
            wide = lambda x: np.pad(x, (0, dims - len(x)))
            a, b = wide(own.min(0)), wide(own.max(0))
            lo, hi = (a, b) if not seen else (np.minimum(wide(lo), a), np.maximum(wide(hi), b))
            seen += batch.num_rows
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(lo)), pa.int32()), pa.array(lo), pa.array(hi)], names=["d", "lo", "hi"])

    found = rows.select("vec").mapInArrow(run, "d int, lo bigint, hi bigint").groupBy("d").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("d").collect()
    return np.array([r.lo for r in found], np.int64), np.array([r.hi for r in found], np.int64)


def blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """``rows`` (id, label, vec array<bigint>) as written blocks along the Hilbert curve, and the number of dimensions.

    Equal vectors follow each other by id, so a vector of very many rows fills blocks whose ids
    ascend.  Within a block rows stand by id.
    """
    lo, hi = _extent(rows)
    dims = max(len(lo), 1)
    wide = np.zeros(dims) if not len(lo) else hi.astype(np.float64) - lo + 1.0
    order = np.argsort(-wide, kind="stable")            # the curve turns first in the widest dimensions
    least = np.zeros(dims) if not len(lo) else lo.astype(np.float64)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(2), dims)
            share = (v - least) / np.maximum(wide, 1.0)
            cells = np.clip(np.floor(share * (1 << CURVE_BITS)), 0, (1 << CURVE_BITS) - 1).astype(np.uint8)[:, order]
            keys = hilbert_keys(cells, CURVE_BITS)
            raw, width = keys.tobytes(), keys.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([raw[i:i + width] for i in range(0, len(raw), width)], pa.binary()), batch.column(0), batch.column(1),
                 pa.array([r.tobytes() for r in v], pa.binary())], names=["key", "id", "label", "vec"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, []

        def block(ids, labels, v) -> pa.RecordBatch:
            nonlocal number
            by = np.argsort(ids, kind="stable")
            ids, labels, v = ids[by], labels[by], v[by]
            small = np.abs(v).max(initial=0) < 1 << 31
            cols = [[number], [len(ids)], [ids.tobytes()], [labels.tobytes()], [v.astype("<i4" if small else "<i8").tobytes()],
                    [v.min(0).tobytes()], [v.max(0).tobytes()], [np.unique(labels).tobytes()], [int(ids[0])]]
            number += 1
            kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 6, pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["block", "n", "ids", "labels", "vecs", "lo", "hi", "kinds", "least"])

        def parts():
            return (np.concatenate([h[i] for h in held]) for i in range(3))

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(),
                         np.frombuffer(b"".join(batch.column(2).to_pylist()), "<i8").reshape(-1, dims)))
            ids, labels, v = parts()
            whole = len(ids) // block_rows * block_rows
            for at in range(0, whole, block_rows):
                yield block(*(x[at:at + block_rows] for x in (ids, labels, v)))
            held[:] = [(ids[whole:], labels[whole:], v[whole:])]
        if held and len(held[0][0]):
            yield block(*held[0])

    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    along = rows.select("id", "label", "vec").mapInArrow(keyed, "key binary, id bigint, label bigint, vec binary") \
        .repartitionByRange(partitions, "key", "id").sortWithinPartitions("key", "id")
    return written(along.select("id", "label", "vec").mapInArrow(packed, _BLOCK), "hilbert-blocks"), dims


def _opened(n: int, ids: bytes, labels: bytes, vecs: bytes, dims: int) -> tuple[np.ndarray, ...]:
    width = len(vecs) // (n * dims)
    return np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8"), np.frombuffer(vecs, f"<i{width}").reshape(n, dims).astype(np.int64)


def _anchors(laid: DataFrame, dims: int, every: int, positives: int) -> DataFrame:
    """(chunk, a: anchor) of every row whose id ``every`` divides.

    Its window for positives starts at the last of the best ``positives`` rows of its own block, if there are that many.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            out = []
            for block, n, ids, labels, vecs in zip(*(c.to_pylist() for c in batch.columns)):
                ids, labels, v = _opened(n, ids, labels, vecs, dims)
                for at in np.flatnonzero(ids % every == 0):
                    same = np.flatnonzero(labels == labels[at])
                    same = same[same != at]
                    score = products(v[at:at + 1], v[same])[0]
                    best = np.lexsort((ids[same], -score))[:positives]
                    full = len(best) == positives
                    out.append({"block": block, "at": int(at), "id": int(ids[at]), "label": int(labels[at]), "vec": v[at].tobytes(),
                                "wins": [{"lo": int(score[best[-1]]) if full else _LOW, "hi": _HIGH, "before": int(ids[same][best[-1]]) if full else None}]})
            chunk = [task + (seen + i) // CHUNK_ANCHORS for i in range(len(out))]
            seen += len(out)
            yield pa.RecordBatch.from_arrays([pa.array(chunk, pa.int64()), pa.array(out, kind)], names=["chunk", "a"])

    kind = _arrow(_ANCHOR)
    found = laid.select("block", "n", "ids", "labels", "vecs").mapInArrow(run, f"chunk bigint, a {_ANCHOR}")
    return written(found, "hilbert-anchors")


def _arrow(ddl: str) -> pa.DataType:
    """Arrow type of the anchors' struct."""
    window = pa.struct([("lo", pa.int64()), ("hi", pa.int64()), ("before", pa.int64())])
    assert ddl == _ANCHOR
    return pa.struct([("block", pa.int64()), ("at", pa.int32()), ("id", pa.int64()), ("label", pa.int64()), ("vec", pa.binary()), ("wins", pa.list_(window))])


class _Chunk:
    """Some anchors as arrays; windows are padded with empty ones (lo > hi)."""

    def __init__(self, rows: pa.StructArray, dims: int):
        self.block, self.at, self.label = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("block", "at", "label"))
        self.vec = np.frombuffer(b"".join(rows.field("vec").to_pylist()), "<i8").reshape(-1, dims)
        wins = rows.field("wins").to_pylist()
        width = max([1, *map(len, wins)])
        self.lo, self.hi = np.full((len(rows), width), _HIGH, np.int64), np.full((len(rows), width), _LOW, np.int64)
        self.before = np.full((len(rows), width), _HIGH, np.int64)
        for i, some in enumerate(wins):
            for j, w in enumerate(some):
                self.lo[i, j], self.hi[i, j] = w["lo"], w["hi"]
                if w["before"] is not None:
                    self.before[i, j] = w["before"]


def _structs(column) -> Iterator[pa.StructArray]:
    """The anchors of each row of an array of lists."""
    ends, flat = column.offsets.to_numpy(), column.values
    return (flat.slice(ends[i], ends[i + 1] - ends[i]) for i in range(len(column)))


def needed_blocks(anchors: DataFrame, laid: DataFrame, dims: int, same_label: bool) -> DataFrame:
    """(block, some: anchors that must read it): blocks, but for the anchor's own, whose bounds meet a window.

    A bound that only equals a window's lower end counts if the block has an id below ``before``.
    """
    total = laid.count()
    zones = max(1, -(-total // ZONE_BLOCKS))
    maps = laid.select("block", "lo", "hi", "kinds", "least")
    maps = maps.groupBy(F.pmod(F.xxhash64("block"), F.lit(zones)).alias("zone")).agg(F.collect_list(F.struct(*maps.columns)).alias("maps"))
    chunks = anchors.groupBy("chunk").agg(F.collect_list("a").alias("some")) \
        .select("some", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(zones - 1).cast("bigint"))).alias("zone"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, zone in zip(_structs(batch.column(0)), batch.column(1).to_pylist()):
                a = _Chunk(some, dims)
                bounds = [np.frombuffer(b"".join([z[c] for z in zone]), "<i8").reshape(-1, dims) for c in ("lo", "hi")]
                least, most = zone_bounds(a.vec, *bounds)
                kinds = [np.frombuffer(z["kinds"], "<i8") for z in zone]
                has = np.stack([np.isin(a.label, k) if same_label else (len(k) > 1) | (a.label != k[0]) for k in kinds], axis=1)
                has &= a.block[:, None] != np.array([z["block"] for z in zone])[None, :]
                first = np.array([z["least"] for z in zone])[None, :]
                meets = np.zeros_like(has)
                for j in range(a.lo.shape[1]):
                    lo, hi, before = a.lo[:, j:j + 1], a.hi[:, j:j + 1], a.before[:, j:j + 1]
                    meets |= (lo <= hi) & (least <= hi) & ((most > lo) | (most == lo) & (first <= before))
                for z in np.flatnonzero((has & meets).any(axis=0)):
                    picked = np.flatnonzero(has[:, z] & meets[:, z])
                    rows = some.take(pa.array(picked))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([zone[z]["block"]], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)], names=["block", "some"])

    return chunks.join(maps, "zone").select("some", "maps").mapInArrow(run, f"block bigint, some array<{_ANCHOR}>")


def best_rows(pairs: DataFrame, laid: DataFrame, dims: int, same_label: bool, keep: int) -> DataFrame:
    """(block, at, win, score, id): candidates of each anchor's windows from the blocks it is paired with.

    Of what one task reads, no window keeps more than its best ``keep`` (a few
    tasks' worth when the task had to make room).
    """
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]

    def best(found: list) -> list:
        block, at, win, score, id_ = (np.concatenate([f[i] for f in found]) for i in range(5))
        by = np.lexsort((id_, -score, win, at, block))
        block, at, win, score, id_ = (x[by] for x in (block, at, win, score, id_))
        good = _ranks(block, at, win) < keep
        return [tuple(x[good] for x in (block, at, win, score, id_))]

    def batch_of(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(found[0], kinds)], names=["block", "at", "win", "score", "id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for batch in batches:
            for some, block, *packed in zip(_structs(batch.column(0)), *(c.to_pylist() for c in batch.columns[1:])):
                a, (ids, labels, v) = _Chunk(some, dims), _opened(*packed, dims)
                score = products(a.vec, v)
                fits = (a.label[:, None] == labels[None, :]) == same_label
                own = np.flatnonzero(a.block == block)
                fits[own, a.at[own]] = False
                by = np.argsort(-score, axis=1, kind="stable")      # rows stand by id
                score, fits = np.take_along_axis(score, by, 1), np.take_along_axis(fits, by, 1)
                for j in range(a.lo.shape[1]):
                    good = fits & (score >= a.lo[:, j:j + 1]) & (score <= a.hi[:, j:j + 1])
                    r, c = np.nonzero(good & (np.cumsum(good, axis=1) <= keep))
                    if len(r):
                        found.append((a.block[r], a.at[r], np.full(len(r), j), score[r, c], ids[by[r, c]]))
                        held += len(r)
            if held > HELD:
                found = best(found)
                held = len(found[0][0])
                if held > HELD // 2:
                    yield batch_of(found)
                    found, held = [], 0
        if found:
            yield batch_of(best(found))

    payload = laid.select("block", "n", "ids", "labels", "vecs")
    return pairs.join(payload, "block").select("some", "block", "n", "ids", "labels", "vecs").mapInArrow(run, _FOUND)


def _first(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("block", "at", "win").orderBy(F.col("score").desc(), F.col("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def _by_block(anchors: DataFrame) -> DataFrame:
    return anchors.groupBy("a.block").agg(F.collect_list("a").alias("some"))


def _with_windows(anchors: DataFrame, windows: DataFrame) -> DataFrame:
    """``anchors`` with the windows (block, at, wins) in place of theirs; anchors without any go."""
    fields = ["block", "at", "id", "label", "vec"]
    joined = anchors.join(windows.select(F.col("block").alias("wb"), F.col("at").alias("wa"), F.col("wins").cast(_WINDOW).alias("wins")),
                          (F.col("a.block") == F.col("wb")) & (F.col("a.at") == F.col("wa")))
    return joined.select("chunk", F.struct(*[F.col(f"a.{c}").alias(c) for c in fields], "wins").alias("a"))


def hard_negatives(rows: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Hard negatives of every row of ``rows`` (id, label, vec: array<bigint>) whose id ``every`` divides.

    For an anchor's first ``positives`` other rows of its label, by score descending, then id,
    each: the first ``negatives`` rows of other labels with ``80 p <= 100 n <= 100 p``,
    p and n being inner products with the anchor.  Returns (anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score).

    Rows with a null id, label, vector or component take no part.  Repeated rows
    and equal ids count each; a shorter vector goes on with zeros.  An empty table, or one
    without anchors, gives an empty result; scores beyond a long raise an error.
    """
    rows = rows.select(F.col("id").cast("bigint").alias("id"), F.col("label").cast("bigint").alias("label"), "vec") \
        .where("id is not null and label is not null and vec is not null and not exists(vec, x -> x is null)")
    laid, dims = blocks(rows, block_rows)
    anchors = _anchors(laid, dims, every, positives)

    found = best_rows(needed_blocks(anchors, laid, dims, True), laid, dims, True, positives) \
        .unionByName(best_rows(_by_block(anchors), laid, dims, True, positives))
    chosen = written(_first(found, positives).select("block", "at", (F.col("rank") - 1).alias("win"), F.col("score").alias("p"), F.col("id").alias("positive_id")),
                     "hilbert-positives")

    # Windows by number of the positive, from ceil(0.8 p); one below zero is empty (0.8 p > p).
    window = F.struct(F.expr("p - p div 5").alias("lo"), F.when(F.col("p") >= 0, F.col("p")).otherwise(F.lit(_LOW)).alias("hi"),
                      F.lit(None).cast("bigint").alias("before"))
    windows = chosen.groupBy("block", "at").agg(F.transform(F.array_sort(F.collect_list(F.struct("win", window.alias("w")))), lambda x: x["w"]).alias("wins"))
    facing = written(_with_windows(anchors, windows), "hilbert-windows")
    home = written(best_rows(_by_block(facing), laid, dims, False, negatives), "hilbert-home")

    # A window in which the own block has all that is wanted starts at the last of them.
    last = _first(home, negatives).where(F.col("rank") == negatives).select(F.col("block").alias("hb"), F.col("at").alias("ha"), "win", F.col("score"), "id")
    last = last.groupBy("hb", "ha").agg(F.map_from_entries(F.collect_list(F.struct("win", F.struct("score", "id")))).alias("full"))
    narrowed = facing.join(last, (F.col("a.block") == F.col("hb")) & (F.col("a.at") == F.col("ha")), "left").select("chunk", F.struct(
        *[F.col(f"a.{c}").alias(c) for c in ("block", "at", "id", "label", "vec")],
        F.transform("a.wins", lambda w, i: F.struct(
            F.coalesce(F.try_element_at("full", i)["score"], w["lo"]).alias("lo"), w["hi"].alias("hi"),
            F.try_element_at("full", i)["id"].alias("before"))).cast(_WINDOW).alias("wins")).alias("a"))
    found = _first(best_rows(needed_blocks(narrowed, laid, dims, False), laid, dims, False, negatives).unionByName(home), negatives)

    ids = anchors.select("a.block", "a.at", F.col("a.id").alias("anchor_id"))
    named = chosen.join(ids, ["block", "at"])
    return found.withColumnRenamed("id", "negative_id").join(named, ["block", "at", "win"]) \
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                F.col("p").alias("positive_score"), F.col("score").alias("negative_score"))


def quantised(vector: Column) -> Column:
    """floor(256 x) of every component, x as double; null where one is null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(256.0)).cast("bigint")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), label.alias("label"), quantised(F.col("embedding")).alias("vec"))
    return hard_negatives(rows)


SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.r AS anchor, b.vec_id AS id, b.r AS r, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS k FROM scored WHERE same) WHERE k <= 5),
ranked AS (
  SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.anchor, p.k ORDER BY n.score DESC, n.id)::INTEGER AS rank,
         n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
  WHERE 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT * FROM ranked WHERE rank <= 5
"""
