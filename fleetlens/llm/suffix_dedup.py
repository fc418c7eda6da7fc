"""Removal of repeated 400-byte strings by a distributed difference-cover suffix sort.

Only suffixes that can have a twin are sorted.  The work goes in five steps:

1. *Filter.*  Every 400-byte window has a minimizer, the smallest hash among
   its 64-byte strings.  Equal windows have equal minimizers at equal offsets,
   so a window whose minimizer occurs once in the corpus is unique.  A text
   sends one row per minimizer: its hash, its place, the windows it serves, and
   a hash of all the bytes these windows can touch (its context).
2. *Whole contexts.*  Equal contexts at two places are repeated as they are.
   Of each class of equal contexts one row stays to be compared with others.
3. *Difference cover.*  The windows of the remaining rows meet by minimizer
   hash.  Positions 1 and 2 modulo 3 are sampled; their byte triples get names,
   and the names are tripled recursively (3, 9, 27, 81, 243 bytes, then 399 by
   overlap).  The remaining positions (0 modulo 3) merge as (byte, name of the
   next sampled position); the sampled ones take their 400th byte.  Names are
   64-bit hashes, so naming needs no global sort and names mean the same in
   all tasks.  Segments are laid down with the minimizer at 0 modulo 3, so
   equal strings always are in the same class.
4. *Adjacent suffixes.*  The suffixes of a task are sorted by name; neighbours
   with one name have equal 400-byte prefixes, and both are repeated.
5. Runs of repeated suffixes become byte spans, united per text.

Equal texts are handled once: a text of 400 bytes or more that occurs twice is
repeated as a whole.  A minimizer with more than ``ROWS_PER_GROUP`` rows is cut
by window offset (windows at different offsets of a minimizer cannot be equal),
and beyond 337 cuts by the window's own hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.llm.common import BYTE_CODES, _BASE, _BASE_INV, _cached_powers, keep, mix, others, read, written

LENGTH = 400
GRAM = 64
OFFSETS = LENGTH - GRAM + 1
#: Windows handled at a time.
PIECE = 1 << 20
_PLACE = np.uint64((1 << 21) - 1)
ROWS_PER_GROUP = 100_000
#: Bytes of segments sorted at a time (whole groups).
TASK_BYTES = 4 << 20
#: Span lists are broadcast up to so many spans in all (16 bytes each, and 32 per text), else joined by shuffle.
BROADCAST_ENTRIES = 1_000_000
_END = 1 << 62


def _prefix_sums(buf: np.ndarray) -> np.ndarray:
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(BYTE_CODES[buf] * _cached_powers(_BASE, len(buf)), out=out[1:])
    return out


def _hashes(sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix((sums[b] - sums[a]) * _cached_powers(_BASE_INV, len(sums))[a])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def minimizers(text: bytes) -> tuple[np.ndarray, ...]:
    """(place, first window, last window, hash, context hash) of the minimizers of a text."""
    out = []
    for at in range(0, len(text) - LENGTH + 1, PIECE):
        # Bytes before and after, so that contexts reach as far as in any other text.
        low = max(at - OFFSETS, 0)
        buf = np.frombuffer(text[low:at + PIECE + 2 * LENGTH], np.uint8)
        sums = _prefix_sums(buf)
        grams = np.arange(len(buf) - GRAM + 1)
        hashes = _hashes(sums, grams, grams + GRAM)
        windows = min(PIECE, len(text) - LENGTH + 1 - at)
        begin = at - low
        part = hashes[begin:begin + windows + OFFSETS - 1]
        least = sliding_min((part & ~_PLACE) | np.arange(len(part), dtype=np.uint64), OFFSETS)
        place = (least & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        last = np.append(first[1:], len(place)) - 1
        p = place[first] + begin
        a, b = np.maximum(p - (OFFSETS - 1), 0), np.minimum(p + LENGTH, len(buf))
        context = mix(_hashes(sums, a, b) + (p - a).astype(np.uint64) * np.uint64(1009) + (b - p).astype(np.uint64))
        out.append((p + low, first + at, last + at, hashes[p], context))
    if not out:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    p, first, last, hashes, context = (np.concatenate(x) for x in zip(*out))
    new = np.flatnonzero(np.diff(p, prepend=-1))                    # a minimizer can serve two pieces
    return p[new], first[new], last[np.append(new[1:], len(p)) - 1], hashes[new], context[new]


def names(buf: np.ndarray) -> np.ndarray:
    """Name of the 400 bytes from each position (0 where fewer are left); equal strings in one class modulo 3 have equal names."""
    n = len(buf)
    out = np.zeros(n, np.uint64)
    wide = buf.astype(np.uint64)
    ahead: np.ndarray | None = None

    def triple(x: np.ndarray, y: np.ndarray, z: np.ndarray) -> np.ndarray:
        v = (x * np.uint64(0x9E3779B97F4A7C15) + y) * np.uint64(0xBF58476D1CE4E5B9) + z
        return (v ^ (v >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)

    for r in (2, 1):
        count = (n - r) // 3
        if count < 133:
            return out
        x = wide[r:r + 3 * count].reshape(-1, 3)
        x = triple(x[:, 0], x[:, 1], x[:, 2])
        for stride in (1, 3, 9, 27):                                  # 9, 27, 81, 243 bytes
            x = triple(x[:-2 * stride], x[stride:-stride], x[2 * stride:])
        x = triple(x[:-52], x[52:], np.uint64(0))                     # 399 bytes
        at = r + 3 * np.arange(len(x))
        fits = at + LENGTH <= n
        out[at[fits]] = mix(x[fits] + BYTE_CODES[buf[at[fits] + LENGTH - 1]])
        ahead = x
    at = 3 * np.arange(len(ahead))                                    # remaining suffixes: (byte, name of the next)
    out[at] = mix(ahead * np.uint64(3) ^ BYTE_CODES[buf[at]])
    return out


_MINIMIZERS = "t bigint, p bigint, lo bigint, hi bigint, h bigint, c bigint"
_SEGMENTS = "h bigint, cut int, t bigint, lo bigint, hi bigint, p bigint, seg binary"
_SPANS = "t bigint, a bigint, b bigint"


def _rows(columns: list, types: list, names_: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names_)


def all_minimizers(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for t, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                if t in seen:
                    continue
                seen.add(t)
                p, lo, hi, h, c = minimizers(raw.as_buffer().to_pybytes())
                if len(p):
                    yield _rows([np.full(len(p), t), p, lo, hi, h.view(np.int64), c.view(np.int64)], [pa.int64()] * 6, ["t", "p", "lo", "hi", "h", "c"])

    return texts.select("t", "raw").where(F.octet_length("raw") >= LENGTH).mapInArrow(run, _MINIMIZERS).distinct()


def segments(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes that the windows of each wanted minimizer cover."""
    per_text = wanted.groupBy(F.col("t").alias("__t")).agg(F.collect_list(F.struct("p", "lo", "hi", "h", "rows")).alias("want"))
    joined = texts.join(per_text, texts["t"] == F.col("__t")).select("t", "raw", "want")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for t, raw, want in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                if t in seen:
                    continue
                seen.add(t)
                text = raw.as_buffer().to_pybytes()
                rows = [(w["h"], *r) for w in want for r in cut(text, t, w["p"], w["lo"], w["hi"], w["rows"])]
                for at in range(0, len(rows), 2000):
                    yield _rows(list(zip(*rows[at:at + 2000])), [pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.binary()],
                                ["h", "cut", "t", "lo", "hi", "p", "seg"])

    return joined.mapInArrow(run, _SEGMENTS)


def cut(text: bytes, t: int, p: int, lo: int, hi: int, rows: int) -> Iterator[tuple]:
    """(cut, t, lo, hi, p, bytes) of a minimizer's windows: one row, or one per range of offsets of a minimizer with many rows."""
    cuts = -(-rows // ROWS_PER_GROUP)
    if cuts == 1:
        yield 0, t, lo, hi, p, text[lo:hi + LENGTH]
        return
    width = max(1, -(-OFFSETS // cuts))
    by_hash = -(-cuts // OFFSETS)
    while lo <= hi:
        number = (p - lo) // width
        end = min(hi, p - number * width)
        if by_hash == 1:
            yield number, t, lo, end, p, text[lo:end + LENGTH]
        else:
            for i in range(lo, end + 1):
                piece = text[i:i + LENGTH]
                part = int(_hashes(_prefix_sums(np.frombuffer(piece, np.uint8)), np.array([0]), np.array([LENGTH]))[0] % np.uint64(by_hash))
                yield number + OFFSETS * (1 + part), t, i, i, p, piece
        lo = end + 1


def repeated(segs: list[bytes], t: list[int], lo: list[int], hi: list[int], p: list[int]) -> tuple[np.ndarray, ...]:
    """Spans (t, a, b) of the suffixes among these segments whose name occurs twice or more."""
    starts, parts, at = [], [], 0
    for seg, first, place in zip(segs, lo, p):
        pad = -(at + place - first) % 3
        parts.append(b"\0" * pad + seg)
        starts.append(at + pad)
        at += pad + len(seg)
    name = names(np.frombuffer(b"".join(parts) + b"\0" * 3, np.uint8))
    starts, lo, hi, t = (np.array(x, np.int64) for x in (starts, lo, hi, t))
    count = hi - lo + 1
    owner = np.repeat(np.arange(len(count)), count)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    mine = name[starts[owner] + offset]
    order = np.argsort(mine, kind="stable")
    same = mine[order[1:]] == mine[order[:-1]]                       # neighbours in suffix order
    twice = np.zeros(len(mine), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    if not len(at):
        return at, at, at
    new = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(owner[at], prepend=-1) != 0))
    last = np.append(new[1:], len(at)) - 1
    return t[owner[at[new]]], lo[owner[at[new]]] + offset[at[new]], lo[owner[at[last]]] + offset[at[last]] + LENGTH


def sorted_spans(segs: DataFrame) -> DataFrame:
    """Spans found by sorting the suffixes of each group (h, cut); several groups are sorted together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(5)]
        size, last = 0, None

        def done() -> Iterator[pa.RecordBatch]:
            t, a, b = repeated(*held)
            if len(t):
                yield _rows([t, a, b], [pa.int64()] * 3, ["t", "a", "b"])

        for batch in batches:
            h, cut_, t, lo, hi, p, seg = (c.to_pylist() for c in batch.columns)
            for i in range(len(h)):
                if (h[i], cut_[i]) != last and size > TASK_BYTES:
                    yield from done()
                    held, size = [[] for _ in range(5)], 0
                last = (h[i], cut_[i])
                for list_, x in zip(held, (seg[i], t[i], lo[i], hi[i], p[i])):
                    list_.append(x)
                size += len(seg[i])
        if held[0]:
            yield from done()

    return segs.repartition("h", "cut").sortWithinPartitions("h", "cut").mapInArrow(run, _SPANS)


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(t, a, b): byte spans to remove of each distinct text; ``texts`` has t (key of the text) and raw (its bytes)."""
    found = written(all_minimizers(texts), "minimizers")
    by_hash, by_context = Window.partitionBy("h"), Window.partitionBy("h", "c")
    counted = found.withColumn("nh", F.count("*").over(by_hash)).withColumn("nc", F.count("*").over(by_context)) \
        .withColumn("first", F.row_number().over(by_context.orderBy("t", "p"))).where("nh > 1")
    counted = written(counted, "minimizers-repeated")
    whole = counted.where("nc > 1").select("t", F.greatest(F.col("p") - (OFFSETS - 1), F.lit(0)).alias("a"), (F.col("p") + LENGTH).alias("b"))
    compared = counted.where("nh > nc and first = 1").select("t", "p", "lo", "hi", "h", F.col("nh").alias("rows"))
    compared = written(compared, "minimizers-compared")
    spans = sorted_spans(segments(texts, compared))
    return written(whole.unionByName(spans), "repeated-spans")


def merged(spans: list[dict], size: int) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["a"], min(s["b"], size)) for s in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def united(spans: DataFrame) -> DataFrame:
    """(__t, __spans): the maximal spans of each text from (t, spans)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [[{"a": a, "b": b} for a, b in merged(x, _END)] for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))],
                                             names=["__t", "__spans"])

    return spans.mapInArrow(run, "__t bigint, __spans array<struct<a:bigint,b:bigint>>")


def text_key(raw: Column) -> Column:
    return F.xxhash64(raw, F.octet_length(raw))


def remove_repeats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans`` (longs), ``spans`` and ``kept`` (binary).

    ``spans`` are the maximal removed (a, b) byte ranges, ``kept`` the other
    bytes.  Null and empty texts have no bytes.  Repeated rows and equal texts
    of ``LENGTH`` bytes or more remove each other.  Shorter texts stay whole.
    An empty table gives an empty one; columns called like an output are replaced.
    """
    out_names = ("n_bytes", "n_removed", "n_spans", "spans", "kept")
    cols = others(docs, out_names)
    raw = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    keyed = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)], text_key(raw).alias("t"), raw.alias("raw"))
    texts = keyed.select("t", "raw")
    copies = texts.where(F.octet_length("raw") >= LENGTH).groupBy("t").agg(F.count("*").alias("n"), F.max(F.octet_length("raw")).cast("long").alias("b")) \
        .where("n > 1").select("t", F.lit(0).cast("long").alias("a"), "b")
    spans = repeated_spans(texts).unionByName(copies)
    per_text = written(united(spans.groupBy("t").agg(F.collect_set(F.struct("a", "b")).alias("spans"))), "spans-per-text")
    # Small united lists are broadcast while they have at most BROADCAST_ENTRIES spans in all.
    few = (per_text.agg(F.sum(F.size("__spans"))).first()[0] or 0) <= BROADCAST_ENTRIES
    joined = keyed.join(F.broadcast(per_text) if few else per_text, F.col("t") == F.col("__t"), "left")
    schema = T.StructType([*[T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(cols)],
                           *[T.StructField(n, T.LongType()) for n in out_names[:3]],
                           T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("kept", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(cols)
        for batch in batches:
            size, gone, number, where, kept = [], [], [], [], []
            for raw_, found in zip(batch.column(k).to_pylist(), batch.column(k + 1).to_pylist()):
                ranges = merged(found or [], len(raw_))
                at, parts = 0, []
                for a, b in ranges:
                    parts.append(raw_[at:a])
                    at = b
                parts.append(raw_[at:])
                kept.append(b"".join(parts))
                size.append(len(raw_))
                gone.append(len(raw_) - len(kept[-1]))
                number.append(len(ranges))
                where.append([list(r) for r in ranges])
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(k)], pa.array(size, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(number, pa.int64()), pa.array(where, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.binary())],
                                             names=[*[f"c{i}" for i in range(k)], *out_names])

    done = joined.select(*[f"c{i}" for i in range(len(cols))], "raw", "__spans").mapInArrow(run, schema)
    return done.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)], *out_names)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, then the kept bytes as text (a cut character becomes replacement characters)."""
    done = remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return keep(done, ["text", "spans"]).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
                                                F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"))
