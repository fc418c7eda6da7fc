"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A text is the multiset of its paragraphs (the pieces between line feeds, empty
ones included).  Each paragraph has a wide vector of hashes, and a text's
fingerprint is their sum, modulo 2^64 or 2^32 in each place.  So the
order of paragraphs does not matter, the fingerprint of two texts put together
is the sum of theirs, and paragraphs are inserted or deleted by adding or
subtracting their vectors, without the rest of the text.

A paragraph's vector has

* 2 counters modulo 2^64: paragraphs (1) and shingles;
* ``LANES`` values modulo 2^64 of a keyed cryptographic hash of its bytes, which decide
  equality;
* ``BUCKETS`` sums modulo 2^32: every run of three words (a shorter paragraph: all
  its words) adds 1 or -1 to the bucket that its hash picks.  Inner products
  of these sums estimate those of the texts' shingle counts, with a standard
  error of about 1 / sqrt(BUCKETS); ``likeness`` is made of them.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.llm.common import CHUNK_BYTES, mix, others, read, word_hashes

LANES, BUCKETS, SHINGLE = 4, 128, 3
#: Key of the paragraph hash (fixed value).
_KEY = b"paragraph multiset 1"
_WIDE = 2 + LANES                                   # places modulo 2^64
SIZE = 8 * _WIDE + 4 * BUCKETS                      # bytes of a fingerprint
#: Parts of the ordered table per shuffle partition, and sampled keys per part and in all (Spark's own range sampling has the same bounds).
PARTS, KEYS_PER_PART, MOST_KEYS = 4, 20, 1_000_000


class Vectors:
    """Fingerprints of some texts: ``wide`` (n, 2 + LANES) modulo 2^64, ``narrow`` (n, BUCKETS) modulo 2^32."""

    def __init__(self, wide: np.ndarray, narrow: np.ndarray):
        self.wide, self.narrow = wide, narrow

    def __add__(self, other: Vectors) -> Vectors:
        return Vectors(self.wide + other.wide, self.narrow + other.narrow)

    def __sub__(self, other: Vectors) -> Vectors:
        return Vectors(self.wide - other.wide, self.narrow - other.narrow)

    def __getitem__(self, at) -> Vectors:
        return Vectors(self.wide[at], self.narrow[at])

    def texts(self) -> list[str]:
        """Base64 of the little-endian places."""
        raw = np.concatenate([self.wide.astype("<u8").view(np.uint8), self.narrow.astype("<u4").view(np.uint8)], axis=1).tobytes()
        return [base64.b64encode(raw[i:i + SIZE]).decode() for i in range(0, len(raw), SIZE)]

    @staticmethod
    def parse(texts: Sequence[str]) -> Vectors:
        raw = np.frombuffer(b"".join([base64.b64decode(t) for t in texts]), np.uint8).reshape(-1, SIZE)
        return Vectors(np.ascontiguousarray(raw[:, :8 * _WIDE]).view("<u8").astype(np.uint64),
                       np.ascontiguousarray(raw[:, 8 * _WIDE:]).view("<u4").astype(np.uint32))

    def likeness(self, other: Vectors) -> np.ndarray:
        """0 to 1 for each pair of rows: 2 x.y / (x.x + y.y) of the bucket sums; equal fingerprints have 1, texts without words else 0."""
        x, y = (v.narrow.astype(np.int32).astype(np.float64) for v in (self, other))
        both = (x * x).sum(1) + (y * y).sum(1)
        out = np.clip(2 * (x * y).sum(1) / np.where(both == 0, 1, both), 0, 1)
        return np.where((self.wide == other.wide).all(1) & (self.narrow == other.narrow).all(1), 1.0, out)


def _shingle_sums(raws: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, bucket sums) of some texts, in one vectorised step."""
    joined = b"\n".join(raws)
    h, start, _ = word_hashes(joined, lower=False)
    n = len(raws)
    if not len(h):
        return np.zeros(n, np.uint64), np.zeros((n, BUCKETS), np.uint32)
    lines = np.flatnonzero(np.frombuffer(joined, np.uint8) == 10)
    line = np.searchsorted(lines, start)
    owner = np.searchsorted(np.cumsum([len(x) + 1 for x in raws]), start, side="right")
    first = np.flatnonzero(np.diff(line, prepend=-1))
    size = np.diff(np.append(first, len(line)))
    # Words that follow within the paragraph, at most SHINGLE - 1 of them.
    left = np.minimum(np.repeat(first + size, size) - np.arange(len(h)), SHINGLE)
    starts = (left == SHINGLE) | (np.repeat(size, size) < SHINGLE) & (np.arange(len(h)) == np.repeat(first, size))
    run = np.zeros(len(h), np.uint64)
    for i in range(SHINGLE):
        there = left > i
        run[there] = mix(run[there] ^ h[np.flatnonzero(there) + i])
    run, owner = mix(run[starts] + left[starts].astype(np.uint64)), owner[starts]
    sign = 1.0 - 2.0 * ((run >> np.uint64(40)) & np.uint64(1)).astype(np.float64)
    place = owner * BUCKETS + (run % np.uint64(BUCKETS)).astype(np.int64)
    sums = np.bincount(place, weights=sign, minlength=n * BUCKETS).reshape(n, BUCKETS)
    return np.bincount(owner, minlength=n).astype(np.uint64), sums.astype(np.int64).astype(np.uint32)


def vectors(raws: Sequence[bytes | None]) -> Vectors:
    """Fingerprint vectors of UTF-8 texts; None stands for no paragraph at all (the zero vector)."""
    digests, count = [], []
    for raw in raws:
        paragraphs = () if raw is None else raw.split(b"\n")
        count.append(len(paragraphs))
        digests += [hashlib.blake2b(p, digest_size=8 * LANES, key=_KEY).digest() for p in paragraphs]
    count = np.array(count, np.int64)
    sums = np.zeros((len(raws) + 1, LANES), np.uint64)
    if digests:
        every = np.concatenate([np.zeros((1, LANES), np.uint64), np.cumsum(np.frombuffer(b"".join(digests), "<u8").reshape(-1, LANES), axis=0, dtype=np.uint64)])
        sums = every[np.concatenate([[0], np.cumsum(count)])]
    shingles, narrow = _shingle_sums([raw or b"" for raw in raws])
    wide = np.concatenate([count.astype(np.uint64)[:, None], shingles[:, None], np.diff(sums, axis=0)], axis=1)
    return Vectors(wide, narrow)


def fingerprint(text: str | None) -> str:
    """Fingerprint of one text (null: empty)."""
    return vectors([(text or "").encode()]).texts()[0]


def inserted(print_: str, paragraphs: str) -> str:
    """The fingerprint after the paragraphs of a text are inserted, wherever they go."""
    return (Vectors.parse([print_]) + vectors([paragraphs.encode()])).texts()[0]


def deleted(print_: str, paragraphs: str) -> str:
    """The fingerprint after the paragraphs of a text are deleted."""
    return (Vectors.parse([print_]) - vectors([paragraphs.encode()])).texts()[0]


def _chunks(items: Iterable[tuple], held) -> Iterator[list[tuple]]:
    """Lists of items of some CHUNK_BYTES (one item at least); ``held`` gives an item's bytes."""
    out, size = [], 0
    for item in items:
        out.append(item)
        size += held(item)
        if size >= CHUNK_BYTES:
            yield out
            out, size = [], 0
    if out:
        yield out


def fingerprint_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``fingerprint`` (one of that name is replaced).

    Null and empty texts alike have the fingerprint of one empty paragraph.
    Repeated rows and equal texts have equal fingerprints; texts of any length
    are read whole; an empty table gives an empty table.
    """
    kept = others(docs, ["fingerprint"])
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            prints = [p for some in _chunks(((t,) for t in texts), lambda x: len(x[0])) for p in vectors([t for t, in some]).texts()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), pa.array(prints, pa.string())], names=[*kept, "fingerprint"])

    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    return docs.select(*[F.col(f"`{c}`") for c in kept], text.alias("__text")).mapInArrow(run, schema)


def combined(prints: DataFrame, keys: Sequence[str], col: str = "fingerprint") -> DataFrame:
    """(keys, fingerprint of all the group's paragraphs together).

    Fingerprints add up, so every task first sums its own rows of each group; a group
    gathers one fingerprint from each task at most (two beyond 50,000 groups a task, and so on).
    Null fingerprints are left out; null keys are a group.
    """
    schema = prints.select(*keys, F.col(col).alias("fingerprint")).schema

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, Vectors] = {}
        for frame in frames:
            for key, print_ in zip(zip(*(frame[k].astype(object).where(frame[k].notna(), None) for k in keys)), frame["fingerprint"]):
                one = Vectors.parse([print_])
                held[key] = held[key] + one if key in held else one
            if len(held) > 50_000:
                yield _frame(held)
                held = {}
        if held:
            yield _frame(held)

    def _frame(held: dict) -> pd.DataFrame:
        return pd.DataFrame([(*k, v.texts()[0]) for k, v in held.items()], columns=[*keys, "fingerprint"])

    own = prints.where(F.col(col).isNotNull()).select(*keys, F.col(col).alias("fingerprint")).mapInPandas(sums, schema)
    settled = own.groupBy(*keys).agg(F.collect_list("fingerprint").alias("all"))
    return settled.select(*keys, F.pandas_udf(_total, "string")("all").alias("fingerprint"))


def _total(lists: pd.Series) -> pd.Series:
    out = []
    for prints in lists:
        v = Vectors.parse(list(prints))
        out.append(Vectors(v.wide.sum(0, dtype=np.uint64)[None], v.narrow.sum(0, dtype=np.uint32)[None]).texts()[0])
    return pd.Series(out, dtype=object)


# ---- every document beside the next one ----------------------------------------------------


def _order(id_col: str, text: Column) -> list[Column]:
    """Order of documents: null ids first, ids ascending, documents of one id by a hash of their text."""
    return [F.col(f"`{id_col}`").isNotNull().alias("__known"), F.col(f"`{id_col}`").alias("__id"), F.xxhash64(text).alias("__h")]


def _bounds(keys: DataFrame, parts: int) -> list[tuple]:
    """At most ``parts`` - 1 keys that divide a sample of the keys evenly; a key of many rows stands there repeatedly."""
    rows = keys.count()
    want = min(KEYS_PER_PART * parts, MOST_KEYS)
    drawn = sorted(_sortable(tuple(r)) for r in keys.sample(fraction=min(1.0, want / max(rows, 1)), seed=7).collect())
    return [drawn[len(drawn) * i // parts] for i in range(1, parts)] if drawn else []


def _sortable(key: tuple) -> tuple:
    return key if key[0] else (False, 0, key[2])


def beside_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(__part, __known, __id, __h, __ahead, __text), dealt by ``__part`` and sorted: each document stands before the next one.

    Parts are ranges of the order, cut at sampled keys; equal rows beyond one part's
    share go to several parts, at random, since any of them may come
    first.  Each part ends with a copy of the next part's first document
    (``__ahead``), the last one's is the first document of all, so no row needs
    another part and the texts are shuffled once.
    The driver holds the sampled keys and one key for each part.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    keyed = docs.select(*_order(id_col, text), text.alias("__text"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(keyed.select("__known", "__id", "__h"), PARTS * partitions)

    @F.pandas_udf("int")
    def part(known: pd.Series, id_: pd.Series, h: pd.Series) -> pd.Series:
        out = []
        for i, key in enumerate(zip(known, id_, h)):
            key = _sortable(key)
            last = bisect_right(bounds, key)
            first = last
            while first and bounds[first - 1] == key:
                first -= 1
            # Equal rows fill the parts between their equal bounds in turn.
            out.append(last if last - first < 2 else first + 1 + i % (last - first))
        return pd.Series(out, dtype="int32")

    parted = keyed.withColumn("__part", part("__known", "__id", "__h"))
    firsts = sorted(parted.groupBy("__part").agg(F.min(F.struct("__known", "__id", "__h")).alias("k")).collect())
    schema = T.StructType([T.StructField("__to", T.IntegerType()), *[T.StructField(f"{c}2", keyed.schema[c].dataType) for c in ("__known", "__id", "__h")]])
    heads = spark.createDataFrame([(firsts[i - 1][0], *firsts[i][1]) for i in range(len(firsts))], schema)
    # At most PARTS x shuffle partitions rows of four numbers.
    ahead = keyed.join(F.broadcast(heads), (F.col("__h") == F.col("__h2")) & (F.col("__known") == F.col("__known2")) & F.col("__id").eqNullSafe(F.col("__id2"))) \
        .dropDuplicates(["__to"]).select(F.col("__to").alias("__part"), *keyed.columns, F.lit(True).alias("__ahead"))
    every = parted.select("__part", *keyed.columns, F.lit(False).alias("__ahead")).unionByName(ahead)
    return every.repartition(partitions, "__part").sortWithinPartitions("__part", "__ahead", "__known", "__id", "__h")


def _valid(raw: bytes) -> bytes:
    """``raw`` with replacement characters where it isn't UTF-8."""
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        return raw.decode("utf-8", "replace").encode()


def edited_prints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every document and of its edited text, with their likeness and that to the next document.

    The edited text has the last quarter of the code points (rounded down) replaced by
    the first as many, or all, of the next document: ascending id,
    null ids first, documents of one id by a hash of their text; after the last
    comes the first, which may be the document itself.  Its fingerprint is the document's less the paragraphs that the edit
    touches plus those that it makes.  Null texts count as empty; repeated rows each give a row, and one
    of them stands before the next other document; whole texts of any
    length are read; an empty table gives an empty one.  Returns ``id_col``, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    names = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [T.LongType(), T.StringType(), T.StringType(), T.StringType(), T.DoubleType(), T.DoubleType()]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *map(T.StructField, names, kinds)])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(id, text, next text) of the rows that are no copies, with one row of lookahead."""
        before = None
        for batch in batches:
            for part, ahead, id_, text in zip(*(c.to_pylist() for c in batch.columns)):
                text = _valid(text)
                if before and before[0] == part and not before[1]:
                    yield before[2], before[3], text
                before = (part, ahead, id_, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def typed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in source:
                kind = batch.schema.field(2).type
                yield batch

        for some in _chunks(rows(typed(batches)), lambda r: len(r[1]) + len(r[2]) // 4):
            heads, tails, ends, after, n_chars, shas = [], [], [], [], [], []
            for _, raw, following in some:
                text = raw.decode()
                n, cut = len(text), len(text) - len(text) // 4
                edited = (text[:cut] + following[:4 * (n - cut)].decode("utf-8", "ignore")[:n - cut]).encode()
                # Paragraphs before the one with the cut stay.
                at = cut if n == len(raw) else len(text[:cut].encode())
                at = raw.rfind(b"\n", 0, at) + 1
                heads.append(raw[:at - 1] if at else None)
                tails.append(raw[at:])
                ends.append(edited[at:])
                after.append(following)
                n_chars.append(n)
                shas.append(hashlib.sha256(edited).hexdigest())
            stays, goes, comes = vectors(heads), vectors(tails), vectors(ends)
            own = stays + goes
            changed = own - goes + comes
            # The next document is the next row, but for the last of a chunk or part.
            follows = [i + 1 if i + 1 < len(some) and some[i + 1][1] is after[i] else -1 for i in range(len(some))]
            alone = [i for i, f in enumerate(follows) if f < 0]
            other = vectors([after[i] for i in alone])
            at = np.array(follows)
            nexts = Vectors(own.wide[at], own.narrow[at])
            nexts.wide[alone], nexts.narrow[alone] = other.wide, other.narrow
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in some], kind), pa.array(n_chars, pa.int64()), pa.array(shas, pa.string()),
                 pa.array(own.texts(), pa.string()), pa.array(changed.texts(), pa.string()),
                 pa.array(own.likeness(changed), pa.float64()), pa.array(own.likeness(nexts), pa.float64())], names=[id_col, *names])

    dealt = beside_next(docs, id_col, text_col)
    return dealt.select("__part", "__ahead", "__id", F.col("__text").cast("binary").alias("__text")).mapInArrow(run, schema)


def op13_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_prints(read(spark, sf_dir, "documents").select("doc_id", "text"))
