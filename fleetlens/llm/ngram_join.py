"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document is the set of its distinct word shingles (hashes).  Two sets with
Jaccard similarity t or more share l tokens among their first
``size - ceil(t * size) + l`` tokens in any common order, for every l.  Tokens
are ordered rarest first, by a count sketch over all documents.  Each
document picks its own l: the prefix grows by one token per
step, and a pair has to be met under l prefix tokens (the smaller l of the
two) before it is verified.  The choice minimises
``prefix length + estimated candidates / l * cost of verifying one``, so long
documents and those whose prefix tokens are shared widely take longer prefixes.

Only links between *different* sets matter for components:

* equal sets fall together by a 64-bit key of the set;
* rows that meet under a prefix token carry size, position and a parity
  signature (the bits in which two signatures differ never outnumber the tokens
  in which the sets do), so what cannot be similar goes no further;
* *first*, each document is verified against the partner it met most often, and
  what links is contracted: a group of thousands of near copies costs thousands of
  verifications, not all its pairs;
* *then* the rows that still meet a document of another component are dealt
  into buckets, tokens with the same sets together.  Each bucket first gets the long signature of every set, which has a bit
  for each token, and then once the sets of the rows that it leaves with a partner.  There a
  pair that shares l prefix tokens is verified, exactly, unless links found in
  the bucket already join its components.  A bucket gives only the links
  that join components, so no list of pairs is ever made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.llm.common import (TOKEN_BITS, TOKEN_BYTES, bounded, chunk_words, chunks, keep, mix, packed_sets, read, scaled_signatures, shingle_hashes,
                                   signatures, token_bytes, tokens_from, written)
from fleetlens.llm.components import components
from fleetlens.llm.set_join import BLOCK, GROUP, Signatures, by_group_and_size, in_blocks, pair_steps, plausible, required, verified, whole_groups

SKETCH = 1 << 18
#: Matches that may be required, besides a 128th, 64th and 32nd of a set's size.
MATCHES = (1, 2, 3, 4, 8)
#: Tokens verified at the cost of one prefix token.
VERIFY_TOKENS = 50
#: Rows of a bucket in which pairs are verified, and bytes of its sets, as expected at most.
BUCKET_ROWS = 40_000
BUCKET_BYTES = 64 << 20
#: Pairs found unlike that a bucket remembers; beyond that it forgets them and may look at one again.
REMEMBERED = 1 << 20
#: Documents that a rare token is expected to meet by chance.
CHANCE = 0.5
#: Words, at least, of the signature kept with the set, and those of the shorter one in prefix rows.
SIGNATURE_WORDS = 8
ROW_SIGNATURE_WORDS = 2
#: Node lists up to this many (32 MB) are broadcast to filter the sets; longer ones are joined by shuffle.
MAX_BROADCAST_NODES = 4_000_000


def shingle_chunk(texts: list[tuple[int, bytes]], n: int) -> tuple[np.ndarray, ...]:
    """(hash, text number, first word, last word) of the shingles of some texts, and the word hashes."""
    words, owner = chunk_words([x for _, x in texts])
    if not len(words):
        return words, owner, owner, owner, words
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    counts = np.diff(np.append(starts, len(owner)))
    first = np.arange(max(len(words) - n + 1, 0))
    first = first[owner[first] == owner[first + n - 1]]
    hashes = np.zeros(len(first), np.uint64)
    for i in range(n):
        hashes = mix(hashes ^ words[first + i])
    short = np.flatnonzero(counts < n)             # texts of fewer words are one shingle
    if len(short):
        more = np.concatenate([shingle_hashes(words[starts[i]:starts[i] + counts[i]], n) for i in short])
        hashes, first = np.concatenate((hashes, more)), np.concatenate((first, starts[short]))
    last = np.minimum(first + n - 1, (starts + counts - 1)[np.searchsorted(starts, first, side="right") - 1])
    return hashes, owner[first], first, last, words


def texts_of(texts: list[str | None]) -> Iterator[tuple[int, bytes]]:
    for row, text in enumerate(texts):
        if text:
            yield row, text.encode("utf-8", "surrogatepass")


def bucket(hashes: np.ndarray) -> np.ndarray:
    """Sketch bucket of 64-bit hashes (that of the token kept of them)."""
    return ((hashes >> np.uint64(64 - TOKEN_BITS)) % np.uint64(SKETCH)).astype(np.int64)


def sketch(docs: DataFrame, n: int) -> np.ndarray:
    """Occurrences of words (first SKETCH numbers) and shingles (next SKETCH) by hash bucket, over all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * SKETCH, dtype=np.int64)
        for batch in batches:
            for chunk in chunks(texts_of(batch.column(0).to_pylist())):
                hashes, _, _, _, words = shingle_chunk(chunk, n)
                total[:SKETCH] += np.bincount(bucket(words), minlength=SKETCH)
                total[SKETCH:] += np.bincount(bucket(hashes), minlength=SKETCH)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["b", "c"])

    table = docs.select(F.col("text").cast("string")).mapInArrow(count, "b int, c bigint").groupBy("b").agg(F.sum("c").alias("c")).toArrow()
    out = np.zeros(2 * SKETCH, dtype=np.int64)                # at most 2 * SKETCH rows
    out[table["b"].to_numpy()] = table["c"].to_numpy()
    return out


class Rarity:
    """The common order of shingles: by frequency as far as the sketch shows it, else by that of their words.

    A shingle that occurs no more often than its bucket's noise is placed by
    the frequency it would have if its words were independent.
    """

    def __init__(self, counts: np.ndarray):
        words, self.seen = counts[:SKETCH], counts[SKETCH:]
        self.total = max(int(words.sum()), 2)
        # In whole 1/1024ths, so that sums do not depend on where in a chunk a shingle stands.
        self.log_words = np.round(1024 * np.log2(self.total / np.maximum(words, 1))).astype(np.int64)
        mean = self.seen.mean()
        self.noise = mean + 3 * np.sqrt(mean)

    def measure(self, hashes: np.ndarray, first: np.ndarray, last: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Level, 0 (rarest) to 15, of each shingle."""
        sums = np.concatenate(([0], np.cumsum(self.log_words[bucket(words)])))
        expected = np.log2(self.total) - (sums[last + 1] - sums[first]) / 1024
        hot = np.log2(np.maximum(self.seen[bucket(hashes)] / max(self.noise, 1.0), 1.0))
        return np.clip(np.maximum((expected + 24) // 2.5, np.where(hot > 1, 8 + hot, 0)), 0, 15).astype(np.uint64)


_DESCRIBED = "doc_id bigint, text_key bigint, k bigint, n int, matches int, prefix array<bigint>, s0 bigint, s1 bigint, sig binary"


def choose_matches(size: np.ndarray, first: np.ndarray, excess: np.ndarray, percent: int) -> np.ndarray:
    """Prefix tokens to be shared, for each set: the number with the least estimated cost.

    The cost is the prefix' length, and the estimated candidates (documents met
    under the prefix tokens, over the matches required) times that of a
    verification, which grows with the set.
    """
    least = -(-percent * size // 100)
    sums = np.concatenate(([0.0], np.cumsum(excess)))
    best, cost = np.ones(len(size), np.int64), np.full(len(size), np.inf)
    for m in [np.full(len(size), x) for x in MATCHES] + [size // x for x in (128, 64, 32)]:
        m = np.maximum(m, 1)
        length = size - least + m
        met = sums[first + np.minimum(length, size)] - sums[first]
        new = np.where(m <= least, length + size / VERIFY_TOKENS * met / m, np.inf)
        best, cost = np.where(new < cost, m, best), np.minimum(cost, new)
    return best


def describe(docs: DataFrame, counts: np.ndarray, n: int, percent: int) -> DataFrame:
    """Per row: set key ``k`` (null for empty sets) and size; short signature; prefix and long signature once per key and task."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    names = ["doc_id", "text_key", "k", "n", "matches", "prefix", "s0", "s1", "sig"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        rarity = Rarity(shared.value)
        for batch in batches:
            texts, with_words = batch.column(2).to_pylist(), np.zeros(batch.num_rows, bool)
            for chunk in chunks(texts_of(texts)):
                rows = np.array([row for row, _ in chunk])
                hashes, owner, begin, end, words = shingle_chunk(chunk, n)
                owner, size, key, first, token = packed_sets(hashes, owner, rarity.measure(hashes, begin, end, words))
                if not len(size):
                    continue
                with_words[rows[owner]] = True
                excess = np.maximum(rarity.seen[(token % np.uint64(SKETCH)).astype(np.int64)] - rarity.noise, 0.0) + CHANCE
                matches = choose_matches(size, first, excess, percent)
                short = signatures(token, size, 64 * ROW_SIGNATURE_WORDS).view(np.int64)
                long = scaled_signatures(token, size, 64 * SIGNATURE_WORDS)
                prefix, sig = [], []
                for i, k in enumerate(key.tolist()):
                    a, b = first[i], first[i] + size[i]
                    new = k not in seen
                    seen.add(k)
                    prefix.append(token[a:b - (-(-percent * size[i] // 100)) + matches[i]].view(np.int64) if new else None)
                    sig.append(long[i] if new else None)
                at = pa.array(rows[owner])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(key), pa.array(size.astype(np.int32)), pa.array(matches.astype(np.int32)),
                     pa.array(prefix, pa.list_(pa.int64())), pa.array(short[:, 0]), pa.array(short[:, 1]), pa.array(sig, pa.binary())], names=names)
            none = pa.array(np.flatnonzero(~with_words))
            if len(none):
                nulls = [pa.nulls(len(none), t) for t in (pa.int32(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(none), batch.column(1).take(none), pa.nulls(len(none), pa.int64()),
                                                  pa.array(np.zeros(len(none), np.int32)), *nulls], names=names)

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint"), F.xxhash64(text), text).mapInArrow(run, _DESCRIBED)


#: ``np``: size and position in the prefix.
_PREFIXES = "token bigint, k bigint, np bigint, s0 bigint, s1 bigint, hot boolean"
_MET = "token bigint, bi int, bj int, block int, k bigint, np bigint, s0 bigint, s1 bigint, v bigint"


def prefixes(described: DataFrame, counts: np.ndarray) -> DataFrame:
    """The prefix rows of every set; a set may come once per task."""
    shared = described.sparkSession.sparkContext.broadcast(counts[SKETCH:] > BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            k, n, s0, s1 = (batch.column(i).to_numpy() for i in range(4))
            lists = batch.column(4)
            length = np.diff(lists.offsets.to_numpy())
            token = lists.flatten().to_numpy()
            pos = np.arange(len(token)) - np.repeat(np.cumsum(length) - length, length)
            packed = np.repeat(n.astype(np.int64) << 32, length) | pos
            yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(np.repeat(k, length)), pa.array(packed), pa.array(np.repeat(s0, length)),
                                              pa.array(np.repeat(s1, length)), pa.array(shared.value[token % SKETCH])],
                                             names=["token", "k", "np", "s0", "s1", "hot"])

    return described.where(F.col("prefix").isNotNull()).select("k", "n", "s0", "s1", "prefix").mapInArrow(run, _PREFIXES)


def compared(number: np.ndarray, table: pa.Table, percent: int, allowed: Callable[..., np.ndarray] | None = None) -> tuple:
    """(rows, steps): the rows, one per set and group, and the pairs i < j that pass the filters (and ``allowed``), step by step."""
    k, packed = (table.column(x).to_numpy() for x in ("k", "np"))
    order = by_group_and_size(number, table, packed >> 32)
    packed = packed[order]
    rows = {"n": packed >> 32, "pos": packed & 0xFFFFFFFF, "block": table.column("block").to_numpy()[order],
            "cut": (table.column("bi").to_numpy() != table.column("bj").to_numpy())[order]}
    sig = np.column_stack([table.column(c).to_numpy()[order] for c in ("s0", "s1")]).view(np.uint64)
    return order, pair_steps(number[order], rows, sig, percent, None if allowed is None else lambda i, j: allowed(order[i], order[j]))


def joined_under_tokens(rows: DataFrame, percent: int) -> DataFrame:
    """The rows of sets that have a partner passing all filters; ``v`` is one of them (null for the first of a group)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in whole_groups(batches):
            order, steps = compared(number, table, percent)
            best, used = np.full(len(order), len(order), np.int64), np.zeros(len(order), bool)
            for i, j in steps:                     # no row comes twice on one side
                best[j] = np.minimum(best[j], i)
                used[i] = used[j] = True
            used = np.flatnonzero(used)
            if not len(used):
                continue
            k = table.column("k").to_numpy()[order]
            none = best[used] == len(order)
            v = pa.array(k[np.where(none, 0, best[used])], mask=none)
            out = table.take(pa.array(order[used])).select(["token", "bi", "bj", "block", "k", "np", "s0", "s1"]).append_column("v", v)
            yield from out.combine_chunks().to_batches()

    return in_blocks(rows).mapInArrow(run, _MET)


def sets_of(docs: DataFrame, described: DataFrame, nodes: DataFrame, counts: np.ndarray, n: int) -> DataFrame:
    """(k, tokens) of the sets ``nodes``, from the text of one document each."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    one = described.where(F.col("prefix").isNotNull()).join(bounded(nodes, MAX_BROADCAST_NODES), "k", "left_semi") \
        .groupBy("k").agg(F.min(F.struct("doc_id", "text_key")).alias("at"))
    wanted = bounded(written(one.select(F.col("at.doc_id").alias("__id"), F.col("at.text_key").alias("__key")).distinct(), "ngram-wanted"))
    text = F.col("text").cast("string")
    joined = docs.select(F.col("doc_id").cast("bigint"), text.alias("text")) \
        .join(wanted, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__key")), "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity = Rarity(shared.value)
        seen: set[int] = set()
        for batch in batches:
            for chunk in chunks(texts_of(batch.column(0).to_pylist())):
                hashes, owner, begin, end, words = shingle_chunk(chunk, n)
                _, size, key, first, token = packed_sets(hashes, owner, rarity.measure(hashes, begin, end, words))
                new = [i for i, k in enumerate(key.tolist()) if k not in seen and not seen.add(k)]
                raw = token_bytes(token)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[new]), pa.array([raw[first[i]:first[i] + size[i]].tobytes() for i in new], pa.binary())], names=["k", "tokens"])

    # Equal rows in several tasks give a set several times, and then a pair; that changes no component.
    return joined.mapInArrow(run, "k bigint, tokens binary")


def _of_mixed_groups(met: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of groups in which several components meet, with their component ``c``."""
    by_group = Window.partitionBy(*GROUP)
    return met.drop("v").join(roots.withColumnRenamed("node", "k"), "k", "left").withColumn("c", F.coalesce("root", "k")).drop("root") \
        .withColumn("low", F.min("c").over(by_group)).withColumn("high", F.max("c").over(by_group)).where("low <> high").drop("low", "high")


def contested(rows: DataFrame, percent: int) -> DataFrame:
    """The rows (together by GROUP) that have a partner of another component ``c`` passing all filters, with the smallest such set ``low`` of their group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in whole_groups(batches):
            c, k = table.column("c").to_numpy(), table.column("k").to_numpy()
            order, steps = compared(number, table, percent, lambda x, y: c[x] != c[y])
            used = np.zeros(len(order), bool)
            for i, j in steps:
                used[i] = used[j] = True
            if used.any():
                at = order[used]
                low = np.full(number[-1] + 1, np.iinfo(np.int64).max)
                np.minimum.at(low, number[at], k[at])
                yield from table.take(pa.array(at)).append_column("low", pa.array(low[number[at]])).combine_chunks().to_batches()

    return rows.sortWithinPartitions(*GROUP).mapInArrow(run, T.StructType([*rows.schema, T.StructField("low", T.LongType())]))


def _in_groups(table: pa.Table, sets: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """(rows sorted by GROUP, group number, place of each row's set in ``sets``)."""
    table = table.sort_by([(c, "ascending") for c in GROUP])
    keys = [table.column(c).to_numpy() for c in GROUP]
    number = np.cumsum(np.any([np.diff(x, prepend=x[:1]) != 0 for x in keys], axis=0))
    by_key = np.argsort(sets.column("key").to_numpy(), kind="stable")
    return table, number, by_key[np.searchsorted(sets.column("key").to_numpy(), table.column("k").to_numpy(), sorter=by_key)]


def still_contested(table: pa.Table, sets: pa.Table, percent: int) -> pa.Table:
    """The ``contested`` rows whose long signature (``sets``: key, sig) allows a partner of another component."""
    table, number, at = _in_groups(table, sets)
    c, n, long = table.column("c").to_numpy(), table.column("np").to_numpy() >> 32, Signatures(sets.column("sig").to_pylist())

    def may(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        ok = c[x] != c[y]
        x, y = x[ok], y[ok]
        ok[ok] = long.apart(at[x], at[y]) <= n[x] + n[y] - 2 * required(n[x], n[y], percent)
        return ok

    order, steps = compared(number, table, percent, may)
    used = np.zeros(len(order), bool)
    for i, j in steps:
        used[i] = used[j] = True
    return table.take(pa.array(order[used])).drop_columns(["bucket"])


def joining_links(table: pa.Table, sets: pa.Table, percent: int) -> pa.Table:
    """(u, v): links between rows (``contested``) of different components, as many as join what can be joined.

    ``sets``: key, matches, long signature and tokens (in prefix order) of every set among the rows.
    """
    table, number, place = _in_groups(table, sets)
    k, n, matches = table.column("k").to_numpy(), table.column("np").to_numpy() >> 32, sets.column("matches").to_numpy()[place]
    at, long = place.tolist(), Signatures(sets.column("sig").to_pylist())
    tokens = sets.column("tokens")
    _, parent = np.unique(table.column("c").to_numpy(), return_inverse=True)      # component of each row, as joined so far
    links = []

    def may(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        ok = parent[x] != parent[y]
        x, y = x[ok], y[ok]
        ok[ok] = long.apart(place[x], place[y]) <= n[x] + n[y] - 2 * required(n[x], n[y], percent)
        return ok

    order, steps = compared(number, table, percent, may)
    unlike: set[tuple[int, int]] = set()
    length = n - -(-percent * n // 100) + matches
    for i, j in steps:
        for x, y in zip(order[i].tolist(), order[j].tolist()):
            pair = at[x], at[y]
            if pair in unlike or parent[x] == parent[y]:
                continue
            s, t = (tokens_from(tokens[r].as_buffer()) for r in pair)
            met = len(np.intersect1d(s[:length[x]], t[:length[y]], assume_unique=True))
            same = len(np.intersect1d(s, t, assume_unique=True)) if met >= min(matches[x], matches[y]) else 0
            if 100 * same >= percent * (len(s) + len(t) - same):
                links.append((k[x], k[y]))
                parent[parent == parent[x]] = parent[y]
            else:
                if len(unlike) == REMEMBERED:
                    unlike.clear()
                unlike.add(pair)
    u, v = (np.array([x[side] for x in links], np.int64) for side in (0, 1))
    return pa.table({"u": np.maximum(u, v), "v": np.minimum(u, v)})


def in_buckets(rows: DataFrame, held: Callable[[DataFrame], DataFrame], token_size: float, run: Callable[[pa.Table, pa.Table], pa.Table], schema) -> DataFrame:
    """``run(rows, sets)`` for every bucket of rows; ``held(nodes)`` gives what is needed of sets (key, ...), some ``token_size`` bytes a token.

    Groups with the same smallest set ``low`` go to one bucket, since they mostly have
    the same sets: a set is copied once for each such smallest set, not for each
    token.  Smallest sets with more than ``BUCKET_ROWS`` rows are salted.
    Buckets are as many as keep their rows, and the bytes of their sets, near the bounds above.
    """
    many = rows.groupBy("low").count().where(F.col("count") > BUCKET_ROWS) \
        .select(F.col("low").alias("__low"), F.ceil(F.col("count") / BUCKET_ROWS).alias("__salts"))
    many = bounded(written(many, "ngram-hot-buckets"))
    salt = F.pmod(F.xxhash64(*GROUP), F.coalesce("__salts", F.lit(1)))
    place = rows.join(many, F.col("low") == F.col("__low"), "left").withColumn("place", F.xxhash64("low", salt)).drop("__low", "__salts")
    wanted = written(place.groupBy("place", "k").agg(F.count("*").alias("rows"), F.max(F.shiftright("np", 32)).alias("n")), "ngram-wanted-sets")
    count, total = wanted.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    buckets = max(1, -(-count // BUCKET_ROWS), int(total * token_size) // BUCKET_BYTES + 1)
    bucket = F.pmod("place", F.lit(buckets))
    asked = wanted.select(bucket.alias("place"), F.col("k").alias("key")).distinct().join(held(wanted.select("k").distinct()), "key")
    return place.withColumn("bucket", bucket).drop("place").groupBy("bucket").cogroup(asked.groupBy("place")).applyInArrow(run, schema)


def links_across(met: DataFrame, roots: DataFrame, known: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """(u, v): links that join the components ``roots`` as far as any similar pairs do; ``sets(nodes)`` gives the sets of nodes,
    ``known`` their ``matches`` and long signature."""
    rows = written(contested(_of_mixed_groups(met, roots), percent), "ngram-mixed")
    described = known.select(F.col("k").alias("key"), "matches", "sig")
    # A signature has some bits for each token.
    rows = in_buckets(rows, lambda nodes: described, 0.25, lambda x, y: still_contested(x, y, percent), rows.schema)
    rows = written(rows, "ngram-contested")

    def held(nodes: DataFrame) -> DataFrame:
        return sets(written(nodes, "ngram-nodes")).dropDuplicates(["k"]).select(F.col("k").alias("key"), "tokens").join(described, "key")

    return in_buckets(rows, held, TOKEN_BYTES + 0.25, lambda x, y: joining_links(x, y, percent), "u bigint, v bigint")


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, ``text_key`` (hash of the text), ``n_shingles``,
    ``set_key``, ``component`` (a set key) and ``component_id``.

    ``component_id`` is the smallest doc_id among the rows that links reach
    from this row (null ids count for nothing; null if there is none).  Null,
    empty and blank texts have an empty set, a null ``set_key`` and link with
    nothing.  Repeated rows have equal sets and share a component.  Texts of
    any length are read whole.  Columns beside doc_id and text do not matter.
    An empty table gives an empty result.
    """
    docs = docs.select("doc_id", "text")
    counts = sketch(docs, n)
    described = written(describe(docs, counts, n, percent), "ngram-sets")
    met = written(joined_under_tokens(prefixes(described, counts), percent), "ngram-partners")
    known = written(described.where(F.col("prefix").isNotNull()).select("k", "n", "matches", "sig").distinct(), "ngram-known")
    matches = known.select("k", "matches")

    # Only the sets that something asks for are built.
    def sets(nodes: DataFrame) -> DataFrame:
        return written(sets_of(docs, described, nodes, counts, n), "ngram-shared-sets")

    # Each set is verified against the partner it met most often.
    best = met.where(F.col("v").isNotNull()).groupBy("k", "v").agg(F.count("*").alias("times")) \
        .groupBy("k").agg(F.max(F.struct("times", "v")).alias("best")) \
        .select(F.greatest("k", "best.v").alias("u"), F.least("k", "best.v").alias("v"), "best.times").distinct()
    often = best.join(matches.select(F.col("k").alias("u"), F.col("matches").alias("mu")), "u") \
        .join(matches.select(F.col("k").alias("v"), F.col("matches").alias("mv")), "v").where("times >= least(mu, mv)").select("u", "v")
    pairs = written(plausible(often, known, percent), "ngram-pairs")
    of_pairs = sets(written(pairs.select(F.col("u").alias("k")).union(pairs.select("v")).distinct(), "ngram-nodes"))
    links = written(verified(pairs, of_pairs, percent), "ngram-links")
    roots = written(components(links), "ngram-roots")

    links = written(links_across(met, roots, known, sets, percent).unionByName(links), "ngram-links")
    roots = components(links)

    ids = described.groupBy("k").agg(F.min("doc_id").alias("low"), F.max("n").alias("n_")).where(F.col("k").isNotNull())
    classes = ids.join(roots, ids["k"] == roots["node"], "left").select("k", "low", F.coalesce("root", "k").alias("component"))
    lowest = classes.groupBy("component").agg(F.min("low").alias("component_id"))
    classes = classes.join(lowest, "component").select(F.col("k").alias("set_key"), "component", "component_id")
    whole = described.select("doc_id", "text_key", F.col("n").cast("long").alias("n_shingles"), F.col("k").alias("set_key"))
    return whole.where(F.col("set_key").isNotNull()).join(classes, "set_key") \
        .unionByName(whole.where(F.col("set_key").isNull()).withColumn("component", F.lit(None).cast("long"))
                     .withColumn("component_id", F.col("doc_id"))) \
        .select("doc_id", "text_key", "n_shingles", "set_key", "component", "component_id")


def drop_near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component (the smallest doc_id; null ids come last) and every row with an empty set."""
    keyed = written(jaccard_components(docs, n, percent), "ngram-groups")
    rank = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "text_key")
    first = keyed.where(F.col("component").isNotNull()).groupBy("component").agg(F.min(rank).alias("first"))
    ranked = keyed.join(first, "component").withColumn("stays", F.col("first").eqNullSafe(rank))
    ids = [F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")]
    gone = bounded(written(ranked.where(~F.col("stays")).select(*ids).distinct(), "ngram-gone"))
    # A row that stays may itself be repeated, equal in id and text.
    twice = written(ranked.where("stays").groupBy(*ids).count().where("count > 1").drop("count"), "ngram-repeated")
    key = F.xxhash64(F.col("text").cast("string"))
    same = lambda other: docs["doc_id"].cast("bigint").eqNullSafe(other["__id"]) & (key == other["__key"])
    kept = docs.join(gone, same(gone), "left_anti")
    if not twice.isEmpty():
        again = kept.join(bounded(twice), same(twice), "left_semi").withColumn("__text_key", key)
        kept = kept.join(bounded(twice), same(twice), "left_anti").unionByName(again.dropDuplicates(["doc_id", "__text_key"]).drop("__text_key"))
    return kept


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(read(spark, sf_dir, "documents"), n=3, percent=90)
    return keep(found, ["text_key", "set_key", "component"])
