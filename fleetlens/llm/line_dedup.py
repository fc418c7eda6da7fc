"""Line dedup by an exact set-similarity join.

A line is the set of its lower-cased words.  Words are ordered rarest first
(by a count sketch over all documents); lines with Jaccard similarity t or
more share a word among their first ``n - ceil(t n) + 1`` words.  Lines that
meet under a prefix word pass the length filter, the positional filter and a
parity signature before their sets are verified exactly.

A line goes if *any* earlier line (by doc_id, then text, then line number) is
similar, removed or not; so the result does not depend on any order of work.
Equal sets form a class, whose first line alone can stay.  Classes are joined,
not lines; sets so small that only equal ones are similar (three words or fewer
at 80 percent) need the class alone.  The rows that meet under a word carry size, position and signature,
so all filters work where they meet; a pair counts under its first shared word
only, which bounds its overlap by what follows.  Only classes with a partner that
passes go on: first each is verified against its earliest such partner per
word, then those still standing against their other ones, where they meet.  Their sets are built
again from their lines; the sets of all lines are never written.  Under a frequent word
classes meet by size band, a class visiting the next band if it can have a partner there;
bands with more than ``BLOCK`` rows are cut into blocks, every pair of blocks in a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.llm.common import TOKEN_BITS, TOKEN_BYTES, bounded, bounded_lists, chunk_words, chunks, mix, others, packed_sets, read, signatures, token_bytes, tokens_from, written
from fleetlens.llm.set_join import BLOCK, GROUP, band_of, by_group_and_size, in_blocks, largest_partner, pair_steps, verified, whole_groups

SKETCH = 1 << 18
SIGNATURE_BITS = 128
#: Lines with fewer distinct words (those without any) are neither removed nor compared.
MIN_WORDS = 1
PERCENT = 80


def lines_of(texts: list[str | None]) -> Iterator[tuple[tuple[int, int], bytes]]:
    """((row, line number), line) of every line that is not empty."""
    for row, text in enumerate(texts):
        for number, line in enumerate((text or "").split("\n")):
            if line:
                yield (row, number), line.encode("utf-8", "surrogatepass")


def bucket(hashes: np.ndarray) -> np.ndarray:
    """Sketch bucket of 64-bit hashes (that of the token kept of them)."""
    return ((hashes >> np.uint64(64 - TOKEN_BITS)) % np.uint64(SKETCH)).astype(np.int64)


def sketch(docs: DataFrame) -> np.ndarray:
    """Word occurrences by hash bucket, over all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, dtype=np.int64)
        for batch in batches:
            for chunk in chunks(lines_of(batch.column(0).to_pylist())):
                total += np.bincount(bucket(chunk_words([x for _, x in chunk])[0]), minlength=SKETCH)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["b", "c"])

    table = docs.select("text").mapInArrow(count, "b int, c bigint").groupBy("b").agg(F.sum("c").alias("c")).toArrow()
    out = np.zeros(SKETCH, dtype=np.int64)                   # at most SKETCH rows
    out[table["b"].to_numpy()] = table["c"].to_numpy()
    return out


def levels(counts: np.ndarray) -> np.ndarray:
    """Rarity class (0 rarest, 15 most frequent) of each bucket."""
    return np.clip(np.log2(np.maximum(counts / max(np.median(counts), 1.0), 1.0)), 0, 15).astype(np.uint64)


_LINES = "doc_id bigint, text_key bigint, line int, k bigint, n int, s0 bigint, s1 bigint, prefix binary"


def describe(docs: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """Per line with MIN_WORDS words or more: its place, class key, size and signature; its prefix once per class and task.

    Sets that one more word would take below ``percent`` are similar to equal ones only: they have no prefix.
    """
    shared = docs.sparkSession.sparkContext.broadcast(levels(counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            for chunk in chunks(lines_of(batch.column(2).to_pylist())):
                rows, numbers = np.array([at for at, _ in chunk]).T
                h, owner = chunk_words([x for _, x in chunk])
                line, size, key, first, word = packed_sets(h, owner, shared.value[bucket(h)])
                long = np.flatnonzero(size >= MIN_WORDS)
                if not len(long):
                    continue
                raw, sig = token_bytes(word), signatures(word, size, SIGNATURE_BITS).view(np.int64)
                length = size - (-(-percent * size // 100)) + 1
                alone = 100 * size < percent * (size + 1)
                prefix = []
                for i in long.tolist():
                    k = int(key[i])
                    if alone[i]:
                        prefix.append(None)
                        continue
                    prefix.append(None if k in seen else raw[first[i]:first[i] + length[i]].tobytes())
                    seen.add(k)
                at = pa.array(rows[line[long]])
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), keys.take(at), pa.array(numbers[line[long]].astype(np.int32)), pa.array(key[long]),
                     pa.array(size[long].astype(np.int32)), pa.array(sig[long, 0]), pa.array(sig[long, 1]), pa.array(prefix, pa.binary())],
                    names=["doc_id", "text_key", "line", "k", "n", "s0", "s1", "prefix"])

    return docs.select("doc_id", "text_key", "text").mapInArrow(run, _LINES)


#: ``np``: size (high half), whether the row visits the next size band (bit 31) and position.
_PREFIXES = "token bigint, k bigint, np bigint, s0 bigint, s1 bigint, hot boolean"
_COLUMNS = ["token", "bi", "bj", "block", "k", "np", "s0", "s1"]
_MET = "token bigint, bi int, bj int, block int, k bigint, np bigint, s0 bigint, s1 bigint"
_LAST = (1 << 63) - 1


def prefixes(described: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """The prefix rows of every class; a class may come once per task.  The key of a frequent word includes the size band."""
    shared = described.sparkSession.sparkContext.broadcast(counts > BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            k, n, s0, s1 = (batch.column(i).to_numpy() for i in range(4))
            word = tokens_from(b"".join(batch.column(4).to_pylist()))
            length = np.diff(np.frombuffer(batch.column(4).buffers()[1], np.int32, batch.num_rows + 1, 4 * batch.column(4).offset)) // TOKEN_BYTES
            pos = np.arange(len(word)) - np.repeat(np.cumsum(length) - length, length)
            row, hot = np.repeat(np.arange(len(k)), length), shared.value[(word % np.uint64(SKETCH)).astype(np.int64)]
            size = n[row].astype(np.int64)
            band = band_of(size, percent)
            visits = np.flatnonzero(hot & (band_of(np.maximum(largest_partner(size, pos, percent), 1), percent) > band))
            at = np.concatenate((np.arange(len(word)), visits))
            guest = (np.arange(len(at)) >= len(word)).astype(np.int64)
            token = np.where(hot[at], mix(word[at] ^ mix((band[at] + guest).astype(np.uint64))), word[at]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (token, k[row[at]], size[at] << 32 | guest << 31 | pos[at], s0[row[at]], s1[row[at]], hot[at])],
                names=["token", "k", "np", "s0", "s1", "hot"])

    return described.where(F.col("prefix").isNotNull()).select("k", "n", "s0", "s1", "prefix").mapInArrow(run, _PREFIXES)


def _within(text_key: str, line: str) -> Column:
    """Order of lines with one doc_id: by text, then line number."""
    return F.shiftleft(F.shiftright(F.col(text_key), 24), 24) + F.col(line)


def compared(number: np.ndarray, table: pa.Table, percent: int, standing: bool = False) -> tuple:
    """(rows, steps): rows, one per class and group, and the pairs that pass the filters (see ``pair_steps``).

    With ``standing`` only pairs whose class of the later place stands.
    """
    packed = table.column("np").to_numpy()
    order = by_group_and_size(number, table, packed >> 32)
    packed = packed[order]
    rows = {"n": packed >> 32, "pos": packed & 0x7FFFFFFF, "home": (packed >> 31) & 1 == 0, "block": table.column("block").to_numpy()[order],
            "cut": (table.column("bi").to_numpy() != table.column("bj").to_numpy())[order]}
    sig = np.column_stack([table.column(c).to_numpy()[order] for c in ("s0", "s1")]).view(np.uint64)
    if not standing:
        return order, pair_steps(number[order], rows, sig, percent)
    stands, place = np.asarray(table.column("standing").to_numpy(), bool)[order], places(table)[order]
    return order, pair_steps(number[order], rows, sig, percent, lambda x, y: stands[np.where(place[x] > place[y], x, y)])


def places(table: pa.Table) -> np.ndarray:
    """Rank of each row's first line among the table's rows (classes have different places, but for equal ids and texts)."""
    k, o0, o1 = (table.column(c).to_numpy() for c in ("k", "o0", "o1"))
    rank = np.empty(len(k), np.int64)
    rank[np.lexsort((k, o1, o0))] = np.arange(len(k))
    return rank


def partnered(rows: DataFrame, percent: int) -> DataFrame:
    """The rows of classes that have a partner passing all filters under that word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in whole_groups(batches):
            order, steps = compared(number, table, percent)
            used = np.zeros(len(order), bool)
            for i, j in steps:
                used[i] = used[j] = True
            if used.any():
                yield from table.take(pa.array(order[used])).select(_COLUMNS).combine_chunks().to_batches()

    return in_blocks(rows).mapInArrow(run, _MET)


def earliest(place: np.ndarray, steps: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(first, more): each row's earliest earlier partner (-1: none), and whether a row is in a pair besides those."""
    first, more = np.full(len(place), -1), np.zeros(len(place), bool)
    for i, j in steps:
        for later, earlier in ((i, j), (j, i)):        # no row comes twice on one side
            mine = place[later] > place[earlier]
            later, earlier = later[mine], earlier[mine]
            known = first[later]
            better = (known < 0) | (place[earlier] < place[known])
            second = np.where(better, known, earlier)
            more[later[second >= 0]] = more[second[second >= 0]] = True
            first[later[better]] = earlier[better]
    return first, more


def earliest_partners(placed: DataFrame, percent: int) -> DataFrame:
    """(u, v): each class with its earliest earlier partner under each word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in whole_groups(batches):
            order, steps = compared(number, table, percent)
            k = table.column("k").to_numpy()[order]
            first, _ = earliest(places(table)[order], steps)
            later = np.flatnonzero(first >= 0)
            if len(later):
                yield pa.RecordBatch.from_arrays([pa.array(k[later]), pa.array(k[first[later]])], names=["u", "v"])

    return placed.sortWithinPartitions(*GROUP).mapInArrow(run, "u bigint, v bigint").distinct()


def contested(rest: DataFrame, percent: int) -> DataFrame:
    """The rows of ``rest`` in a pair whose later class stands and which is not that class's earliest under the word (that one is verified)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in whole_groups(batches):
            order, steps = compared(number, table, percent, True)
            _, more = earliest(places(table)[order], steps)
            if more.any():
                yield from table.take(pa.array(order[more])).combine_chunks().to_batches()

    return rest.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(run, rest.schema)


def similar_to_earlier(placed: DataFrame, percent: int) -> DataFrame:
    """(k): the standing classes that are similar to an earlier class; rows carry their ``tokens`` and are verified where they meet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in whole_groups(batches):
            order, steps = compared(number, table, percent, True)
            k, place, tokens = table.column("k").to_numpy()[order], places(table)[order], table.column("tokens")
            gone = np.zeros(len(k), bool)
            for i, j in steps:
                swap = place[i] > place[j]
                later, earlier = np.where(swap, i, j), np.where(swap, j, i)
                for x, y in zip(later[~gone[later]].tolist(), earlier[~gone[later]].tolist()):
                    a, b = (tokens_from(tokens[int(order[r])].as_buffer()) for r in (x, y))
                    same = len(a) + len(b) - len(np.unique(np.concatenate((a, b))))
                    gone[x] |= 100 * same >= percent * (len(a) + len(b) - same)
            if gone.any():
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(k[gone]))], names=["k"])

    return placed.sortWithinPartitions(*GROUP).mapInArrow(run, "k bigint").distinct()


def sets_of(docs: DataFrame, described: DataFrame, nodes: DataFrame, counts: np.ndarray) -> DataFrame:
    """(k, tokens) of the classes ``nodes``, from the line of one document each."""
    shared = docs.sparkSession.sparkContext.broadcast(levels(counts))
    one = described.where(F.col("prefix").isNotNull()).join(bounded(nodes), "k", "left_semi") \
        .groupBy("k").agg(F.min(F.struct("doc_id", "text_key", "line")).alias("at")).select("at.*")
    wanted = one.groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).agg(F.collect_list("line").alias("want"))
    wanted = bounded_lists(written(wanted, "line-wanted"), "want")
    joined = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["__id"]) & (docs["text_key"] == wanted["__key"])).select("text", "want")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            def lines() -> Iterator[tuple[int, bytes]]:
                for text, want in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    split = text.split("\n")
                    for number in want:
                        yield number, split[number].encode("utf-8", "surrogatepass")

            for chunk in chunks(lines()):
                h, owner = chunk_words([x for _, x in chunk])
                _, size, key, first, word = packed_sets(h, owner, shared.value[bucket(h)])
                raw = token_bytes(word)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array([raw[a:a + n].tobytes() for a, n in zip(first, size)], pa.binary())],
                                                 names=["k", "tokens"])

    # Equal rows in several tasks give a set several times, and then a pair; that changes nothing.
    return joined.mapInArrow(run, "k bigint, tokens binary")


def removed_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_key, line) of the lines that go; ``docs`` has doc_id, text_key and text."""
    counts = sketch(docs)
    described = written(describe(docs, counts, percent), "line-sets")
    met = written(partnered(prefixes(described, counts, percent), percent), "line-partners")
    nodes = written(met.select("k").distinct(), "line-nodes")
    sets = written(sets_of(docs, described, nodes, counts), "line-shared-sets")

    place = F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("o0"), _within("text_key", "line").alias("o1"))
    classes = written(described.groupBy("k").agg(F.min(place).alias("first"), F.count("*").alias("times"))
                      .select("k", "first.*", "times"), "line-classes")
    placed = written(met.join(classes.select("k", "o0", "o1"), "k"), "line-placed")
    gone = written(verified(earliest_partners(placed.repartition(*GROUP), percent), sets, percent).select(F.col("u").alias("k")).distinct(), "lines-gone")

    # Classes that still stand, against their other partners.
    rest = placed.join(gone.withColumn("gone", F.lit(True)), "k", "left").withColumn("standing", F.col("gone").isNull()).drop("gone")
    rest = written(contested(rest, percent), "line-standing")
    gone = gone.unionByName(similar_to_earlier(rest.join(sets, "k").repartition(*GROUP), percent)).distinct()

    marked = classes.join(gone.withColumn("gone", F.lit(True)), "k", "left").where("gone or times > 1")
    lines = described.select("doc_id", "text_key", "line", "k").join(marked, "k")
    is_first = (F.col("o0") == place["o0"]) & (F.col("o1") == place["o1"])
    return lines.where(F.col("gone").isNotNull() | ~is_first).select("doc_id", "text_key", "line").distinct()


def dedup_lines(docs: DataFrame, percent: int = PERCENT, text_col: str = "text") -> DataFrame:
    """``docs`` with their text (and ``n_chars``, if there is one) without the removed lines,
    ``n_lines`` and ``n_removed``.

    Lines are ``\\\\n``-separated.  Null texts stay null with 0 lines; an empty
    text is one empty line.  Lines without words stay.  Rows that agree in doc_id and text are one document and fare alike;
    a null doc_id comes after all others.  An empty table gives an empty one.
    Columns called like an output are replaced.
    """
    text = F.col(f"`{text_col}`").cast("string")
    keyed = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    going = removed_lines(keyed, percent).groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")) \
        .agg(F.sort_array(F.collect_list("line")).alias("__going"))
    going = bounded_lists(written(going, "lines-going"), "__going")
    out_cols = [c for c in others(docs, ("n_lines", "n_removed"))]
    joined = docs.select(*[F.col(f"`{c}`") for c in out_cols], text.alias("__text"), F.xxhash64(text).alias("__text_key")) \
        .join(going, docs["doc_id"].cast("bigint").eqNullSafe(F.col("__id")) & (F.col("__text_key") == F.col("__key")), "left") \
        .select(*[F.col(f"`{c}`") for c in out_cols], "__text", "__going")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_lines, n_removed = [], [], []
            for text, going in zip(batch.column(len(out_cols)).to_pylist(), batch.column(len(out_cols) + 1).to_pylist()):
                n_lines.append(0 if text is None else text.count("\n") + 1)
                n_removed.append(len(going or ()))
                if going:
                    drop = set(going)
                    text = "\n".join([x for i, x in enumerate(text.split("\n")) if i not in drop])
                kept.append(text)
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(out_cols))], pa.array(kept, pa.string()),
                                              pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())],
                                             names=[*out_cols, "__kept", "n_lines", "n_removed"])

    schema = T.StructType([*[docs.schema[c] for c in out_cols], T.StructField("__kept", T.StringType()),
                           T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])
    done = joined.mapInArrow(run, schema)
    kept = {text_col: F.col("__kept"), "n_chars": F.when(F.col("n_removed") > 0, F.length("__kept")).otherwise(
        F.col("n_chars")).cast(docs.schema["n_chars"].dataType) if "n_chars" in out_cols else None}
    return done.select(*[kept[c].alias(c) if kept.get(c) is not None else F.col(f"`{c}`") for c in out_cols], "n_lines", "n_removed")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed and the SHA-256 of the text that stays."""
    done = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
