"""Set-similarity joins: comparing the rows that meet under a prefix token, and verifying pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import bounded, tokens_from, written

#: Rows of a block; a token with more prefix rows is cut into blocks, every pair of blocks a group of its own.
BLOCK = 4096
#: Rows compared at a time.
STEP_ROWS = 60_000
GROUP = ["token", "bi", "bj"]


def required(a, b, percent: int):
    """Smallest intersection of sets of ``a`` and ``b`` elements with Jaccard >= percent / 100."""
    return -(-percent * (a + b) // (100 + percent))


def in_blocks(rows: DataFrame) -> DataFrame:
    """Rows (token, k, ...) with block, bi, bj, together and sorted by GROUP: every two rows of a token meet in one group.

    The tokens with more than ``BLOCK`` rows are counted first, among those
    that the sketch does not rule out (column ``hot``); there are at most rows
    / BLOCK of them.
    """
    many = rows.where("hot").groupBy("token").count().where(F.col("count") > BLOCK).select(F.col("token").alias("__t"), F.ceil(F.col("count") / BLOCK).cast("int").alias("__b"))
    many = bounded(written(many, "hot-tokens"))
    blocks = F.coalesce("__b", F.lit(1))
    return rows.join(many, rows["token"] == many["__t"], "left").withColumn("block", F.pmod(F.xxhash64("k"), blocks).cast("int")) \
        .withColumn("__o", F.explode(F.sequence(F.lit(0), blocks - 1))) \
        .withColumn("bi", F.least("block", "__o")).withColumn("bj", F.greatest("block", "__o")).drop("__t", "__b", "__o", "hot") \
        .repartition(*GROUP).sortWithinPartitions(*GROUP)


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.Table]]:
    """(group number of each row, rows) of some STEP_ROWS rows of sorted batches; a group is never cut, groups of one row are left out."""
    held: list[pa.RecordBatch] = []
    size = 0

    def numbers(table: pa.Table) -> np.ndarray:
        keys = [table.column(c).to_numpy() for c in GROUP]
        new = np.zeros(table.num_rows, bool)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        return np.cumsum(new)

    def shared(number: np.ndarray, table: pa.Table) -> tuple[np.ndarray, pa.Table]:
        many = np.bincount(number)[number] > 1
        return number[many], table.filter(pa.array(many))

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= STEP_ROWS:
            table = pa.Table.from_batches(held)
            number = numbers(table)
            last = int(np.searchsorted(number, number[-1]))
            if last:
                yield shared(number[:last], table.slice(0, last))
            held = table.slice(last).combine_chunks().to_batches()
            size = table.num_rows - last
            if not last:
                size = 0                       # one group: collect it whole, however many batches it takes
    if held:
        table = pa.Table.from_batches(held)
        yield shared(numbers(table), table)


def by_group_and_size(number: np.ndarray, table: pa.Table, size: np.ndarray) -> np.ndarray:
    """Row order by group, then set size, one row for each set and group (a set may have come once per task)."""
    k = table.column("k").to_numpy()
    order = np.lexsort((k, size, number))
    again = np.zeros(len(k), bool)
    again[1:] = (np.diff(number[order]) == 0) & (np.diff(k[order]) == 0)
    return order[~again]


def band_of(n: np.ndarray, percent: int) -> np.ndarray:
    """Geometric size band; sets similar by ``percent`` lie in one band or in neighbouring ones."""
    return (np.log(n) / (np.log(100 / percent) * (1 + 1e-9))).astype(np.int64)


def largest_partner(n: np.ndarray, pos: np.ndarray, percent: int) -> np.ndarray:
    """Largest similar set of one with ``n`` elements, of which the first ``pos`` are not shared (less than ``n``: none as large)."""
    return (n - pos) * (100 + percent) // percent - n


def pair_steps(number: np.ndarray, rows: dict[str, np.ndarray], sig: np.ndarray, percent: int,
               allowed: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of one group that may be similar enough, some at a time; rows stand in the order of ``by_group_and_size``.

    ``rows``: n (set size), pos (position of the token in the set's order),
    block, cut (whether the group pairs two different blocks); with ``home``
    (false: the row only visits the group of the next size band), a pair needs a
    row at home and counts under its first shared token only.  ``sig``: parity
    signature, 64-bit words.  Sizes, positions and signatures must agree and
    ``allowed(i, j)`` must hold.  All rows step through their neighbours
    together; a row drops out at the first neighbour that is too large for it.
    Within one step no i and no j comes twice.
    """
    if not len(number):
        return
    n, pos, block, cut = (rows[c] for c in ("n", "pos", "block", "cut"))
    home = rows.get("home")
    any_cut = bool(cut.any())
    end = np.searchsorted(number, number, side="right")
    most = largest_partner(n, pos if home is not None else 0 * pos, percent)
    i = np.arange(len(number))
    step = 1
    i = i[i + step < end[i]]
    while len(i):
        j = i + step
        near = n[j] <= most[i]                         # larger neighbours are further away
        i, j = i[near], j[near]
        a, b, p, q = n[i], n[j], pos[i], pos[j]
        need = required(a, b, percent)
        if home is None:
            ok = np.minimum(p, q) + np.minimum(a - p, b - q) >= need
        else:
            ok = (np.minimum(a - p, b - q) >= need) & (home[i] | home[j])
        if any_cut:
            ok &= ~cut[i] | (block[i] != block[j])
        at = np.flatnonzero(ok)
        if len(at):
            x, y = i[at], j[at]
            good = np.bitwise_count(sig[x] ^ sig[y]).sum(axis=1, dtype=np.int64) <= (a + b - 2 * need)[at]
            x, y = x[good], y[good]
            if allowed is not None and len(x):
                good = allowed(x, y)
                x, y = x[good], y[good]
            if len(x):
                yield x, y
        step += 1
        i = i[i + step < end[i]]


def folded(sig: bytes, words: int) -> np.ndarray:
    """A parity signature cut to ``words`` 64-bit words: a power of two, as its own length; what it counts stays the same."""
    out = np.frombuffer(sig, np.uint64)
    while len(out) > words:
        out = out[:len(out) // 2] ^ out[len(out) // 2:]
    return out


class Signatures:
    """Parity signatures of different lengths; two are compared at the length of the shorter one."""

    def __init__(self, sigs: list[bytes]):
        self.sigs = sigs
        self.words = np.array([len(x) // 8 for x in sigs], np.int64)
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _table(self, words: int) -> tuple[np.ndarray, np.ndarray]:
        """(place of each signature in the table, table) of those with at least ``words`` words."""
        if words not in self.tables:
            has = np.flatnonzero(self.words >= words)
            place = np.full(len(self.sigs), -1)
            place[has] = np.arange(len(has))
            self.tables[words] = place, np.array([folded(self.sigs[i], words) for i in has.tolist()])
        return self.tables[words]

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Bits in which signatures x and y (by their index) differ: never more than the tokens in which their sets do."""
        out = np.zeros(len(x), np.int64)
        shorter = np.minimum(self.words[x], self.words[y])
        for words in np.unique(shorter).tolist():
            at = np.flatnonzero(shorter == words)
            place, table = self._table(words)
            out[at] = np.bitwise_count(table[place[x[at]]] ^ table[place[y[at]]]).sum(axis=1, dtype=np.int64)
        return out


def plausible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (u, v) of ``pairs`` whose sizes and signatures (``sets``: k, n, sig) do not rule them out."""
    left = sets.select(F.col("k").alias("u"), F.col("n").alias("m"), F.col("sig").alias("x"))
    right = sets.select(F.col("k").alias("v"), F.col("n").alias("n"), F.col("sig").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = batch.column(2).to_numpy().astype(np.int64), batch.column(3).to_numpy().astype(np.int64)
            sigs, at = Signatures(batch.column(4).to_pylist() + batch.column(5).to_pylist()), np.arange(batch.num_rows)
            need = required(a, b, percent)
            mask = pa.array((np.minimum(a, b) >= need) & (sigs.apart(at, at + batch.num_rows) <= a + b - 2 * need))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["u", "v"])

    return pairs.join(left, "u").join(right, "v").select("u", "v", "m", "n", "x", "y").mapInArrow(run, "u bigint, v bigint")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (u, v) of ``pairs`` whose sets (``sets``: k, tokens) are similar enough, by exact intersection."""
    left = sets.select(F.col("k").alias("u"), F.col("tokens").alias("x"))
    right = sets.select(F.col("k").alias("v"), F.col("tokens").alias("y"))
    both = pairs.select("u", "v").join(left, "u").join(right, "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs, xs, ys = (batch.column(i) for i in range(4))
            ok = []
            for x, y in zip(xs, ys):
                x, y = tokens_from(x.as_buffer()), tokens_from(y.as_buffer())
                same = len(x) + len(y) - len(np.unique(np.concatenate((x, y))))
                ok.append(100 * same >= percent * (len(x) + len(y) - same))
            mask = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([us.filter(mask), vs.filter(mask)], names=["u", "v"])

    return both.select("u", "v", "x", "y").mapInArrow(run, "u bigint, v bigint")
