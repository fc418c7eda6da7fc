"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.session import delete_at_exit, ensure_checkpoint_dir

#: Words of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

# 64-bit mixing constants of the splitmix64 finalizer (fixed values).
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the cluster's shared checkpoint folder and read back.

    Cuts the lineage: a lost executor costs a re-read, never a recomputation
    of the stages before the write.  The table is deleted when the driver ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    delete_at_exit(spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def others(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Columns of ``df`` that none of ``names`` replaces (names compare without case)."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def keep(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without the columns that outputs called ``names`` replace."""
    return df.select(*[F.col(f"`{c}`") for c in others(df, names)])


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finalizer over a uint64 array."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


# A random value for every byte, and the odd base of the polynomial hash.
BYTE_CODES = mix(np.arange(256, dtype=np.uint64))
_BASE = np.uint64(0x2545F4914F6CDD1D)
_BASE_INV = np.uint64(pow(0x2545F4914F6CDD1D, -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Text per vectorised step.
CHUNK_BYTES = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[:1] = 1
    if n > 1:
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


_POWERS: dict[int, np.ndarray] = {}


def _cached_powers(base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        have = _powers(base, max(n, 1 << 16))
        if n <= 2 * CHUNK_BYTES:
            _POWERS[int(base)] = have
    return have[:n]


def split_words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the words in a byte array."""
    inside = ~_SPACE[buf]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(text: bytes, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit hash of each word, starts, ends) of one UTF-8 text."""
    buf = np.frombuffer(text, dtype=np.uint8)
    if not len(buf):
        none = np.empty(0, dtype=np.int64)
        return np.empty(0, dtype=np.uint64), none, none
    start, end = split_words(buf)
    if lower:
        buf = _LOWER[buf]
    sums = np.empty(len(buf) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(BYTE_CODES[buf] * _cached_powers(_BASE, len(buf)), out=sums[1:])
    back = _cached_powers(_BASE_INV, len(buf))
    return mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64)), start, end


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words; with fewer words, one hash of all of them."""
    if not len(words):
        return words
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for i in range(n):
        out = mix(out ^ words[i:len(words) - n + 1 + i])
    return out


#: Rows of a few fixed-width columns that may be broadcast (at most some 100 MB).
BROADCAST_ROWS = 2_000_000


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (already written, so that counting is cheap) with a broadcast hint if it has at most ``rows`` rows.

    Beyond that the hint is left out and the join shuffles.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def bounded_lists(df: DataFrame, column: str, entries: int = BROADCAST_ROWS) -> DataFrame:
    """As ``bounded``, by the rows and by the entries of an array column in all rows."""
    return bounded(df, entries) if (df.agg(F.sum(F.size(column))).first()[0] or 0) <= entries else df


#: Bits of a token hash in a packed set, and rows per packed chunk (their number takes 12 bits, a rarity level 4).
TOKEN_BITS = 48
TOKEN_BYTES = TOKEN_BITS // 8
CHUNK_ROWS = 1 << 12


def chunks(items: Iterable[tuple[object, bytes]]) -> Iterator[list[tuple[object, bytes]]]:
    """Lists of at most CHUNK_ROWS (tag, bytes) items and some CHUNK_BYTES."""
    out, held = [], 0
    for tag, raw in items:
        if out and (len(out) == CHUNK_ROWS or held + len(raw) > CHUNK_BYTES):
            yield out
            out, held = [], 0
        out.append((tag, raw))
        held += len(raw)
    if out:
        yield out


def chunk_words(raws: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and text number of every word of some texts."""
    h, start, _ = word_hashes(b"\n".join(raws))
    return h, np.searchsorted(np.cumsum([len(x) + 1 for x in raws]), start, side="right")


def packed_sets(hashes: np.ndarray, owner: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct tokens of each owner, by (level, hash): (owners that have any, sizes, set keys, first index, tokens)."""
    width = np.uint64(TOKEN_BITS)
    packed = np.unique((owner.astype(np.uint64) << np.uint64(52)) | (level.astype(np.uint64) << width) | (hashes >> np.uint64(64 - TOKEN_BITS)))
    token = packed & ((np.uint64(1) << width) - np.uint64(1))
    owner = (packed >> np.uint64(52)).astype(np.int64)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    size = np.diff(np.append(first, len(owner)))
    if not len(first):
        return owner, size, np.empty(0, np.int64), first, token
    mixed = mix(token)
    key = mix(np.add.reduceat(mixed, first) ^ mix(np.bitwise_xor.reduceat(mixed * np.uint64(3), first)) + size.astype(np.uint64))
    return owner[first], size, key.view(np.int64), first, token


def signatures(token: np.ndarray, size: np.ndarray, bits: int) -> np.ndarray:
    """A row of parity bits per set; the bits in which two sets differ never outnumber the tokens in which they do."""
    at = (mix(token) % np.uint64(bits)).astype(np.int64) + np.repeat(np.arange(len(size)) * bits, size)
    return np.packbits((np.bincount(at, minlength=len(size) * bits) & 1).astype(np.uint8).reshape(len(size), bits), axis=1)


def scaled_signatures(token: np.ndarray, size: np.ndarray, bits: int) -> list[bytes]:
    """``signatures`` of ``bits`` (a power of two) times the power of two that gives a set a bit for each token."""
    out: list[bytes] = [b""] * len(size)
    level = np.ceil(np.log2(np.maximum(size / bits, 1))).astype(np.int64)
    for n in np.unique(level).tolist():
        at = np.flatnonzero(level == n)
        for i, row in zip(at.tolist(), signatures(token[np.repeat(level == n, size)], size[at], bits << n)):
            out[i] = row.tobytes()
    return out


def token_bytes(token: np.ndarray) -> np.ndarray:
    """TOKEN_BYTES bytes per token."""
    return token.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES]


def tokens_from(raw) -> np.ndarray:
    wide = np.zeros((len(raw) // TOKEN_BYTES, 8), np.uint8)
    wide[:, :TOKEN_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, TOKEN_BYTES)
    return wide.view("<u8").ravel()
