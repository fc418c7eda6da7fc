"""BPE encoding and decoding by prefix-sharing trie traversal.

A byte-pair encoding has two properties that make prefixes shareable: the
tokens of a text cut after any token are the encoding of that prefix, and a
token sequence is an encoding exactly when every adjacent pair of tokens is
left alone by the merges.  The encoding of a prefix is therefore described by
its *last* token and the prefix before it.  The distinct words of a batch are
inserted into a trie, which is walked depth first; each edge extends the state
(last token per prefix) of the path by one symbol, so a prefix that thousands
of words share is encoded once.  A word's ids are read off by following its
last tokens backwards.

The vocabulary marks the last symbol of a word (``end_of_word_suffix``), so a
trie node carries the state for its prefix as an inner part, and every word
ending there adds one leaf state for the marked symbol.

The vocabulary file is read on the driver and broadcast (its size is the
vocabulary's, 1.7 MB here, whatever the corpus; files over
``MAX_VOCABULARY_BYTES`` are refused).

Each task keeps the words it has already encoded, up to ``CACHED_WORDS``; a
full cache is emptied, which costs time and changes no result.
"""

from __future__ import annotations

import hashlib
import json
import os
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.llm.common import keep, others, read

MAX_VOCABULARY_BYTES = 64 << 20
CACHED_WORDS = 600_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    code = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}
    return [chr(code[b]) for b in range(256)]


class Encoder:
    """One vocabulary: trie encoding of words, encoding and decoding of texts."""

    def __init__(self, spec: dict, cached_words: int = CACHED_WORDS):
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for i, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[vocab[a], vocab[b]] = (i, vocab[a + b])
        self.name = {i: t for t, i in vocab.items()}
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.name.update({i: t for t, i in special.items()})
        self.special = {t: (array("I", [i]).tobytes(), t) for t, i in special.items()}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        pre = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.piece = regex.compile(pre, regex.V0)
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + self.suffix] for s in symbols]
        # Tokens as symbol strings; a marked token ends a word.  Only a token
        # that encodes to itself can occur in an encoding.
        code = {s: b for b, s in enumerate(symbols)}
        self.parts: dict[int, list[int]] = {}
        self.open: dict[bytes, int] = {}
        self.closed: dict[bytes, int] = {}
        for text, i in vocab.items():
            marked = bool(self.suffix) and text.endswith(self.suffix)
            body = text[:-len(self.suffix)] if marked else text
            if not body or any(c not in code for c in body):
                continue
            raw = bytes(code[c] for c in body)
            self.parts[i] = [self.inner[b] for b in raw[:-1]] + [(self.last if marked else self.inner)[raw[-1]]]
            (self.closed if marked else self.open)[raw] = i
        if not self.suffix:
            self.closed = self.open
        self.open_ends, self.closed_ends = self._ends(self.open), self._ends(self.closed)
        self.pairs: dict[int, bool] = {}
        self.cached_words = cached_words
        self.words: dict[str, tuple[bytes, str]] = {}

    def merged(self, ids: list[int]) -> list[int]:
        """Plain merge loop, used to settle pairs of tokens."""
        ids = list(ids)
        while len(ids) > 1:
            best = min(((self.rank[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.rank), default=None)
            if best is None:
                break
            k = best[1]
            ids[k:k + 2] = [self.rank[ids[k], ids[k + 1]][1]]
        return ids

    def _ends(self, tokens: dict[bytes, int]) -> dict[bytes, tuple[int, ...]]:
        """Keep the tokens that encode to themselves; the lengths they have, by their last three bytes."""
        for raw in [r for r, i in tokens.items() if len(r) > 1 and self.merged(self.parts[i]) != [i]]:
            del tokens[raw]
        found: dict[bytes, set[int]] = {}
        for raw in tokens:
            found.setdefault(raw[-3:], set()).add(len(raw))
        short = {end: found.get(end, set()) for end in found if len(end) < 3}
        full = {end: n | short.get(end[-2:], set()) | short.get(end[-1:], set()) for end, n in found.items()}
        return {end: tuple(sorted(n, reverse=True)) for end, n in full.items()}

    def compatible(self, left: int, right: int) -> bool:
        ok = self.merged(self.parts[left] + self.parts[right]) == [left, right]
        if len(self.pairs) > 1_000_000:
            self.pairs.clear()
        self.pairs[left << 32 | right] = ok
        return ok

    def state(self, raw: bytes, at: int, tokens: dict[bytes, int], ends: dict[bytes, tuple[int, ...]],
              path: list[tuple[int, int]]) -> tuple[int, int]:
        """(last token, length of the prefix before it) of ``raw[:at]``."""
        pairs = self.pairs
        lengths = ends.get(raw[at - 3 if at > 3 else 0:at]) or ends.get(raw[at - 2 if at > 2 else 0:at]) or (1,)
        for n in lengths:
            start = at - n
            if start >= 0:
                token = tokens.get(raw[start:at])
                if token is not None:
                    if not start:
                        return token, 0
                    left = path[start][0]
                    ok = pairs.get(left << 32 | token)
                    if self.compatible(left, token) if ok is None else ok:
                        return token, start
        raise ValueError("the vocabulary lacks a byte")

    def learn(self, words: set[str]) -> None:
        """Encode new words: their trie in depth-first order is their sorted order with a path of states."""
        path: list[tuple[int, int]] = [(-1, 0)]
        previous = b""
        state, known, name = self.state, self.words, self.name
        for raw, word in sorted([(w.encode(), w) for w in words]):
            shared, most = 0, min(len(path) - 1, len(raw) - 1)
            while shared < most and previous[shared] == raw[shared]:
                shared += 1
            del path[shared + 1:]
            for at in range(shared + 1, len(raw)):          # proper prefixes: inner states
                path.append(state(raw, at, self.open, self.open_ends, path))
            token, start = state(raw, len(raw), self.closed, self.closed_ends, path)
            ids = [token]
            while start:
                token, start = path[start]
                ids.append(token)
            ids.reverse()
            known[word] = (array("I", ids).tobytes(), " ".join([name[i] for i in ids]))
            previous = raw

    def pieces(self, text: str) -> list[str]:
        """Special-token strings and words of a text, in order."""
        out: list[str] = []
        for k, part in enumerate(self.split_special.split(text) if self.split_special else [text]):
            if k % 2:
                out.append(part)
            elif part:
                # Lower-casing is by single characters, without the final-sigma rule.
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                out += self.piece.findall(part)
        return out

    def encode_batch(self, texts: list[str | None]) -> Iterator[tuple[int, bytes, str]]:
        """(number of ids, ids as little-endian uint32, decoded text) of each text."""
        chunk: list[list[str]] = []
        held = 0
        for text in texts:
            chunk.append(self.pieces(text) if text else [])
            held += len(chunk[-1])
            if held > 400_000:
                yield from self._encoded(chunk)
                chunk, held = [], 0
        yield from self._encoded(chunk)

    def _encoded(self, docs: list[list[str]]) -> Iterator[tuple[int, bytes, str]]:
        special, known = self.special, self.words
        seen = set().union(*docs)
        new = seen - known.keys() - special.keys()
        if len(known) + len(new) > self.cached_words:
            known.clear()
            new = seen - special.keys()
        self.learn(new)
        known.update(special)
        for pieces in docs:
            found = [known[p] for p in pieces]
            ids = b"".join([f[0] for f in found])
            yield len(ids) // 4, ids, " ".join([f[1] for f in found])

    def decode(self, ids) -> str:
        """Token strings joined by one space (the vocabulary file names no decoder)."""
        return " ".join(self.name[i] for i in ids)


def load_vocabulary(path: str) -> dict:
    if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than a vocabulary may be ({MAX_VOCABULARY_BYTES} bytes)")
    with open(path, encoding="utf-8") as f:
        return json.load(f)


_ENCODER: dict[str, Encoder] = {}       # the last vocabulary's, by its file's hash: workers outlive a task


def bpe_encode(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """Add ``n_tokens`` (long), ``ids`` (binary: little-endian uint32) and ``decoded`` to ``docs``.

    ``decoded`` is what decoding the ids gives.  Null and empty texts have no
    ids and decode to ''.  Repeated rows are encoded alike; an empty table
    gives an empty table.  Columns called like an output are replaced.
    """
    spark = docs.sparkSession
    loaded = load_vocabulary(vocabulary)
    shared = spark.sparkContext.broadcast(loaded)
    which = hashlib.sha256(json.dumps(loaded, sort_keys=True).encode()).hexdigest()
    names = ("n_tokens", "ids", "decoded")
    df = docs.withColumn("__text", F.col(f"`{text_col}`").cast("string"))
    out_cols = others(docs, names)
    schema = T.StructType([docs.schema[c] for c in out_cols]
                          + [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
                             T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if which not in _ENCODER:
            _ENCODER.clear()
            _ENCODER[which] = Encoder(shared.value)
        encoder = _ENCODER[which]
        for batch in batches:
            done = list(encoder.encode_batch(batch.column(batch.num_columns - 1).to_pylist()))
            n, ids, text = zip(*done) if done else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(out_cols))]
                + [pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(text, pa.string())],
                names=[*out_cols, *names])

    return df.select(*[F.col(f"`{c}`") for c in out_cols], "__text").mapInArrow(run, schema)


def ids_array(encoded: DataFrame) -> DataFrame:
    """``encoded`` with ``ids`` as array<bigint> in place of bytes."""
    hexed = F.hex("ids")
    one = lambda k: F.conv(F.concat(*[F.substring(hexed, k * 8 + 7 - 2 * j, 2) for j in range(4)]), 16, 10).cast("long")
    return encoded.withColumn("ids", F.when(F.length("ids") == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), (F.length("ids") / 4).cast("int") - 1), one)))


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe_encode(docs, default_vocabulary())
    return keep(encoded, ["text"]).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
