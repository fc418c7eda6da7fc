"""Toxicity by a noisy-channel decoder and a lexicon learnt from labels.

1. *Language model*: character trigrams of all documents are counted in
   ``LM_BUCKETS`` hash buckets (numpy counts per task, summed by Spark).
2. *Decoder*: a token in which letters mix with digits or symbols, or a letter
   repeats three times or more, becomes a lattice: each input character offers
   the letters it may stand for, a run offers one, two or all copies, a
   separator offers nothing.  Viterbi over (last two letters) finds the cheapest
   path under channel costs and the language model.  Plain tokens have a
   one-path lattice, themselves.  The gap beside a token of at most ``SHORT``
   characters is a symbol of the lattice too, dropped or kept as the end of a
   word, so a run of tokens is segmented by the same Viterbi ('a m o r o n',
   'id iot').  Between two tokens that face each other with two plain letters
   each, the choice depends on those four letters alone: it is looked up, and
   runs are cut where such a gap is kept.  Two fixed letters in a row leave
   Viterbi a single state, so a run is read in windows that reach from such a
   pair to the next.
3. *Lexicon*: each restored word has features (the word, its prefixes of three
   to six letters) in ``FEATURES`` hash buckets; a feature's evidence is the
   lower bound of its log odds between toxic and other labelled documents.
   Lexicon and calibration are fitted on at most ``train_rows`` labelled
   documents (those whose ids hash lowest); the fit never sees ids with
   ``crc32(doc_id) mod 5 = 0``.
4. *Score*: logistic function of a document's three strongest distinct words
   and its size.

The driver holds the two models only: ``LM_BUCKETS`` and ``FEATURES`` numbers;
the calibration's Newton steps take their gradient and Hessian as sums from
Spark, so an id with many texts brings no row to the driver.  Tasks keep
the evidence of up to ``CACHED`` tokens; a full cache is emptied.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from itertools import groupby
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.llm.common import mix, others, read, written

LM_BUCKETS = 1 << 18
PAIR_BUCKETS = 1 << 14
FEATURES = 1 << 19
TRAIN_ROWS = 40_000
CACHED = 200_000

#: What a character may stand for besides itself (fixed values of leetspeak).
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "×": "x",
}
SEPARATORS = ".-_*~·'’/\\^,"
_EDGE = ".,;:?()[]{}\"'«»„“”…&%#*<>~^=/\\-_`´"
_LETTER = re.compile(r"[^\W\d_]")
_ODD = re.compile(r"[^\W\d_].*[^\w\s]|[^\w\s].*[^\W\d_]|\d.*[^\W\d_]|[^\W\d_].*\d|_|(.)\1\1", re.S)
_RUN = re.compile(r"(.)\1*", re.S)
_DOUBLE = re.compile(r"(.)\1+")
_TRIPLE = re.compile(r"(.)\1\1")

# Channel costs in nats.
SUBSTITUTE, LITERAL, DROP, COLLAPSE, KEEP_RUN = 0.7, 14.0, 0.7, 0.7, 3.0
#: Two or more letters in a row that stand for themselves: none is part of a repetition.
_FIXED = re.compile(r"(?:([^\W\d_])(?!\1)(?<!\1\1)){2,}", re.S)
#: Runs of so many characters are remembered like tokens.
REMEMBERED = 14
#: A gap of a run that is dropped whatever stands around the letters beside it.
SURE = "\x1f"
#: A gap can be dropped if a token beside it has at most so many characters.
SHORT = 3


def _trigram(a, b, c):
    return mix((np.uint64(1) + a) * np.uint64(0x1000003) + (b << np.uint64(21)) + (c << np.uint64(42)))


def char_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed counts of letter trigrams and their contexts; anything but a letter is a boundary (0)."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    code = np.where((code >= 97) & (code <= 122) | (code >= 0xDF), code, 0).astype(np.uint64)
    code = np.concatenate((np.zeros(2, np.uint64), code, np.zeros(1, np.uint64)))
    a, b, c = code[:-2], code[1:-1], code[2:]
    a = np.where(b == 0, 0, a).astype(np.uint64)           # a word starts after two boundaries
    real = (b != 0) | (c != 0)
    a, b, c = a[real], b[real], c[real]
    tri = np.bincount((_trigram(a, b, c) % np.uint64(LM_BUCKETS)).astype(np.int64), minlength=LM_BUCKETS)
    pair = np.bincount((_trigram(a, b, np.zeros_like(b)) % np.uint64(PAIR_BUCKETS)).astype(np.int64), minlength=PAIR_BUCKETS)
    return tri, pair


def char_model(docs: DataFrame) -> np.ndarray:
    """Trigram bucket counts, then context bucket counts, over all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LM_BUCKETS + PAIR_BUCKETS, dtype=np.int64)
        for batch in batches:
            chunk, held = [], 0
            for text in [*batch.column(0).to_pylist(), None]:
                if text:
                    chunk.append(text)
                    held += len(text)
                if chunk and (held > 1 << 20 or text is None):
                    tri, pair = char_counts(" ".join(chunk))
                    total[:LM_BUCKETS] += tri
                    total[LM_BUCKETS:] += pair
                    chunk, held = [], 0
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    counted = docs.select(F.col("text").cast("string")).mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    table = counted.toArrow()                                # at most LM_BUCKETS + PAIR_BUCKETS rows
    out = np.zeros(LM_BUCKETS + PAIR_BUCKETS, dtype=np.int64)
    out[table["bucket"].to_numpy()] = table["n"].to_numpy()
    return out


class Decoder:
    """Restores obfuscated tokens under the character model."""

    def __init__(self, counts: np.ndarray):
        self.tri, self.pair = counts[:LM_BUCKETS], counts[LM_BUCKETS:]
        self.memo: dict[tuple[str, str, str], float] = {}
        self.gaps: dict[str, bool | None] = {}
        self.lattices: dict[str, list[list[tuple[str, float]]]] = {}
        self.readings: dict[str, str] = {}

    def cost(self, a: str, b: str, c: str) -> float:
        key = (a, b, c)
        if (cost := self.memo.get(key)) is None:
            x, y, z = (np.uint64(ord(k) if k else 0) for k in key)
            with np.errstate(over="ignore"):
                n = self.tri[int(_trigram(x, y, z) % np.uint64(LM_BUCKETS))]
                m = self.pair[int(_trigram(x, y, np.uint64(0)) % np.uint64(PAIR_BUCKETS))]
            if len(self.memo) > 500_000:
                self.memo.clear()
            cost = self.memo[key] = float(-np.log((n + 0.1) / (max(m, n) + 5.0)))
        return cost

    @staticmethod
    def lattice(token: str) -> list[list[tuple[str, float]]]:
        """For each run of a character: what it may have been, with channel costs."""
        out = []
        for m in _RUN.finditer(token):
            c, n = m.group(1), len(m.group(0))
            if c.isalpha():
                options = [(c, 0.0 if n == 1 else COLLAPSE)]
                if n > 1:
                    options.append((c * 2, 0.0 if n == 2 else COLLAPSE))
                if n > 2:
                    options.append((c * n, KEEP_RUN))
            else:
                options = [(x, SUBSTITUTE) for x in LEET.get(c, "")]
                if n > 1:
                    options += [(x * 2, SUBSTITUTE) for x in LEET.get(c, "")]
                options.append((c * n, LITERAL))
                if c in SEPARATORS or n > 2:
                    options.append(("", DROP))
            out.append(options)
        return out

    def restore(self, token: str) -> str:
        """The cheapest reading of a token, or of tokens with a blank in every gap."""
        states: dict[tuple[str, str], tuple[float, tuple | None]] = {("", ""): (0.0, None)}
        memo, cost = self.memo, self.cost
        for number, part in enumerate(token.split(" ")):
            if number:
                # Dropped: the word goes on.  Kept: it ends, and the next one starts.
                kept = min(((paid + (self.cost(a, b, "") if b else 0.0), path) for (a, b), (paid, path) in states.items()), key=lambda s: s[0])
                states = {at: (paid + DROP, path) for at, (paid, path) in states.items() if at != ("", "")}
                states["", ""] = (kept[0], (kept[1], " "))
            steps = self.lattices.get(part)
            if steps is None:
                if len(self.lattices) > 50_000:
                    self.lattices.clear()
                steps = self.lattices[part] = self.lattice(part)
            for options in steps:
                c = options[0][0]
                if len(options) == 1 and len(c) == 1 and c.isalpha():        # a plain letter, at no price
                    nearer: dict[tuple[str, str], tuple[float, tuple | None]] = {}
                    for (a, b), (paid, path) in states.items():
                        step = memo.get((a, b, c))
                        paid += cost(a, b, c) if step is None else step
                        before = nearer.get((b, c))
                        if before is None or paid < before[0]:
                            nearer[b, c] = (paid, (path, c))
                    states = nearer
                    continue
                reached: dict[tuple[str, str], tuple[float, tuple | None]] = {}
                for (a, b), (paid, path) in states.items():
                    for letters, price in options:
                        x, y, total = a, b, paid + price
                        for c in letters:
                            letter = c if c.isalpha() else ""
                            total += self.cost(x, y, letter) if letter else 0.0
                            x, y = (y, letter) if letter else ("", "")
                        if (x, y) not in reached or total < reached[x, y][0]:
                            reached[x, y] = (total, (path, letters))
                states = reached
        return min((paid + self.cost(a, b, ""), _spelled(path)) for (a, b), (paid, path) in states.items())[1]

    def drops(self, left: str, right: str) -> bool | None:
        """Whether the gap between two tokens is dropped; None if more than two letters on either side decide."""
        key = left[-2:] + right[:2]
        if len(left) < 2 or len(right) < 2:
            return None
        if key not in self.gaps:
            a, b, c, d = key
            plain = key.isalpha() and a != b and c != d
            kept = self.cost(a, b, "") + self.cost("", "", c) + self.cost("", c, d) if plain else 0.0
            if len(self.gaps) > 500_000:
                self.gaps.clear()
            self.gaps[key] = DROP + self.cost(a, b, c) + self.cost(b, c, d) < kept if plain else None
        return self.gaps[key]


    def restored(self, run: str) -> str:
        """``restore`` of a run (gaps are blanks, or ``SURE`` where ``drops`` has decided to drop them), piece by piece.

        Two fixed letters in a row leave Viterbi a single state, so the readings before
        and after them do not depend on each other.  A gap that ``drops`` decides has such letters on either side.
        """
        return "".join([self.reading(p) for p in run.split(SURE)])

    def reading(self, text: str) -> str:
        """``restore`` of a token or of tokens with open gaps; fixed letters stand for themselves, the windows between them are read and remembered."""
        if text.isalpha() and not _DOUBLE.search(text):
            return text
        out: list[str] = []
        done = 0                                         # end of the last fixed letters
        for m in _FIXED.finditer(text):
            start, end = m.span()
            if start:
                out.append(self.window(text[max(done - 2, 0):start + 2])[2 if done else 0:])
                out.append(text[start + 2:end])
            else:
                out.append(text[:end])
            done = end
        if done < len(text):
            out.append(self.window(text[max(done - 2, 0):])[2 if done else 0:])
        return "".join(out)

    def window(self, text: str) -> str:
        """``restore``, remembered."""
        found = self.readings.get(text)
        if found is None:
            if len(self.readings) >= CACHED:
                self.readings.clear()
            found = self.readings[text] = self.restore(text)
        return found


def _spelled(path: tuple | None) -> str:
    out = []
    while path:
        path, letters = path
        out.append(letters)
    return "".join(reversed(out))


def core(token: str) -> str:
    """A lower-case token without punctuation around it."""
    token = token.strip(_EDGE)
    if token.isalpha():
        return token
    token = token.rstrip("!")
    return token.rstrip("$") if token.endswith("$$") else token


#: Checksum of the mark before a prefix.
_CARET = crc32(b"^")


def features(word: str) -> list[int]:
    raw = [word.encode("utf-8", "surrogatepass")] + [b"^" + word[:n].encode("utf-8", "surrogatepass") for n in (3, 4, 5, 6) if len(word) > n]
    return [crc32(r) % FEATURES for r in raw]


class _Pieces(dict):
    """What ``scan`` asks of a token: as a piece of a word, whether it is short, its first and last two characters, whether it is a number; and what ``value`` makes of it."""

    def __init__(self, value: Callable[[str, str], object]):
        super().__init__()
        self.value = value
        self.ends: dict[str, str] = {}                   # one object per pair of characters

    def clear(self) -> None:
        super().clear()
        self.ends.clear()

    def __missing__(self, token: str) -> tuple[str, bool, str | None, str | None, bool, object]:
        # A single character and a token of nothing but marks stand for themselves.
        p = token if len(token) == 1 or token.isalpha() else core(token) or token
        if (n := len(p)) > 1:
            head, tail = p[:2], p[-2:]
            known = p, n <= SHORT, self.ends.setdefault(head, head), self.ends.setdefault(tail, tail), n > SHORT and _is_number(p), self.value(token, p)
        else:
            known = p, True, None, None, False, self.value(token, p)
        self[token] = known
        return known


class Restorer:
    """Restored words of texts."""

    def __init__(self, counts: np.ndarray):
        self.decoder = Decoder(counts)
        self.pieces = _Pieces(self.value)

    def value(self, token: str, piece: str) -> object:
        """What ``scan`` gives for a token (``piece`` is the token without the marks around it, unless nothing is left)."""
        return None

    def forms(self, token: str) -> list[str]:
        """The word that a token stands for (the words, if it is a run), and its form without doubled letters."""
        if " " in token or SURE in token:
            joined = token.replace(SURE, "")
            if joined.isalpha() and not _DOUBLE.search(joined):
                return [joined]
            words = dict.fromkeys([w if w.isalpha() else core(w) for w in self.decoder.restored(token).split()])
            return list(dict.fromkeys([f for w in words for f in ((w, _DOUBLE.sub(r"\1", w)) if _DOUBLE.search(w) else (w,))]))
        word = token if token.isalpha() else core(token)
        if word.isalpha():
            if not _DOUBLE.search(word):
                return [word]
            odd = _TRIPLE.search(word)                   # letters only: nothing else is odd
        else:
            odd = len(word) > 2 and _ODD.search(word) and _LETTER.search(word)
        if odd:
            word = core(self.decoder.reading(word))
        single = _DOUBLE.sub(r"\1", word)
        return [word] if single == word else [word, single]

    def scan(self, text: str) -> tuple[dict[str, object], set[str]]:
        """Distinct tokens of a text with their ``value``, and the runs of tokens whose gaps may be dropped, joined by blanks (``SURE`` where ``drops`` decides)."""
        words = text.lower().split()
        if len(self.pieces) >= CACHED:
            self.pieces.clear()
        runs: set[str] = set()
        gaps, drops = self.decoder.gaps, self.decoder.drops
        run: list[str] = []                              # tokens and the gaps between them
        last, last_short, tail, last_number = "", False, "", False
        pieces = list(map(self.pieces.__getitem__, words))
        for p, short, head, end, number, _ in pieces:
            if short or last_short:
                if tail and head:
                    going = gaps.get(tail + head, 0)
                    if going == 0 and going is not False:
                        going = drops(last, p)
                else:
                    going = None
                if (going or going is None and not number and not last_number) and last:
                    if not run:
                        run.append(last)
                    run += (SURE if going else " ", p)
                    last, last_short, tail, last_number = p, short, end, number
                    continue
            if run:
                runs.update(_read_as(run))
                run = []
            last, last_short, tail, last_number = p, short, end, number
        if run:
            runs.update(_read_as(run))
        return {w: known[5] for w, known in dict(zip(words, pieces)).items()}, {r for r in runs if _LETTER.search(r)}

    def tokens(self, text: str) -> set[str]:
        """Distinct tokens, and the runs of tokens whose gaps may be dropped, joined by blanks."""
        found, runs = self.scan(text)
        return set(found) | {r.replace(SURE, " ") for r in runs}


def _read_as(run: list[str]) -> Iterator[str]:
    """A run (tokens and gaps) as it stands, and its short tokens without the longer ones beside them (whose own reading may pull letters over)."""
    yield "".join(run)
    if len(run) == 3 or max(map(len, run)) <= SHORT:
        return
    at = 0
    for short, part in groupby(run[::2], lambda p: len(p) <= SHORT):
        n = len(list(part))
        if short and n > 1:
            yield "".join(run[2 * at:2 * (at + n) - 1])
        at += n


def _is_number(token: str) -> bool:
    """Too long to be a piece of a word, and without a letter."""
    return len(token) > SHORT and not token.isalpha() and not _LETTER.search(token)


class Lister(Restorer):
    """Restored words' features."""

    def __init__(self, counts: np.ndarray):
        super().__init__(counts)
        self.known: dict[str, tuple[int, ...]] = {}

    def value(self, token: str, piece: str) -> tuple[int, ...]:
        word = piece if piece.isalpha() else token
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= CACHED:
                self.known.clear()
            found = self.known[word] = self.listed(word)
        return found

    def listed(self, token: str) -> tuple[int, ...]:
        return tuple([f for w in self.forms(token) if w for f in features(w)])


class Scorer(Restorer):
    def __init__(self, counts: np.ndarray, evidence: np.ndarray, weights: np.ndarray | None = None):
        super().__init__(counts)
        self.evidence, self.weights = array("f", evidence.astype(np.float32).tobytes()), weights
        self.known: dict[str, float] = {}

    def value(self, token: str, piece: str) -> float:
        """The evidence of a token: that of the word without the marks around it, if nothing else is left."""
        word = piece if piece.isalpha() else token
        found = self.known.get(word)
        if found is None:
            found = self.known[word] = self.of_token(word)
        return found

    def of_word(self, word: str) -> float:
        """The largest evidence of a word's ``features``; a prefix's checksum goes on from that of the one before."""
        if not word:
            return 0.0
        evidence, raw, n = self.evidence, word.encode("utf-8", "surrogatepass"), len(word)
        if len(raw) > n:
            return max([evidence[f] for f in features(word)])
        most = evidence[crc32(raw) % FEATURES]
        if n > 3:
            crc = crc32(raw[:3], _CARET)
            most = max(most, evidence[crc % FEATURES])
            for i in range(3, min(n - 1, 6)):
                crc = crc32(raw[i:i + 1], crc)
                most = max(most, evidence[crc % FEATURES])
        return most

    def of_token(self, token: str) -> float:
        """The largest evidence of the words that a token or a run stands for."""
        forms = self.forms(token)
        return self.of_word(forms[0]) if len(forms) == 1 else max([self.of_word(w) for w in forms], default=0.0)

    def measure(self, text: str | None) -> tuple[float, float, float, float]:
        """The three largest evidences of a text's words, and the log of their number."""
        if not text:
            return 0.0, 0.0, 0.0, 0.0
        known = self.known
        if len(known) >= CACHED:
            known.clear()
        tokens, runs = self.scan(text)
        count = len(tokens) + len(runs)
        values = [v for v in tokens.values() if v]
        for r in runs:
            if len(r) > REMEMBERED:                      # long runs hardly ever come again
                v = self.of_token(r)
            elif (v := known.get(r)) is None:
                v = known[r] = self.of_token(r)
            if v:
                values.append(v)
        values = sorted(values, reverse=True)[:3] + [0.0] * 3
        return values[0], values[1], values[2], float(np.log1p(count))

    def score(self, text: str | None) -> float:
        z = float(np.dot(self.weights, (1.0, *self.measure(text))))
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def _task_models(shared, kind):
    """One scorer per broadcast and worker (a broadcast is deserialized once per worker)."""
    value = shared.value
    if "scorer" not in value:
        value["scorer"] = kind(value)
    return value["scorer"]


def bucket5(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(-1))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> dict:
    """Character model, evidence per feature bucket and calibration weights."""
    sc = docs.sparkSession.sparkContext
    counts = char_model(docs)
    shared = sc.broadcast({"counts": counts})
    chosen = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__id")) \
        .agg(F.max("toxic").alias("__y")).withColumn("__part", bucket5(F.col("__id"))).where("__part <> 0") \
        .orderBy(F.xxhash64("__id"), "__id").limit(train_rows)
    train = docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["__id"]) \
        .select("__id", "__y", "__part", F.col("text").cast("string")).distinct()          # a repeated row counts once
    train = written(train, "toxicity-train")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = _task_models(shared, lambda m: Lister(m["counts"]))
        for batch in batches:
            seen = {0: np.zeros(FEATURES, np.int64), 1: np.zeros(FEATURES, np.int64)}
            docs_seen = [0, 0]
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens, runs = restorer.scan(text or "")
                found: set[int] = set().union(*tokens.values())
                for r in runs:                          # they hardly ever come again
                    found.update(restorer.listed(r))
                seen[int(y)][list(found)] += 1
                docs_seen[int(y)] += 1
            at = np.flatnonzero(seen[0] + seen[1])
            yield pa.RecordBatch.from_arrays([pa.array([-1, *at.tolist()], pa.int32()),
                                              pa.array([docs_seen[0], *seen[0][at].tolist()], pa.int64()),
                                              pa.array([docs_seen[1], *seen[1][at].tolist()], pa.int64())], names=["f", "n0", "n1"])

    first = train.where("__part <> 4").select(F.when(F.col("__y") > 0, 1).otherwise(0).cast("int").alias("y"), "text")
    table = first.mapInArrow(count, "f int, n0 bigint, n1 bigint").groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    n0, n1 = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)                 # at most FEATURES + 1 rows
    at = table["f"].to_numpy()
    n0[at], n1[at] = table["n0"].to_numpy(), table["n1"].to_numpy()
    all0, all1 = n0[-1] + 1, n1[-1] + 1
    n0, n1 = n0[:-1] + 0.5, n1[:-1] + 0.5
    evidence = np.log(n1 / all1) - np.log(n0 / all0) - 1.5 * np.sqrt(1 / n1 + 1 / n0)
    evidence = np.maximum(evidence, 0.0).astype(np.float32)

    model = {"counts": counts, "evidence": evidence}
    second = train.where("__part = 4").select(F.when(F.col("__y") > 0, 1).otherwise(0).cast("int").alias("y"), "text")
    shared2 = sc.broadcast(dict(model))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _task_models(shared2, lambda m: Scorer(m["counts"], m["evidence"]))
        for batch in batches:
            got = [(float(y), *scorer.measure(t)) for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in (zip(*got) if got else [[]] * 5)], names=list("yabcn"))

    measured = written(second.mapInArrow(measure, "y double, a double, b double, c double, n double"), "toxicity-measured")
    return model | {"weights": _logistic(measured)}


def _slopes(measured: DataFrame, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of the log loss at ``w``, summed by Spark: one row of 30 numbers."""
    names = [f"s{i}" for i in range(30)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(30)
        for batch in batches:
            rows = np.column_stack([batch.column(i).to_numpy() for i in range(5)])
            x = np.column_stack((np.ones(len(rows)), rows[:, 1:]))
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            total[:5] += x.T @ (p - rows[:, 0])
            total[5:] += ((x * (p * (1 - p))[:, None]).T @ x).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in total], names=names)

    sums = measured.mapInArrow(run, ", ".join(f"{c} double" for c in names)).agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in names]).first()
    return np.array(sums[:5]), np.array(sums[5:]).reshape(5, 5)


def _logistic(measured: DataFrame) -> np.ndarray:
    """Ridge logistic regression of y on (a, b, c, n) by Newton steps; classes weigh as they occur."""
    w = np.zeros(5)
    w[0] = -1.0
    for _ in range(50):
        grad, hess = _slopes(measured, w)
        step = np.linalg.solve(hess + 0.1 * np.eye(5), grad + 0.1 * w)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


def score_toxicity(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if score >= 0.5, else 0).

    Null and empty texts get the score of a text without evidence.  Repeated
    rows score alike; an empty table gives an empty one; columns called like
    an output are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dict(model))
    out_cols = others(docs, ("score", "predicted"))
    schema = T.StructType([*[docs.schema[c] for c in out_cols], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _task_models(shared, lambda m: Scorer(m["counts"], m["evidence"], m["weights"]))
        for batch in batches:
            scores = [scorer.score(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(out_cols))], pa.array(scores, pa.float64()),
                                              pa.array([int(s >= 0.5) for s in scores], pa.int32())], names=[*out_cols, "score", "predicted"])

    return docs.select(*[F.col(f"`{c}`") for c in out_cols], F.col(f"`{text_col}`").cast("string").alias("__text")).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Fit on the labelled part and score every document of ``docs`` (doc_id, text)."""
    return score_toxicity(docs, fit(docs.select("doc_id", "text"), labels, train_rows))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity(docs, read(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return scored.select("doc_id", (bucket5(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")
