"""Operators on single texts: BPE, quality, toxicity, sharding, decontamination."""

from __future__ import annotations

import re
import struct

import pytest
from pyspark.sql import functions as F

from fleetlens.llm import bpe, decontaminate, quality, sharding, toxicity
from tests.llm.data import SCHEMA, documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_bpe_equals_the_tokenizers_library(docs, empty):
    from tokenizers import Tokenizer
    known = Tokenizer.from_file(bpe.default_vocabulary())
    rows = bpe.bpe_encode(docs.withColumn("N_TOKENS", F.lit("clash")), bpe.default_vocabulary()).collect()
    assert len(rows) == len(documents())
    for r in rows:
        ids = known.encode(r.text or "", add_special_tokens=False).ids
        assert list(struct.unpack(f"<{r.n_tokens}I", r.ids)) == ids
        assert r.decoded == known.decode(ids, skip_special_tokens=False)
    assert bpe.bpe_encode(empty, bpe.default_vocabulary()).count() == 0
    arrays = bpe.ids_array(bpe.bpe_encode(docs, bpe.default_vocabulary())).select("ids", "n_tokens").collect()
    assert all(len(r.ids) == r.n_tokens for r in arrays)


def test_bpe_trie_on_odd_texts():
    from tokenizers import Tokenizer
    known = Tokenizer.from_file(bpe.default_vocabulary())
    encoder = bpe.Encoder(bpe.load_vocabulary(bpe.default_vocabulary()), cached_words=50)
    texts = ["ΣΑΣ İstanbul don't we'll x'd a\x85b 中文字 ½ ² Ⅷ <|startoftext|>Hi<|endoftext|> <|START|>", "aaaa" * 500, "ab" * 300, "\x00\x01",
             prose(1, 500), "é é ß K"]
    for text, (n, ids, decoded) in zip(texts, encoder.encode_batch(texts)):
        want = known.encode(text, add_special_tokens=False).ids
        assert list(struct.unpack(f"<{n}I", ids)) == want and decoded == known.decode(want, skip_special_tokens=False)
        assert encoder.decode(want) == decoded


def _base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows: dict[tuple, list[int]] = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {p + k for at in windows.values() if len(at) > 1 for p in at for k in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_base_measures_and_verdict(spark, docs, empty):
    labels = spark.createDataFrame([(i, 1 if i % 2 else 0, 0) for i in range(30)] + [(1, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.quality_rules(docs.withColumn("Kept", F.lit(7)), labels, n_buckets=256).collect()
    assert len(rows) == len(documents())
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == _base(r.text)
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.score >= quality.MIN_SCORE)
    again = quality.quality_rules(docs.repartition(7), labels, n_buckets=256).collect()
    key = lambda r: (r.doc_id or -1, r.text or "", r.score)
    assert sorted(map(key, rows)) == sorted(map(key, again))
    assert quality.quality_rules(empty, labels).count() == 0
    none = quality.quality_rules(docs, labels.where("false"), n_buckets=64).collect()
    assert {r.score for r in none} == {0.0}


def test_sharding_fits_and_equals_sql(spark, docs, empty):
    import duckdb
    rows = documents()
    got = sharding.shard_documents(docs.withColumn("fits", F.lit(1)), limit=3000)
    sizes = {}
    for r in got.collect():
        size = len((r.text or "").encode())
        sizes[r.shard] = sizes.get(r.shard, 0) + size
        assert len(r.shard) == r.depth and r.fits == (r.shard_bytes <= 3000)
    assert {r.shard: r.shard_bytes for r in got.collect()} == sizes
    shards = sorted(sizes)
    assert not any(b.startswith(a) for a, b in zip(shards, shards[1:]))      # a directory: no shard inside another
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [[r[0], r[1]] for r in rows if r[0] not in (0, None)])
    sql = {r[0]: r[1:] for r in con.execute(sharding.SQL.replace(str(sharding.SHARD_BYTES), "3000")).fetchall()}
    unique = spark.createDataFrame([r for r in rows if r[0] not in (0, None)], SCHEMA)
    mine = {r.doc_id: (r.shard, r.depth, r.shard_bytes, r.fits) for r in sharding.shard_documents(unique, limit=3000).collect()}
    assert mine == sql
    assert sharding.shard_documents(empty, limit=10).count() == 0


def test_decontamination_finds_edited_passages_and_no_others(spark, docs, empty):
    item = prose(77, 40)
    words = item.split(" ")
    words[7], words[20] = "changed", "words"
    rows = documents() + [(900, prose(78, 300) + " " + item.upper() + ". " + prose(79, 100), "en", "s", 1),
                          (901, " ".join(words), "en", "s", 1), (902, prose(80, 50) + " " + " ".join(item.split(" ")[:16]), "en", "s", 1)]
    table = spark.createDataFrame(rows, SCHEMA)
    bench = spark.createDataFrame([(1, item), (2, prose(81, 30)), (3, None), (4, ""), (5, "too short"), (1, item)], "item_id long, text string")
    hits = {(r.doc_id, r.item_id) for r in decontaminate.benchmark_hits(table, bench).collect()}
    assert hits == {(900, 1), (901, 1), (902, 1)}
    kept = decontaminate.decontaminate(table, bench)
    assert kept.columns == table.columns and kept.count() == len(rows) - 3
    assert decontaminate.decontaminate(empty, bench).count() == 0
    assert decontaminate.decontaminate(docs, bench.where("false")).count() == len(documents())


def test_short_items_equal_a_scan_of_all_diagonals(spark):
    """Items of 5 to 20 tokens, one token substituted at every place, and none, two or halves only, between other words."""
    items, rows = [], []
    for n in (5, 7, 8, 9, 10, 12, 13, 14, 20):
        words = [f"b{n}x{i}" for i in range(n)]
        items.append((None if n == 9 else n, " ".join(words)))
        for wrong in [(), *[(i,) for i in range(n)], (1, n - 2), tuple(range(n // 2))]:
            rows.append((len(rows), " ".join(["left words", *["zz" if i in wrong else w for i, w in enumerate(words)], "right words"])))
    got = {(r.doc_id, r.item_id) for r in decontaminate.benchmark_hits(spark.createDataFrame(rows, "doc_id long, text string"),
                                                                       spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = set()
    for doc_id, text in rows:
        doc = text.split(" ")
        for item_id, own in ((i, t.split(" ")) for i, t in items):
            for shift in range(-len(own), len(doc)):
                same = [0 <= shift + i < len(doc) and doc[shift + i] == w for i, w in enumerate(own)]
                run = best = 0
                for x in same:
                    run = max(run + (1 if x else -decontaminate.MISMATCH), 0)
                    best = max(best, run)
                if best >= min(decontaminate.MIN_SCORE, len(own)) or len(own) >= 8 and sum(same) >= len(own) - 1:
                    want.add((doc_id, item_id))
    assert got == want and {i for _, i in got} == {i for i, _ in items}


def test_toxicity_held_out_and_obfuscated(spark, empty):
    bad = ["idiot", "moron", "scum", "loser"]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        text = prose(1000 + i, 60)
        if toxic:
            text = text + f" {bad[i % 16 // 4]} " + prose(3000 + i, 10) + f" {bad[(i // 4 + 1) % 4]}."
        rows.append((i, text, "en", "s", 1))
        labels.append((i, int(toxic)))
    rows += [(1000, None, None, None, None), (1001, "", None, None, 0), (None, "x", None, None, 1), rows[0]]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("SCORE", F.lit("clash"))
    marks = spark.createDataFrame(labels + [(0, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(table.select("doc_id", "text"), marks)
    got = {r.doc_id: r for r in toxicity.score_toxicity(table, model).collect()}
    held = [i for i in range(400) if __import__("zlib").crc32(str(i).encode()) % 5 == 0]
    right = sum(got[i].predicted == (i % 4 == 0) for i in held)
    assert right >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    scorer = toxicity.Scorer(model["counts"], model["evidence"], model["weights"])
    clean = prose(9, 40)
    for word in ("1d1ot", "i d i o t", "m0r0n", "iiidiooot", "$cum", "l-o-s-e-r"):
        assert scorer.score(f"{clean} {word} {clean} {word}") > scorer.score(f"{clean} river {clean} stone")
    assert toxicity.score_toxicity(empty, model).count() == 0


def test_toxicity_segments_runs_of_short_tokens():
    """A gap is dropped or kept by the language model, with one-letter words beside it and in pieces of any length."""
    said = "you are a friend and he is an idiot or such a moron, a scum and a loser are here "
    tri, pair = toxicity.char_counts("".join(said + prose(i, 20).replace("w", " ") + " " for i in range(60)))
    restorer = toxicity.Restorer(toxicity.np.concatenate((tri, pair)))
    for text, want in (("you are a m o r o n", "moron"), ("y o u i d i o t", "idiot"), ("he is an id iot here", "idiot"), ("such a mo r on", "moron"),
                       ("a lose r", "loser"), ("river m 0 r o n, stone", "moron"), ("a s c u m.", "scum")):
        words = {f for t in restorer.tokens(text) for f in restorer.forms(t)}
        assert want in words, (text, words)
    words = {f for t in restorer.tokens("you are a friend and he is an idiot") for f in restorer.forms(t)}
    assert words == {"you", "are", "a", "friend", "and", "he", "is", "an", "idiot"}


def test_toxicity_gaps_cut_early_leave_the_same_segments():
    """Cutting runs at kept gaps changes nothing: the whole text as one lattice has the same words."""
    tri, pair = toxicity.char_counts(" ".join(prose(i, 200, 50) for i in range(20)) + " the cat sat on a mat of an old inn to be in it")
    restorer = toxicity.Restorer(toxicity.np.concatenate((tri, pair)))
    for text in ("the cat sat on a mat", "in it to be of an old a in", "o f the c at sa t on", "inn all of ss as a s", "a " * 300):
        whole = set(restorer.decoder.restore(" ".join(text.split())).split())
        assert whole <= {w for t in restorer.tokens(text) for w in ([t] if " " not in t else restorer.decoder.restore(t).split())}


def test_toxicity_reads_windows_between_fixed_letters():
    """Tokens that differ only away from what is odd share a remembered window, and read as the whole token does."""
    tri, pair = toxicity.char_counts(" ".join(prose(i, 200, 50) for i in range(20)) + " the cat sat on a mat of an old inn to be in it")
    decoder = toxicity.Restorer(toxicity.np.concatenate((tri, pair))).decoder
    ends = [a + b for a in "bcdfg" for b in "aeiou"]
    for token in [f"{x}m00n{y}st" for x in ends for y in ends] + [f"{x}ring a ba{y}" for x in ends for y in ends]:
        assert decoder.reading(token) == decoder.restore(token), token
    assert len(decoder.readings) <= 5 * 5 * 25 + 1
    for token in ("aa", "a", "1d1ot", "baab", "abba a abba", "a a", "aab b baa", "½x½", "m o ooo n", "xx.yy", "llama, 1l1ama"):
        assert decoder.reading(token) == decoder.restore(token), token
    assert decoder.reading("plainword") == "plainword" and "plainword" not in decoder.readings


def test_toxicity_fit_counts_repeated_rows_once_and_keeps_them_off_the_driver(spark, monkeypatch):
    rows = [(i, prose(1000 + i, 30) + (" idiot scum" if i % 4 == 0 else "")) for i in range(120)]
    marks = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(120)], "doc_id long, toxic int")
    again = next(r for r in rows if __import__("zlib").crc32(str(r[0]).encode()) % 5 == 4)
    once, often = (spark.createDataFrame(r, "doc_id long, text string") for r in (rows, rows + [again] * 60))
    monkeypatch.setattr(toxicity, "char_model", lambda docs, counts=toxicity.char_model(once): counts)
    monkeypatch.delattr(type(once), "toPandas")
    a, b = toxicity.fit(once, marks), toxicity.fit(often, marks)
    assert (a["evidence"] == b["evidence"]).all() and abs(a["weights"] - b["weights"]).max() < 1e-9


def test_decontamination_finds_short_items_word_for_word(spark):
    rows = [(1, "He said: Too short!"), (2, "too very short"), (3, "a b c d e f g h"), (4, "b c d e f x g"), (5, "word " * 50), (6, "中文句子。好"), (7, "too"), (8, None)]
    items = [(1, "too short"), (2, "b c d e f g"), (3, "word"), (4, "中文句子"), (5, "a b c d e f g h"), (6, ""), (7, None)]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.score, r.n_hits) for r in decontaminate.benchmark_hits(docs, bench).collect()}
    assert got == {(1, 1, 2, 1), (3, 2, 6, 1), (5, 3, 1, 1), (6, 4, 1, 1), (3, 5, 8, 1)}
