"""Operators across texts against brute force: n-gram join, line dedup, repeated strings, components."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import components, line_dedup, ngram_join, set_join, suffix_dedup
from fleetlens.llm.common import scaled_signatures
from tests.llm.data import SCHEMA, documents, edited, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _sets(rows, n):
    out = []
    for r in rows:
        w = WORD.findall((r[1] or "").translate(LOWER))
        out.append(frozenset(tuple(w[i:i + n]) for i in range(max(len(w) - n + 1, 1))) if w else frozenset())
    return out


def _components(sets, percent):
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * len(sets[i] | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_ngram_components_equal_brute_force(spark, docs, empty, n, percent):
    rows = documents() + [(500 + i, edited(prose(1, 300), 300 + i, 0.012), "en", "s", 1) for i in range(25)]
    sets = _sets(rows, n)
    roots = _components(sets, percent)
    low = {}
    for r, root in zip(rows, roots):
        if r[0] is not None:
            low[root] = min(low.get(root, r[0]), r[0])
    want = sorted((str(r[0]), len(s), str(low.get(root) if s else r[0])) for r, s, root in zip(rows, sets, roots))
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = ngram_join.jaccard_components(table, n, percent).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == want
    kept = ngram_join.drop_near_duplicates(table, n, percent)
    groups = {root for root, s in zip(roots, sets) if s}
    assert kept.columns == table.columns
    assert kept.count() == len(groups) + sum(not s for s in sets)
    assert ngram_join.jaccard_components(empty).count() == 0


def test_near_copies_are_never_all_paired(spark, monkeypatch):
    """3,000 edits of one text, many pairs of them just below the limit: links stay in proportion to documents."""
    counted = {}

    def counting(df, name):
        out = common_written(df, name)
        counted[name] = max(counted.get(name, 0), out.count())
        return out

    common_written = ngram_join.written
    monkeypatch.setattr(ngram_join, "written", counting)
    rows = [(i, edited(prose(1, 60), 1000 + i, 0.02), "en", "s", 1) for i in range(3000)]
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(spark.createDataFrame(rows, SCHEMA).repartition(4), 3, 90).collect()}
    sets = sorted(set(_sets(rows, 3)), key=sorted)
    roots = dict(zip(sets, _components(sets, 90)))
    low = {}
    for r, s in zip(rows, _sets(rows, 3)):
        low[roots[s]] = min(low.get(roots[s], r[0]), r[0])
    assert got == {r[0]: low[roots[s]] for r, s in zip(rows, _sets(rows, 3))}
    buckets = -(-counted["ngram-contested"] // ngram_join.BUCKET_ROWS)
    assert counted["ngram-links"] <= len(sets) * (1 + max(buckets, 1))


def test_buckets_of_any_number_give_the_same_components(spark, monkeypatch):
    rows = [(i, edited(prose(1 + i % 3, 200), 300 + i, 0.02), "en", "s", 1) for i in range(120)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    one = sorted(ngram_join.jaccard_components(docs, 3, 80).select("doc_id", "component_id").collect())
    monkeypatch.setattr(ngram_join, "BUCKET_ROWS", 50)
    monkeypatch.setattr(ngram_join, "REMEMBERED", 3)
    assert sorted(ngram_join.jaccard_components(docs, 3, 80).select("doc_id", "component_id").collect()) == one


def test_long_signatures_grow_with_the_set(spark):
    """Sets of 6,000 tokens with Jaccard 0.5 or 0.7 are told apart by their signatures, also from shorter ones; similar ones never are."""
    rng = np.random.default_rng(1)
    token = np.unique(rng.integers(0, 1 << 48, 20_000, dtype=np.uint64))
    token = token[rng.permutation(len(token))]
    sets = [token[:6000], token[2000:8000], token[1058:7058], token[100:6050], token[:3500], token[:150]]
    sigs = scaled_signatures(np.concatenate(sets), np.array([len(x) for x in sets]), 512)
    assert [len(x) for x in sigs] == [1024, 1024, 1024, 1024, 512, 64]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i)]
    apart = set_join.Signatures(sigs).apart(*np.array(pairs).T)
    for (i, j), bits in zip(pairs, apart.tolist()):
        assert bits <= len(np.setxor1d(sets[i], sets[j]))
    known = spark.createDataFrame([(i, len(x), bytes(sig)) for i, (x, sig) in enumerate(zip(sets, sigs))], "k long, n int, sig binary")
    got = set_join.plausible(spark.createDataFrame(pairs, "u long, v long"), known, 90).collect()
    assert [(r.u, r.v) for r in got] == [(3, 0)]


def test_near_duplicates_keep_clashing_columns(spark, docs):
    clashing = docs.select("doc_id", "text", *[F.lit(i).alias(c) for i, c in enumerate(("k", "n", "component", "set_key", "text_key", "token", "bucket", "v"))])
    kept = ngram_join.drop_near_duplicates(clashing)
    assert kept.columns == clashing.columns
    assert kept.count() == ngram_join.drop_near_duplicates(docs).count()


def test_prefix_order_is_the_same_in_every_text():
    counts = np.random.default_rng(1).integers(0, 50, 2 * ngram_join.SKETCH)
    rarity = ngram_join.Rarity(counts)
    text = prose(5, 400)
    alone = ngram_join.shingle_chunk([(0, text.encode())], 3)
    after = ngram_join.shingle_chunk([(0, prose(6, 333).encode()), (1, text.encode())], 3)
    a = dict(zip(alone[0].tolist(), rarity.measure(*(alone[i] for i in (0, 2, 3, 4))).tolist()))
    b = dict(zip(after[0].tolist(), rarity.measure(*(after[i] for i in (0, 2, 3, 4))).tolist()))
    assert all(b[h] == level for h, level in a.items())


def test_components_of_random_links(spark):
    rnd = random.Random(2)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)] + [(7, i) for i in range(2000, 2100)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in links:
        if u != v:
            root[max(find(u), find(v))] = min(find(u), find(v))
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: find(x) for x in list(root)}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_line_dedup_equals_brute_force(spark, empty):
    base = [prose(i, 30) for i in range(12)]
    rows = documents()
    for i in range(40):
        rnd = random.Random(i)
        rows.append((600 + i, "\n".join(rnd.choice([rnd.choice(base), edited(rnd.choice(base), i, 0.08), prose(5000 + i, 20), "short line", "}"])
                                        for _ in range(6)), "en", "s", 99))
    rows = [r for r in rows if r[0] is not None]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("n_lines", F.lit("clash"))
    earlier, gone = [], set()
    for doc_id, text in sorted({(r[0], r[1]) for r in rows if r[1] is not None}):
        for number, line in enumerate(text.split("\n")):
            words = frozenset(WORD.findall(line.translate(LOWER)))
            if len(words) < line_dedup.MIN_WORDS:
                continue
            if any(100 * len(words & e) >= 80 * len(words | e) for e in earlier):
                gone.add((doc_id, number))
            earlier.append(words)
    got = line_dedup.dedup_lines(table)
    assert sorted(got.columns) == sorted(table.columns + ["n_removed"])
    for r in got.collect():
        source = next(x[1] for x in rows if x[0] == r.doc_id)
        if source is None:
            assert (r.text, r.n_lines, r.n_removed) == (None, 0, 0)
            continue
        lines = source.split("\n")
        kept = [x for i, x in enumerate(lines) if (r.doc_id, i) not in gone]
        assert (r.text, r.n_lines, r.n_removed) == ("\n".join(kept), len(lines), len(lines) - len(kept)), r.doc_id
    assert line_dedup.dedup_lines(empty).count() == 0


def test_frequent_words_meet_by_size_band_and_block(spark, monkeypatch):
    """Every word is frequent and every band is cut: the same lines go as by comparing all pairs."""
    for module in (line_dedup, set_join):
        monkeypatch.setattr(module, "BLOCK", 3)
    rnd, rows = random.Random(7), []
    for i in range(120):
        words = rnd.sample(range(60), rnd.choice((6, 9, 12, 15, 19, 24, 30)))
        if i % 3 and rows:
            words = [int(w[1:]) for w in rows[rnd.randrange(len(rows))][1].split(" ")]
            words = [w for w in words if rnd.random() > 0.09] + [rnd.randrange(60) for _ in range(rnd.randrange(3))]
        rows.append((i, " ".join(f"w{w}" for w in dict.fromkeys(words))))
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    sets = [frozenset(t.split(" ")) for _, t in rows]
    want = {i: int(any(100 * len(a & b) >= 80 * len(a | b) for b in sets[:i])) for i, a in enumerate(sets)}
    assert got == want and 20 < sum(want.values()) < 100


def test_line_dedup_removes_repeats_of_short_lines(spark):
    """Lines of one to three distinct words, at any length, go like all others; lines without words stay."""
    long = "la " * 40 + "di da"
    rows = [(1, "Les.\nAnd ornd.\none two three\n \n" + long), (2, "les.\nornd. And\none two\n \n" + long), (3, "Les.\none two three four\n\nLes."),
            (4, "three two one\none two three four five\n" + "da di la"), (None, "Les.")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in got} == {
        1: (rows[0][1], 5, 0), 2: ("one two\n ", 5, 3), 3: ("one two three four\n", 4, 2), 4: ("", 3, 3), None: ("", 1, 1)}


def test_small_line_sets_match_at_any_percent(spark):
    """At 60 percent, two words of three are enough: the bound for sets without a prefix follows the percentage."""
    rows = [(1, "a b"), (2, "a b c"), (3, "a"), (4, "b"), (5, "a")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), percent=60).collect()
    assert {r.doc_id: r.n_removed for r in got} == {1: 0, 2: 1, 3: 0, 4: 0, 5: 1}


def _removed(texts):
    seen = {}
    for t in texts:
        for i in range(len(t) - 399):
            seen[t[i:i + 400]] = seen.get(t[i:i + 400], 0) + 1
    out = []
    for t in texts:
        mark = bytearray(len(t))
        for i in range(len(t) - 399):
            if seen[t[i:i + 400]] > 1:
                mark[i:i + 400] = b"\1" * 400
        spans = [m.span() for m in re.finditer(b"\1+", bytes(mark))]
        out.append((len(t), sum(mark), len(spans), hashlib.sha256(bytes(c for c, k in zip(t, mark) if not k)).hexdigest()))
    return out


def test_repeated_strings_equal_brute_force(spark, empty):
    passage = prose(3, 120)
    rows = documents() + [(700, "x" * 1500, None, None, 1), (701, prose(70, 100) + passage[17:] + prose(71, 100), None, None, 1),
                          (702, passage[:399], None, None, 1), (703, passage[:400], None, None, 1)]
    texts = [(r[1] or "").encode() for r in rows]
    want = sorted((str(r[0]), *x) for r, x in zip(rows, _removed(texts)))
    table = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("KEPT", F.lit(1))
    got = suffix_dedup.remove_repeats(table).withColumn("h", F.sha2("kept", 256)).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.h) for r in got) == want
    for r in got:
        assert sum(b - a for a, b in r.spans) == r.n_removed
    assert suffix_dedup.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("rows", [1, 500_000, 10**8])
def test_cut_groups_find_the_same_spans(rows):
    """However a minimizer's windows are cut, the repeated spans are the same."""
    rnd = random.Random(rows)
    alphabet = b"abcdef gh"
    shared = bytes(rnd.choice(alphabet) for _ in range(900))
    texts = [bytes(rnd.choice(alphabet) for _ in range(600)) + shared[i:] + bytes(rnd.choice(alphabet) for _ in range(500)) for i in range(3)]
    groups: dict[tuple, list] = {}
    for t, text in enumerate(texts):
        for p, lo, hi, h, _ in zip(*[x.tolist() for x in suffix_dedup.minimizers(text)]):
            for c, *row, seg in suffix_dedup.cut(text, t, p, lo, hi, rows):
                groups.setdefault((h, c), []).append((seg, row[0], row[1], row[2], row[3]))
    covered = [bytearray(len(t)) for t in texts]
    for group in groups.values():
        for t, a, b in zip(*[x.tolist() for x in suffix_dedup.repeated(*map(list, zip(*group)))]):
            covered[t][a:b] = b"\1" * (b - a)
    assert [sum(c) for c in covered] == [x[1] for x in _removed(texts)]


def test_minimizers_do_not_depend_on_pieces(monkeypatch):
    text = prose(9, 4000).encode()
    whole = suffix_dedup.minimizers(text)
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    assert all((a == b).all() for a, b in zip(whole, suffix_dedup.minimizers(text)))
