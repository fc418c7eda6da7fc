"""Source divergences against a brute-force evaluation of their definition."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fleetlens.llm import source_audit
from tests.llm.data import SCHEMA, documents, prose

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_documents=3, top=200):
    df, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = TERM.findall((text or "").translate(FOLD))
        df[lang].update(set(words))
        counts[lang, source].update(words)
    out = []
    for lang, source in groups:
        kept = [t for t, n in df[lang].items() if n >= min_documents]
        peers = sorted(s for g, s in groups if g == lang)
        whole = {s: sum(counts[lang, s][t] for t in kept) + len(kept) for s in peers}
        total = Counter()
        for s in peers:
            total.update(counts[lang, s])
        everything = sum(total[t] for t in kept) + len(kept)
        p = {s: {t: 1 + 10**9 * (counts[lang, s][t] + 1) // whole[s] for t in kept} for s in peers}
        q = {t: 1 + 10**9 * (total[t] + 1) // everything for t in kept}
        f = lambda a, b: (a - b) ** 2 // b
        pair = [(s, sum(f(p[source][t], p[s][t]) for t in kept)) for s in peers if s != source]
        term = [(t, f(p[source][t], q[t])) for t in kept if counts[lang, source][t] and p[source][t] > q[t]]
        for part, items in (("pair", pair), ("term", term)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, i, v, k) for k, (i, v) in enumerate(items, 1) if part == "pair" or k <= top]
    return sorted(out)


def mixed_rows(seed=5, n=160):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rnd.choice(["en", "en", "en", "de", None, ""])
        source = "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", "Ä", None, "", "only" + str(i)])
        text = rnd.choice([None, "", "123 --", prose(i, rnd.randrange(1, 60), 50), "Été ÉTÉ été İx 中文 中文! x9y A-B_c", "tie tie knot knot"])
        rows.append((i, text, lang, source, None))
    return rows + rows[:5]


def got(spark, rows, **how):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    # Clashing and other columns change nothing.
    docs = docs.withColumn("TERM", F.lit("x")).withColumn("stripe", F.lit(1)).withColumn("value", F.lit(2.0))
    return sorted(tuple(r) for r in source_audit.divergences(docs, **how).collect())


@pytest.mark.parametrize("held", [200_000, 7])
def test_divergences_equal_brute_force(spark, held):
    rows = mixed_rows()
    want = brute(rows, top=6)
    assert any(r[2] == "term" for r in want) and any(r[4] > 0 for r in want)
    assert got(spark, rows, top=6, held=held) == want


def test_awkward_rows_and_languages_without_kept_terms(spark):
    rows = documents()
    assert got(spark, rows) == brute(rows)
    rows = [(1, "alone", "en", "a", 0), (2, None, "en", "b", 0), (None, None, None, None, None)]
    assert got(spark, rows) == brute(rows) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert source_audit.divergences(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_texts_are_split_between_terms():
    text = ("Ab é中 " * 900_000 + "end").encode()
    assert len(text) > source_audit.SPLIT_BYTES
    assert source_audit.term_counts(text) == Counter({b"ab": 900_000, "é中".encode(): 900_000, b"end": 1})


def test_spilled_stripes_hold_no_more_than_their_limit(spark):
    """A task emits its stripes as soon as they hold ``held`` entries, in the middle of a document if need be."""
    import pyarrow as pa
    texts = [" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(k, k + 300)) for k in (0, 200, 0)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 3), pa.array(["s", "s", "t"]), pa.array([t.encode() for t in texts])], names=["lang", "source", "text"])
    out = list(source_audit._fold(100)(iter([batch])))
    assert max(b.num_rows for b in out) <= 101
    df = Counter()
    for b in out:
        for term, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            df[term] += n
    want = Counter(w for t in texts for w in set(t.split()))
    assert {k: v for k, v in df.items() if k} == dict(want)


def test_sql_twin(spark, tmp_path):
    import duckdb
    rows = mixed_rows(9)
    path = str(tmp_path / "d")
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    cur = con.execute(source_audit.SQL)
    names = [d[0] for d in cur.description]
    at = [names.index(c) for c in ("lang", "source", "part", "item", "value", "rank")]
    assert sorted(tuple(r[i] for i in at) for r in cur.fetchall()) == got(spark, rows)
