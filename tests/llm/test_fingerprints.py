"""Multiset fingerprints: their algebra, and every document beside the next one against plain Python."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import fingerprints as fp
from tests.llm.data import SCHEMA, documents, edited, prose


def test_order_of_paragraphs_does_not_matter_but_every_byte_does():
    text = "first paragraph here\n\nsecond one\nthird one, é 中\nsecond one"
    parts = text.split("\n")
    random.Random(1).shuffle(parts)
    assert fp.fingerprint(text) == fp.fingerprint("\n".join(parts))
    for other in (text + "\n", text.replace("second one", "second  one", 1), text.replace("\nsecond one", "", 1), text.lower().upper(), ""):
        assert fp.fingerprint(other) != fp.fingerprint(text)
    assert fp.fingerprint(None) == fp.fingerprint("") != fp.fingerprint("\n")


def test_insertion_deletion_and_sum():
    text, more = prose(1, 80) + "\n" + prose(2, 50), prose(3, 20) + "\n" + prose(2, 50)
    whole = fp.fingerprint(text + "\n" + more)
    assert fp.inserted(fp.fingerprint(text), more) == whole
    assert fp.deleted(whole, more) == fp.fingerprint(text)
    assert fp.deleted(fp.inserted(whole, "x"), "x") == whole
    v = fp.vectors([text.encode(), more.encode(), None])
    assert (v[0:1] + v[1:2]).texts() == [whole] and not v.wide[2].any() and not v.narrow[2].any()
    assert fp.Vectors.parse(v.texts()).texts() == v.texts()


def test_one_batch_or_many_give_the_same_vectors():
    texts = [(t or "").encode() for _, t, *_ in documents()] + [None, b"\n\n", b"a\nb c\nd e f\n g h i j "]
    together = fp.vectors(texts).texts()
    assert together == [fp.vectors([t]).texts()[0] for t in texts]


def test_shingle_sums_by_definition():
    from fleetlens.llm.common import mix, word_hashes
    text = "a b c d\n\n  e f \ng\nh i j\na b c d"
    want = np.zeros(fp.BUCKETS, np.int64)
    n = 0
    for line in text.split("\n"):
        h, _, _ = word_hashes(line.encode(), lower=False)
        for i in range(max(len(h) - fp.SHINGLE + 1, min(len(h), 1))):
            run, some = np.uint64(0), h[i:i + fp.SHINGLE]
            for x in some:
                run = mix(np.array([run ^ x]))[0]
            run = mix(np.array([run + np.uint64(len(some))]))[0]
            want[int(run) % fp.BUCKETS] += -1 if int(run) >> 40 & 1 else 1
            n += 1
    v = fp.vectors([text.encode()])
    assert v.wide[0][0] == 6 and v.wide[0][1] == n == 7
    assert (v.narrow[0].astype(np.int32) == want).all()


def test_likeness_follows_the_share_of_common_shingles():
    base = "\n".join(prose(k, 60) for k in range(8))
    some = [edited(base, 1, share) for share in (0.02, 0.1, 0.5)] + [prose(99, 480)]
    v = fp.vectors([base.encode()] + [t.encode() for t in some])
    got = v[[0] * 5].likeness(v)
    assert got[0] == 1.0 and got[1] > 0.8 and got[1] > got[2] > got[3] and got[4] < 0.25
    assert list(fp.vectors([b"", b"", b" "]).likeness(fp.vectors([b"", b"a", b"\t"]))) == [1.0, 0.0, 0.0]


def brute(rows):
    """Contract rows from plain Python; documents of one id in the order of the operator's hash."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    out = []
    for i, (id_, text, _) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        k = len(text) // 4
        new = text[:len(text) - k] + following[:k]
        a, b, c = (fp.vectors([t.encode()]) for t in (text, new, following))
        out.append((id_, len(text), hashlib.sha256(new.encode()).hexdigest(), a.texts()[0], b.texts()[0], float(a.likeness(b)[0]), float(a.likeness(c)[0])))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def check(spark, rows, partitions):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(partitions).withColumn("FINGERPRINT", F.lit("clash")).withColumn("__part", F.lit(9))
    hashed = [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")))).collect()]
    got = [tuple(r) for r in fp.edited_prints(docs).collect()]
    assert sorted(got, key=key) == sorted(brute(hashed), key=key)


def test_edited_prints_equal_brute_force(spark):
    check(spark, documents(), 3)
    check(spark, documents()[:1], 1)
    check(spark, [(1, None, None, None, None), (2, "", None, None, None)], 2)
    assert fp.edited_prints(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_hot_id_of_equal_rows_goes_to_many_parts(spark):
    rows = [(i, prose(i, 12), "en", "s", 0) for i in range(-60, 60)] + [(7, "the same text\nof a third of all rows", "en", "s", 0)] * 300
    check(spark, rows, 4)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    most = fp.beside_next(docs).where("not __ahead").groupBy("__part").count().agg(F.max("count")).first()[0]
    assert most < 100


def test_equal_ids_with_different_texts_and_null_ids(spark):
    rows = [(5, prose(i, 9), None, None, None) for i in range(40)] + [(None, prose(i, 9), None, None, None) for i in range(20)]
    check(spark, rows, 3)


def test_very_long_text(spark):
    check(spark, [(1, "é word\n" * 400_000, None, None, None), (2, "x" * 3_000_000, None, None, None), (3, "short", None, None, None)], 2)


def test_documents_keep_their_columns_and_groups_add_up(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("Fingerprint", F.lit(1))
    got = fp.fingerprint_documents(docs)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "fingerprint"]
    assert {(r.text, r.fingerprint) for r in got.collect()} == {(r[1], fp.fingerprint(r[1])) for r in rows}
    groups = {r.source: r.fingerprint for r in fp.combined(got, ["source"]).collect()}
    for source in {r[3] for r in rows}:
        assert groups[source] == fp.fingerprint("\n".join((r[1] or "") for r in rows if r[3] == source))
