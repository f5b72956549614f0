"""Hard negatives, clustering and the token index against plain versions on small rows."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakestrata.llm import clusters, indexed, negatives, tokens
from lakestrata.runtime import scratch_path

BYTES = public_tokenizers.path("byte_bpe_50k.json")
VECTORS = "vec_id long, embedding array<double>, label int, `slot` string, score string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, b, "x", "y") for i, v, b in rows], VECTORS)


def some_vectors(n, width=8, seed=1, groups=3):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(groups)]
    return [(i, [c + rng.uniform(-0.4, 0.4) for c in centres[rng.randrange(groups)]], rng.randrange(3)) for i in range(n)]


BROKEN = [
    (900, None, 1), (901, [1.0] * 7 + [None], 1), (902, [math.nan] + [1.0] * 7, 1), (903, [math.inf] * 8, 1), (904, [1.0] * 8, None),
]


# --- hard negatives ---------------------------------------------------------------------------


def plain_negatives(rows, is_anchor, positives=5, most=3):
    good = {}
    for i, v, b in rows:
        if i is not None and b is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            good[(i, b, tuple(math.floor(256 * c) for c in v))] = None
    score = lambda x, y: sum(a * b for a, b in zip(x, y, strict=False))
    out = []
    for i, b, x in good:
        if not is_anchor(i):
            continue
        best, worse = {}, {}
        for j, c, y in good:
            if j != i:
                side = best if c == b else worse
                side[j] = max(side.get(j, -(10**18)), score(x, y))
        for j, p in sorted(best.items(), key=lambda e: (-e[1], e[0]))[:positives]:
            fit = sorted(((k, s) for k, s in worse.items() if 50 * p <= 100 * s <= 95 * p), key=lambda e: (-e[1], e[0]))
            out += [(i, j, r + 1, k, p, s) for r, (k, s) in enumerate(fit[:most])]
    return sorted(out)


@pytest.mark.parametrize("wave", [1 << 20, 300])
def test_hard_negatives_are_those_of_all_pairs(spark, wave):
    rows = some_vectors(120) + BROKEN + [(None, [1.0] * 8, 1)]
    # ties, repeated rows, an id with two vectors, a zero vector, a shorter one
    rows += [(200 + i, rows[3][1], i % 3) for i in range(9)] + [rows[5]] * 3 + [(7, rows[9][1], 2), (300, [0.0] * 8, 0), (301, [0.3, 0.2], 1)]
    got = negatives.hard_negatives(vectors_of(spark, rows).repartition(3), F.col("vec_id") % 10 == 0, wave_bytes=wave, block=16, tile=5)
    want = plain_negatives(rows, lambda i: i % 10 == 0)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 50


def test_hard_negatives_of_nothing(spark):
    empty = vectors_of(spark, [])
    assert negatives.hard_negatives(empty, F.lit(True)).columns[0] == "anchor_id"
    assert not negatives.hard_negatives(empty, F.lit(True)).count()
    # one label only: positives without negatives; every label once: no positives
    alike = vectors_of(spark, [(i, [1.0, float(i)], 1) for i in range(4)])
    assert not negatives.hard_negatives(alike, F.lit(True)).count()
    apart = vectors_of(spark, [(i, [1.0, float(i)], i) for i in range(4)])
    assert not negatives.hard_negatives(apart, F.lit(True)).count()


def test_intervals_hold_the_score_and_rule_out_far_rows():
    rng = np.random.default_rng(4)
    for width in (3, 64, 100):
        centres = rng.normal(size=(6, width)) * 200
        x = np.floor(centres[rng.integers(0, 6, 400)] + rng.normal(size=(400, width)) * 5)
        x[5] = 0
        low, high = negatives.Anchors(x[:40]).interval(slice(None), negatives.Codes(x))
        true = x[:40] @ x.T
        assert (low <= true).all() and (true <= high).all()
        if width >= 64:
            fifth = np.sort(true, axis=1)[:, -5]
            assert (high >= fifth[:, None]).mean() < 0.5


def test_rotation_keeps_lengths_and_products():
    x = np.random.default_rng(2).normal(size=(5, 37))
    turned = negatives.rotated(x)
    assert np.allclose(turned @ turned.T, x @ x.T)


# --- clustering -------------------------------------------------------------------------------


def plain_k_means(rows, width, scale, k, rounds, seed):
    kept = [(i, [math.floor(scale * c) for c in v]) for i, v, _ in rows if v is not None and len(v) == width and all(c is not None and math.isfinite(c) for c in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [r[1] for r in sorted(kept, key=key)[:k]]
    away = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c, strict=True))
    nearest = lambda x: min(range(len(centroids)), key=lambda c: (away(x, centroids[c]), c))
    for _ in range(rounds):
        own = [nearest(x) for _, x in kept]
        for c in range(len(centroids)):
            mine = [x for (_, x), o in zip(kept, own, strict=True) if o == c]
            if mine:
                centroids[c] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    own = [nearest(x) for _, x in kept]
    far = [away(x, centroids[o]) for (_, x), o in zip(kept, own, strict=True)]
    each = {c: sum(d for d, o in zip(far, own, strict=True) if o == c) for c in set(own)}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, o, d, each[o], sum(far), sha[o]) for (i, _), o, d in zip(kept, own, far, strict=True)]


def by_text(rows):
    return sorted(map(str, map(tuple, rows)))


@pytest.mark.parametrize("k", [1, 3, 8])
def test_clusters_are_those_of_plain_k_means(spark, k):
    rows = some_vectors(90, seed=k) + BROKEN + [(905, [1.0] * 9, 1), (None, [0.1] * 8, 0), (None, [0.2] * 8, 0)]
    rows += [rows[4]] * 3 + [(400 + i, rows[8][1], 0) for i in range(6)] + [(4, [0.5] * 8, None)]
    got = clusters.k_means(vectors_of(spark, rows).repartition(4), width=8, scale=64, k=k, rounds=4)
    assert by_text(got.collect()) == by_text(plain_k_means(rows, 8, 64, k, 4, 3))


def test_ties_stay_with_the_smaller_number_and_empty_clusters_stay(spark):
    # equal centroids: all but the first are empty in every round
    rows = [(i, [1.0, 2.0], 0) for i in range(5)]
    got = clusters.k_means(vectors_of(spark, rows), width=2, k=4, rounds=3).collect()
    assert {(r.cluster, r.distance, r.inertia) for r in got} == {(0, 0, 0)}
    middle = np.array([[0, 0], [2, 0], [0, 2]])
    assert clusters.Planes(middle).nearest(np.array([[1, 0], [1, 1], [0, 1], [2, 2], [3, 0]])).tolist() == [0, 0, 0, 1, 1]


def test_clusters_of_few_rows_and_of_nothing(spark):
    assert not clusters.k_means(vectors_of(spark, [])).count()
    one = clusters.k_means(vectors_of(spark, [(5, [0.5] * 64, 1)])).collect()
    assert [(r.vec_id, r.cluster, r.distance) for r in one] == [(5, 0, 0)]
    with pytest.raises(ValueError, match="63 bits"):
        clusters.k_means(vectors_of(spark, [(1, [2000000.0, 0.0], 0)]), width=2).count()


# --- token index ------------------------------------------------------------------------------

TEXTS = [
    "Hello world!", None, "", "a  b", "a   b  ", " \n lead", "it's we'll 12 345,6 !!", "café ÄÖ naïve", "日本 語 text", "a<|endoftext|>b <|endoftext|>",
    "x\x1cy \x85  z", "long " * 9000, "end.\nNew line\n\n\tindent \n", "﷐ mark", "one two one two", "\U0001f600 ok",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


def test_byte_level_ids_are_the_librarys(library):
    rng = random.Random(8)
    alphabet = "ab'sS .,!\n\t 1é²½你" + " " * 6
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice(alphabet) for _ in range(80)) for _ in range(600)]
    for limit in (5, 100_000):
        own = tokens.ByteIds(BYTES, limit)
        for start in range(0, len(texts), 50):
            part = texts[start : start + 50]
            for text, ids in zip(part, own.of(part), strict=True):
                assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def plain_index(library, rows):
    ids = [np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for _, t in rows]
    starts = np.cumsum([0] + [len(i) for i in ids])
    return [(d, int(s), len(i), zlib.crc32(i.tobytes()), i.tobytes()) for (d, _), s, i in zip(rows, starts, ids, strict=False)]


def test_index_gives_every_document_in_order(spark, library):
    rows = [(i * 7 - 20, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame([(d, t, "a", 1.0) for d, t in rows], "doc_id long, text string, file string, shard double").repartition(5)
    folder = scratch_path(spark, "index")
    shards = indexed.write_index(docs, BYTES, folder, shards=3)
    assert shards.count() > 1
    got = indexed.fetch(spark, folder, docs.select("doc_id"), nulls=True, whole=True)
    assert sorted(map(tuple, got.collect())) == plain_index(library, rows)
    # the raw files one after the other are all ids
    files = [r.file for r in shards.orderBy("shard").collect()]
    raw = b"".join(open(f"{f}.ids", "rb").read() for f in files)
    assert np.frombuffer(raw, "<u2").astype("<u4").tobytes() == b"".join(r[4] for r in plain_index(library, rows))
    some = indexed.fetch(spark, folder, spark.createDataFrame([(1,), (1,), (5,), (999,), (None,)], "k long"))
    assert [(r.doc_id, r.ids) for r in some.collect()] == [(1, None)]


def test_index_of_repeated_and_missing_keys(spark, library):
    rows = [(3, f"text {i % 4}") for i in range(60)] + [(None, f"none {i}") for i in range(9)] + [(i, "same") for i in range(4, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    folder = scratch_path(spark, "index")
    indexed.write_index(docs, BYTES, folder, shards=4)
    got = indexed.fetch(spark, folder, docs.select("doc_id"), nulls=True, whole=True).collect()
    assert sorted((str(r.doc_id), r.ids) for r in got) == sorted((str(r[0]), r[4]) for r in plain_index(library, rows))
    end = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == end
        end += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))


def test_index_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    folder = scratch_path(spark, "index")
    assert not indexed.write_index(docs, BYTES, folder).count()
    assert not indexed.fetch(spark, folder, docs.select("doc_id"), nulls=True).count()


def test_perfect_hash_numbers_are_all_and_once():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        perfect = indexed.PerfectHash.build(keys)
        assert np.array_equal(np.sort(perfect.numbers(keys)), np.arange(len(keys)))
        out = indexed.io.BytesIO()
        perfect.write(out)
        again, size = indexed.PerfectHash.read(memoryview(out.getvalue()))
        assert np.array_equal(again.numbers(keys), perfect.numbers(keys)) and size == len(out.getvalue())
        if n > 1000:
            assert 8 * size < 5 * n and len(perfect.sizes) < 40
