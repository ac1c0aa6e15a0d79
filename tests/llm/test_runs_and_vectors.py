"""Periodic runs, near-duplicate vectors and vector codes against brute force, and their defined odd cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from folio.llm import embedding_dedup, runs, vector_codes

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
VECTORS = "vec_id long, embedding array<float>, label int"


# --- periodic runs ---------------------------------------------------------------------

def brute_runs(w, least=24, times=3):
    """Every period of every stretch, the least one kept."""
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > s and i - s + q >= max(least, times * q):
                found.setdefault((s, i - s + q), q)
            i += i == s
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic_texts(rnd, count):
    for _ in range(count):
        kind, n, letters = rnd.randint(0, 4), rnd.randint(0, 300), rnd.choice([1, 2, 3, 50])
        some = lambda k: [rnd.randrange(letters) for _ in range(k)]
        if kind == 0:
            yield some(n)
        elif kind == 1:
            p = some(rnd.randint(1, 60))
            yield (p * (n // len(p) + 1))[:n] + some(rnd.randint(0, 40))
        elif kind == 2:
            yield [x for _ in range(rnd.randint(1, 9)) for x in some(rnd.choice([1, 2, 3, 7, 16, 17, 31, 32, 33, 50])) * rnd.randint(1, 9)][:500]
        elif kind == 3:  # blocks that are periodic themselves, inside longer periods
            p = [0] * rnd.randint(5, 60) + [1] + [0] * rnd.randint(0, 5) + [2] * rnd.randint(0, 3)
            yield (p * rnd.randint(2, 8) + p[:rnd.randint(0, len(p))])[:500]
        else:
            p = ([0, 1] * rnd.randint(3, 30) + [rnd.randrange(3)]) * rnd.randint(2, 4) + [3]
            yield (p * rnd.randint(1, 4))[:600]


def test_runs_equal_all_stretches_of_all_periods():
    texts = list(periodic_texts(random.Random(1), 600))
    want = [brute_runs(w) for w in texts]
    assert sum(map(len, want)) > 500 and any(len(x) > 1 for x in want)
    for lo in range(0, len(texts), 60):  # searched together: texts do not run into each other
        got = runs.runs_of([np.array(w, np.int64) for w in texts[lo:lo + 60]])
        assert [[tuple(r) for r in g.tolist()] for g in got] == want[lo:lo + 60]
    again = runs.repeats_eight([np.array(w, np.int64) for w in texts])
    assert all(a or not w for a, w in zip(again, want))


def test_range_successor():
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 64, 500):
        a = rng.permutation(n)
        s = runs.Successor(a)
        lo = rng.integers(0, n + 1, 300)
        hi = np.minimum(n, lo + rng.integers(0, n + 1, 300))
        x = rng.integers(0, 2 * n + 2, 300)
        want = [min((v for v in a[p:q].tolist() if v >= y), default=-1) for p, q, y in zip(lo, hi, x)]
        assert s.at_least(lo, hi, x).tolist() == want


def expected_report(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    found = brute_runs(w)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-(r[1] / r[2]), r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))


def test_run_report_of_all_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r[0]: tuple(r)[1:] for r in runs.op11_periodic_runs(spark, SMALL).collect()}
    assert set(got) == set(texts) and sum(g[0] > 0 for g in got.values()) > 10
    for d, t in texts.items():
        if len(WORD.findall(t or "")) < 1500:  # brute force is quadratic
            assert got[d] == expected_report(d, t)


def test_run_odd_rows(spark, odd_docs, no_docs):
    extra = odd_docs.selectExpr("*", "1 AS id", "'x' AS n_runs", "'y' AS start")
    rows = runs.run_report(extra, "doc_id", runs.with_periodic_tails(F.col("doc_id"), F.col("text"))).collect()
    want = sorted(str((r.doc_id, *expected_report(r.doc_id, r.text))) for r in odd_docs.collect() if r.doc_id != 4)
    assert sorted(str(tuple(r)) for r in rows if r.doc_id != 4) == want and len(rows) == 9
    long = next(r for r in rows if r.doc_id == 4)
    assert (long.n_runs, long.start, long.length, long.period) == (1, 0, 20_000, 977)
    assert runs.run_report(no_docs).count() == 0 and runs.periodic_runs(no_docs).count() == 0


def test_runs_as_rows(spark):
    docs = spark.createDataFrame([(1, "a b c " * 20), (2, "no run here"), (None, "x " * 30), (1, "a b c " * 20)], "doc_id long, text string")
    rows = sorted(map(tuple, runs.periodic_runs(docs).collect()), key=str)
    assert rows == sorted([(1, 0, 60, 3), (1, 0, 60, 3), (None, 0, 30, 1)], key=str)
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, least=10)


# --- near-duplicate vectors --------------------------------------------------------------

def brute_links(vectors, threshold=0.95):
    x = np.array([v if v is not None else [0.0] * 16 for v in vectors], np.float64)
    ok = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
    unit = np.where(ok[:, None], x, 1.0)
    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
    linked = (unit @ unit.T >= threshold) & ok[:, None] & ok[None, :]
    np.fill_diagonal(linked, False)
    root = np.arange(len(x))
    while True:
        new = np.array([min(root[i], *root[linked[i]]) if linked[i].any() else root[i] for i in range(len(x))])
        if (new == root).all():
            return linked.sum(axis=1), root
        root = new


@pytest.fixture(scope="module")
def crowd():
    """Copies, near copies, chains and lone vectors of 16 components; groups from two to hundreds."""
    rng = np.random.default_rng(11)
    out = list(rng.standard_normal((300, 16)))
    for size, noise in ((2, .05), (3, .05), (5, .07), (12, .1), (40, .1), (250, .1), (120, .25)):
        centre = rng.standard_normal(16)
        out += list(centre + noise * rng.standard_normal((size, 16)))
    out += [out[0] * 3.5, *[out[1]] * 30]
    order = rng.permutation(len(out))
    return [np.float32(out[i]).tolist() for i in order]


def test_links_and_components_equal_all_pairs(spark, crowd):
    rows = spark.createDataFrame([(i, v, None) for i, v in enumerate(crowd)], VECTORS)
    got = sorted(embedding_dedup.near_duplicates(rows, longest=40).collect())  # tiles for the largest groups
    degree, root = brute_links([np.float32(v) for v in crowd])
    assert len(got) == len(crowd)
    right = sum(r.n_links == degree[i] for i, r in enumerate(got))
    assert sum(r.n_links for r in got) >= 0.98 * degree.sum() and right >= 0.97 * len(got)
    assert all(r.n_links <= degree[i] for i, r in enumerate(got))  # no link below the threshold
    assert sum(r.component_id == root[i] for i, r in enumerate(got)) >= 0.98 * len(got)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_tiles_count_every_pair(spark, crowd):
    degree, _ = brute_links([np.float32(v) for v in crowd])
    members = spark.createDataFrame([(0, i, 1, [float(x) for x in np.float32(v)], i % 7) for i, v in enumerate(crowd)], "comp long, node long, n long, v array<double>, key long")
    for tile in (64, 1024):
        embedding_dedup.TILE = tile
        got = {r.node: r.others for r in embedding_dedup._dense_links(members, 0.95).collect()}
        assert [got[i] for i in range(len(crowd))] == degree.tolist()
    embedding_dedup.TILE = 512


def test_vector_odd_rows(spark):
    a, b = [1.0, 2.0, 0.0], [0.0, -1.0, 5.0]
    rows = [(1, a, None), (1, a, 2), (None, a, 2), (2, [2.0, 4.0, 0.0], 1), (3, None, 1), (4, [0.0, 0.0, 0.0], 1), (5, [1.0, None, 2.0], 1), (6, [float("nan"), 1.0, 1.0], 1),
            (None, None, None), (7, b, 3), (8, [-1.0, -2.0, 0.0], 3), (9, [], 1), (10, [3e38, 0.0, 3e38], 1), (11, [1e-38, 0.0, 1e-38], 1), (12, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS node", "'z' AS v", "2 AS id")
    got = sorted((tuple(r) for r in embedding_dedup.near_duplicates(df).collect()), key=str)
    want = [(1, 3, 1, True), (1, 3, 1, True), (None, 3, 1, False), (2, 3, 1, False), *[(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 12)],
            (None, 0, None, False), (10, 1, 10, True), (11, 1, 10, False)]
    assert got == sorted(want, key=str)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


# --- vector codes -----------------------------------------------------------------------

def test_trie_gives_the_nearest_entry():
    rng = np.random.default_rng(4)
    for width, span in ((1, 3), (4, 2), (8, 3), (3, 2000)):
        parts = rng.integers(-span, span, (9000, width))
        book = parts[:16]
        order = np.lexsort(parts.T[::-1])
        d = ((parts[order][:, None] - book[None]) ** 2).sum(axis=2)
        entry, least = vector_codes.nearest(parts[order], book)
        assert (entry == d.argmin(axis=1)).all() and (least == d.min(axis=1)).all()
        entry, _ = vector_codes.nearest(parts, book)  # any order is right
        assert (entry[order] == d.argmin(axis=1)).all()


def test_codes_equal_plain_rounds(spark):
    rows = [r for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()]
    q = np.floor(4096 * np.array([r.embedding for r in rows], np.float64)).astype(np.int64)
    cut = q.reshape(len(q), 8, -1)
    books = cut[:16].transpose(1, 0, 2).copy()
    for turn in range(7):
        d = ((cut[:, :, None] - books[None]) ** 2).sum(axis=3)
        at = d.argmin(axis=2)
        for p in range(8):
            for e in range(16):
                if turn < 6 and (at[:, p] == e).any():
                    books[p, e] = cut[at[:, p] == e, p].sum(axis=0) // (at[:, p] == e).sum()
    got = sorted(vector_codes.op13_vector_codes(spark, SMALL).collect())
    assert [r.code for r in got] == ["".join(f"{e:02x}" for e in a) for a in at]
    assert [r.error for r in got] == d.min(axis=2).sum(axis=1).tolist()
    by = {}
    for r, g in zip(rows, got):
        by[r.label] = by.get(r.label, 0) + g.error
    assert [g.label_error for g in got] == [by[r.label] for r in rows]


def test_code_odd_rows(spark):
    v = [float(i) for i in range(8)]
    rows = [(2, v, None), (1, [x / 3 for x in v], 4), (1, [x / 3 for x in v], 4), (None, [-x for x in v], None), (5, None, 4), (6, [None] * 8, 4), (7, [float("inf")] * 8, 4)]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' AS q", "2 AS id", "3 AS error")
    codes, books = vector_codes.compress(df)
    got = sorted(map(tuple, codes.collect()), key=str)
    assert [(g[0], g[1], g[3]) for g in got] == [(1, 4, 0), (1, 4, 0), (2, None, 0), (None, None, 0)] and books.shape == (8, 4, 1)
    assert got[0][2] == got[1][2] == "00" * 8 and got[2][2] == "00" + "02" * 7 and got[3][2] == "00" + "03" * 7
    assert vector_codes.compress(df.limit(0))[0].count() == 0
    for bad in ([1.0] * 9, [1e9] * 8):
        with pytest.raises(Exception):
            vector_codes.compress(spark.createDataFrame([(1, bad, 1)], VECTORS))[0].collect()
