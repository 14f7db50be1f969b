"""Clusters, codes and nearest neighbours of vectors against plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from incidentry.llm import nearest_vectors as near
from incidentry.llm.bisector_clusters import bisector_clusters, bisectors, tournament
from incidentry.llm.nearest_vectors import nearest_vectors, quantised
from incidentry.llm.queries import op11_centroid_clustering, op12_vector_codes, op13_nearest_vectors
from incidentry.llm.vector_codes import adapted, full_search, next_search, resized, vector_codes
from incidentry.llm.vectors import exact_squares

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, point int, cluster int, distance int"
NAN, INF = float("nan"), float("inf")


def odd_vectors(width=8, n=90, seed=1):
    """Ties, copies (a third of the rows), repeated ids and rows, faults, other lengths, null ids and labels."""
    rng = random.Random(seed)
    hot = [round(rng.uniform(-1, 1), 2) for _ in range(width)]
    rows = []
    for i in range(n):
        vector = hot if i % 3 == 0 else [rng.choice([-0.5, 0.25, 0.125, 0.3, -0.0, 0.75]) for _ in range(width)]
        rows.append((i * 10 if i % 7 else 70, vector, rng.choice([None, 1, 2])))
    rows += [rows[4], rows[4], (None, rows[5][1], 1), (None, None, None), (None, [1.0] * width, None)]
    rows += [(1001, None, 1), (1002, [], 1), (1003, [0.0] * width, 2), (1004, [-0.0] * width, 2)]
    rows += [(1005, [None, *hot[1:]], 1), (1006, [NAN, *hot[1:]], 1), (1007, [*hot[1:], -INF], 1)]
    rows += [(1020, [1.0] * (width + 1), 1), (1021, [0.5] * (width + 1), 1), (1022, [0.25], None)]
    return [(i, v, lab, "i", 1, 2, 3) for i, v, lab in rows]


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def sound(vector):
    return bool(vector) and all(x is not None and math.isfinite(x) for x in vector)


def single(vector):
    return [float(np.float32(x)) for x in vector]


def square(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def lloyd(points, centroids, rounds):
    """Centroids after the rounds and each point's nearest one, in plain integers."""

    def nearest(p):
        return min(range(len(centroids)), key=lambda c: (square(p, centroids[c]), c))

    for _ in range(rounds):
        groups = {}
        for p in points:
            groups.setdefault(nearest(p), []).append(p)
        for c, members in groups.items():
            centroids[c] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    return centroids, [nearest(p) for p in points]


def by_row(values):
    return sorted(values, key=repr)


@pytest.mark.parametrize(("k", "rounds", "seed"), [(4, 3, 1), (1, 2, 2), (16, 3, 3), (500, 1, 4), (5, 0, 5)])
def test_clusters_equal_plain_rounds(spark, k, rounds, seed):
    rows = odd_vectors(seed=seed)
    kept = [(i, [math.floor(64 * x) for x in single(v)]) for i, v, *_ in rows if sound(v) and len(v) == 8]
    name = [hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest() for i, _ in kept]
    first = sorted(zip(name, [p for _, p in kept], strict=True))[:k]
    centroids, assigned = lloyd([p for _, p in kept], [p for _, p in first], rounds)
    want = [(i, c, square(p, centroids[c])) for (i, p), c in zip(kept, assigned, strict=True)]
    got = bisector_clusters(frame(spark, rows), k=k, rounds=rounds, width=8)
    assert by_row(tuple(r) for r in got.assigned.collect()) == by_row(want)
    assert [(r["cluster"], list(r["centroid"])) for r in got.centroids.orderBy("cluster").collect()] == list(
        enumerate(centroids)
    )


def test_tournament_ties_favour_smaller_numbers():
    rng = np.random.default_rng(3)
    for _ in range(50):
        points, centroids = rng.integers(-2, 3, (200, 3)), rng.integers(-2, 3, (12, 3))
        assert (tournament(points, *bisectors(centroids)) == exact_squares(points, centroids).argmin(1)).all()
    far = np.array([[1 << 27] * 64, [-(1 << 27)] * 64])  # the largest components that are let in
    assert (tournament(far, *bisectors(far)) == [0, 1]).all()
    assert exact_squares(far, far).tolist() == [[0, 1 << 62], [1 << 62, 0]]


def test_empty_and_refused_vectors(spark):
    for rows in ([], [(1, None, 1, "i", 1, 2, 3), (2, [NAN] * 8, 1, "i", 1, 2, 3)]):
        some = spark.createDataFrame(rows, SCHEMA)
        assert bisector_clusters(some, width=8).assigned.collect() == []
        assert bisector_clusters(some, width=8).centroids.collect() == []
        assert vector_codes(some, keep=("label",)).coded.collect() == []
        assert vector_codes(some).codebooks.collect() == []
        assert nearest_vectors(some, F.lit(True)).collect() == []
    large = spark.createDataFrame([(1, [3e38] * 8, 1, "i", 1, 2, 3)], SCHEMA)
    with pytest.raises(PySparkException, match="beyond"):
        bisector_clusters(large, width=8)
    with pytest.raises(ValueError, match="beyond"):
        vector_codes(large)
    with pytest.raises(ValueError, match="rename"):
        vector_codes(large.withColumnRenamed("cluster", "Code"), keep=("Code",))
    with pytest.raises(ValueError, match="256"):
        vector_codes(large, entries=257)


@pytest.mark.parametrize(("entries", "rounds", "seed"), [(6, 4, 1), (1, 2, 2), (256, 3, 3), (12, 0, 4), (20, 6, 5)])
def test_codes_equal_plain_rounds(spark, entries, rounds, seed):
    rows = odd_vectors(seed=seed, n=150)
    kept = [(i, lab, [math.floor(1024 * x) for x in single(v)]) for i, v, lab, *_ in rows if sound(v) and len(v) == 8]
    raw = [(i is None, i or 0, single(v)) for i, v, *_ in rows if sound(v)]
    first = [v for _, _, v in sorted(raw)[:entries]]
    want_codes, errors, books = [b""] * len(kept), [0] * len(kept), []
    for p in range(4):
        cut = slice(2 * p, 2 * p + 2)
        parts = [q[cut] for _, _, q in kept]
        book, codes = lloyd(parts, [[math.floor(1024 * x) for x in v[cut]] for v in first if len(v) == 8], rounds)
        want_codes = [w + bytes([c]) for w, c in zip(want_codes, codes, strict=True)]
        errors = [e + square(q, book[c]) for e, q, c in zip(errors, parts, codes, strict=True)]
        books += [(p, e, b) for e, b in enumerate(book)]
    got = vector_codes(frame(spark, rows), entries=entries, rounds=rounds, keep=("label", "cluster"))
    want = [(i, lab, 2, c, e) for (i, lab, _), c, e in zip(kept, want_codes, errors, strict=True)]
    have = [(r["id"], r["label"], r["cluster"], bytes(r["code"]), r["error"]) for r in got.coded.collect()]
    assert by_row(have) == by_row(want)
    assert [(r[0], r[1], list(r[2])) for r in got.codebooks.orderBy("part", "entry").collect()] == books


def test_vectors_of_another_length_get_no_code(spark):
    rows = [(1, [1.0, 2.0, 3.0], 1), (2, [1.0] * 8, 1), (3, [2.0] * 8, 1)]
    some = frame(spark, [(*r, "i", 1, 2, 3) for r in rows])
    assert vector_codes(some).coded.collect() == []  # the least id's length cannot be cut in four
    assert {r["id"] for r in vector_codes(some.where("vec_id > 1")).coded.collect()} == {2, 3}


@pytest.mark.parametrize("seed", range(12))
def test_bounds_find_what_a_full_search_finds(seed):
    """Entries move, b changes, and the kept bounds never lie above a true distance."""
    rng = np.random.default_rng(seed)
    spread = [3, 50, 4000, 1 << 26][seed % 4]
    points = rng.integers(-spread, spread + 1, (400, 4))
    entries = rng.integers(-spread, spread + 1, (int(rng.integers(1, 40)), 4))
    b = min(4, len(entries))
    kept = full_search(points, entries, b)
    for _ in range(6):
        after = entries + rng.integers(-max(spread // 20, 1), max(spread // 20, 1) + 1, entries.shape)
        steps = np.nextafter(np.sqrt(((after - entries) ** 2).sum(1).astype(float)), np.inf)
        entries = after
        kept = next_search(points, entries, steps, kept)
        squares = exact_squares(points, entries)
        assert (kept.code == squares.argmin(1)).all()
        for i in range(len(points)):
            known = [j for j in kept.near[i] if j >= 0]
            assert len({*known, kept.code[i]}) == len(known) + 1
            for j, low in zip(kept.near[i], kept.bound[i], strict=False):
                assert j < 0 or low <= math.sqrt(squares[i, j])
            rest = set(range(len(entries))) - {*known, int(kept.code[i])}
            assert all(kept.bound[i, -1] <= math.sqrt(squares[i, j]) for j in rest)
        assert (np.diff(kept.bound, axis=1) >= 0).all()
        needs = np.bincount(kept.need, minlength=b + 2)
        b = adapted(needs, b, 4 * len(entries))
        kept = resized(kept, b)


def test_b_follows_what_was_needed():
    assert adapted(np.array([90, 8, 2, 0, 0, 0]), 4, 256) == 2  # two settle all but a sixteenth
    assert adapted(np.array([50, 20, 20, 5, 4, 1]), 4, 256) == 3
    assert adapted(np.array([50, 10, 10, 10, 10, 10]), 4, 256) == 8
    assert adapted(np.array([50, 10, 10, 10, 10, 10]), 4, 20) == 5


def brute_nearest(rows, is_query, k):
    """Answers of each query row, with scores summed from the first component on."""
    used = [(i, single(v)) for i, v, *_ in rows if sound(v) and any(x != 0 for x in v)]
    out = []
    for n, (qid, q) in enumerate(used):
        if is_query(qid):
            found = []
            for m, (vid, v) in enumerate(used):
                if m != n and len(v) == len(q):
                    total = 0.0
                    for x, y in zip(q, v, strict=True):
                        total += x * y
                    found.append((-total, vid is None, vid or 0, vid))
            out += [(qid, r, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k], 1)]
    return out


@pytest.mark.parametrize(("k", "width", "seed"), [(5, 8, 1), (20, 8, 2), (3, 33, 3), (500, 8, 4), (1, 1100, 5)])
def test_nearest_equal_all_pairs(spark, monkeypatch, k, width, seed):
    monkeypatch.setattr(near, "CELL_BLOCKS", 2)
    rows = odd_vectors(width=width, n=60 if width > 100 else 120, seed=seed)
    got = nearest_vectors(frame(spark, rows), F.col("vec_id") % 20 == 0, k=k).collect()
    assert by_row(tuple(r) for r in got) == by_row(brute_nearest(rows, lambda i: i is not None and i % 20 == 0, k))


@pytest.mark.parametrize(("block", "query_block", "cell"), [(1, 1, 4), (7, 3, 1), (50, 500, 2), (13, 5, 100)])
def test_blocks_and_cells_of_any_size_agree(spark, monkeypatch, block, query_block, cell):
    monkeypatch.setattr(near, "CELL_BLOCKS", cell)
    rows = odd_vectors(n=60, seed=9)
    want = by_row(brute_nearest(rows, lambda i: i is not None and i % 20 == 0, 7))
    some = frame(spark, rows, parts=block % 5 + 1)
    got = nearest_vectors(some, F.col("vec_id") % 20 == 0, k=7, block=block, query_block=query_block).collect()
    assert by_row(tuple(r) for r in got) == want


@pytest.mark.parametrize("seed", range(8))
def test_tiles_keep_every_near_pair(seed):
    rng = np.random.default_rng(seed)
    width = [4, 64, 1500][seed % 3]
    scale = 10.0 ** rng.uniform(-20, 20, (60, 1))
    vectors = rng.normal(size=(60, width)) * scale
    vectors[10:30] = vectors[5]
    small, step, size, lost = quantised(vectors)
    exact = vectors @ vectors.T
    estimate = near.int8_products(small, small) * step[:, None] * step[None, :]
    error = (size + lost)[:, None] * lost[None, :] + lost[:, None] * size[None, :]
    assert (np.abs(exact - estimate) <= error * (1 + 1e-9) + 1e-12 * size[:, None] * size[None, :]).all()
    assert (small.astype(int) @ small.astype(int).T == near.int8_products(small, small)).all()
    block = near._Block.__new__(near._Block)
    block.vectors, block.small, block.scale, block.size, block.lost = vectors, small, step, size, lost
    block.width, block.of, block.place = width, np.zeros(60, np.int64), np.arange(60)
    query, row, score = near.tile(block, block, 4, np.full(60, -np.inf))
    assert (query != row).all()
    for q in range(60):
        scores = near.inner_products(np.repeat(vectors[q : q + 1], 60, 0), vectors)
        wanted = sorted(((-s, r) for r, s in enumerate(scores) if r != q))[:4]
        assert {r for _, r in wanted} <= set(row[query == q].tolist())
        assert all(-score[(query == q) & (row == r)][0] == s for s, r in wanted)


def test_queries_on_shared_tables(spark):
    sf = "/root/testdata/sf0.001"
    clusters = op11_centroid_clustering(spark, sf).collect()
    assert len(clusters) == 500 and len({r["centroid_sha256"] for r in clusters}) <= 16
    assert sum(r["distance"] for r in clusters) == clusters[0]["inertia"]
    codes = op12_vector_codes(spark, sf).collect()
    assert all(len(r["code"]) == 8 for r in codes) and len({r["codebooks_sha256"] for r in codes}) == 1
    answers = op13_nearest_vectors(spark, sf).collect()
    assert len(answers) == 25 * 20 and {r["rank"] for r in answers} == set(range(1, 21))
