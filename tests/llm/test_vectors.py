"""Vector codes and hard negatives against brute force."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grimlake.llm import hard_negatives as H
from grimlake.llm import vector_codes as V

#: Extra columns with names that the operators use inside.
SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()), T.StructField("row", T.StringType()), T.StructField("kind", T.StringType()),
    T.StructField("entry", T.StringType()), T.StructField("score", T.StringType()), T.StructField("cluster", T.StringType())])


def rows(seed, n, dim=16, levels=3):
    """Few different components, so that there are ties; nulls, non-finite
    numbers, repeated rows, a null id and ids over 2^53."""
    r = np.random.default_rng(seed)
    out = [(i, [float(np.float32(x)) for x in r.integers(-levels, levels + 1, dim) / 8], int(r.integers(0, 4))) for i in range(n)]
    if n > 20:
        out[3] = (3, None, 1)
        out[4] = (4, [None, *out[4][1][1:]], 1)
        out[5] = (5, [math.nan, *out[5][1][1:]], 1)
        out[6] = (6, [math.inf, *out[6][1][1:]], 2)
        out[7] = (7, out[7][1], None)
        out[8] = (8, [0.0] * dim, 1)
        out += [out[10], out[10], (None, out[11][1], 2), (9007199254740993, out[12][1], 0)]
    return out


def frame(spark, data, parts=3):
    return spark.createDataFrame([(*x, "x", "x", "x", "x", "x") for x in data], SCHEMA).repartition(parts)


def usable(data):
    return [x for x in data if x[1] is not None and all(v is not None and math.isfinite(v) for v in x[1])]


def brute_codes(data, parts=8, entries=16, rounds=6, scale=4096):
    data = sorted(usable(data), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    vec = np.array([[math.floor(scale * v) for v in x[1]] for x in data], np.int64).reshape(len(data), parts, -1)
    books = vec[:entries].transpose(1, 0, 2).copy()
    for k in range(rounds + 1):
        d = ((vec[:, :, None, :] - books[None]) ** 2).sum(3)
        a = d.argmin(2)
        if k < rounds:
            for p in range(parts):
                for e in range(books.shape[1]):
                    own = vec[a[:, p] == e, p]
                    if len(own):
                        books[p, e] = own.sum(0) // len(own)
    error = np.take_along_axis(d, a[:, :, None], 2)[:, :, 0].sum(1)
    by_label = {}
    for x, e in zip(data, error):
        by_label[x[2]] = by_label.get(x[2], 0) + int(e)
    sha = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return sorted(((x[0], "".join(f"{v:02x}" for v in c), int(e), by_label[x[2]], sha) for x, c, e in zip(data, a, error)), key=str)


@pytest.mark.parametrize("seed,n,dim", [(1, 300, 16), (2, 9, 8), (3, 60, 24)])
def test_codes_equal_brute_force(spark, seed, n, dim):
    data = rows(seed, n, dim)
    codes = V.compress(frame(spark, data))
    got = [tuple(r) for r in V.with_label_errors(codes).collect()]
    assert sorted(got, key=str) == brute_codes(data)
    assert codes.books.shape[0] == 7


def test_codes_of_nothing(spark):
    for data in ([], [(1, None, 1), (2, [math.nan] * 8, 2)]):
        out = V.with_label_errors(V.compress(spark.createDataFrame([(*x, *"xxxxx") for x in data], SCHEMA)))
        assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and out.count() == 0


def test_uneven_vectors_are_an_error(spark):
    with pytest.raises(ValueError):
        V.compress(frame(spark, [(1, [0.5] * 9, 1)]))


def test_bounds_save_measurements_and_net_moves_are_no_longer_than_drifts():
    r = np.random.default_rng(5)
    centres = r.integers(-2000, 2000, (16, 8))
    vec = (centres[r.integers(0, 16, 4000)] + r.integers(-60, 60, (4000, 8)))[:, None, :]
    books = vec[:16].transpose(1, 0, 2)[None]
    bounds, scans, drift = V.Bounds(len(vec), 1), [], 0.0
    for k in range(7):
        past = V.History(books)
        scans.append(bounds.assign(vec, past, k == 0)[1])
        d = ((vec[:, 0, None] - books[-1, 0][None]) ** 2).sum(2)
        assert (bounds.entry[:, 0] == d.argmin(1)).all()
        if k:
            drift = drift + np.sqrt(((books[-1] - books[-2]).astype(float) ** 2).sum(2))
            assert (past.own[0] <= drift * (1 + 1e-6)).all()
        new = books[-1].copy()
        for e in range(16):
            if len(own := vec[bounds.entry[:, 0] == e, 0]):
                new[0, e] = own.sum(0) // len(own)
        books = np.concatenate([books, new[None]])
    assert scans[0] == 4000 and sum(scans[1:]) < 4000 * 2


def test_large_components_use_exact_integers():
    r = np.random.default_rng(1)
    a, b = r.integers(-V.LARGEST, V.LARGEST, (50, 8)), r.integers(-V.LARGEST, V.LARGEST, (16, 8))
    assert (V.squared(a, b) == [[sum((int(x) - int(y)) ** 2 for x, y in zip(p, q)) for q in b] for p in a]).all()
    with pytest.raises(ValueError):
        V.integers(np.array([[1e6]]), 4096)


def brute_negatives(data, every):
    use = [(i, l, [math.floor(256 * v) for v in vec]) for i, vec, l in usable(data) if l is not None]
    out = []
    for n, (i, l, u) in enumerate(use):
        if i is None or i % every:
            continue
        all_ = sorted(((-sum(a * b for a, b in zip(u, w)), j is None, j or 0, m) for m, (j, _, w) in enumerate(use) if m != n))
        own = [x for x in all_ if use[x[3]][1] == l][:5]
        for ps, _, _, pm in own:
            neg = [x for x in all_ if use[x[3]][1] != l and 50 * -ps <= 100 * -x[0] <= 95 * -ps][:3]
            out += [(i, use[pm][0], k + 1, use[x[3]][0], -ps, -x[0]) for k, x in enumerate(neg)]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,n,dim", [(1, 260, 16), (2, 12, 4), (3, 400, 3)])
def test_negatives_equal_brute_force(spark, monkeypatch, seed, n, dim):
    # small blocks, packs and clusters: many pairs and waves
    for name, value in (("BLOCK", 64), ("PACK", 16), ("WAVE", 2), ("MEMBERS", 4), ("STEP", 16)):
        monkeypatch.setattr(H, name, value)
    data = rows(seed, n, dim)
    got = [tuple(r) for r in H.mine(frame(spark, data), F.col("vec_id") % 5 == 0).collect()]
    want = brute_negatives(data, 5)
    assert sorted(got, key=str) == want
    assert n < 100 or len(want) > 100


def test_negatives_of_nothing(spark):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    for data in ([], [(1, [0.5, 0.5], 1)], [(0, [0.5, 0.5], 1)], [(0, None, 1), (5, [1.0, 0.0], None)]):
        out = H.mine(spark.createDataFrame([(*x, *"xxxxx") for x in data], SCHEMA), F.col("vec_id") % 5 == 0)
        assert out.columns == names and out.count() == 0


def test_walks_end_early_and_lose_nothing():
    """In clustered data a member leaves most of the list unread."""
    r = np.random.default_rng(3)
    centres = r.normal(0, 1, (20, 16))
    vec = np.floor(256 * (centres[r.integers(0, 20, 6000)] + r.normal(0, 0.05, (6000, 16))))
    table = H.Table({"row": np.arange(6000), "id": np.arange(6000), "known": np.ones(6000, np.uint8),
                     "label": r.integers(0, 3, 6000), "vec": vec})
    near = np.flatnonzero((vec @ centres.T).argmax(1) == 0)[:40]
    members = table.take(near)
    members.floor = H.first_floors(members, 5, 50, 95)
    hits, products = H.walk(members, table, 5, 50, 95)
    assert products < 0.4 * len(near) * 6000
    for m in range(len(near)):
        s = vec[near[m]] @ vec.T
        order = [x for x in np.lexsort((np.arange(6000), -s)) if x != near[m] and table.label[x] == members.label[m]][:5]
        assert hits[2][hits[0] == m].tolist() == order
