"""Whitening and hard negatives equal plain versions of them."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from staywarehouse.llm import hard_negatives, vectors, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, whitened string, _at int, no int"


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def integers(vector):
    if vector is None or any(c is None or not math.isfinite(c) for c in vector):
        return None
    return [math.floor(256 * float(c)) for c in vector]


# ---- packed vectors


def test_packing():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(-high, high, (40, 5)) for high in (2, 128, 129, 40_000, 2**40)])
    packed = vectors.pack(x)
    assert np.array_equal(vectors.unpack(pa.array(packed), 5), x)
    assert len(set(packed)) == len({tuple(r) for r in x.tolist()})
    some = [None, [], [1.0], [0.5, None], [math.nan], [math.inf, 1], [-0.001, 2.0], [1e-9, -1e-9]]
    for given in (pa.array(some), pa.array([[9.0], *some])[1:]):
        rows, x = vectors.whole(given, 2)
        assert rows.tolist() == [1, 2, 6, 7]
        assert x.tolist() == [[0, 0], [256, 0], [-1, 512], [0, -1]]


# ---- 11 whitening


def matrices():
    rng = np.random.default_rng(7)
    for size in (1, 2, 3, 17, 64, 130):
        a = rng.standard_normal((size, size + 5))
        yield a @ a.T
        turn = np.linalg.qr(a[:, :size])[0]
        for values in (np.ones(size), 10.0 ** -np.arange(size), np.arange(size) // 4,
                       rng.integers(0, 3, size), rng.standard_normal(size),
                       1 + 1e-14 * np.arange(size)):
            yield turn @ np.diag(values.astype(float)) @ turn.T
            yield np.diag(values.astype(float))
    yield np.zeros((5, 5))
    yield np.zeros((0, 0))


def test_components():
    for v in matrices():
        values, basis = whitening.components(v)
        scale = max(np.linalg.norm(v), 1e-300)
        assert np.abs(basis.T @ basis - np.eye(len(v))).max(initial=0) < 1e-13
        assert np.abs(v @ basis - basis * values).max(initial=0) < 1e-13 * scale
        assert np.abs(values - np.linalg.eigvalsh(v)[::-1]).max(initial=0) < 1e-13 * scale


def test_polar():
    rng = np.random.default_rng(3)
    for size in (2, 9, 40):
        a = rng.standard_normal((size, size))
        a = a + a.T
        u = whitening.polar(a)
        assert np.abs(u @ u - np.eye(size)).max() < 1e-12
        assert np.linalg.eigvalsh(u @ a).min() > 0
    with pytest.raises(np.linalg.LinAlgError):
        whitening.polar(np.ones((3, 3)))


def plain_whitening(rows, keep):
    """(vec_id, component): deviation, |whitened|, explained."""
    size = max((len(r[1]) for r in rows if r[1] is not None), default=0)
    own = [(r[0], integers(r[1])) for r in rows]
    own = [(i, tuple(x + [0] * (size - len(x)))) for i, x in own if x is not None]
    fit = sorted({x for _, x in own})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    far = np.array(fit, float) - np.array(sums) / max(n, 1)
    values, basis = np.linalg.eigh(far.T @ far / n)
    out = []
    for i, x in own:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        for k in range(min(keep, size)):
            e, q = values[-1 - k], basis[:, -1 - k]
            if e > 1e-9 * values[-1]:
                white = (np.array(x) - np.array(sums) / n) @ q / math.sqrt(e)
                out.append((i, k + 1, n, deviation, abs(white), e / values.sum()))
    return out


ODD = [(1, None), (2, [0.5, None, 1.0]), (3, [math.nan, 0.0, 0.0]), (4, [math.inf, 0.0, 0.0]),
       (5, [0.25, -0.5, 0.001]), (5, [0.25, -0.5, 0.001]), (None, [0.1, 0.2, 0.9]),
       (6, [0.25, -0.5, 0.0011]), (7, [1.5]), (8, []), (9, [0.7, 0.7, -3.0]), (50, [-1.0, 0.3, 2.0])]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3) for i, v in rows], SCHEMA)


def test_whitening(spark, rows, table):
    given = rows("SELECT vec_id, embedding FROM '{f}/embeddings.parquet'")
    for df, plain in ((table("embeddings"), given), (frame(spark, ODD), ODD)):
        found = got(whitening.report(df))
        wanted = sorted(plain_whitening(plain, 4), key=repr)
        assert len(found) == len(wanted) > 0
        order = lambda r: (repr(r[0]), r[1])
        for a, b in zip(sorted(found, key=order), sorted(wanted, key=order)):
            assert a[:4] == b[:4]
            assert math.isclose(abs(a[4]), b[4], rel_tol=1e-6, abs_tol=1e-9)
            assert math.isclose(a[5], b[5], rel_tol=1e-9)
            assert a[6] < 1e-9


def test_whitened_vectors_have_the_identity_as_covariance(spark, table):
    df = table("embeddings")
    model = whitening.fit(df)
    assert len(model.values) == 64 and model.identity_error < 1e-9
    white = np.array([r.whitened for r in whitening.whitened(df, model).collect()])
    assert np.abs(np.cov(white.T, bias=True) - np.eye(64)).max() < 1e-9
    clash = frame(spark, ODD).withColumnRenamed("no", "deviation")
    out = whitening.whitened(clash, whitening.fit(clash))
    assert out.columns == [*clash.columns, "whitened_", "deviation_"]
    assert [r.whitened_ is None for r in out.orderBy("vec_id").collect()].count(True) == 4


def test_whitening_of_little(spark):
    assert got(whitening.report(frame(spark, []))) == []
    assert got(whitening.report(frame(spark, [(1, None)]))) == []
    assert got(whitening.report(frame(spark, [(1, []), (2, [])]))) == []
    assert got(whitening.report(frame(spark, [(1, [0.5, 1.0])] * 3))) == []
    two = got(whitening.report(frame(spark, [(1, [0.5, 1.0]), (2, [0.5, 3.0])])))
    assert [(r[0], r[1], r[2], r[3], round(abs(r[4]), 9), r[5]) for r in two] == [
        (1, 1, 2, 262144, 1.0, 1.0), (2, 1, 2, 262144, 1.0, 1.0)]


def test_deviations_are_exact_or_null():
    model = whitening.Whitening(3, (5 * 10**9, -7), np.ones(1), np.ones((2, 1)), 1.0)
    x = np.array([[10**9, 4], [-(10**9), 0]])
    assert model.deviations(x) == [(3 * 10**9 - 5 * 10**9) ** 2 + 19**2, None]
    assert (3 * 10**9 + 5 * 10**9) ** 2 + 49 > 2**63


# ---- 12 hard negatives


def plain_negatives(rows, positives=5, negatives=3):
    own = {}
    for i, v, label in rows:
        x = integers(v)
        if i is not None and label is not None and x is not None:
            own[i, tuple(x), (label + 1) % 10 if i % 7 == 0 else label] = None
    out = []
    for i, x, label in own:
        if i % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), j, m) for j, y, m in own if j != i)
        for s, j, _ in [r for r in scored if r[2] == label][:positives]:
            fits = [r for r in scored if r[2] != label and 50 * -s <= 100 * -r[0] <= 95 * -s]
            out += [(i, j, k + 1, r[1], -s, -r[0]) for k, r in enumerate(fits[:negatives])]
    return sorted(out, key=repr)


def made(seed, n, size=6, steps=3):
    """Vectors in clusters, many equal or with equal scores, and some odd ones."""
    rng = random.Random(seed)
    middle = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(5)]
    out = []
    for i in range(n):
        c = rng.choice(middle)
        v = [round((a + rng.gauss(0, 0.3)) * steps) / steps for a in c]
        out.append((i, v, rng.randrange(4)))
    out += [(n + i, middle[0], 2) for i in range(n // 3)]
    out += [(50, [0.0] * size, 1), (3000, [1.0], 0), (3050, [], 0), (3100, None, 1),
            (3150, [None] * size, 1), (3200, [math.nan] * size, 1), (3250, middle[1], None),
            (None, middle[1], 1), (3300, [-a for a in middle[0]], 2)]
    return out + out[:40]


def frame3(spark, rows):
    data = [(i, v, label, "x", 2, 3) for i, v, label in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(5)


@pytest.mark.parametrize("anchors,stripe,stripes,slice_,chunk", [
    (4096, 1 << 20, 16, 512, 1024), (3, 100, 1, 7, 2), (5, 10, 3, 1, 1)])
def test_hard_negatives(spark, monkeypatch, anchors, stripe, stripes, slice_, chunk):
    rows = made(5, 400)
    names = ("ANCHORS", "STRIPE", "STRIPES", "SLICE", "CHUNK")
    for name, value in zip(names, (anchors, stripe, stripes, slice_, chunk)):
        monkeypatch.setattr(hard_negatives, name, value)
    found = got(hard_negatives.report(frame3(spark, rows)))
    assert found == plain_negatives(rows) and len(found) > 60


def test_hard_negatives_of_little(spark):
    for rows in ([], [(50, [1.0, 2.0], 1)], [(50, None, 1)], [(1, [1.0], 1), (2, [1.0], 1)],
                 [(50, [], 1), (100, [], 1), (3, [], 2)]):
        assert got(hard_negatives.report(frame3(spark, rows))) == plain_negatives(rows)


def test_bounds_hold():
    rng = np.random.default_rng(4)
    for size in (1, 2, 8, 64):
        x = rng.integers(-300, 300, (300, size))
        x = np.concatenate([x, 3 * x[:50], -x[50:100], x[:20] + rng.integers(-1, 2, (20, size)),
                            np.zeros((2, size), int)])
        to = hard_negatives.references(x[::3])
        norm, theta = hard_negatives.angles(x, to)
        exact = hard_negatives.scores(x, x)
        for first in range(0, len(x), 7):
            part = slice(first, first + rng.integers(1, 8))
            lower, upper = hard_negatives.score_bounds(
                norm, theta, theta[part].astype(float).min(0), theta[part].astype(float).max(0),
                norm[part].min(), norm[part].max())
            assert (exact[:, part].min(1) >= lower).all() and (exact[:, part].max(1) <= upper).all()


def test_windows_skip_rows(spark, monkeypatch):
    """In clustered data most slices are skipped, and the hits are those of all rows."""
    rng = np.random.default_rng(2)
    middle = rng.standard_normal((16, 32)) * 4
    x = np.floor(256 * (middle[np.arange(4000) % 16] + rng.standard_normal((4000, 32)) * 0.1))
    x = x.astype(np.int64)
    norm, theta = hard_negatives.angles(x, hard_negatives.references(x[:500]))
    near = np.lexsort((theta.min(1), theta.argmin(1)))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(near), pa.array(near), pa.array(near % 3), pa.array(norm[near]),
         pa.array(vectors.pack(x[near]), pa.binary()),
         pa.array([t.tobytes() for t in theta[near]], pa.binary())],
        names=["no", "id", "label", "norm", "x", "angles"])
    rows = hard_negatives.Rows([batch], 32)
    keeper = hard_negatives.Positives(hard_negatives.Rows([batch.slice(0, 60)], 32), 5)
    scored, plain = [], hard_negatives.scores
    monkeypatch.setattr(hard_negatives, "SLICE", 64)
    monkeypatch.setattr(hard_negatives, "scores",
                        lambda a, b: scored.append(len(a) * len(b)) or plain(a, b))
    hard_negatives._compared(keeper, rows)
    assert 0 < sum(scored) < 60 * 4000 / 4
    for k in range(60):
        anchor = near[k]
        others = sorted((-int(x[anchor] @ x[j]), j) for j in range(4000)
                        if j != anchor and j % 3 == anchor % 3)[:5]
        assert list(zip(-keeper.best.score[k], keeper.best.id[k])) == others


def test_scores_beyond_doubles_are_exact():
    a = np.array([[2**30 + 1, 3], [-(2**30), 5]])
    assert hard_negatives.scores(a, a).tolist() == (a.astype(object) @ a.T.astype(object)).tolist()
    with pytest.raises(ValueError):
        hard_negatives.scores(a * 4, a * 4)


def test_labels_are_of_any_table(spark):
    df = spark.createDataFrame([(1, 2, [1.0, 0.0], True), (2, 2, [0.9, 0.1], None),
                                (3, 4, [0.6, 0.1], False)],
                               "key long, kind long, v array<double>, first boolean")
    found = hard_negatives.mine(df, "key", "kind", "v", F.col("first"))
    assert got(found) == [(1, 2, 1, 3, 256 * 230, 256 * 153)]
