import numpy as np
import pytest
from sonora.llm import topk_search as K


def brute(vectors, k=5, modulus=50):
    width = max((len(v) for _, v in vectors), default=0)
    x = {i: np.array([*map(int, np.floor(256.0 * np.array(v, float))), *[0] * (width - len(v))], object) for i, v in vectors}
    out = []
    for q in sorted(x):
        if q % modulus == 0:
            found = sorted((-int((x[q] * x[c]).sum()), c) for c in x if c != q)[:k]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(found)]
    return out


def search(spark, rows, **params):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string, score string").repartition(3)
    return sorted(tuple(r) for r in K.topk_search(frame, **params).collect())


def test_random_and_equal_vectors(spark):
    rng = np.random.default_rng(1)
    vectors = [(k, rng.normal(size=8).astype(np.float32).tolist()) for k in range(700)]
    vectors += [(1000 + k, vectors[50][1]) for k in range(300)]
    got = search(spark, [(*v, "a", None) for v in vectors])
    assert got == brute(vectors)


def test_waves_and_scales(spark):
    rng = np.random.default_rng(2)
    vectors = [(k, (rng.normal(size=4) * 10.0 ** rng.integers(-2, 4)).astype(np.float32).tolist()) for k in range(400)]
    assert search(spark, [(*v, None, None) for v in vectors], wave_queries=3) == brute(vectors)


@pytest.mark.parametrize("scale", [1.0, 3e5])
def test_large_integers_are_exact(spark, scale):
    rng = np.random.default_rng(3)
    vectors = [(k, (rng.normal(size=3) * scale).astype(np.float32).tolist()) for k in range(150)]
    assert search(spark, [(*v, None, None) for v in vectors]) == brute(vectors)


def test_odd_rows(spark):
    good = [(0, [1.0, 2.0]), (50, [1.0]), (3, []), (4, [-1.0, 0.5]), (5, [1.0, 2.0])]
    odd = [(100, None), (7, [float("nan"), 1.0]), (8, [float("inf")]), (9, [1.0, None]), (None, [1.0, 1.0])]
    rows = [(*v, "a", "b") for v in [*good, *odd, good[0], good[4]]]
    assert search(spark, rows) == brute(good)
    assert search(spark, []) == [] and search(spark, [(1, [1.0], None, None)]) == []


def test_cover_tree_covers():
    points = np.random.default_rng(5).integers(-300, 300, (1000, 6))
    tree = K.CoverTree(points, leaf=16)
    assert sorted(tree.order.tolist()) == list(range(1000))
    for node in range(len(tree.first)):
        own = points[tree.order[tree.first[node] : tree.last[node]]]
        assert (np.sqrt(((own - tree.centre[node]) ** 2).sum(1)) <= tree.radius[node] + 1e-9).all()
        if tree.children[node]:
            assert sum(tree.last[c] - tree.first[c] for c in tree.children[node]) == len(own)


def test_levels_of_the_cover_tree():
    points = np.random.default_rng(6).integers(-40, 40, (600, 3))
    tree = K.CoverTree(points)
    distance = lambda a, b: float(np.sqrt(((points[a] - points[b]) ** 2).sum()))
    assert max(tree.level) - min(tree.level) >= 4
    for node, children in enumerate(tree.children):
        assert (tree.centre[node] == points[tree.pivot[node]]).all() and tree.radius[node] <= K.BASE ** tree.level[node] * (1 + 1e-9)
        if not children:
            assert tree.last[node] - tree.first[node] <= K.LEAF_POINTS or tree.radius[node] == 0
            continue
        levels = {tree.level[c] for c in children}
        assert len(levels) == 1 and levels.pop() < tree.level[node]  # one level, below the parent's
        assert tree.pivot[children[0]] == tree.pivot[node]  # nesting
        reach = K.BASE ** tree.level[children[0]]
        assert all(distance(tree.pivot[a], tree.pivot[b]) > reach for a in children for b in children if a < b)  # separation
        assert all(distance(tree.pivot[c], p) <= reach for c in children for p in tree.members(np.array([c])))  # covering


def lots(queries, data, k=5):
    """Best scores after all lots of the data, and the the products made, of centres too, as a share of all pairs."""
    tree, ids, best, products = K.CoverTree(queries, leaf=1), np.arange(len(queries)) - len(queries), K.Best(len(queries), k), 0
    for lo in range(0, len(data), K.LOT_ROWS):
        lot = data[lo : lo + K.LOT_ROWS]
        products += K.Search(tree, ids, queries, K.CoverTree(lot), np.arange(lo, lo + len(lot)), lot, best).products
    return best.score, products / (len(queries) * len(data))


@pytest.mark.parametrize("noise, most", [(0.01, 0.1), (0.03, 0.3)])
def test_clustered_vectors_are_pruned(noise, most):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(200, 64))
    centres /= np.sqrt((centres**2).sum(1))[:, None]
    draw = lambda n: np.floor(256 * (centres[rng.integers(0, 200, n)] + rng.normal(size=(n, 64)) * noise)).astype(np.int64)
    queries, data = draw(600), draw(10_000)
    score, share = lots(queries, data)
    assert (score == -np.sort(-(queries @ data.T), 1)[:, :5]).all()
    assert share < most, share


def test_unit_vectors_without_clusters_stay_exact():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(4000, 64))
    x = np.floor(256 * x / np.sqrt((x**2).sum(1))[:, None]).astype(np.int64)
    assert (lots(x[:300], x)[0] == -np.sort(-(x[:300] @ x.T), 1)[:, :5]).all()
