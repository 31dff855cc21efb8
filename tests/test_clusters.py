"""Neighbour searches, clusterings and label audits against brute force on small tables."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ledgerlark.operators import audit, cluster, dbscan, neighbours, reduce


def frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(a) for a in v]) for i, v in zip(ids, x)], "id long, v array<double>")


@pytest.fixture(scope="module")
def cloud():
    """Three clumps, scattered points, and a large group of copies."""
    draw = np.random.default_rng(5)
    clumps = [draw.normal(c, 0.15, (60, 2)) for c in ((0, 0), (2, 0), (1, 2))]
    return np.round(np.vstack([*clumps, draw.uniform(-2, 4, (40, 2)), np.tile([[2.0, 2.0]], (110, 1))]), 6)


def distances(x, y=None):
    y = x if y is None else y
    return np.sqrt(((x[:, None] - y[None]) ** 2).sum(2))


def brute_dbscan(x, eps, min_samples):
    near = distances(x) <= eps
    core = near.sum(1) >= min_samples
    label, nxt = np.full(len(x), -1), 0
    for i in np.nonzero(core)[0]:
        if label[i] >= 0:
            continue
        todo = [i]
        while todo:
            j = todo.pop()
            if label[j] < 0 and core[j]:
                label[j] = nxt
                todo += np.nonzero(near[j] & core)[0].tolist()
        nxt += 1
    for i in np.nonzero(~core)[0]:
        touching = label[near[i] & core]
        label[i] = touching.min() if len(touching) else -1
    return label


@pytest.mark.parametrize("block", [2048, 16])
def test_kth_distance(spark, cloud, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    got = neighbours.kth_distance(frame(spark, cloud), "id", "v", 5).toPandas().sort_values("id")
    want = np.sort(distances(cloud), axis=1)[:, 4]
    assert np.allclose(got.kth_distance, want, atol=1e-12) and len(got) == len(cloud)


def test_neighbours_break_ties_by_id(spark):
    x = [[0.0], [1.0], [-1.0], [1.0], [5.0]]
    got = neighbours.nearest_neighbours(frame(spark, x), frame(spark, x), 3, "id", "id", "v")
    rows = {(r["pid"], r["rank"]): r["nid"] for r in got.collect()}
    assert [rows[0, i] for i in (1, 2, 3)] == [0, 1, 2]
    assert [rows[1, i] for i in (1, 2, 3)] == [1, 3, 0]


def test_knn_classify(spark, cloud, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 32)
    label = (cloud[:, 0] > 1).astype(int)
    df = frame(spark, cloud).withColumn("y", (F.col("v")[0] > 1).cast("int"))
    train, test = df.where("id % 3 > 0"), df.where("id % 3 = 0")
    got = neighbours.knn_classify(train, test, "id", "v", "y", 5).toPandas()
    tr = np.array([i for i in range(len(cloud)) if i % 3])
    for r in got.itertuples():
        d = distances(cloud[[r.id]], cloud[tr])[0]
        near = tr[np.lexsort((tr, d))[:5]]
        assert r.pred == int(label[near].sum() >= 3)
    assert len(got) == test.count()


@pytest.mark.parametrize("block, few", [(2048, 200_000), (16, 0)])
def test_dbscan(spark, cloud, monkeypatch, block, few):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    monkeypatch.setattr(dbscan.connected_components, "__defaults__", (few,))
    order = np.random.default_rng(7).permutation(len(cloud))
    df = frame(spark, cloud[order], order)
    got = dbscan.dbscan(df, "id", "v", 0.2, 6).toPandas().sort_values("id")
    assert got.cluster.tolist() == brute_dbscan(cloud, 0.2, 6).tolist()


def test_dbscan_with_text_ids(spark, cloud):
    names = [f"r{i:04d}" for i in range(len(cloud))]
    df = frame(spark, cloud).withColumn("id", F.format_string("r%04d", "id"))
    got = dbscan.dbscan(df, "id", "v", 0.2, 6).toPandas().sort_values("id")
    assert got.id.tolist() == names
    assert got.cluster.tolist() == brute_dbscan(cloud, 0.2, 6).tolist()


def test_dbscan_edges(spark):
    x = [[0.0], [0.1], [0.2], [1.2], [0.7], [1.3], [1.4], [9.0]]
    df = frame(spark, x)
    # 0.7 touches both groups, is no core point itself, and joins the lower one; 9.0 is alone
    got = dbscan.dbscan(df, "id", "v", 0.5 + 1e-12, 4).toPandas().sort_values("id")
    assert got.cluster.tolist() == brute_dbscan(np.array(x), 0.5 + 1e-12, 4).tolist()
    alone = dbscan.dbscan(df, "id", "v", 0.01, 1).toPandas()
    assert alone.cluster.nunique() == 8
    none = dbscan.dbscan(df, "id", "v", 0.01, 2)
    assert {r["cluster"] for r in none.collect()} == {-1}
    assert {r["cluster"] for r in dbscan.reassign_noise(none, "v").collect()} == {0}
    assert dbscan.summary(none).first().asDict() == {"clusters": 0, "outliers": 8, "outlier_pct": 100.0}


def test_connected_components(spark):
    draw = np.random.default_rng(11)
    chain = [(i, i + 1) for i in range(60)] + [(100, j) for j in range(101, 160)]
    chain += [(int(a), int(b)) for a, b in draw.integers(200, 400, (120, 2))]
    edges = spark.createDataFrame([chain[i] for i in draw.permutation(len(chain))], "a long, b long")
    few = {tuple(r) for r in dbscan.connected_components(edges).collect()}
    many = {tuple(r) for r in dbscan.connected_components(edges, few=0).collect()}
    assert few == many and {c for n, c in few if n <= 60} == {0} and {c for n, c in few if 100 <= n < 160} == {100}


def test_reassign_noise_goes_to_the_nearest_mean(spark):
    df = spark.createDataFrame(
        [([0.0], 3), ([1.0], 3), ([10.0], 7), ([4.0], -1), ([9.0], -1)], "v array<double>, cluster int"
    )
    got = [r["cluster"] for r in dbscan.reassign_noise(df, "v").orderBy(F.col("v")[0]).collect()]
    assert got == [0, 0, 0, 1, 1]


def test_kmeans_and_elbow(spark, cloud):
    df = frame(spark, cloud)
    costs = [cluster.kmeans(df, "v", k, restarts=3)[1] for k in (1, 2, 4)]
    assert costs[0] > costs[1] > costs[2]
    assert costs[0] == pytest.approx(((cloud - cloud.mean(0)) ** 2).sum())
    centres, cost = cluster.kmeans(df, "v", 3, restarts=2)
    got = cluster.assign(df, "v", centres).toPandas().sort_values("id")
    d = distances(cloud, np.array(centres))
    assert (got.cluster.to_numpy() == d.argmin(1)).all()
    assert cost == pytest.approx((d.min(1) ** 2).sum(), rel=1e-9)
    curve = spark.createDataFrame([(1, 10.0), (2, 4.0), (3, 2.0), (4, 1.0)], "k int, inertia double")
    assert cluster.elbow(curve).first()["k"] == 2
    flat = spark.createDataFrame([(1, 3.0), (2, 2.0), (3, 1.0)], "k int, inertia double")
    assert cluster.elbow(flat).first()["k"] == 1


def test_shared_kmeans_runs(spark, cloud):
    """Runs that share scans settle where the plain rounds do, find the best partition, and don't depend on the partitions."""
    df = frame(spark, cloud)
    found = cluster.kmeans_runs(df, "v", [1, 2, 3, 5], restarts=4)
    for k, (centres, cost) in found.items():
        c = np.array(centres)
        at = distances(cloud, c).argmin(1)
        assert len(c) == k and cost == pytest.approx(((cloud - c[at]) ** 2).sum(), rel=1e-9)
        assert np.allclose([cloud[at == j].mean(0) for j in range(k)], c, atol=1e-3)
    alone = cluster.kmeans_runs(df.repartition(7), "v", [3], restarts=4)
    assert np.allclose(alone[3][0], found[3][0]) and alone[3][1] == pytest.approx(found[3][1])
    line = np.r_[np.zeros(20), np.full(30, 10.0), np.full(5, 100.0)]
    pairs = np.stack([line, np.tile([0.0, 1.0, 2.0, 3.0, 4.0], 11)], axis=1)
    best, cost = cluster.kmeans(frame(spark, pairs), "v", 3)
    assert sorted(round(c[0], 6) for c in best) == [0.0, 10.0, 100.0] and cost == pytest.approx(110.0)


def test_kmeans_of_few_vectors(spark):
    rows = [([1.0],), ([1.0],), ([4.0],), (None,)]
    df = spark.createDataFrame(rows, "v array<double>")
    assert cluster.kmeans(df, "v", 3) == ([[1.0], [4.0]], 0.0) or cluster.kmeans(df, "v", 3) == ([[4.0], [1.0]], 0.0)
    assert cluster.kmeans(df.where("v IS NULL"), "v", 3) == ([], 0.0)
    assert cluster.inertia_curve(df, "v", [1, 2]).collect() == [(1, 6.0), (2, 0.0)]


def test_fuzzy_memberships(spark, cloud):
    df = frame(spark, cloud)
    centres = cluster.fuzzy_cmeans(df, "id", "v", 3, error=0.05)
    got = cluster.with_memberships(df, "v", centres).toPandas().sort_values("id")
    u = np.stack(got.membership)
    assert np.allclose(u.sum(1), 1) and (got.cluster.to_numpy() == u.argmax(1)).all()
    inverse = 1 / distances(cloud, np.array(centres)) ** 2
    assert np.allclose(u, inverse / inverse.sum(1, keepdims=True))
    moved = (u**2).T @ cloud / (u**2).sum(0)[:, None]
    assert np.abs(moved - np.array(centres)).max() < 0.02


def test_subtractive_is_exact(spark, cloud, monkeypatch):
    monkeypatch.setattr(cluster, "CANDIDATES", 8)
    x = (cloud - cloud.min(0)) / (np.ptp(cloud, axis=0) + 1e-10)
    r = np.percentile(np.sqrt((x**2).sum(1)), 75) / 2
    d = distances(x)
    density = np.exp(-(d**2) / r**2).sum(1)
    chosen = []
    for i in np.lexsort((np.arange(len(x)), -np.round(density, 9))):
        if density[i] > 0.15 * density.max() and all(d[i, j] >= r / 2 for j in chosen):
            chosen.append(i)
        if len(chosen) == 3:
            break
    scaled = cluster.min_max_vectors(frame(spark, cloud), "v", "s")
    got = cluster.subtractive_centres(scaled, "id", "s", 3)
    assert np.allclose(got, x[chosen])


def brute_ward(x, size, k):
    """Greedy merging of the cheapest pair, one at a time, over a full cost matrix."""
    x, n = np.array(x, float), np.array(size, float)
    member = np.arange(len(x))
    with np.errstate(invalid="ignore"):
        cost = distances(x) ** 2 * np.outer(n, n) / np.add.outer(n, n)
    np.fill_diagonal(cost, np.inf)
    for _ in range(len(x) - k):
        i, j = sorted(np.unravel_index(np.argmin(cost), cost.shape))
        x[i] = (n[i] * x[i] + n[j] * x[j]) / (n[i] + n[j])
        n[i] += n[j]
        member[member == j] = i
        cost[j], cost[:, j] = np.inf, np.inf
        alive = np.isin(np.arange(len(x)), member)
        new = np.where(alive, ((x - x[i]) ** 2).sum(1) * n * n[i] / (n + n[i]), np.inf)
        new[i] = np.inf
        cost[i], cost[:, i] = new, new
    return member


def numbered(member, weight):
    sizes = {g: weight[member == g].sum() for g in set(member.tolist())}
    order = sorted(sizes, key=lambda g: (-sizes[g], g))
    return [order.index(g) for g in member.tolist()]


@pytest.mark.parametrize("block", [2048, 40])
def test_ward(spark, cloud, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    cloud = cloud[::2] if block < 2048 else cloud
    got = cluster.ward(frame(spark, cloud), "id", "v", 4).toPandas().sort_values("id").cluster.tolist()
    vectors, first, inverse, size = np.unique(cloud, axis=0, return_index=True, return_inverse=True, return_counts=True)
    member = first[brute_ward(vectors, size, 4)]
    least = {g: first[member == g].min() for g in set(member.tolist())}
    member = np.array([least[g] for g in member.tolist()])
    want = dict(zip(first.tolist(), numbered(member, size), strict=True))
    assert got == [want[int(first[i])] for i in inverse]


def test_ward_edges(spark):
    few = frame(spark, [[0.0], [0.0], [5.0]])
    got = {r["id"]: r["cluster"] for r in cluster.ward(few, "id", "v", 3).collect()}
    assert got == {0: 0, 1: 0, 2: 1}
    one = cluster.ward(frame(spark, [[1.0]] * 3), "id", "v", 2).collect()
    assert [r["cluster"] for r in one] == [0, 0, 0]
    ties = frame(spark, [[float(i)] for i in range(8)])  # every neighbour is as near as the other
    sizes = sorted(r["count"] for r in cluster.ward(ties, "id", "v", 2).groupBy("cluster").count().collect())
    assert sizes == [4, 4]


def test_tree_leaves_are_bounded(spark, cloud, monkeypatch):
    draw = np.random.default_rng(3)
    x = np.vstack([draw.normal(0, 1, (900, 3)), 2.0 ** np.arange(60)[:, None] * [[1.0, 0, 0]], np.tile([[9.0, 9, 9]], (40, 1))])
    points = neighbours.distinct_vectors(frame(spark, x), "id", "v")
    for sent in (neighbours.SENT, 0):
        monkeypatch.setattr(neighbours, "SENT", sent)
        monkeypatch.setattr(neighbours, "BLOCK", 120)
        tree, placed = neighbours.build_tree(points)
        sizes = [r["count"] for r in placed.groupBy("cell").count().collect()]
        assert max(sizes) <= 120 and sum(sizes) == points.count() and len(tree.levels) >= 2
        near = neighbours.nearest_neighbours(frame(spark, x[:40]), frame(spark, x), 4, "id", "id", "v")
        got = {(r["pid"], r["rank"]): r["distance"] for r in near.collect()}
        want = np.sort(distances(x[:40], x), axis=1)
        assert all(np.isclose(got[i, j + 1], want[i, j]) for i in range(40) for j in range(4))


def test_pca(spark, cloud):
    df = frame(spark, cloud).withColumn("f", array_to_vector("v"))
    scored, explained = reduce.pca_scores(df, "f", 2)
    s = np.stack(scored.toPandas().sort_values("id").scores)
    values = np.sort(np.linalg.eigvalsh(np.cov(cloud.T)))[::-1]
    assert np.allclose(s.mean(0), 0, atol=1e-9) and np.allclose(np.cov(s.T), np.diag(values), atol=1e-9)
    assert np.allclose(explained, values / values.sum())


def test_consensus(spark):
    labelled = spark.createDataFrame([(i, y) for i, y in enumerate([0, 0, 0, 0, 1, 1])], "id int, y int")
    rows = [(i, "all_zero", int(i >= 4)) for i in range(6)]  # cluster 0 holds zeros only
    rows += [(i, "even", i % 2) for i in range(6)] + [(i, "one", 0) for i in range(6)]
    votes = spark.createDataFrame(rows, "id int, algorithm string, cluster int")
    got = [r["revised"] for r in audit.consensus_relabel(labelled, votes, "id", "y").orderBy("id").collect()]
    assert got == [0, 0, 0, 0, 1, 1]  # 4 and 5: one vote of two, a tie, gives 1
    single = votes.where("algorithm = 'one'")
    got = [r["revised"] for r in audit.consensus_relabel(labelled, single, "id", "y").orderBy("id").collect()]
    assert got == [0] * 6
    tie = spark.createDataFrame([(0, 1), (0, 0)], "c int, y int")
    assert audit.cluster_verdicts(tie, "y", ["c"]).first()["verdict"] == 0


def test_agreement_and_flags(spark):
    rows = [(0, 0)] * 3 + [(0, 1)] + [(1, 0)] * 2 + [(1, 1)] * 2
    df = spark.createDataFrame(rows, "y int, c int")
    got = {r["y"]: (r["matched"], r["share"]) for r in audit.matching_clusters(df, "y", "c").collect()}
    assert got == {0: (0, 75.0), 1: (1, 50.0)}
    assert audit.cluster_agreement(df, "y", "c").first()["verdict"] == "ALERTA"
    assert audit.mislabelled(df, "y", "c").count() == 3
    assert audit.hit_flags(df, "y", "c").agg(F.sum("hit")).first()[0] == 5
    noisy = spark.createDataFrame([(1, 3), (0, 3), (0, -1)], "y int, c int")
    assert [r["quality"] for r in audit.parity_flags(noisy, "y", "c").collect()] == [1.0, 0.0, 0.5]
    empty = df.where("y > 5").withColumn("r", F.col("y"))
    assert audit.label_changes(empty, "y", "r").first()["pct"] == 0.0
