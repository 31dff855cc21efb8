"""Pack joins: searches of many dimensions against brute force, and what they keep on disk."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import audit, cluster, dbscan, neighbours, packs, profile


def frame(spark, x, name="r%04d"):
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "n long, v array<double>").withColumn("id", F.format_string(name, "n"))


def distances(x, y):
    return np.sqrt(((x[:, None] - y[None]) ** 2).sum(2))


@pytest.fixture(scope="module")
def wide():
    """Vectors in 24 dimensions, where every query has to see nearly every leaf, with copies."""
    x = np.random.default_rng(3).normal(size=(300, 24))
    return np.vstack([x, x[:20], x[:20]])


def rows_kept(monkeypatch, module):
    """The numbers of rows of all tables that the module materialises."""
    kept, cut = [], module.cut_lineage

    def spy(df):
        out = cut(df)
        kept.append(out.count())
        return out

    monkeypatch.setattr(module, "cut_lineage", spy)
    return kept


def test_adaptive_eps_keeps_no_row_per_query_and_leaf(spark, wide, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    kept = rows_kept(monkeypatch, neighbours)
    got = dbscan.adaptive_eps(frame(spark, wide), "n", "v", 5, 0.9, "linear").first()["eps"]
    want = np.quantile(np.sort(distances(wide, wide), axis=1)[:, 4], 0.9)
    assert got == pytest.approx(want, abs=1e-12)
    assert max(kept) <= 5 * len(wide)


@pytest.mark.parametrize("many", [8_000_000, 0])
@pytest.mark.parametrize("shift", [0.0, 1e7])
def test_neighbours_with_text_ids_and_ties(spark, wide, monkeypatch, many, shift):
    monkeypatch.setattr(neighbours, "BLOCK", 32)
    monkeypatch.setattr(neighbours, "MANY", many)
    x = wide + shift
    df = frame(spark, x)
    got = neighbours.nearest_neighbours(df.where("n % 3 = 0"), df, 4, "id", "id", "v").collect()
    asked = {r["pid"]: [] for r in got}
    for r in sorted(got, key=lambda r: r["rank"]):
        asked[r["pid"]].append((r["nid"], r["distance"]))
    d = distances(x, x)
    for pid, near in asked.items():
        i = int(pid[1:])
        best = np.lexsort((np.arange(len(x)), d[i]))[:4]
        assert near == [(f"r{j:04d}", d[i, j]) for j in best]
    assert len(asked) == len({tuple(v) for v in x[::3]})


def test_within_settles_what_single_precision_leaves_open():
    draw = np.random.default_rng(4)
    x = draw.normal(size=(70, 8))
    for shift, scale in ((0.0, 1.0), (1e9, 1.0), (0.0, 1e25), (0.0, 1e-20)):
        y = np.vstack([x * scale + shift, draw.normal(size=(50, 8)) * scale + shift])
        d = distances(y, y)
        for limit in (0.0, d[3, 5], np.nextafter(d[3, 5], 0), np.inf):
            got = np.vstack([m for _, m in packs.within(y, y, limit)])
            assert (got == (d <= limit)).all()


def test_packs_refuse_vectors_of_unequal_length(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0], ""), (2, [0.0], "")], "pid long, v array<double>, cell string")
    with pytest.raises(Exception, match="same length"):
        packs.packs(df, ["pid"], 16, 4)


def ward_by_pairs(x, size, k):
    """The cheapest pair of all, one at a time."""
    x, n, member = x.copy(), size.astype(float), np.arange(len(x))
    alive = list(range(len(x)))
    while len(alive) > k:
        cost = ((x[alive][:, None] - x[alive][None]) ** 2).sum(2) * np.outer(n[alive], n[alive]) / np.add.outer(n[alive], n[alive])
        np.fill_diagonal(cost, np.inf)
        i, j = sorted(np.unravel_index(cost.argmin(), cost.shape))
        i, j = alive[i], alive[j]
        x[i], n[i] = (n[i] * x[i] + n[j] * x[j]) / (n[i] + n[j]), n[i] + n[j]
        member[member == j] = i
        alive.remove(j)
    return member


@pytest.mark.parametrize("merged, many", [(cluster.MERGED, 8_000_000), (0, 8_000_000), (0, 0)])
def test_ward_micro_needs_few_searches(spark, wide, monkeypatch, merged, many):
    monkeypatch.setattr(neighbours, "BLOCK", 60)
    monkeypatch.setattr(cluster, "MERGED", merged)
    monkeypatch.setattr(neighbours, "MANY", many)
    searches, build = [], cluster.build_tree
    monkeypatch.setattr(cluster, "build_tree", lambda points: searches.append(1) or build(points))
    x = wide[:180] * np.r_[4.0, 2.0, np.ones(22)]
    x = np.vstack([x, x[:30]])
    got = cluster.ward(frame(spark, x), "n", "v", 5).toPandas().sort_values("n").cluster.to_numpy()
    member = ward_by_pairs(x[:180], np.r_[np.full(30, 2), np.ones(150)], 5)
    member = np.r_[member, member[:30]]
    order = sorted(set(member.tolist()), key=lambda g: (-(member == g).sum(), g))
    assert got.tolist() == [order.index(g) for g in member.tolist()]
    assert not merged or len(searches) <= 3


def test_dbscan_reads_no_row_per_point_and_leaf(spark, wide, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    visits, join = [], dbscan.block_join
    monkeypatch.setattr(dbscan, "block_join", lambda visiting, *rest: visits.append(visiting.count()) or join(visiting, *rest))
    x = wide * 0.5
    d = distances(x, x)
    eps = float(np.quantile(d[d > 0], 0.06))
    near = d <= eps
    core = near.sum(1) >= 6
    label, last = np.full(len(x), -1), -1
    for i in np.flatnonzero(core):
        if label[i] < 0:
            last, todo = last + 1, [i]
            while todo:
                j = todo.pop()
                if label[j] < 0:
                    label[j] = last
                    todo += np.flatnonzero(near[j] & core & (label < 0)).tolist()
    touched = [label[near[i] & core] for i in range(len(x))]
    want = [int(label[i]) if core[i] else min(map(int, touched[i]), default=-1) for i in range(len(x))]
    got = dbscan.dbscan(frame(spark, x), "id", "v", eps, 6).toPandas().sort_values("n").cluster.tolist()
    assert got == want and 0 < sum(c >= 0 for c in got) < len(x)
    assert max(visits, default=0) <= len(x)


def test_subtractive_judges_few_candidates_where_balls_overlap(spark, wide, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    monkeypatch.setattr(cluster, "CANDIDATES", 8)
    asked, exact = [], cluster._densities
    monkeypatch.setattr(cluster, "_densities", lambda p, v, r: asked.append(len(v)) or exact(p, v, r))
    x = (wide - wide.min(0)) / (np.ptp(wide, axis=0) + 1e-10)
    radius = np.quantile(np.sqrt((x**2).sum(1)), 0.75) / 2
    density = np.exp(-(distances(x, x) ** 2) / radius**2).sum(1)
    chosen, order = [], np.lexsort((np.arange(len(x)), -np.round(density, 9)))
    for i in order:
        if len(chosen) < 3 and (not chosen or density[i] > 0.15 * density[chosen[0]]) and (distances(x[[i]], x[chosen]) >= radius / 2).all():
            chosen.append(i)
    got = cluster.subtractive_centres(frame(spark, x), "n", "v", 3)
    assert np.allclose(got, x[chosen])
    assert sum(asked) < 100


def test_ward_parted_far_from_the_origin(spark, wide, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 30)
    searches, build = [], cluster.build_tree
    monkeypatch.setattr(cluster, "build_tree", lambda points: searches.append(1) or build(points))
    group = np.arange(150) % 3
    x = wide[:150] + 1e4 + 40.0 * group[:, None]
    got = cluster.ward(frame(spark, x), "n", "v", 3).toPandas().sort_values("n").cluster.tolist()
    assert got == group.tolist()  # equal sizes are numbered by smallest row
    assert len(searches) <= 3


def test_all_clusterings_keep_no_row_per_point_and_leaf(spark, wide, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 24)
    kept = rows_kept(monkeypatch, neighbours)
    df = frame(spark, wide[:150] + 30.0 * (np.arange(150) % 3)[:, None])
    got = cluster.all_clusterings(df, "n", "v", 3, restarts=2)
    sizes = {tuple(r) for r in got.groupBy("algorithm", "cluster").count().collect()}
    assert {("Hierarchical", c, 50) for c in range(3)} <= sizes and len({a for a, _, _ in sizes}) == 5
    assert max(kept) <= 5 * 150


@pytest.mark.parametrize("dims", [2, 24])
def test_knn_self_distance_and_full_vectors(spark, wide, monkeypatch, dims):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    kept = rows_kept(monkeypatch, neighbours)
    x = wide[:, :dims]
    got = neighbours.kth_distance(frame(spark, x), "id", "v", 5).toPandas().sort_values("n")
    assert np.array_equal(got.kth_distance, np.sort(distances(x, x), axis=1)[:, 4])
    assert max(kept) <= 5 * len(x)


def test_knn_classify_of_other_rows(spark, wide, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    kept = rows_kept(monkeypatch, neighbours)
    df = frame(spark, wide).withColumn("y", (F.col("v")[0] > 0).cast("int"))
    got = neighbours.knn_classify(df.where("n % 4 > 0"), df.where("n % 4 = 0"), "id", "v", "y", 5).toPandas().sort_values("n")
    train = np.array([i for i in range(len(wide)) if i % 4])
    d = distances(wide[::4], wide[train])
    votes = [(wide[train[np.lexsort((train, row))[:5]], 0] > 0).sum() for row in d]
    assert got.pred.tolist() == [int(v >= 3) for v in votes]
    assert max(kept) <= 5 * len(wide)


def test_tables_read_from_clusters_search_once(spark, wide, monkeypatch):
    """Sizes, summary, reassigned noise, parity flags and percentages: no search runs again when its result is read."""
    monkeypatch.setattr(neighbours, "BLOCK", 32)
    x = np.vstack([wide[:100] * 0.2, wide[100:140] * 0.2 + 9.0, wide[140:150] * 30.0])
    df = frame(spark, x).withColumn("y", (F.col("n") % 2).cast("int"))
    found = dbscan.dbscan(df, "id", "v", 1.6, 4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "MapInArrow" not in plan and "FlatMapCoGroups" not in plan
    near = distances(x, x) <= 1.6
    assert dbscan.summary(found).first()["clusters"] == 2 and not near[:100, 100:140].any()
    sizes = {r["cluster"]: r["n"] for r in profile.distinct_counts(found, "cluster", ignore=-1).collect()}
    noise = found.where("cluster = -1").count()
    assert sum(sizes.values()) + noise == len(x) and noise >= 10
    moved = {r["cluster"]: r["count"] for r in dbscan.reassign_noise(found, "v").groupBy("cluster").count().collect()}
    assert set(moved) == {0, 1} and sum(moved.values()) == len(x)
    flags = audit.parity_flags(found, "y", "cluster").where("cluster >= 0")
    assert flags.where("quality <> cast(cluster % 2 = y as double)").count() == 0
    assert profile.contingency(found, "y", "cluster").agg(F.sum("n")).first()[0] == len(x)
