"""Queries on the vector view: distances, neighbours, clusters and label audits."""

from __future__ import annotations

from math import cos

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window as W, functions as F

from ledgerlark.functions.scalars import euclidean
from ledgerlark.operators import audit, cluster, dbscan as density, kernel, neighbours, profile
from ledgerlark.operators.models import with_probability
from ledgerlark.operators.reduce import pca_scores
from ledgerlark.operators.neighbours import centre_distances, nearest_centre
from ledgerlark.plans.registry import query
from ledgerlark.plans.views import VECTORS, points, vectors, with_sql

DIMS = 64
EPS, MIN_SAMPLES = 1.16, 6
#: Three given centres of full width.
START3 = [[round(0.1 * cos(1 + i * (j + 1)), 6) for i in range(DIMS)] for j in range(3)]


def _list(c) -> str:
    """SQL of a centre: an expression as it is, numbers as a list."""
    return c if isinstance(c, str) else f"[{', '.join(map(repr, c))}]::DOUBLE[]"


def _d2(a: str, c) -> str:
    """SQL of the squared distance of ``a.v`` to a centre, or to the vector of another alias."""
    other = f"{c}.v" if isinstance(c, str) and c.isidentifier() else _list(c)
    return f"pow(list_distance({a}.v, {other}), 2)"


def _centres_sql(rows: str, value: str, names: list[str]) -> str:
    """One row of lists, entry by entry; ``value`` holds {j} for the centre and {x} for the entry."""
    columns = ", ".join(f"{value.format(j=j, x='v[i]')} AS {n}" for j, n in enumerate(names))
    lists = ", ".join(f"list({n} ORDER BY i) AS {n}" for n in names)
    return f"SELECT {lists} FROM (SELECT i, {columns} FROM {rows}, range(1, {DIMS + 1}) AS t(i) GROUP BY i)"


@query(
    with_sql(
        VECTORS,
        """SELECT a.vec_id, round(list_distance(a.v, b.v), 6) AS distance FROM vectors a JOIN vectors b ON b.vec_id = a.vec_id + 1""",
    )
)
def pair_distance(spark, sf_dir):
    """Distance of each vector to the next one."""
    a = vectors(spark, sf_dir).select("vec_id", "v")
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("w"))
    d = euclidean(F.col("v"), F.col("w"))
    return a.join(b, "vec_id").select("vec_id", F.round(d, 6).alias("distance"))


KDIST = VECTORS + f""", pairs AS (SELECT a.vec_id, list_distance(a.v, b.v) AS d, b.vec_id AS o FROM points a, points b),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, o) AS rk FROM pairs),
  kd AS (SELECT vec_id, d AS kth_distance FROM ranked WHERE rk = 5)"""


@query(with_sql(KDIST, "SELECT vec_id, round(kth_distance, 6) AS kth_distance FROM kd"))
def knn_self_distance(spark, sf_dir):
    out = neighbours.kth_distance(points(spark, sf_dir), "vec_id", "v", 5)
    return out.select("vec_id", F.round("kth_distance", 6).alias("kth_distance"))


@query(
    with_sql(
        VECTORS,
        """, pairs AS (SELECT a.vec_id, list_distance(a.v, b.v) AS d, b.vec_id AS o FROM vectors a, vectors b),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, o) AS rk FROM pairs)
        SELECT vec_id, round(d, 6) AS kth_distance FROM ranked WHERE rk = 5""",
    )
)
def knn_full_vectors(spark, sf_dir):
    """The same over all 64 dimensions."""
    out = neighbours.kth_distance(vectors(spark, sf_dir), "vec_id", "v", 5)
    return out.select("vec_id", F.round("kth_distance", 6).alias("kth_distance"))


@query(
    with_sql(
        KDIST,
        """, r AS (SELECT kth_distance, row_number() OVER (ORDER BY kth_distance) - 1 AS i, count(*) OVER () AS n FROM kd)
        SELECT 'index' AS method, round(max(CASE WHEN i = CAST(floor(n * 0.9) AS BIGINT) THEN kth_distance END), 6) AS eps FROM r
        UNION ALL SELECT 'linear', round(quantile_cont(kth_distance, 0.9), 6) FROM kd""",
    )
)
def adaptive_eps(spark, sf_dir):
    """Both variants: the ordered value and the interpolated percentile."""
    p = points(spark, sf_dir)
    out = None
    for method in ("index", "linear"):
        one = density.adaptive_eps(p, "vec_id", "v", 5, 0.9, method)
        one = one.select(F.lit(method).alias("method"), F.round("eps", 6).alias("eps"))
        out = one if out is None else out.unionByName(one)
    return out


def _nearest_sql(centres, alias: str = "points") -> str:
    d = [f"({_d2(alias, c)})" for c in centres]
    cases = []
    for i in range(len(d) - 1):
        later = " AND ".join(f"{d[i]} <= {d[j]}" for j in range(i + 1, len(d)))
        cases.append(f"WHEN {later} THEN {i}")
    return f"CAST(CASE {' '.join(cases)} ELSE {len(d) - 1} END AS INTEGER)"


@query(
    with_sql(
        VECTORS,
        f"""SELECT vec_id, {_nearest_sql(START3)} AS centre,
        round(sqrt(least({", ".join(_d2("points", c) for c in START3)})), 6) AS distance FROM points""",
    )
)
def nearest_centre_assignment(spark, sf_dir):
    p = points(spark, sf_dir)
    d = F.sqrt(F.array_min(centre_distances(F.col("v"), START3)))
    return p.select(
        "vec_id", nearest_centre(F.col("v"), START3).alias("centre"), F.round(d, 6).alias("distance")
    )


@query(
    with_sql(
        VECTORS,
        f""", train AS (SELECT * FROM points WHERE vec_id % 4 <> 0), test AS (SELECT * FROM points WHERE vec_id % 4 = 0),
        pairs AS (SELECT a.vec_id, a.label, b.label AS l, list_distance(a.v, b.v) AS d, b.vec_id AS o FROM test a, train b),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, o) AS rk FROM pairs),
        votes AS (SELECT vec_id, label, l, count(*) AS n FROM ranked WHERE rk <= 5 GROUP BY ALL),
        best AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, l) AS b FROM votes)
        SELECT vec_id, label, l AS pred FROM best WHERE b = 1""",
    )
)
def knn_classify(spark, sf_dir):
    """Every fourth vector is classified by the others."""
    p = points(spark, sf_dir).select("vec_id", "label", "v")
    train, test = p.where(F.col("vec_id") % 4 != 0), p.where(F.col("vec_id") % 4 == 0)
    return neighbours.knn_classify(train, test, "vec_id", "v", "label", 5).drop("v")


DBSCAN = VECTORS + f""", near AS (SELECT a.vec_id AS a, b.vec_id AS b FROM points a, points b WHERE list_distance(a.v, b.v) <= {EPS}),
  core AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= {MIN_SAMPLES}),
  links AS (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
  walk(a, b) AS (SELECT a, b FROM links UNION SELECT w.a, l.b FROM walk w JOIN links l ON w.b = l.a),
  roots AS (SELECT a AS id, min(b) AS root FROM walk GROUP BY a),
  numbered AS (SELECT id, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS cluster FROM roots),
  border AS (SELECT a AS id, min(cluster) AS cluster FROM near JOIN numbered n ON near.b = n.id
             WHERE a NOT IN (SELECT id FROM core) GROUP BY a),
  found AS (SELECT p.*, coalesce(n.cluster, b.cluster, -1) AS cluster FROM points p
            LEFT JOIN numbered n ON p.vec_id = n.id LEFT JOIN border b ON p.vec_id = b.id)"""


def found(spark, sf_dir):
    return density.dbscan(points(spark, sf_dir), "vec_id", "v", EPS, MIN_SAMPLES)


@query(with_sql(DBSCAN, "SELECT vec_id, cluster FROM found"))
def dbscan(spark, sf_dir):
    return found(spark, sf_dir).select("vec_id", "cluster")


@query(
    with_sql(
        DBSCAN,
        """SELECT count(DISTINCT CASE WHEN cluster >= 0 THEN cluster END) AS clusters, count(CASE WHEN cluster = -1 THEN 1 END) AS outliers,
        round(100.0 * count(CASE WHEN cluster = -1 THEN 1 END) / count(*), 6) AS outlier_pct FROM found""",
    )
)
def dbscan_summary(spark, sf_dir):
    out = density.summary(found(spark, sf_dir))
    return out.withColumn("outlier_pct", F.round("outlier_pct", 6))


@query(with_sql(DBSCAN, "SELECT cluster, count(*) AS n FROM found WHERE cluster <> -1 GROUP BY cluster"))
def cluster_sizes(spark, sf_dir):
    return profile.distinct_counts(found(spark, sf_dir), "cluster", ignore=-1)


@query(
    with_sql(
        DBSCAN,
        f""", means AS (SELECT cluster, list(m ORDER BY i) AS v FROM (
          SELECT cluster, i, avg(v[i]) AS m FROM found, range(1, {DIMS + 1}) AS t(i) WHERE cluster <> -1 GROUP BY ALL) GROUP BY cluster),
        moved AS (SELECT f.vec_id, m.cluster, row_number() OVER (PARTITION BY f.vec_id ORDER BY {_d2("f", "m")}, m.cluster) AS rk
          FROM found f, means m WHERE f.cluster = -1)
        SELECT f.vec_id, coalesce(m.cluster, f.cluster) AS cluster FROM found f LEFT JOIN moved m ON m.vec_id = f.vec_id AND m.rk = 1""",
    )
)
def dbscan_reassign_noise(spark, sf_dir):
    return density.reassign_noise(found(spark, sf_dir), "v").select("vec_id", "cluster")


@query(
    with_sql(
        DBSCAN,
        """SELECT vec_id, y, cluster, CAST(CASE WHEN cluster = -1 THEN 0.5 WHEN cluster % 2 = y THEN 1 ELSE 0 END AS DOUBLE) AS quality FROM found""",
    )
)
def parity_flags(spark, sf_dir):
    out = audit.parity_flags(found(spark, sf_dir), "y", "cluster")
    return out.select("vec_id", "y", "cluster", "quality")


def _lloyd_sql(rounds: int) -> str:
    sql, names = VECTORS, ["c0", "c1", "c2"]
    sql += f", a0 AS (SELECT *, {_nearest_sql(START3)} AS c FROM points)"
    for r in range(1, rounds + 1):
        means = _centres_sql(f"a{r - 1}", "avg(CASE WHEN c = {j} THEN {x} END)", names)
        centres = [f"k{r}.{n}" for n in names]
        sql += f", k{r} AS ({means})"
        sql += f", a{r} AS (SELECT points.*, {_nearest_sql(centres)} AS c, least({', '.join(_d2('points', c) for c in centres)}) AS d FROM points, k{r})"
    return sql


@query(
    with_sql(_lloyd_sql(2), "SELECT vec_id, c AS cluster, round(d, 7) AS d2 FROM a2")
)
def kmeans_fixed(spark, sf_dir):
    """Two rounds of k-means from given centres."""
    p = points(spark, sf_dir)
    centres = cluster.lloyd(p, "v", START3, 2)
    d2 = F.array_min(centre_distances(F.col("v"), centres))
    out = cluster.assign(p, "v", centres)
    return out.select("vec_id", "cluster", F.round(d2, 7).alias("d2"))


@query(with_sql(_lloyd_sql(2), "SELECT round(sum(d), 6) AS inertia FROM a2"))
def kmeans_inertia_fixed(spark, sf_dir):
    p = points(spark, sf_dir)
    centres = cluster.lloyd(p, "v", START3, 2)
    d2 = F.array_min(centre_distances(F.col("v"), centres))
    return p.agg(F.round(F.sum(d2), 6).alias("inertia"))


@query()
def kmeans_fit(spark, sf_dir):
    """Best of several seeded runs; sizes and inertia."""
    p = points(spark, sf_dir)
    centres, cost = cluster.kmeans(p, "v", 3)
    sizes = profile.distinct_counts(cluster.assign(p, "v", centres), "cluster")
    return sizes.withColumn("inertia", F.round(F.lit(cost), 4))


def _fuzzy_sql() -> str:
    sql, names, centres = VECTORS, ["c0", "c1", "c2"], START3
    for r in range(3):
        inv = [f"1 / greatest({_d2('points', c)}, 4.930380657631324e-32)" for c in centres]
        total = " + ".join(f"({x})" for x in inv)
        source = "points" if r == 0 else f"points, f{r}"
        if r == 2:
            us = ", ".join(f"round(({x}) / ({total}), 6) AS u{j}" for j, x in enumerate(inv))
            return sql + f", done AS (SELECT vec_id, {us}, {_nearest_sql(centres)} AS cluster FROM {source})"
        us = ", ".join(f"({x}) / ({total}) AS u{j}" for j, x in enumerate(inv))
        sql += f", g{r} AS (SELECT points.*, {us} FROM {source})"
        sql += f", f{r + 1} AS ({_centres_sql(f'g{r}', 'sum(u{j} * u{j} * {x}) / sum(u{j} * u{j})', names)})"
        centres = [f"f{r + 1}.{n}" for n in names]


@query(with_sql(_fuzzy_sql(), "SELECT vec_id, u0, u1, u2, cluster FROM done"))
def fuzzy_cmeans_fixed(spark, sf_dir):
    """Two rounds of fuzzy c-means from given centres."""
    p = points(spark, sf_dir)
    centres = cluster.fuzzy_cmeans(p, "vec_id", "v", 3, max_rounds=2, error=0.0, start=START3)
    out = cluster.with_memberships(p, "v", centres)
    u = [F.round(F.col("membership")[j], 6).alias(f"u{j}") for j in range(3)]
    return out.select("vec_id", *u, "cluster")


@query()
def fuzzy_cmeans_fit(spark, sf_dir):
    """From seeded memberships until they settle."""
    p = points(spark, sf_dir)
    centres = cluster.fuzzy_cmeans(p, "vec_id", "v", 3)
    out = cluster.with_memberships(p, "v", centres)
    top = F.round(F.array_max("membership"), 4)
    return out.select("vec_id", "cluster", top.alias("top"))


def _subtractive_sql() -> str:
    sql = VECTORS + f""", ext AS (SELECT list(l ORDER BY i) AS l, list(h ORDER BY i) AS h FROM (
        SELECT i, min(v[i]) AS l, max(v[i]) AS h FROM points, range(1, {DIMS + 1}) AS t(i) GROUP BY i)),
      s AS (SELECT vec_id, list_transform(range(1, {DIMS + 1}), lambda i: (v[i] - l[i]) / (h[i] - l[i] + 1e-10)) AS v FROM points, ext),
      rad AS (SELECT quantile_cont(sqrt(list_dot_product(v, v)), 0.75) / 2 AS r FROM s),"""
    sql += f"""dens AS (SELECT a.vec_id, any_value(a.v) AS v,
        sum(exp(-({_d2("a", "b")}) / (r * r))) AS d FROM s a, s b, rad GROUP BY a.vec_id),
      c1 AS (SELECT * FROM dens ORDER BY d DESC, vec_id LIMIT 1),
      c2 AS (SELECT dens.* FROM dens, c1, rad WHERE list_distance(dens.v, c1.v) >= r * 0.5 AND dens.d > c1.d * 0.15 ORDER BY dens.d DESC, dens.vec_id LIMIT 1),
      c3 AS (SELECT dens.* FROM dens, c1, c2, rad WHERE list_distance(dens.v, c1.v) >= r * 0.5 AND list_distance(dens.v, c2.v) >= r * 0.5
             AND dens.d > c1.d * 0.15 ORDER BY dens.d DESC, dens.vec_id LIMIT 1),
      cs AS (SELECT 0 AS i, * FROM c1 UNION ALL SELECT 1, * FROM c2 UNION ALL SELECT 2, * FROM c3),
      r AS (SELECT s.vec_id, i, row_number() OVER (PARTITION BY s.vec_id ORDER BY {_d2("s", "cs")}, i) AS rk FROM s, cs)"""
    return sql


@query(with_sql(_subtractive_sql(), "SELECT vec_id, CAST(i AS INTEGER) AS cluster FROM r WHERE rk = 1"))
def subtractive(spark, sf_dir):
    return cluster.subtractive(points(spark, sf_dir), "vec_id", "v", 3).select("vec_id", "cluster")


@query(
    with_sql(
        VECTORS,
        """, curve AS (SELECT CAST(label + 1 AS INTEGER) AS k, round(sum(list_dot_product(v, v)) / (label + 1), 6) AS inertia FROM points GROUP BY label),
        e AS (SELECT min(k) AS k0, arg_min(inertia, k) AS y0, max(k) AS k1, arg_max(inertia, k) AS y1 FROM curve),
        d AS (SELECT k, round(abs((k1 - k0) * (y0 - inertia) - (y1 - y0) * (k0 - k)) / sqrt((k1 - k0) * (k1 - k0) + (y1 - y0) * (y1 - y0)), 12) AS dist FROM curve, e)
        SELECT k FROM d ORDER BY dist DESC, k LIMIT 1""",
    )
)
def elbow(spark, sf_dir):
    """The knee of a given curve."""
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    k = (F.col("label") + 1).cast("int")
    curve = points(spark, sf_dir).groupBy(k.alias("k")).agg(F.sum(norm).alias("_s"))
    curve = curve.select("k", F.round(F.col("_s") / F.col("k"), 6).alias("inertia"))
    return cluster.elbow(curve)


@query()
def elbow_fit(spark, sf_dir):
    """Inertia for one to ten centres, and the recommended number."""
    curve = cluster.inertia_curve(points(spark, sf_dir), "v", range(1, 11))
    return curve.withColumn("best", cluster.elbow(curve).scalar()).withColumn(
        "inertia", F.round("inertia", 4)
    )


@query()
def pca_k(spark, sf_dir):
    """Three components of all 64 dimensions, with the label and the explained shares."""
    v = vectors(spark, sf_dir).withColumn("features", array_to_vector("v"))
    scores, explained = pca_scores(v, "features", 3)
    shares = [F.round(F.lit(e), 6).alias(f"explained{i + 1}") for i, e in enumerate(explained)]
    s = [F.round(F.col("scores")[i], 5).alias(f"pc{i + 1}") for i in range(3)]
    return scores.select("vec_id", "label", *s, *shares)


GIVEN = VECTORS + """, given AS (SELECT vec_id, y, CAST(CASE WHEN x0 > 0.02 THEN 1 ELSE 0 END AS INTEGER) AS cluster FROM points)"""
MATCH = GIVEN + """, cnt AS (SELECT y, cluster, count(*) AS n FROM given GROUP BY ALL),
  best AS (SELECT y, cluster AS matched, n, sum(n) OVER (PARTITION BY y) AS total,
    row_number() OVER (PARTITION BY y ORDER BY n DESC, CASE WHEN cluster = y THEN 0 ELSE 1 END, cluster) AS rk FROM cnt)"""


def given(spark, sf_dir):
    """Vectors with a fixed assignment to two clusters."""
    p = points(spark, sf_dir)
    return p.select("vec_id", "y", (F.col("x0") > 0.02).cast("int").alias("cluster"))


@query(
    with_sql(
        GIVEN,
        """, r AS (SELECT DISTINCT y FROM given), c AS (SELECT DISTINCT cluster FROM given)
        SELECT r.y, c.cluster, count(g.vec_id) AS n FROM r CROSS JOIN c LEFT JOIN given g ON g.y = r.y AND g.cluster = c.cluster GROUP BY r.y, c.cluster""",
    )
)
def contingency(spark, sf_dir):
    return profile.contingency(given(spark, sf_dir), "y", "cluster").drop("pct")


@query(
    with_sql(
        DBSCAN,
        """, r AS (SELECT DISTINCT y FROM found), c AS (SELECT DISTINCT cluster FROM found),
        t AS (SELECT r.y, c.cluster, count(f.vec_id) AS n FROM r CROSS JOIN c LEFT JOIN found f ON f.y = r.y AND f.cluster = c.cluster GROUP BY r.y, c.cluster)
        SELECT y, cluster, n, round(100.0 * n / sum(n) OVER (PARTITION BY y), 6) AS pct FROM t""",
    )
)
def contingency_pct(spark, sf_dir):
    """Labels against density clusters, noise included, with row percentages."""
    out = profile.contingency(found(spark, sf_dir), "y", "cluster")
    return out.withColumn("pct", F.round("pct", 6))


@query(
    with_sql(
        MATCH,
        """SELECT round(avg(100.0 * n / total), 6) AS agreement, CASE WHEN avg(100.0 * n / total) >= 85 THEN 'EXCELENTE'
        WHEN avg(100.0 * n / total) >= 75 THEN 'BUENO' WHEN avg(100.0 * n / total) >= 60 THEN 'ALERTA' ELSE 'CRITICO' END AS verdict
        FROM best WHERE rk = 1""",
    )
)
def cluster_agreement(spark, sf_dir):
    out = audit.cluster_agreement(given(spark, sf_dir), "y", "cluster")
    return out.withColumn("agreement", F.round("agreement", 6))


@query(with_sql(MATCH, "SELECT y, matched, round(100.0 * n / total, 6) AS share FROM best WHERE rk = 1"))
def matching_clusters(spark, sf_dir):
    out = audit.matching_clusters(given(spark, sf_dir), "y", "cluster")
    return out.withColumn("share", F.round("share", 6))


@query(
    with_sql(
        VECTORS,
        """, a AS (SELECT label, 100.0 * avg(CASE WHEN x0 > 0 THEN 1 ELSE 0 END) AS pct FROM points GROUP BY label)
        SELECT label, round(pct, 6) AS pct, CASE WHEN pct >= 85 THEN 'EXCELENTE' WHEN pct >= 75 THEN 'BUENO' WHEN pct >= 60 THEN 'ALERTA' ELSE 'CRITICO' END AS verdict FROM a""",
    )
)
def verdict(spark, sf_dir):
    p = points(spark, sf_dir)
    share = p.groupBy("label").agg((100.0 * F.avg((F.col("x0") > 0).cast("int"))).alias("pct"))
    return share.select("label", F.round("pct", 6).alias("pct"), audit.verdict(F.col("pct")).alias("verdict"))


@query(
    with_sql(
        MATCH,
        "SELECT vec_id, y, cluster FROM given JOIN (SELECT y, matched FROM best WHERE rk = 1) USING (y) WHERE cluster <> matched",
    )
)
def mislabelled(spark, sf_dir):
    return audit.mislabelled(given(spark, sf_dir), "y", "cluster")


@query(
    with_sql(
        MATCH,
        """SELECT vec_id, y, cluster, CAST(CASE WHEN (cluster = m.matched) = (y = 1) THEN 1 ELSE 0 END AS INTEGER) AS hit
        FROM given, (SELECT matched FROM best WHERE rk = 1 AND y = 1) m""",
    )
)
def hit_flags(spark, sf_dir):
    return audit.hit_flags(given(spark, sf_dir), "y", "cluster")


VOTES = VECTORS + """, votes AS (
  SELECT vec_id, y, 'a' AS algorithm, CAST(CASE WHEN x0 > 0 THEN 1 ELSE 0 END AS INTEGER) AS cluster FROM points
  UNION ALL SELECT vec_id, y, 'b', CAST(floor((x1 + 1) * 20) AS INTEGER) FROM points
  UNION ALL SELECT vec_id, y, 'c', 0 FROM points
  UNION ALL SELECT vec_id, y, 'd', CAST(label % 3 AS INTEGER) FROM points),
 usable AS (SELECT algorithm FROM votes GROUP BY 1 HAVING count(DISTINCT cluster) >= 2),
 v AS (SELECT algorithm, cluster, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives,
   CAST(CASE WHEN sum(y) * 2 > count(*) THEN 1 ELSE 0 END AS INTEGER) AS verdict FROM votes GROUP BY ALL),
 revised AS (SELECT vec_id, y, CAST(CASE WHEN avg(verdict) >= 0.5 THEN 1 ELSE 0 END AS INTEGER) AS revised
   FROM votes JOIN usable USING (algorithm) JOIN v USING (algorithm, cluster) GROUP BY vec_id, y)"""


def assignments(spark, sf_dir):
    """Four fixed assignments, one of which puts all rows into one cluster."""
    p = points(spark, sf_dir)
    rules = {
        "a": (F.col("x0") > 0).cast("int"),
        "b": F.floor((F.col("x1") + 1) * 20).cast("int"),
        "c": F.lit(0),
        "d": (F.col("label") % 3).cast("int"),
    }
    entries = [F.struct(F.lit(n).alias("algorithm"), c.alias("cluster")) for n, c in rules.items()]
    return p.select("vec_id", "y", F.inline(F.array(*entries)))


def revised(spark, sf_dir):
    labelled = points(spark, sf_dir).select("vec_id", "y")
    votes = assignments(spark, sf_dir).drop("y")
    return audit.consensus_relabel(labelled, votes, "vec_id", "y")


@query(with_sql(VOTES, "SELECT vec_id, y, revised FROM revised"))
def consensus_relabel(spark, sf_dir):
    return revised(spark, sf_dir)


@query(with_sql(VOTES, "SELECT algorithm, cluster, n, positives, verdict FROM v"))
def cluster_verdicts(spark, sf_dir):
    return audit.cluster_verdicts(assignments(spark, sf_dir), "y", ["algorithm", "cluster"])


@query(
    with_sql(
        VOTES,
        """SELECT count(CASE WHEN y <> revised THEN 1 END) AS changes, round(100.0 * count(CASE WHEN y <> revised THEN 1 END) / count(*), 6) AS pct,
        count(CASE WHEN y = 1 THEN 1 END) AS ones_before, count(CASE WHEN revised = 1 THEN 1 END) AS ones_after FROM revised""",
    )
)
def label_changes(spark, sf_dir):
    out = audit.label_changes(revised(spark, sf_dir), "y", "revised")
    return out.withColumn("pct", F.round("pct", 6))


@query()
def ward_micro(spark, sf_dir):
    out = cluster.ward(points(spark, sf_dir), "vec_id", "v", 3)
    return profile.distinct_counts(out, "cluster")


@query()
def all_clusterings(spark, sf_dir):
    """Rows per algorithm and cluster over the first three dimensions."""
    out = cluster.all_clusterings(points(spark, sf_dir), "vec_id", "v", 3)
    return out.groupBy("algorithm", "cluster").agg(F.count(F.lit(1)).alias("n"))


# --- well-parted vectors: fits whose best answer is known -----------------------------------------

#: Distance between the groups, far beyond any within one.
APART = 40.0
PARTED = VECTORS + f""", parted AS (
  SELECT vec_id, label % 3 AS g, list_transform(v, lambda x, i: CASE WHEN i = 1 THEN x + {APART} * (label % 3) ELSE x END) AS v FROM vectors),
  sized AS (SELECT g, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, min(vec_id)) - 1 AS cluster FROM parted GROUP BY g)"""


def parted(spark, sf_dir):
    """The vectors, moved apart into three groups by label."""
    move = F.transform("v", lambda x, i: F.when(i == 0, x + APART * (F.col("label") % 3)).otherwise(x))
    return vectors(spark, sf_dir).select("vec_id", "label", move.alias("v"))


@query(with_sql(PARTED, "SELECT vec_id, CAST(cluster AS INTEGER) AS cluster FROM parted JOIN sized USING (g)"))
def ward_parted(spark, sf_dir):
    """The whole Ward hierarchy, cut at three clusters."""
    return cluster.ward(parted(spark, sf_dir), "vec_id", "v", 3).select("vec_id", "cluster")


@query(
    with_sql(
        PARTED,
        """, entry AS (SELECT g, i, v[i] AS x FROM parted, range(1, 65) AS t(i)),
        spread AS (SELECT sum(n) AS inertia FROM (SELECT count(*) * var_pop(x) AS n FROM entry GROUP BY g, i))
        SELECT CAST(cluster AS INTEGER) AS place, n, round(inertia, 4) AS inertia FROM sized, spread""",
    )
)
def kmeans_parted(spark, sf_dir):
    """The best of several k-means runs: the sizes of its clusters, the largest first, and its inertia."""
    df = parted(spark, sf_dir)
    centres, cost = cluster.kmeans(df, "v", 3)
    sizes = cluster.assign(df, "v", centres).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    place = (F.row_number().over(W.orderBy(F.col("n").desc(), "least")) - 1).alias("place")  # three rows
    return sizes.select(place, "n", F.round(F.lit(cost), 4).alias("inertia"))


@query(
    with_sql(
        PARTED,
        """, entry AS (SELECT g, i, v[i] AS x FROM parted, range(1, 65) AS t(i)),
        cut AS (SELECT * FROM (VALUES (1, 0, 0, 0), (2, 0, 0, 1), (2, 0, 1, 1), (3, 0, 1, 2)) AS c(k, c0, c1, c2)),
        part AS (SELECT k, c0, c1, c2, i, count(*) * var_pop(x) AS n FROM entry, cut
          GROUP BY k, c0, c1, c2, i, CASE g WHEN 0 THEN c0 WHEN 1 THEN c1 ELSE c2 END),
        cost AS (SELECT k, sum(n) AS n FROM part GROUP BY k, c0, c1, c2),
        curve AS (SELECT k, min(n) AS inertia FROM cost GROUP BY k),
        e AS (SELECT min(k) AS k0, arg_min(inertia, k) AS y0, max(k) AS k1, arg_max(inertia, k) AS y1 FROM curve),
        d AS (SELECT k, abs((k1 - k0) * (y0 - inertia) - (y1 - y0) * (k0 - k)) AS dist FROM curve, e),
        b AS (SELECT k AS best FROM d ORDER BY dist DESC, k LIMIT 1)
        SELECT k, round(inertia, 4) AS inertia, best FROM curve, b""",
    )
)
def elbow_parted(spark, sf_dir):
    """Inertia of the best runs with one to three centres on parted groups, and the recommended number."""
    curve = cluster.inertia_curve(parted(spark, sf_dir), "v", [1, 2, 3])
    best = cluster.elbow(curve).scalar()
    return curve.select("k", F.round("inertia", 4).alias("inertia"), best.alias("best"))


@query(
    with_sql(
        PARTED,
        "SELECT CAST(g = 1 AS INTEGER) AS y, count(*) AS n, count(*) AS hits, CAST(1.0 AS DOUBLE) AS sure FROM parted GROUP BY y",
    )
)
def kernel_parted(spark, sf_dir):
    """The RBF machine told the group in the middle from those beside it: rows, right decisions, share of right sides of 1/2."""
    y = (F.col("label") % 3 == 1).cast("int").alias("y")
    rows = parted(spark, sf_dir).select("vec_id", y, array_to_vector("v").alias("features"))
    scored = with_probability(kernel.KernelMachine("y", C=10.0).fit(rows).transform(rows))
    right = F.col("prediction").cast("int") == F.col("y")
    sure = F.avg(((F.col("p1") > 0.5).cast("int") == F.col("y")).cast("double"))
    return scored.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.count_if(right).alias("hits"), sure.alias("sure"))
