"""Centroid clustering with lower bounds loosened by geometry.

Vectors are integers. Each keeps its cluster and a lower bound of its distance
to every other centroid. When centroids move, the bound must be loosened by as
much as some other centroid may have come nearer. That is at most how far one
moved, but less for most: all vectors of a cluster lie in a sphere around its
old centroid c, with the largest distance r of them as radius. For a centroid
that moves from a to b, with the middle m of the two, a vector x comes nearer by
(2 (b - a)(x - m)) / (|x - a| + |x - b|), and |x - a| + |x - b| >= 2 |x - m|; so
by at most |b - a| times the cosine of the angle at m between x and b. In the
plane of a, b and c the sphere takes the angle arcsin(r / |c - m|) to both sides
of c, so the smallest angle is that of c less it; a sphere on the far side gives
no loosening at all, one that holds m the whole drift. A cluster's bounds are
loosened by the largest such value over the other centroids.

A vector that is nearer to its own centroid than the bound stays. The others
are ambiguous and compared with every centroid, in integers; equal distances go
to the smaller number.

Scale: each round reads the vectors once and writes them with their cluster and
bound, in the shared folder, so a lost executor costs a part of one round; the
table before goes. Nothing of a vector is shuffled: sums, counts and radii of a
cluster are partial aggregates, k rows of some columns each, and so the driver
holds k centroids only.

Defined cases: vectors that are null, have not ``width`` components, or a null
or non-finite one take no part; rows that repeat vec_id, or all of a row, are
vectors each, and one with a null id is a vector with that id; fewer vectors
than k start as many centroids (rows of one id in the order of their
components, null ids last); an empty cluster keeps its centroid; an empty table
gives no rows; other columns are not used. Distances are exact: in 64 bits where
components have at most 27, in unbounded integers beyond, and one that is no
long is null, as is an inertia with it; a component that is no long counts as
the nearest one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import MAX_LONG, materialise, release, table

K, ROUNDS, SCALE, WIDTH = 40, 5, 256, 64
#: Components below this in size have distances of 64 bits.
SMALL = 1 << 27
#: Vectors that are compared with all centroids together.
BATCH = 4096
#: Bounds give way by this share, for what doubles lose.
SLACK = 1e-9


def scaled(vectors: DataFrame, scale: int = SCALE, width: int = WIDTH) -> DataFrame:
    """vec_id and v, the integer components, of every vector that takes part."""
    x = F.col("embedding")
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != float("inf"))) & (F.size(x) == width)
    return vectors.filter(F.coalesce(good, F.lit(False))).select("vec_id", F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))


def exact(rows: np.ndarray) -> np.ndarray:
    """Rows as numbers whose squares can be summed: 64 bits, or unbounded where they are too large."""
    return rows if not rows.size or (rows.max() < SMALL and rows.min() > -SMALL) else rows.astype(object)


def squared(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distance of every row to every centroid."""
    v, c = exact(v), exact(centroids)
    if v.dtype != object and c.dtype != object and max(np.abs(v).max(initial=0), np.abs(c).max(initial=0)) < 1 << 20:
        x, y = v.astype(np.float64), c.astype(np.float64)  # sums below 2^53 are exact in doubles
        return ((x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)[None, :]).astype(np.int64)
    return np.stack([((v - row) ** 2).sum(1) for row in c], axis=1)


def loosening(before: np.ndarray, after: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster i and centroid j, how much nearer j may have come to a vector in i's sphere."""
    k = len(before)
    drift = np.sqrt(((after - before) ** 2).sum(1))
    out = np.zeros((k, k))
    for j in np.flatnonzero(drift > 0):
        to = before - (before[j] + after[j]) / 2
        away = np.sqrt((to * to).sum(1))
        with np.errstate(divide="ignore", invalid="ignore"):
            angle = np.arccos(np.clip(to @ (after[j] - before[j]) / (away * drift[j]), -1, 1))
            least = angle - np.arcsin(np.clip(radius / away, 0, 1))
        share = np.where(away > radius, np.maximum(0, np.cos(np.maximum(0, least))), 1.0)
        out[:, j] = drift[j] * np.minimum(1, share + SLACK)
    return out


def loosened(before: np.ndarray, after: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster, how much the bound to its nearest other centroid gives way."""
    each = loosening(before, after, radius)
    np.fill_diagonal(each, 0)
    return each.max(1, initial=0)


def assign(v: np.ndarray, cluster: np.ndarray, bound: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """cluster, squared distance and lower bound to the others after comparing what is ambiguous; and how many that were.

    Without a cluster (-1) a vector is ambiguous.
    """
    own = ((exact(v) - exact(centroids)[np.maximum(cluster, 0)]) ** 2).sum(1)
    near = np.sqrt(own.astype(np.float64))
    unsure = np.flatnonzero((cluster < 0) | (near * (1 + SLACK) + SLACK >= bound))
    cluster, bound, distance = cluster.copy(), bound.copy(), own.copy()
    for at in range(0, len(unsure), BATCH):
        rows = unsure[at : at + BATCH]
        every = squared(v[rows], centroids)
        best = every.argmin(1)
        cluster[rows] = best
        least = every[np.arange(len(rows)), best]
        distance[rows] = least
        others = every.astype(np.float64)
        others[np.arange(len(rows)), best] = np.inf
        bound[rows] = np.sqrt(others.min(1)) * (1 - SLACK)
    return cluster, distance, bound, len(unsure)


def components(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width)


def one_round(state: DataFrame, centroids: np.ndarray, loose: np.ndarray, width: int) -> DataFrame:
    """vec_id, v, cluster, distance and bound of every vector, for the centroids, as a table."""
    shared = state.sparkSession.sparkContext.broadcast((centroids, loose))

    def step(batches):
        centroids, loose = shared.value
        for batch in batches:
            v = components(batch.column("v"), width)
            before = batch.column("cluster").to_numpy()
            bound = batch.column("bound").to_numpy() - loose[np.maximum(before, 0)]
            cluster, distance, bound, _ = assign(v, before, bound, centroids)
            whole = pa.array([int(d) if d <= MAX_LONG else None for d in distance] if distance.dtype == object else distance, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(cluster.astype(np.int32)), whole, pa.array(bound)], names=["vec_id", "v", "cluster", "distance", "bound"])

    kept = state.select("vec_id", "v", "cluster", "bound")
    schema = kept.select("vec_id", "v", "cluster", F.lit(None).cast("long").alias("distance"), "bound").schema
    return materialise(kept.mapInArrow(step, schema), "clusters")


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors of smallest sha256 of salt and id."""
    order = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.select("v", order.alias("o")).orderBy(F.col("o").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def moved(state: DataFrame, centroids: np.ndarray, large: bool) -> tuple[np.ndarray, np.ndarray]:
    """Centroids at the floors of their vectors' means, and each cluster's radius before."""
    width = centroids.shape[1]
    sums = [F.sum(F.get("v", i).cast("decimal(19,0)" if large else "long")).alias(f"s{i}") for i in range(width)]
    rows = state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("far"), F.count("distance").alias("known"), *sums).collect()  # k rows
    after, radius = centroids.copy(), np.zeros(len(centroids))
    for r in rows:
        after[r.cluster] = [int(r[f"s{i}"]) // r.n for i in range(width)]
        radius[r.cluster] = np.sqrt(float(r.far)) * (1 + SLACK) + SLACK if r.known == r.n else np.inf
    return after, radius


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, salt: str = "2:", scale: int = SCALE, width: int = WIDTH) -> tuple[DataFrame, np.ndarray]:
    """vec_id, v, cluster, distance and bound of every vector after the rounds, and the centroids."""
    kept = scaled(vectors, scale, width)
    state = materialise(kept.withColumns({"cluster": F.lit(-1), "bound": F.lit(0.0)}), "clusters")
    centroids = first_centroids(state, k, salt)
    if not len(centroids):
        return state.select("vec_id", "v", "cluster", F.lit(None).cast("long").alias("distance"), "bound"), np.zeros((0, width), np.int64)
    large = not state.filter(F.exists("v", lambda x: (x >= SMALL) | (x <= -SMALL))).isEmpty()
    loose = np.zeros(len(centroids))
    for _ in range(rounds):
        after = one_round(state, centroids, loose, width)
        release(state)
        state = after
        new, radius = moved(state, centroids, large)
        loose = loosened(centroids.astype(np.float64), new.astype(np.float64), radius)
        centroids = new
    last = one_round(state, centroids, loose, width)
    release(state)
    return last, centroids


def op13_centroid_clustering(spark, sf_dir: str) -> DataFrame:
    state, centroids = cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    sums = state.groupBy("cluster").agg(F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(19,0)"))).alias("inertia")).collect()  # k rows
    as_long = lambda x: int(x) if x is not None and x <= MAX_LONG else None
    inertia = {r.cluster: r.inertia for r in sums}
    total = as_long(None if None in inertia.values() else sum(inertia.values()))
    rows = [(i, as_long(inertia.get(i)), total, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)]
    named = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    steps = [
        f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: CAST(floor(CAST(c AS DOUBLE) * {SCALE}) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)) NULLS LAST, v) - 1 AS c, v AS w FROM v QUALIFY c < {K})"""
    ]
    for i in range(ROUNDS + 1):
        distance = "CAST(list_inner_product(CAST(v AS DOUBLE[]), CAST(v AS DOUBLE[])) - 2 * list_inner_product(CAST(v AS DOUBLE[]), CAST(w AS DOUBLE[])) + list_inner_product(CAST(w AS DOUBLE[]), CAST(w AS DOUBLE[])) AS BIGINT)"
        steps.append(f"a{i} AS MATERIALIZED (SELECT r, min((d, c)) AS best FROM (SELECT r, c, {distance} AS d FROM v, c{i}) GROUP BY r)")
        if i < ROUNDS:
            steps.append(
                f"""m{i} AS (SELECT c, list(CAST(floor(s / n) AS BIGINT) ORDER BY place) AS w FROM (SELECT c, place, sum(x) AS s, count(*) AS n FROM (SELECT best[2] AS c, unnest(v) AS x, unnest(range({WIDTH})) AS place FROM a{i} JOIN v USING (r)) GROUP BY c, place) GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m{i}.w, c{i}.w) AS w FROM c{i} LEFT JOIN m{i} USING (c))"""
            )
    last = f"a{ROUNDS}"
    return ",\n".join(steps) + (
        f"""\nSELECT vec_id, CAST(best[2] AS INTEGER) AS cluster, best[1] AS distance, CAST(sum(best[1]) OVER (PARTITION BY best[2]) AS BIGINT) AS cluster_inertia, CAST(sum(best[1]) OVER () AS BIGINT) AS inertia,
sha256(array_to_string(w, ',')) AS centroid_sha256 FROM {last} JOIN v USING (r) JOIN c{ROUNDS} ON c = best[2]"""
    )


#: Every distance of every round.
OP13_SQL = _sql()
