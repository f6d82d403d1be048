"""Centroid clustering with bounds loosened by total displacement.

Every vector keeps, between rounds, an upper bound of the distance to its own
centroid and one lower bound per group of centroids of the distance to all
others, each with the round it was measured in.  All earlier centroids are kept
too.  A bound measured in round T holds in round t once it is loosened by how
far the centroid is from where it was in T: the norm of the whole displacement,
which is never more than the sum of the moves between and often far less, as
centroids move to and fro.  Only where the loosened bounds do not settle a
vector is it measured again, and only against the groups whose bound fails
(and its own), in exact whole numbers.

One pass over the vectors a round writes them with their bounds to the shared
folder, the sums per cluster are partial aggregates over that, and the round
before is deleted.  What reaches the driver is one row per cluster.

Defined results: rows whose vector is NULL, of another width, or holds a NULL or
non-finite component take no part; a NULL id takes part, but comes last among
the starting vectors; repeated rows are vectors of their own; fewer vectors than
clusters give as many clusters as vectors; no vectors give no rows.  Columns
other than id and vector are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.storage import release, stored
from .vectors import all_finite, matrix, squared_distances, whole

STATE = "id long, v array<int>, cluster int, upper double, upper_at int, lower array<double>, lower_at array<int>, measured long"
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, measured long"
#: Bounds are compared with this relative slack, so that rounding never settles what is equal.
SLACK = 1e-9


@dataclass(frozen=True)
class Settings:
    """``start``: what precedes the id in the hash that draws the first centroids; ``group``: centroids per lower bound."""

    clusters: int = 40
    rounds: int = 5
    width: int = 64
    start: str = "2:"
    group: int = 10


@dataclass(frozen=True)
class History:
    """All centroids so far, one array per round, and the groups they are bounded in."""

    centroids: tuple[np.ndarray, ...]
    groups: tuple[np.ndarray, ...]

    def moved(self) -> np.ndarray:
        """How far each centroid is now from where it was in each round."""
        now = self.centroids[-1]
        return np.array([np.sqrt(((now - then) ** 2).sum(axis=1)) for then in self.centroids])

    def group_moved(self, moved: np.ndarray) -> np.ndarray:
        return np.array([[row[members].max() for members in self.groups] for row in moved])


def grouped(centroids: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Near centroids together: each next group is the unused centroid farthest from the mean with its nearest ones."""
    left = list(range(len(centroids)))
    away = ((centroids - centroids.mean(axis=0)) ** 2).sum(axis=1)
    out = []
    while left:
        head = max(left, key=lambda j: (away[j], -j))
        near = sorted(left, key=lambda j: (((centroids[j] - centroids[head]) ** 2).sum(), j))[:size]
        out.append(np.array(sorted(near)))
        left = [j for j in left if j not in set(near)]
    return tuple(out)


class Assignment:
    """Assigns blocks of vectors to the nearest of the newest centroids; ties go to the smaller number."""

    def __init__(self, history: History):
        self.groups = history.groups
        self.now = len(history.centroids) - 1
        self.centroids = history.centroids[-1]
        self.moved = history.moved()
        self.group_moved = history.group_moved(self.moved)
        self.group_of = np.zeros(len(self.centroids), dtype=np.int64)
        for g, members in enumerate(self.groups):
            self.group_of[members] = g

    def first(self, x: np.ndarray):
        """State of vectors never measured before."""
        n = len(x)
        state = [np.full(n, -1), np.full(n, np.inf), np.zeros(n, int), np.zeros((n, len(self.groups))), np.zeros((n, len(self.groups)), int), np.zeros(n, int)]
        self.measure(x, np.arange(n), np.ones((n, len(self.groups)), dtype=bool), np.full(n, np.iinfo(np.int64).max), state)
        return state

    def again(self, x: np.ndarray, state):
        """State of vectors with bounds from earlier rounds."""
        cluster, upper, upper_at, lower, lower_at, measured = state
        loose = lower - self.group_moved[lower_at, np.arange(len(self.groups))]
        above = upper + self.moved[upper_at, cluster]
        open_rows = np.flatnonzero(above * (1 + SLACK) >= loose.min(axis=1) * (1 - SLACK))
        if not len(open_rows):
            return state
        own = self.own_distances(x[open_rows], cluster[open_rows])
        upper[open_rows], upper_at[open_rows] = np.sqrt(own.astype(np.float64)), self.now
        measured[open_rows] += 1
        fails = upper[open_rows, None] * (1 + SLACK) >= loose[open_rows] * (1 - SLACK)
        failing = fails.any(axis=1)
        open_rows, fails, own = open_rows[failing], fails[failing], own[failing]
        fails[np.arange(len(open_rows)), self.group_of[cluster[open_rows]]] = True
        self.measure(x, open_rows, fails, own, state)
        return state

    def own_distances(self, x: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        apart = (x - self.centroids[cluster]).astype(np.int64)
        return np.einsum("ij,ij->i", apart, apart)

    def measure(self, x: np.ndarray, rows: np.ndarray, wanted: np.ndarray, known: np.ndarray, state) -> None:
        """Exact distances of the rows to the wanted groups; ``known`` is the squared distance to the present centroid."""
        cluster, upper, upper_at, lower, lower_at, measured = state
        if not len(rows):
            return
        best, nearest = known.copy(), cluster[rows].copy()
        found = []
        for g, members in enumerate(self.groups):
            at = np.flatnonzero(wanted[:, g])
            apart = squared_distances(x[rows[at]], self.centroids[members])
            found.append((at, apart))
            pick = apart.argmin(axis=1)
            value, number = apart[np.arange(len(at)), pick], members[pick]
            better = (value < best[at]) | ((value == best[at]) & (number < nearest[at]))
            best[at[better]], nearest[at[better]] = value[better], number[better]
            measured[rows[at]] += len(members)
        for g, (at, apart) in enumerate(found):
            others = np.where(self.groups[g][None, :] == nearest[at][:, None], np.inf, np.sqrt(apart.astype(np.float64)))
            lower[rows[at], g], lower_at[rows[at], g] = others.min(axis=1), self.now
        cluster[rows], upper[rows], upper_at[rows] = nearest, np.sqrt(best.astype(np.float64)), self.now


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), type=kind))


def _round(history: History, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assignment = Assignment(history)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("v"), width)
            if len(history.centroids) == 1:
                state = assignment.first(x)
            else:
                groups = len(history.groups)
                plain = [batch.column(c).to_numpy(zero_copy_only=False).copy() for c in ("cluster", "upper", "upper_at", "measured")]
                bounds, times = matrix(batch.column("lower"), groups), matrix(batch.column("lower_at"), groups).astype(int)
                state = assignment.again(x, [*plain[:3], bounds, times, plain[3]])
            cluster, upper, upper_at, lower, lower_at, measured = state
            columns = [batch.column("id"), batch.column("v"), pa.array(cluster, pa.int32()), pa.array(upper, pa.float64()), pa.array(upper_at, pa.int32())]
            columns += [_lists(lower, pa.float64()), _lists(lower_at, pa.int32()), pa.array(measured, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "v", "cluster", "upper", "upper_at", "lower", "lower_at", "measured"])

    return run


def _distances(centroids: np.ndarray, width: int):
    """Exact squared distance of each vector to its centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = (matrix(batch.column("v"), width) - centroids[batch.column("cluster").to_numpy(zero_copy_only=False)]).astype(np.int64)
            found = np.einsum("ij,ij->i", apart, apart)
            columns = [batch.column("id"), batch.column("cluster"), pa.array(found, pa.int64()), batch.column("measured")]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance", "measured"])

    return run


def moved_centroids(state: DataFrame, before: np.ndarray) -> np.ndarray:
    """Component-wise floor of the mean of each cluster; an empty one stays."""
    sums = [F.sum(F.col("v")[i].cast("long")).alias(f"s{i}") for i in range(before.shape[1])]
    after = before.copy()
    for row in state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        after[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(before.shape[1])]
    return after


def clustered(rows: DataFrame, settings: Settings | None = None, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per vector: cluster, squared distance, the sums of these per cluster and in all, and the centroid's digest.

    ``measured`` counts the centroids the vector was measured against over all rounds.
    """
    settings = settings or Settings()
    spark = rows.sparkSession
    given = F.col(f"`{vector}`")
    usable = rows.where(all_finite(given) & (F.size(given) == settings.width))
    vectors = usable.select(F.col(f"`{id}`").cast("long").alias("id"), whole(given).alias("v"))
    draw = F.sha2(F.concat(F.lit(settings.start), F.col("id").cast("string")), 256)
    start = vectors.orderBy(draw.asc_nulls_last(), "v").limit(settings.clusters).collect()
    if not start:
        return spark.createDataFrame([], RESULT)
    first = np.array([row.v for row in start], dtype=np.float64)
    history = History((first,), grouped(first, settings.group))
    paths: list[str] = []
    state = stored(vectors.mapInArrow(_round(history, settings.width), STATE), paths)
    for _ in range(settings.rounds):
        history = History((*history.centroids, moved_centroids(state, history.centroids[-1])), history.groups)
        state = stored(state.mapInArrow(_round(history, settings.width), STATE), paths)
        before, paths[:] = paths[:-1], paths[-1:]
        release(spark, before)
    last = history.centroids[-1]
    found = state.mapInArrow(_distances(last, settings.width), "vec_id long, cluster int, distance long, measured long")
    found = stored(found, kept := [])
    release(spark, paths)
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    own, total = {r.cluster: int(r.s) for r in sums}, sum(int(r.s) for r in sums)
    about = [
        (j, own.get(j, 0), total, hashlib.sha256(",".join(str(int(c)) for c in last[j]).encode()).hexdigest())
        for j in range(len(last))
    ]
    facts = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select(*(c.split()[0] for c in RESULT.split(", ")))


def report_sql(settings: Settings | None = None) -> str:
    """The same by plain assignment of every vector to every centroid, for DuckDB."""
    settings = settings or Settings()
    k, dim = settings.clusters, settings.width
    parts = [
        f"""v as materialized (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
 where len(embedding) = {dim} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {dim})""",
        f"""c0 as materialized (select cast(row_number() over (order by h) - 1 as int) as c, v from (
 select v, sha256('{settings.start}' || vec_id::varchar) as h from v order by h limit {k}) s)""",
    ]
    for t in range(settings.rounds + 1):
        parts.append(
            f"""a{t} as materialized (select vec_id, v, m.c as cluster, m.d as distance from (
 select vec_id, any_value(x.v) as v, min({{'d': cast(list_dot_product(x.v, x.v) - 2 * list_dot_product(x.v, c.v)
 + list_dot_product(c.v, c.v) as bigint), 'c': c.c}}) as m from v x cross join c{t} c group by vec_id) y)"""
        )
        if t < settings.rounds:
            parts.append(
                f"""c{t + 1} as materialized (select c.c, coalesce(n.v, c.v) as v from c{t} c left join (
 select cluster, list(x order by i) as v from (select cluster, i, floor(sum(v[i]) / count(*)) as x
 from a{t}, range(1, {dim + 1}) r(i) group by cluster, i) s group by cluster) n on n.cluster = c.c)"""
            )
    t = settings.rounds
    return f"""with {", ".join(parts)}
select a.vec_id, a.cluster, a.distance, cast(sum(a.distance) over (partition by a.cluster) as bigint) as cluster_inertia,
 cast(sum(a.distance) over () as bigint) as inertia,
 sha256(array_to_string(list_transform(c.v, lambda x: x::bigint::varchar), ',')) as centroid_sha256
from a{t} a join c{t} c on c.c = a.cluster"""
