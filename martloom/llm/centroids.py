"""Exact k-means over integer vectors, with Ns-bounds in place of most distance computations.

A row remembers, for every centroid, the exact distance at its last evaluation and the round of it. All
centroids of earlier rounds are kept (rounds x clusters x components numbers). In a later round the
remembered distance is loosened by the norm of the *total* displacement of that centroid since the
round of the evaluation, not by the sum of its steps: the distance to the row's own centroid gives an upper
bound, those to the others lower bounds. Only where a lower bound does not clear the upper one is the
distance computed again, in integers, so assignments and ties are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.tables import forget, stored, stored_at
from martloom.session import scratch_dir

DIMS = 64
CLUSTERS = 8
ROUNDS = 10
#: Components are ``floor(SCALE * x)``.
SCALE = 1024
#: Beyond this a squared distance of 64 components might leave 64 bits.
LARGEST = 1 << 27
#: Relative room for rounding in bounds; only how many distances are computed depends on it.
ROOM = 1e-9

STATE = "vec_id long, x array<int>, cluster int, was int, d2 array<long>, seen array<int>"


def kept_vectors(embeddings: DataFrame, dims: int = DIMS) -> DataFrame:
    """``vec_id, x``: rows whose ``embedding`` has ``dims`` components, none null or non-finite, as integers.

    A component beyond ``LARGEST`` is an error: exact squared distances would not fit their type.
    """
    usable = F.forall(
        F.col("embedding"),
        lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")),
    )
    scaled = lambda v: SCALE * v.cast("double")
    whole = F.transform(
        F.col("embedding"),
        lambda v: F.when(F.abs(scaled(v)) < LARGEST, F.floor(scaled(v)).cast("int")).otherwise(
            F.raise_error(F.lit(f"a component of an embedding is not below {LARGEST / SCALE:.0f}")).cast("int")
        ),
    )
    rows = embeddings.filter((F.size("embedding") == dims) & usable)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("x"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = 3) -> list[list[int]]:
    """The vectors with the least SHA-256 of ``seed:vec_id``; equal ids by components, null ids last."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.select(drawn.alias("h"), "x").orderBy(F.col("h").asc_nulls_last(), "x").limit(clusters)
    return [list(r["x"]) for r in rows.collect()]


def _numbers(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _nested(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()).cast(kind))


def squared(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    apart = x - centroid
    return np.einsum("ij,ij->i", apart, apart)


def advanced(
    x: np.ndarray, cluster: np.ndarray, d2: np.ndarray, seen: np.ndarray, history: np.ndarray
) -> tuple[np.ndarray, int]:
    """The cluster of each row under the last centroids of ``history``, and how many distances it took.

    ``d2`` and ``seen`` (remembered squared distances and their rounds) are brought up to date in place.
    """
    now, clusters = len(history) - 1, history.shape[1]
    moved = np.sqrt(((history[now] - history) ** 2).sum(2).astype(float))  # round, cluster
    every = np.arange(clusters)
    rows = np.arange(len(x))

    def doubtful(some: np.ndarray) -> np.ndarray:
        """Of the rows named: which centroids their bounds do not rule out, the own one aside."""
        own = cluster[some]
        reach = np.sqrt(d2[some].astype(float))
        drift = moved[seen[some], every]
        upper = reach[np.arange(len(some)), own] + drift[np.arange(len(some)), own]
        open_ = (reach - drift) - upper[:, None] <= ROOM * (reach + drift + upper[:, None])
        open_[np.arange(len(some)), own] = False
        return open_

    def evaluate(some: np.ndarray, centroid: int) -> None:
        d2[some, centroid] = squared(x[some], history[now, centroid])
        seen[some, centroid] = now

    failing = rows[doubtful(rows).any(1)]
    own = cluster[failing]
    work = int((seen[failing, own] < now).sum())
    for c in range(clusters):
        evaluate(failing[own == c], c)
    # with the own distance exact again, fewer of the others stay in doubt
    still = doubtful(failing) & (seen[failing] < now)
    for c in range(clusters):
        evaluate(failing[still[:, c]], c)
    work += int(still.sum())
    exact = np.where(seen[failing] == now, d2[failing], np.iinfo(np.int64).max)
    out = cluster.copy()
    out[failing] = exact.argmin(1)  # of equal distances the first
    return out, work


def _step(batches: Iterator[pa.RecordBatch], history: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One round for rows of the last state."""
    clusters, dims = history.shape[1:]
    for batch in batches:
        x, d2, seen = _numbers(batch, "x", dims), _numbers(batch, "d2", clusters), _numbers(batch, "seen", clusters)
        before = batch.column("cluster").to_numpy()
        after, _ = advanced(x, before.astype(np.int64), d2, seen, history)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("vec_id"), batch.column("x"), pa.array(after, pa.int32()), pa.array(before, pa.int32()),
                _nested(d2, pa.int64()), _nested(seen, pa.int32()),
            ],
            names=["vec_id", "x", "cluster", "was", "d2", "seen"],
        )


def _start(batches: Iterator[pa.RecordBatch], history: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The first round: every distance once. ``was`` is -1: a row that comes from no cluster."""
    clusters, dims = history.shape[1:]
    for batch in batches:
        x = _numbers(batch, "x", dims)
        d2 = np.stack([squared(x, c) for c in history[0]], 1)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("vec_id"), batch.column("x"), pa.array(d2.argmin(1), pa.int32()),
                pa.array(np.full(len(x), -1), pa.int32()), _nested(d2, pa.int64()), _nested(np.zeros_like(d2), pa.int32()),
            ],
            names=["vec_id", "x", "cluster", "was", "d2", "seen"],
        )


def _changes(batches: Iterator[pa.RecordBatch], clusters: int, dims: int) -> Iterator[pa.RecordBatch]:
    """What rows that changed cluster add to one and take from the other: a row per cluster and task."""
    total, rows = np.zeros((clusters, dims), np.int64), np.zeros(clusters, np.int64)
    for batch in batches:
        x = _numbers(batch, "x", dims)
        for side, sign in (("cluster", 1), ("was", -1)):
            of = batch.column(side).to_numpy()
            for c in np.unique(of[of >= 0]):
                total[c] += sign * x[of == c].sum(0)
                rows[c] += sign * int((of == c).sum())
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(clusters), pa.int32()), _nested(np.hstack([rows[:, None], total]), pa.int64())],
        names=["cluster", "sums"],
    )


def _changed(state: DataFrame, clusters: int, dims: int) -> np.ndarray:
    """Per cluster the change of its count and of its component sums (clusters x (1 + dims) numbers)."""
    moved = state.filter("cluster <> was").select("cluster", "was", "x")
    parts = moved.mapInArrow(lambda b: _changes(b, clusters, dims), "cluster int, sums array<long>")
    sums = parts.select("cluster", F.posexplode("sums").alias("at", "s")).groupBy("cluster", "at").agg(
        F.sum("s").alias("s")
    )
    out = np.zeros((clusters, 1 + dims), object)
    for r in sums.collect():  # clusters x (1 + dims) rows, whatever the input
        out[r["cluster"], r["at"]] += int(r["s"])
    return out


def _measured(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, of = _numbers(batch, "x", centroids.shape[1]), batch.column("cluster").to_numpy()
        far = squared(x, centroids[of])
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("cluster"), pa.array(far, pa.int64())],
            names=["vec_id", "cluster", "distance"],
        )


@dataclass
class Clustering:
    """Rows with cluster and squared distance, and the centroids of every round."""

    rows: DataFrame
    history: list[list[list[int]]] = field(default_factory=list)


def clustered(
    embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, seed: int = 3
) -> Clustering:
    """``vec_id, cluster, distance`` of every kept vector after ``rounds`` of assignment and replacement.

    Each round is one narrow pass over the last state, stored below the shared scratch folder (a lost
    executor costs the tasks it ran, not earlier rounds); the state before it is deleted, so two exist at
    most. Sums follow from the rows that changed cluster alone. A large cluster is never gathered: tasks add
    up their own rows. Repeated rows count as often as they occur; rows with a null ``vec_id`` take part.
    Fewer vectors than clusters give so many centroids; an empty table gives no rows. Other columns
    are not read.
    """
    vectors = kept_vectors(embeddings, dims)
    spark = embeddings.sparkSession
    first = first_centroids(vectors, clusters, seed)
    if not first:
        return Clustering(spark.createDataFrame([], "vec_id long, cluster int, distance long"))
    history, k = [first], len(first)
    sums = np.zeros((k, 1 + dims), object)

    def array() -> np.ndarray:
        return np.array(history, np.int64)

    past = array()
    folder = scratch_dir(spark, "ns-bounds")
    state = stored_at(vectors.mapInArrow(lambda b: _start(b, past), STATE), f"{folder}/0")
    for t in range(rounds):
        sums = sums + _changed(state, k, dims)
        history.append([
            [int(s) // int(row[0]) for s in row[1:]] if row[0] else last for row, last in zip(sums, history[-1])
        ])
        past = array()
        state = stored_at(state.mapInArrow(lambda b: _step(b, past), STATE), f"{folder}/{t + 1}")
        forget(spark, f"{folder}/{t}")
    last = past[-1]
    rows = state.select("vec_id", "x", "cluster").mapInArrow(
        lambda b: _measured(b, last), "vec_id long, cluster int, distance long"
    )
    out = stored(rows, "ns-clusters")
    forget(spark, folder)
    return Clustering(out, history)


def with_inertia(found: Clustering) -> DataFrame:
    """Each row with the distance summed over its cluster and over all, and the digest of its centroid."""
    rows, spark = found.rows, found.rows.sparkSession
    per = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    about = [
        (c, per[c], sum(per.values()), digest(found.history[-1][c])) for c in sorted(per)
    ]  # a row per cluster
    names = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return rows.join(F.broadcast(spark.createDataFrame(about, names)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def clusters_sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, seed: int = 3) -> str:
    """DuckDB SQL for the same rows by plain rounds, every distance computed."""
    far = "list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    whole = "(s - ((s % n) + n) % n) // n"
    parts = [
        f"""WITH k AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
  list_transform(embedding, lambda e: CAST(floor({SCALE} * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {dims}
    AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(CAST(e AS DOUBLE)))) = {dims})""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, x) - 1 AS c, x
  FROM (SELECT sha256('{seed}:' || CAST(vec_id AS VARCHAR)) AS h, x FROM k ORDER BY h NULLS LAST, x LIMIT {clusters}))""",
    ]
    for t in range(rounds + 1):
        parts.append(f"""a{t} AS MATERIALIZED (SELECT r, m.c AS c, m.d AS d
  FROM (SELECT v.r, min({{'d': {far}, 'c': c.c}}) AS m FROM k v, c{t} c GROUP BY v.r))""")
        if t < rounds:
            parts.append(f"""c{t + 1} AS MATERIALIZED (SELECT o.c, coalesce(n.x, o.x) AS x FROM c{t} o LEFT JOIN (
    SELECT c, list({whole} ORDER BY i) AS x FROM (
      SELECT c, i, CAST(sum(e) AS BIGINT) AS s, count(*) AS n
      FROM (SELECT c, unnest(x) AS e, generate_subscripts(x, 1) AS i FROM a{t} JOIN k USING (r)) GROUP BY c, i)
    GROUP BY c) n USING (c))""")
    return ",\n".join(parts) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(z.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN k USING (r) JOIN c{rounds} z USING (c)
"""
