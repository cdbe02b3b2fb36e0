"""Centroid clustering with a Walsh-Hadamard progressive search.

Vectors become integers floor(scale * x). The Walsh-Hadamard matrix W (entries
+1 and -1, W W' = 64 I) keeps distances up to a factor: |Wx - Wc|^2 = 64 |x - c|^2,
so the squared differences of the first coefficients are a lower bound that
grows with every further one. Coefficients are taken in order of sequency,
coarse to fine: after the first block the centroid with the smallest partial
sum is measured in full, every centroid whose partial sum is strictly above
that distance is dropped, and the ones that are left go on block by block; the
survivors finish all coefficients and the nearest, of equal ones the smaller
number, wins. All of it is integer arithmetic (doubles only where every value
stays below 2^53, Python integers for components of 2^24 and more).

A round is one job: tasks assign their vectors and return a count and a sum
per (centroid, component), which Spark adds up; the driver sees one row per
(centroid, component) and takes exact floors. Vectors are written once to the
shared checkpoint folder and read by every round.

Defined results: null vectors, vectors of another length or with a null or
non-finite component are left out, and so are those with a component beyond
+-2^62 after scaling; a distance or sum beyond 64 bits is null. Rows without
an id are clustered, but never start a centroid before rows with one. Rows
with equal ids are clustered each; where they start a centroid, ties of the
hash go by the components. Fewer vectors than centroids: fewer centroids. An
empty table returns no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskforge.llm.common import materialize

BLOCKS = (4, 8, 16, 32)      # where centroids are dropped; all further coefficients follow at once
ROWS = 4096                  # vectors searched at once
EXACT_DOUBLE = 1 << 18       # components up to here: every sum stays below 2^53
EXACT_LONG = 1 << 24         # and up to here below 2^63
BIGGEST = 1 << 62


def walsh(dim: int) -> np.ndarray:
    """The Walsh-Hadamard matrix of a power of two, rows in order of sequency (sign changes)."""
    if dim < 1 or dim & (dim - 1):
        raise ValueError("the number of components must be a power of two")
    m = np.ones((1, 1), dtype=np.int64)
    while len(m) < dim:
        m = np.block([[m, m], [m, -m]])
    return m[np.argsort((np.diff(m, axis=1) != 0).sum(axis=1), kind="stable")]


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Per integer vector the nearest centroid and its squared distance, exactly."""
    dim = vectors.shape[1]
    blocks = [*(b for b in BLOCKS if b < dim), dim]
    top = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    kind = np.float64 if top <= EXACT_DOUBLE else np.int64 if top <= EXACT_LONG else object
    turn = walsh(dim).T.astype(kind)
    y, z = vectors.astype(kind) @ turn, centroids.astype(kind) @ turn
    n, rows = len(y), np.arange(len(y))
    first = blocks[0]
    head, zhead = y[:, :first], z[:, :first]
    part = (head * head).sum(1)[:, None] + (zhead * zhead).sum(1)[None, :] - 2 * (head @ zhead.T)
    leader = np.argmin(part, axis=1)
    bound = part[rows, leader] + ((y[:, first:] - z[leader, first:]) ** 2).sum(1)
    at, c = np.nonzero(part <= bound[:, None])
    sums = part[at, c]
    for lo, hi in zip(blocks, blocks[1:]):
        sums = sums + ((y[at, lo:hi] - z[c, lo:hi]) ** 2).sum(1)
        keep = sums <= bound[at]
        at, c, sums = at[keep], c[keep], sums[keep]
    # pairs are in order of (vector, centroid): the first smallest of a vector is the smaller number
    start = np.searchsorted(at, rows)
    low = np.minimum.reduceat(sums, start) if n else sums
    hit = np.flatnonzero(sums == low[at])
    choice = c[hit[np.searchsorted(at[hit], rows)]]
    return choice, [int(d) // dim for d in low]


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    col = batch.column("v")
    return col.flatten().to_numpy().reshape(len(col), dim)


def _sums(centroids: np.ndarray):
    def run(batches):
        k, dim = centroids.shape
        count, total = np.zeros(k, dtype=np.int64), np.zeros((k, dim), dtype=object)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                v = _matrix(batch.slice(i, ROWS), dim)
                own, _ = nearest(v, centroids)
                count += np.bincount(own, minlength=k)
                part = np.zeros((k, dim), dtype=np.int64 if np.abs(v).max(initial=0) < BIGGEST // ROWS else object)
                np.add.at(part, own, v.astype(part.dtype))
                total += part.astype(object)
        used = np.flatnonzero(count)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(used, dim).astype(np.int32)), pa.array(np.tile(np.arange(dim, dtype=np.int32), len(used))),
                 pa.array(np.repeat(count[used], dim)), pa.array([str(s) for s in total[used].ravel()])], ["c", "i", "n", "s"])
    return run


def _assign(centroids: np.ndarray):
    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                own, far = nearest(_matrix(part, centroids.shape[1]), centroids)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(own.astype(np.int32)), pa.array([str(d) for d in far])],
                                                 ["id", "cluster", "d"])
    return run


def cluster(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 40, rounds: int = 5,
            dim: int = 64, scale: int = 256, seed: int = 2) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that is kept."""
    walsh(dim)
    x = F.col("x")
    kept = (rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
            .filter((F.size(x) == dim) & F.forall(x, lambda e: e.isNotNull() & (F.abs(e * scale) <= float(BIGGEST)) & ~F.isnan(e)))
            .select("id", F.transform(x, lambda e: F.floor(e * scale).cast("long")).alias("v")))
    kept = materialize(kept, "walsh-vectors")
    # the smallest k by hash; rows without an id last
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    starts = kept.orderBy(key.asc_nulls_last(), "v").limit(k).select("v").collect()
    centroids = [[int(e) for e in r["v"]] for r in starts]
    table = np.array(centroids, dtype=np.int64).reshape(len(centroids), dim)
    for _ in range(rounds if centroids else 0):
        added = (kept.select("v").mapInArrow(_sums(table), "c int, i int, n long, s string")
                 .groupBy("c", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
        for r in added:                       # one row per centroid and component
            table[r["c"], r["i"]] = int(r["s"]) // r["n"]
    id_kind = kept.schema["id"].dataType.simpleString()
    if not centroids:
        assigned = kept.select("id", F.lit(0).alias("cluster"), F.lit("0").alias("d"))
    else:
        assigned = kept.mapInArrow(_assign(table), f"id {id_kind}, cluster int, d string")
    assigned = materialize(assigned.withColumn("d", F.col("d").cast("decimal(38,0)")), "walsh-clusters")
    inertia = assigned.groupBy("cluster").agg(F.sum("d").alias("ci")).collect()
    whole = sum(int(r["ci"]) for r in inertia)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in table.tolist()]
    named = rows.sparkSession.createDataFrame([(r["cluster"], str(r["ci"]), str(whole), digest[r["cluster"]]) for r in inertia],
                                              "cluster int, ci string, whole string, centroid_sha256 string")
    as_long = lambda c: F.expr(f"try_cast({c} AS bigint)")
    return assigned.join(F.broadcast(named), "cluster").select(
        "id", "cluster", as_long("d").alias("distance"), as_long("ci").alias("cluster_inertia"),
        as_long("whole").alias("inertia"), "centroid_sha256")


def oracle(table: str = "embeddings", k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2) -> str:
    """DuckDB SQL of ``cluster`` by plain distances, the rounds written out."""
    near = """SELECT r, c, d FROM (
        SELECT r, c, d, row_number() OVER (PARTITION BY r ORDER BY d, c) AS place FROM (
          SELECT p.r, q.c, sum((p.x - q.x) * (p.x - q.x)) AS d FROM parts p JOIN {cents} q USING (i) GROUP BY p.r, q.c)) WHERE place = 1"""
    sql = [f"""WITH numbered AS (
      SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM {table}
      WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda t: t IS NOT NULL AND isfinite(t))) = {dim}),
    parts AS MATERIALIZED (SELECT r, unnest(generate_series(1, {dim})) AS i, floor(unnest(e) * {scale})::HUGEINT AS x FROM numbered),
    chosen AS (SELECT r, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, e) - 1 AS c FROM numbered),
    c0 AS MATERIALIZED (SELECT c, i, x FROM chosen JOIN parts USING (r) WHERE c < {k})"""]
    for t in range(rounds):
        sql.append(f"""a{t} AS MATERIALIZED ({near.format(cents=f'c{t}')}),
    m{t} AS (SELECT c, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{t} JOIN parts USING (r) GROUP BY c, i),
    c{t + 1} AS MATERIALIZED (SELECT c, i, CASE WHEN n IS NULL THEN x ELSE (s - ((s % n) + n) % n) // n END AS x
      FROM c{t} LEFT JOIN m{t} USING (c, i))""")
    return ",\n    ".join(sql) + f""",
    last AS MATERIALIZED ({near.format(cents=f'c{rounds}')}),
    hashed AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
    SELECT vec_id, c::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
      (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
    FROM last JOIN numbered USING (r) JOIN hashed USING (c)"""
