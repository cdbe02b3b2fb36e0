"""Near-duplicate vectors by int8 tile products with error bounds.

A unit vector x is held as int8 codes q with one scale s a block, and its own
error e = |x - s q| is kept. For two vectors

    | x.y - s_x s_y (q_x . q_y) |  <=  e_x + e_y + e_x e_y,

so a product of int8 tiles (exact in floats: at most 127**2 a component) tells
most pairs apart for certain; pairs whose bound straddles the threshold are
computed again in double precision from the given components.

Identical vectors are one row with a count from the start. The distinct
vectors are dealt into blocks of about ``BLOCK`` rows, and every pair of blocks
is one task: each vector is sent to as many tasks as there are blocks, never
paired with another in Spark. A task returns, for each of its vectors, the
number of links and one smallest linked representative, so a group of near
copies costs rows in proportion to its vectors, not its pairs.

The work is quadratic in the distinct vectors (all rows are compared whatever
their labels); with n vectors of d components it is n**2 d / 2 multiply-adds
of which a core does about 2e10 a second.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing, and so do vectors of different lengths; repeated
rows are rows (each is the other's link); a null id counts as a row and is
nobody's smallest id; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskforge.llm.common import connected_components, materialize

THRESHOLD = 0.95
BLOCK = 8192
TILE = 1024
SLACK = 1e-9         # rounding of the bounds themselves
DIMS = 1024          # components multiplied at once: sums stay below 2**24, exact in a float


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)          # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def quantise(u: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """int8 codes, the block's scale and every row's error."""
    scale = float(np.abs(u).max()) / 127.0
    q = np.rint(u / scale)
    err = np.sqrt(((u - scale * q) ** 2).sum(axis=1)) + SLACK
    return q.astype(np.int8), scale, err


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a[:, :DIMS].astype(np.float32) @ b[:, :DIMS].astype(np.float32).T
    for i in range(DIMS, a.shape[1], DIMS):
        out = out.astype(np.float64) + a[:, i:i + DIMS].astype(np.float32) @ b[:, i:i + DIMS].astype(np.float32).T
    return out


def tile_links(xa: np.ndarray, xb: np.ndarray | None, threshold: float):
    """Chunks (rows of a, rows of b) of the linked pairs; a against itself if b is None."""
    ua = unit(xa)
    qa, sa, ea = quantise(ua)
    ub, (qb, sb, eb) = (ua, (qa, sa, ea)) if xb is None else ((v := unit(xb)), quantise(v))
    most = float(eb.max())
    for r in range(0, len(qa), TILE):
        e = ea[r:r + TILE]
        floor = ((threshold - e - most - e * most) / (sa * sb)).astype(np.float64)
        first = r if xb is None else 0
        p = _product(qa[r:r + TILE], qb[first:])
        i, j = np.nonzero(p >= (floor - 1.0)[:, None])
        if not len(i):
            continue
        approx = p[i, j] * (sa * sb)
        i, j = i + r, j + first
        if xb is None:
            keep = j > i
            i, j, approx = i[keep], j[keep], approx[keep]
        bound = ea[i] + eb[j] + ea[i] * eb[j]
        sure = approx - bound >= threshold + SLACK
        unsure = np.flatnonzero(~sure & (approx + bound >= threshold - SLACK))
        good = sure
        for c in range(0, len(unsure), 1 << 15):
            k = unsure[c:c + (1 << 15)]
            good[k] = cosine(xa[i[k]], (xa if xb is None else xb)[j[k]]) >= threshold
        if good.any():
            yield i[good], j[good]


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x, y = x / np.abs(x).max(axis=1, keepdims=True), y / np.abs(y).max(axis=1, keepdims=True)
    return np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))


def _tile(threshold: float):
    """One pair of blocks: (rid, n, low) with n links and the smallest linked representative."""
    def run(key, tab):
        own = key[1].as_py() == key[2].as_py()
        rid, times, side = (tab.column(c).to_numpy() for c in ("rid", "times", "side"))
        vec = tab.column("vec").combine_chunks()
        x = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rid), -1)
        a = np.flatnonzero(side == 0)
        b = a if own else np.flatnonzero(side == 1)
        n, label = np.zeros(len(rid), np.int64), np.arange(len(rid))
        if len(a) and len(b):
            li, lj = [], []
            for i, j in tile_links(x[a], None if own else x[b], threshold):
                i, j = a[i], b[j]
                np.add.at(n, i, times[j])
                np.add.at(n, j, times[i])
                # links inside one tree say nothing more about the component
                label = _union(label, i, j)
        hit = np.flatnonzero(n > 0)
        return pa.table({"rid": pa.array(rid[hit], pa.int64()), "n": pa.array(n[hit], pa.int64()),
                         "low": pa.array(rid[label[hit]], pa.int64())})
    return run


def _union(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Join the components of linked rows; a row's label is a row of its component."""
    while True:
        a, b = label[i], label[j]
        if (a == b).all():
            return label
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while (label != label[label]).any():
            label = label[label]


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", *,
                    threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per row: id, n_links, component_id, kept."""
    vec = F.col(vec_col).cast("array<double>") if "decimal" in dict(vectors.dtypes)[vec_col] else F.col(vec_col)
    rows = vectors.select(F.col(id_col).alias("id"), vec.alias("vec"))
    fine = ((F.size("vec") > 0) & F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
            & F.exists("vec", lambda v: v != 0))
    rows = rows.withColumn("vec", F.when(fine, F.col("vec")))
    good = rows.filter("vec is not null")
    reps = materialize(good.groupBy("vec").agg(F.min("id").alias("low_id"), F.count("*").alias("times"))
                       .withColumn("rid", F.monotonically_increasing_id()), "emb-reps")
    n = reps.count()
    blocks = max(1, -(-n // block))
    dealt = reps.select("rid", "times", "vec", F.size("vec").alias("d"), F.pmod(F.xxhash64("rid"), F.lit(blocks)).cast("int").alias("blk"))
    sent = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
        "d", F.least("blk", "o").alias("bi"), F.greatest("blk", "o").alias("bj"),
        (F.col("blk") > F.col("o")).cast("int").alias("side"), "rid", "times", "vec")
    found = materialize(sent.groupBy("d", "bi", "bj").applyInArrow(_tile(threshold), "rid long, n long, low long"), "emb-links")
    comps = connected_components(found.select(F.col("rid").alias("a"), F.col("low").alias("b")), "emb")
    named = (reps.join(found.groupBy("rid").agg(F.sum("n").alias("n")), "rid", "left")
             .join(comps.withColumnRenamed("node", "rid"), "rid", "left")
             .select("rid", "vec", "low_id", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"),
                     F.coalesce("component", "rid").alias("component")))
    smallest = named.groupBy("component").agg(F.min("low_id").alias("component_id"))
    named = named.join(smallest, "component").select(F.col("vec").alias("v2"), "n_links", "component_id")
    linked = (rows.filter("vec is not null").join(named, F.col("vec") == F.col("v2")).select("id", "n_links", "component_id"))
    alone = rows.filter("vec is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
