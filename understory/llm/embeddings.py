"""Embedding near-dedup by Euclidean p-stable hashing.

Vectors are normalised; Gaussian projections with random offsets, quantised to a
width, give each vector a bucket in each of several tables.  Vectors of a bucket are
compared by exact cosine in double precision.  A pair counts in the first table it
shares; links are counted and joined up inside blocks of bounded size and never become
rows.  Equal vectors are one class and are not compared with each other.

Width, projections per table and tables are chosen together, for the counted vectors:
projections that leave about one stranger in a bucket at any size, as many tables as let
one pair in MISS at the threshold through (fewer above it), and the width whose tables are
fewest.

Buckets are computed from coordinates and projections rounded to integers, whose sums
doubles hold exactly, so every task finds the same buckets whatever its batch.

Defined results: vectors that are null, empty, zero or hold null or non-finite components
link with nothing; vectors of different lengths never link; copies are links of cosine
1; a null id is a row of its own and is no component's id unless all ids are null; an
empty table gives an empty result; other columns are ignored; a very long vector costs its
length, and no more vectors are held at once than two blocks have.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from understory.llm import blocks
from understory.llm.common import components, map_arrow, saved

THRESHOLD = 0.95
MISS = 1e-4
SEED = 51
KEYS = ["part", "bucket"]
#: Bits after the point that coordinates and projections keep.
_BITS = 20
#: Rows of a bucket whose pairs are taken up with those of other buckets, and pairs at once.
SMALL = 64
PAIRS = 1 << 16


@dataclass(frozen=True)
class Plan:
    """Tables, projections per table, and the projections' seed."""

    tables: int
    each: int
    width: float
    seed: int = SEED

    def projections(self, dimension: int) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng([self.seed, dimension])
        n = self.tables * self.each
        a = np.rint(rng.normal(size=(dimension, n)) * (1 << _BITS))
        return a, np.rint(rng.uniform(0, self.width, n) * 2.0 ** (2 * _BITS))

    def buckets(self, unit: np.ndarray) -> np.ndarray:
        """The bucket of each row in each table."""
        a, offset = self.projections(unit.shape[1])
        out = np.empty((len(unit), self.tables), np.int64)
        mixer = np.random.default_rng(self.seed).integers(1, 1 << 62, self.each, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for at in range(0, len(unit), 4096):
            part = np.rint(unit[at : at + 4096] * (1 << _BITS))
            cells = np.floor((part @ a + offset) / (self.width * 2.0 ** (2 * _BITS))).astype(np.int64).view(np.uint64)
            cells = cells.reshape(len(part), self.tables, self.each)
            key = np.zeros((len(part), self.tables), np.uint64)
            for i in range(self.each):
                key ^= cells[:, :, i] * mixer[i] + (key << np.uint64(7)) + (key >> np.uint64(3))
            out[at : at + 4096] = key.view(np.int64)
        return out


def _collision(distance: float, width: float) -> float:
    """Probability that one projection puts two vectors at a distance in one cell."""
    x = width / distance
    tail = 0.5 * math.erfc(x / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * x) * (1 - math.exp(-x * x / 2))


def plan_for(rows: int, threshold: float = THRESHOLD, miss: float = MISS) -> Plan:
    """The width whose tables are fewest: projections that leave about one unrelated vector in a bucket, tables that miss `miss` of the links."""
    distance = max(math.sqrt(max(0.0, 2 - 2 * threshold)), 1e-6)
    best = None
    for step in range(6, 41):
        width = step / 10
        near, far = _collision(distance, width), _collision(math.sqrt(2), width)
        each = max(4, math.ceil(math.log(max(rows, 2)) / -math.log(far)))
        whole = near**each
        tables = 1 if whole >= 1 - miss else math.ceil(math.log(miss) / math.log1p(-whole))
        if best is None or (tables, each) < (best.tables, best.each):
            best = Plan(tables, each, width)
    return best


def usable(vector: Column) -> Column:
    """Whether a vector can link: not null, zero, or with null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def _unit(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = values.reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _hash(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("vector")
            lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
            out = np.empty((batch.num_rows, plan.tables), np.int64)
            for d in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == d)
                out[rows] = plan.buckets(_unit(vectors.take(pa.array(rows)))) ^ d
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * plan.tables)
            yield pa.RecordBatch.from_arrays([batch.column("class"), pa.ListArray.from_arrays(ends, pa.array(out.ravel()))], names=["class", "buckets"])

    return run


def _units(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(length, place, matrices): row i is row place[i] of the matrix of its length."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    place, matrices = np.empty(len(lengths), np.int64), {}
    for d in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == d)
        place[rows] = np.arange(len(rows))
        matrices[d] = _unit(vectors.take(pa.array(rows)))
    return lengths, place, matrices


def _pairs_within(bounds: np.ndarray, groups: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index arrays of all pairs of rows within the marked groups, about PAIRS at a time."""
    sizes = np.diff(bounds)
    rows = np.flatnonzero(np.repeat(groups, sizes)) + bounds[0]
    later = np.repeat(bounds[1:], sizes)[rows - bounds[0]] - 1 - rows
    total = np.cumsum(later)
    at = 0
    while at < len(rows):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")))
        n = later[at:end]
        p = np.repeat(rows[at:end], n)
        if len(p):
            yield p, p + 1 + np.arange(len(p)) - np.repeat(np.cumsum(n) - n, n)
        at = end


def _first_here(plan: Plan, table: np.ndarray, ids: np.ndarray, vectors: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of rows share no table before the one given; each class is hashed once.

    ids, vectors: of the rows; a, b: the pairs' rows; table: of each pair.
    """
    _, place, where = np.unique(ids, return_index=True, return_inverse=True)
    keys = plan.buckets(vectors[place])
    same = keys[where[a]] == keys[where[b]]
    return same.argmax(axis=1) >= np.where(same.any(axis=1), table, 0)


def _compare(plan: Plan, threshold: float):
    def large(out: list, unit: np.ndarray, table: int, ids: np.ndarray, copies: np.ndarray, side: np.ndarray, crossed: bool) -> None:
        keys, links, ps, qs = None, np.zeros(len(ids), np.int64), [], []
        for p, q in blocks.pairs(side, crossed):
            close = np.einsum("ij,ij->i", unit[p], unit[q]) >= threshold
            p, q = p[close], q[close]
            if table and len(p):
                keys = plan.buckets(unit) if keys is None else keys
                first = ~(keys[p, :table] == keys[q, :table]).any(axis=1)
                p, q = p[first], q[first]
            np.add.at(links, p, copies[q])
            np.add.at(links, q, copies[p])
            ps.append(p)
            qs.append(q)
        if links.any():
            root = blocks.roots(len(ids), np.concatenate(ps), np.concatenate(qs))
            some = np.flatnonzero(links)
            out.append((ids[some], links[some], ids[root[some]]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bounds in blocks.whole_groups(batches, [*KEYS, "dimension", "i", "j"]):
            lengths, place, matrices = _units(batch.column("vector"))
            table, ids, copies, side, i, j = (batch.column(c).to_numpy() for c in ("part", "class", "copies", "side", "i", "j"))
            out: list[tuple] = []
            sizes, heads = np.diff(bounds), bounds[:-1]
            small = (sizes <= SMALL) & (i[heads] == j[heads])
            ps, qs = [], []
            for p, q in _pairs_within(bounds, small):
                for d, unit in matrices.items():
                    mine = lengths[p] == d
                    a, b = (p[mine], q[mine]) if not mine.all() else (p, q)
                    near = np.einsum("ij,ij->i", unit[place[a]], unit[place[b]]) >= threshold
                    a, b = a[near], b[near]
                    if len(a):
                        rows, at = np.unique(np.concatenate([a, b]), return_inverse=True)
                        first = _first_here(plan, table[a], ids[rows], unit[place[rows]], at[: len(a)], at[len(a) :])
                        ps.append(a[first])
                        qs.append(b[first])
            if ps:
                p, q = np.concatenate(ps), np.concatenate(qs)
                some, where = np.unique(np.concatenate([p, q]), return_inverse=True)
                p, q, links = where[: len(p)], where[len(p) :], np.zeros(len(some), np.int64)
                np.add.at(links, p, copies[some[q]])
                np.add.at(links, q, copies[some[p]])
                out.append((ids[some], links, ids[some[blocks.roots(len(some), p, q)]]))
            for k in np.flatnonzero(~small).tolist():
                rows = slice(bounds[k], bounds[k + 1])
                head = bounds[k]
                large(out, matrices[int(lengths[head])][place[rows]], int(table[head]), ids[rows], copies[rows], side[rows], i[head] != j[head])
            if any(len(x[0]) for x in out):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["class", "links", "root"])

    return run


def link(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, n_links, component_id, kept of each row of vectors.

    Classes are numbered by their least id where ids are unique, so a class is a
    number; rows without id take part through their class.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.monotonically_increasing_id().alias("row"))
    rows = saved(rows.withColumn("vector", F.when(usable(F.col("vector")), F.transform("vector", lambda x: x + 0.0))), "vectors")
    classes = rows.where("vector IS NOT NULL").groupBy("vector").agg(F.min("row").alias("class"), F.count("*").alias("copies"), F.min("id").alias("least"))
    classes = saved(classes, "vector-classes")
    plan = plan_for(classes.count(), threshold)
    buckets = map_arrow(classes.select("class", "vector"), _hash(plan), "class long, buckets array<long>")
    shared = blocks.shared_buckets(buckets.select("class", F.posexplode("buckets").alias("part", "bucket")), KEYS)
    shared = shared.join(classes.select("class", "vector", "copies", F.size("vector").alias("dimension")), "class")
    dealt = blocks.block_pairs(shared, [*KEYS, "dimension"], "class")
    links = saved(map_arrow(dealt, _compare(plan, threshold), "class long, links long, root long"), "vector-links")
    counts = links.groupBy("class").agg(F.sum("links").alias("links"))
    found = components(links, "class", "root").withColumnRenamed("node", "class")
    least = found.join(classes.select("class", "least"), "class").groupBy("component").agg(F.min("least").alias("component_id"))
    found = found.join(least, "component").select("class", "component_id").join(counts, "class")
    summary = classes.join(found, "class", "left")
    result = rows.join(summary.select("vector", "copies", "least", "component_id", "links"), "vector", "left")
    result = result.select(
        F.col("id").alias(id_col),
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"),
        F.coalesce("component_id", "least", "id").alias("component_id"),
    )
    return result.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def op8_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of embeddings."""
    return link(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


#: DuckDB SQL for op8: all pairs.
OP8_SQL = """
WITH RECURSIVE every AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
squares AS (SELECT vec_id, e, CASE WHEN len(e) > 0 AND len([x for x in e if NOT coalesce(isfinite(x), false)]) = 0 THEN list_sum([x * x for x in e]) ELSE 0 END AS square FROM every),
usable AS MATERIALIZED (SELECT vec_id, e, sqrt(square) AS norm FROM squares WHERE square > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95 ELSE false END),
reach AS (SELECT vec_id, vec_id AS r FROM every UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.r),
found AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
degrees AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept FROM every JOIN found USING (vec_id) LEFT JOIN degrees USING (vec_id)
"""
