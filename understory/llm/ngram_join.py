"""N-gram Jaccard join with Bayesian candidate pruning.

Texts with equal sets of word shingles are one class.  Classes meet in buckets of
MinHash bands; within a bucket, pairs are compared a few MinHash values at a time and
dropped as soon as the posterior probability (uniform prior) that their similarity
reaches the threshold is below a tolerance.  The rest are verified exactly on their
whole shingle sets.  A pair counts in the first band it shares only, links are counted
and joined up inside blocks of bounded size, and no pair becomes a row.

Of pairs right at the threshold, 24 bands of 4 values miss 3 in a million and pruning
drops 8 in a million; above it, far fewer.

Defined results: texts without words (null and empty ones too) are linked with nothing
and form groups of their own; a text of fewer words than a shingle is one shingle;
equal shingle sets are links of similarity 1; repeated rows are copies; a row of a null
id is a row of its own; a very long text is one set, read whole; other columns are
ignored by the join and kept by keep_one(), whatever their names; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from understory.llm import blocks
from understory.llm import textkernel as tk
from understory.llm.common import components, fresh, keyed, map_arrow, saved

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
#: MinHash values compared before each pruning step, and the posterior below which a pair goes.
STEP = 16
TOLERANCE = 1e-6
#: Documents whose ids are broadcast at most (8 bytes each); more are joined by shuffle.
BROADCAST_IDS = 500_000
#: Rows of candidates that a class meets its shingles with in one place; more are dealt.
DEALT_ROWS = 256
KEYS = ["band", "bucket"]

_rng = np.random.default_rng(20011)
_FACTORS = _rng.integers(1, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFTS = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)


def least_matches(threshold: float, tolerance: float, total: int = HASHES, step: int = STEP) -> list[tuple[int, int]]:
    """(values compared, matches below which a pair is dropped) for each step.

    With a uniform prior and m of n values equal, the similarity has a Beta(m + 1,
    n - m + 1) posterior, whose upper tail is a binomial sum.
    """
    out = []
    for n in range(step, total + 1, step):
        tail = 0.0
        for m in range(n + 1):
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                out.append((n, m))
                break
    return out


def signatures(unique: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The low 16 bits of HASHES MinHash values of each (non-empty) set, as rows."""
    low = (unique >> np.uint64(32)).astype(np.uint32) ^ unique.astype(np.uint32)
    out = np.empty((len(bounds) - 1, HASHES), np.uint16)
    for i in range(HASHES):
        value = low * _FACTORS[i]
        value += _SHIFTS[i]
        out[:, i] = np.minimum.reduceat(value, bounds[:-1]).astype(np.uint16)
    return out


def _sets(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, rows with words, their sorted unique shingles, bounds) of slices."""
    for first, end, raw, offsets in tk.slices(column):
        hashes, bounds = tk.shingles(tk.words(raw, offsets), WORDS)
        parts = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True) if b > a]
        some = np.flatnonzero(np.diff(bounds)) + first
        ends = np.cumsum([0, *map(len, parts)])
        yield first, end, some, np.concatenate(parts) if parts else np.zeros(0, np.uint64), ends


def _class(part: np.ndarray) -> bytes:
    return hashlib.blake2b(part.tobytes(), digest_size=16).digest()


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids: list[bytes | None] = [None] * batch.num_rows
        rows = []
        for _, _, some, unique, ends in _sets(batch.column("text")):
            if len(some):
                for at, a, b in zip(some.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    ids[at] = _class(unique[a:b])
                rows.append(signatures(unique, ends).view(np.int64))
        flat = np.concatenate(rows).ravel() if rows else np.zeros(0, np.int64)
        lengths = np.cumsum([0, *(BANDS if x else 0 for x in ids)]).astype(np.int32)
        signature = pa.ListArray.from_arrays(pa.array(lengths), pa.array(flat))
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text_hash"), pa.array(ids, pa.binary()), signature], names=["id", "text_hash", "class", "signature"])


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, some, unique, ends in _sets(batch.column("text")):
            if len(some):
                parts = [unique[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([_class(p) for p in parts], pa.binary()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["class", "shingles"])


class _Pruner:
    """Pairs of a group that this band is the first to hold and that may reach the threshold."""

    def __init__(self, threshold: float):
        self.steps = least_matches(threshold, TOLERANCE)

    def __call__(self, group: pa.RecordBatch, signature: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        side = group.column("side").to_numpy()
        band = group.column("band")[0].as_py()
        crossed = group.column("i")[0].as_py() != group.column("j")[0].as_py()
        longs = signature.view(np.int64)
        for p, q in blocks.pairs(side, crossed):
            matches, done = np.zeros(len(p), np.int32), 0
            for n, least in self.steps:
                matches += (signature[p, done:n] == signature[q, done:n]).sum(axis=1, dtype=np.int32)
                keep = matches >= least
                if not keep.all():
                    p, q, matches = p[keep], q[keep], matches[keep]
                done = n
            if band and len(p):
                first = ~(longs[p, :band] == longs[q, :band]).any(axis=1)
                p, q = p[first], q[first]
            if len(p):
                yield p, q


def _candidates(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prune, out = _Pruner(threshold), []
        for group in blocks.groups(batches, [*KEYS, "i", "j"]):
            signature = blocks.matrix(group.column("signature"), np.uint16, HASHES)
            used = np.zeros(group.num_rows, bool)
            for p, q in prune(group, signature):
                used[p] = used[q] = True
            if used.any():
                out.append(group.filter(pa.array(used)))
                if len(out) >= 512:
                    yield pa.concat_batches(out)
                    out = []
        if out:
            yield pa.concat_batches(out)

    return run


def _overlaps(parts: list[np.ndarray], p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Common elements of the sets p and q of each pair."""
    if len(p) <= 64:
        return np.array([len(np.intersect1d(parts[a], parts[b], assume_unique=True)) for a, b in zip(p, q, strict=True)], np.int64)
    used = np.unique(np.concatenate([p, q]))
    place = np.full(len(parts), -1)
    place[used] = np.arange(len(used))
    whole = np.concatenate([parts[i] for i in used])
    row = np.repeat(np.arange(len(used)), [len(parts[i]) for i in used])
    _, column, count = np.unique(whole, return_inverse=True, return_counts=True)
    keep = count[column] > 1
    column, row = column[keep], row[keep]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    total = np.zeros((len(used), len(used)), np.float32)
    width = 4096
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [a, a + width])
        dense = np.zeros((len(used), width), np.float32)
        dense[row[lo:hi], column[lo:hi] - a] = 1
        total += dense @ dense.T
    return total[place[p], place[q]].astype(np.int64)


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prune = _Pruner(threshold)
        out: list[tuple] = []
        for group in blocks.groups(batches, [*KEYS, "i", "j"]):
            signature = blocks.matrix(group.column("signature"), np.uint16, HASHES)
            copies = group.column("copies").to_numpy()
            ids = group.column("class").to_pylist()
            parts = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
            sizes = np.array([len(x) for x in parts])
            links, ps, qs = np.zeros(len(ids), np.int64), [], []
            for p, q in prune(group, signature):
                both = _overlaps(parts, p, q)
                close = both >= threshold * (sizes[p] + sizes[q] - both) - 1e-9
                p, q = p[close], q[close]
                np.add.at(links, p, copies[q])
                np.add.at(links, q, copies[p])
                ps.append(p)
                qs.append(q)
            if links.any():
                root = blocks.roots(len(ids), np.concatenate(ps), np.concatenate(qs))
                out += [(ids[x], int(links[x]), ids[root[x]]) for x in np.flatnonzero(links).tolist()]
                if len(out) >= 20_000:
                    yield _linked(out)
                    out = []
        if out:
            yield _linked(out)

    return run


def _linked(rows: list[tuple]) -> pa.RecordBatch:
    a, n, b = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(n, pa.int64()), pa.array(b, pa.binary())], names=["class", "links", "root"])


def join(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of docs: id, text_hash, class_id, component_id, n_links, kept.

    class_id: least id with the same shingle set; component_id: least id reachable by
    links; n_links: other rows linked directly, copies included; kept: the id is the
    component's.  text_hash is xxhash64 of the text, for telling apart rows of one id.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.coalesce(text_col, F.lit("")).alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    features = saved(map_arrow(texts, _features, f"id {id_type}, text_hash long, class binary, signature array<long>"), "features")
    some = features.where("class IS NOT NULL")
    classes = saved(some.groupBy("class").agg(F.first("signature").alias("signature"), F.count("*").alias("copies"), F.min("id").alias("least")), "classes")
    rows = classes.select("class", F.posexplode("signature").alias("band", "bucket"))
    shared = blocks.shared_buckets(rows, KEYS).join(classes.select("class", "signature", "copies"), "class")
    dealt = blocks.block_pairs(shared, KEYS, "class")
    candidates = saved(map_arrow(dealt, _candidates(threshold), dealt.schema), "candidates")
    needed = candidates.groupBy("class").agg(F.ceil(F.count("*") / DEALT_ROWS).cast("int").alias("deals"))
    needed = saved(needed.join(classes.select("class", "least"), "class"), "needed")
    ids = needed.select("least").distinct()
    ids = F.broadcast(ids) if needed.count() <= BROADCAST_IDS else ids
    sets = map_arrow(texts.join(ids, F.col("id").eqNullSafe(F.col("least")), "left_semi"), _shingle_sets, "class binary, shingles binary")
    # a class of many rows has a copy of its shingles for each deal of them
    often = needed.where("deals > 1").select("class", "deals")
    often = F.broadcast(often) if often.count() <= BROADCAST_IDS else often
    deal = F.when(F.col("deals").isNull(), 0).otherwise(F.pmod(F.xxhash64(*KEYS, "i", "j"), "deals").cast("int"))
    dealt = candidates.join(often, "class", "left").withColumn("deal", deal).drop("deals")
    copied = sets.dropDuplicates(["class"]).join(often, "class", "left")
    copied = copied.select("class", "shingles", F.explode(F.sequence(F.lit(0), F.coalesce("deals", F.lit(1)) - 1)).alias("deal"))
    whole = dealt.join(copied, ["class", "deal"]).drop("deal")
    whole = whole.repartition(*KEYS, "i", "j").sortWithinPartitions(*KEYS, "i", "j", "side", "class")
    links = saved(map_arrow(whole, _verify(threshold), "class binary, links long, root binary"), "links")
    counts = links.groupBy("class").agg(F.sum("links").alias("links"))
    found = components(links, "class", "root").withColumnRenamed("node", "class")
    least = found.join(classes.select("class", "least"), "class").groupBy("component").agg(F.min("least").alias("component_id"))
    found = found.join(least, "component").select("class", "component_id").join(counts, "class")
    summary = classes.select("class", "copies", F.col("least").alias("class_id")).join(found, "class", "left")
    result = features.drop("signature").join(summary, "class", "left").select(
        F.col("id").alias(id_col),
        "text_hash",
        F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("component_id", "class_id", "id").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"),
        F.col("class").isNull().alias("wordless"),
    )
    return result.withColumn("kept", F.col("wordless") | F.col(id_col).eqNullSafe(F.col("component_id"))).drop("wordless")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group of near duplicates: the one of least id; all columns stay.

    Where ids are null or repeated, rows are numbered as they are stored and that of the
    least number stays.
    """
    rows, key = keyed(docs, id_col)
    (out,) = fresh(rows, "_out")
    found = join(rows.select(F.col(key).alias("id"), F.col(text_col).alias("text")), threshold, "id", "text")
    gone = saved(found.where("NOT kept").select(F.col("id").alias(out)), "gone")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return rows.join(gone, F.col(key) == F.col(out), "left_anti").select(*docs.columns)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near duplicates stays."""
    return keep_one(docs)


def op6_ngram_join(spark, sf_dir: str) -> DataFrame:
    """doc_id, class_id, component_id, n_links, kept of each row of documents."""
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).drop("text_hash")


#: DuckDB SQL for op6: all pairs that share a shingle, whole sets, 64-bit hashes of shingles.
OP6_SQL = r"""
WITH RECURSIVE dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
places AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i, len(w) AS n FROM dw WHERE len(w) > 0),
hashed AS (SELECT doc_id, i, n, hash(concat_ws(' ', x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o)) AS h FROM places WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
sets AS (SELECT doc_id, list_sort(list(DISTINCT h)) AS s FROM hashed WHERE i <= greatest(n - 4, 1) GROUP BY doc_id),
classes AS (SELECT min(doc_id) AS c, count(*) AS copies, s, len(s) AS n FROM sets GROUP BY s),
members AS (SELECT c, n, unnest(s) AS h FROM classes),
links AS (SELECT a.c AS a, b.c AS b FROM members a JOIN members b ON a.h = b.h AND a.c <> b.c AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n HAVING 5 * count(*) >= 4 * (a.n + b.n - count(*))),
reach AS (SELECT c, c AS r FROM classes UNION SELECT reach.c, links.b FROM reach JOIN links ON links.a = reach.r),
found AS (SELECT c, min(r) AS component_id FROM reach GROUP BY c),
degrees AS (SELECT a AS c, sum(copies) AS n FROM links JOIN classes ON classes.c = links.b GROUP BY a)
SELECT doc_id, coalesce(classes.c, doc_id) AS class_id, coalesce(component_id, doc_id) AS component_id,
  CAST(coalesce(degrees.n, 0) + coalesce(copies, 1) - 1 AS BIGINT) AS n_links, coalesce(component_id, doc_id) = doc_id AS kept
FROM dw LEFT JOIN sets USING (doc_id) LEFT JOIN classes ON classes.s = sets.s LEFT JOIN found ON found.c = classes.c LEFT JOIN degrees ON degrees.c = classes.c
"""
