"""Pairs of rows that share a bucket, in blocks of bounded size.

A bucket of n rows is dealt into ceil(n / BLOCK) blocks by a hash of the row id, and
each pair of blocks is a group of its own, so a bucket of any size is spread over
many tasks, and a task holds two blocks at most.  Groups are compared in arrays;
pairs are counted and joined up where they are found and never become rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1024
#: Pairs that are compared at once.
PAIRS = 1 << 18


def shared_buckets(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of buckets with two rows or more, with n, the bucket's rows."""
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return rows.join(sizes, keys)


def block_pairs(rows: DataFrame, keys: list[str], id_col: str, block: int = BLOCK) -> DataFrame:
    """rows (with n from shared_buckets) once for each block pair i <= j they are in.

    side is 0 for rows of block i and 1 for those of block j; 0 where i = j.  The
    result is partitioned and sorted by bucket and block pair.
    """
    m = F.ceil(F.col("n") / block)
    own = F.pmod(F.xxhash64(id_col), m)
    dealt = rows.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), m - 1)))
    dealt = dealt.withColumn("i", F.least("_own", "_other").cast("int")).withColumn("j", F.greatest("_own", "_other").cast("int"))
    dealt = dealt.withColumn("side", (F.col("_own") != F.col("i")).cast("int")).drop("_own", "_other", "n")
    return dealt.repartition(*keys, "i", "j").sortWithinPartitions(*keys, "i", "j", "side", id_col)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(rows, bounds): batches of whole runs of rows with equal integer keys; run i is rows bounds[i]:bounds[i + 1]."""
    tail = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if tail is not None:
            batch = pa.concat_batches([tail, batch])
        change = np.zeros(batch.num_rows - 1, bool)
        for k in keys:
            values = batch.column(k).to_numpy(zero_copy_only=False)
            change |= values[1:] != values[:-1]
        cuts = np.concatenate([[0], np.flatnonzero(change) + 1])
        if cuts[-1]:
            yield batch.slice(0, int(cuts[-1])), cuts
        tail = batch.slice(int(cuts[-1]))
    if tail is not None:
        yield tail, np.array([0, tail.num_rows])


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The runs of rows with equal integer keys, across batches."""
    for batch, bounds in whole_groups(batches, keys):
        cuts = bounds.tolist()
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def pairs(side: np.ndarray, crossed: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index arrays of all pairs of a group, PAIRS at a time: across the sides, or within the one."""
    if crossed:
        first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(first) or not len(second):
            return
        rows = max(1, PAIRS // len(second))
        for a in range(0, len(first), rows):
            part = first[a : a + rows]
            yield np.repeat(part, len(second)), np.tile(second, len(part))
    else:
        n = len(side)
        a = 0
        while a < n - 1:
            b = min(n - 1, a + max(1, PAIRS // (n - a)))
            p = np.repeat(np.arange(a, b), n - 1 - np.arange(a, b))
            start = np.cumsum(n - 1 - np.arange(a, b)) - (n - 1 - np.arange(a, b))
            q = np.arange(len(p)) - np.repeat(start, n - 1 - np.arange(a, b)) + p + 1
            yield p, q
            a = b


def roots(n: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The smallest index each of 0..n-1 is connected to by the links p-q."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[p], label[q])
        new = label.copy()
        np.minimum.at(new, p, low)
        np.minimum.at(new, q, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def matrix(column: pa.Array, dtype: np.dtype | type, width: int) -> np.ndarray:
    """A list column of equal lengths as a matrix of rows."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.view(dtype).reshape(len(column), width)
