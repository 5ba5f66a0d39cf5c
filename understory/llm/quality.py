"""Quality classifier: supervised subword embeddings.

Learned vectors of hashed words, unordered word pairs and character 3- and 4-grams are
averaged over a document and a softmax layer gives the classes; both are trained by stochastic
gradient descent in numpy.  Scoring uses that the output is linear in the average:
each bucket's share of the logit is folded into one number, so whole texts are scored
by array look-ups.  These numbers are whole (fixed point), so a text's sum is exact and
the same wherever it stands.

Defined results: null and empty texts have no features and get the learned prior;
repeated rows get equal scores, rows of a null or repeated id too; a very long text is read
whole; input columns of a made column's name are replaced, others kept; without labelled
rows every score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from understory.llm import textkernel as tk
from understory.llm.common import map_arrow, saved, with_text_columns

#: Labelled rows that are learned from at most: those of least hash; and their features (8 bytes each).
SAMPLE_ROWS = 1200
SAMPLE_FEATURES = 4_000_000
BUCKETS = 1 << 15
DIMENSIONS = 12
EPOCHS = 6
RATE = 4.0
SEED = 7
THRESHOLD = 0.3
#: Bits after the point of a bucket's share of the logit.
_BITS = 32

FEATURES = "label int, draw long, ids binary, counts binary"


def _grams(points: np.ndarray, n: int) -> np.ndarray:
    """Bucket of the n characters from each position on."""
    h = np.zeros(max(len(points) - n + 1, 0), np.uint32)
    for i in range(n):
        h *= np.uint32(0x01000193)
        h += points[i : i + len(h)]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    return (h & np.uint32(BUCKETS - 1)).astype(np.int32)


def _features(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bucket, first, end): features of each kind, and each text's range of them."""
    points = np.frombuffer(raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    before = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=before[1:])
    places = before[offsets]
    for kind, n in ((0, 3), (1, 4)):
        ids = _grams(points, n)
        first = np.minimum(places[:-1], len(ids))
        yield ids + np.int32(kind * BUCKETS), first, np.maximum(first, np.minimum(places[1:] - n + 1, len(ids)))
    found = tk.words(raw, offsets, tk.TOKEN_BYTE)
    yield (found.hashes & np.uint64(BUCKETS - 1)).astype(np.int32) + np.int32(2 * BUCKETS), found.bounds[:-1], found.bounds[1:]
    pairs = tk.mix(found.hashes[:-1] ^ found.hashes[1:])  # one bucket for every word said twice running
    first = np.minimum(found.bounds[:-1], len(pairs))
    yield (pairs & np.uint64(BUCKETS - 1)).astype(np.int32) + np.int32(3 * BUCKETS), first, np.maximum(first, found.bounds[1:] - 1)


@dataclass
class Model:
    """The share of the logit of each bucket, and the logit of no features."""

    share: np.ndarray
    prior: float


def gradients(vectors: np.ndarray, part: np.ndarray, output: np.ndarray, bias: np.ndarray, label: int) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the softmax loss of a document's buckets (vectors, with their parts of it) and of the output layer."""
    mean = (vectors * part).sum(axis=0)
    z = mean @ output + bias
    p = np.exp(z - z.max())
    p /= p.sum()
    p[label] -= 1
    return part * (output @ p), np.outer(mean, p)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], seed: int = SEED) -> Model:
    """Embeddings and softmax layer from (label, buckets, counts), by gradient descent one document a step."""
    size = 4 * BUCKETS
    if not rows:
        return Model(np.zeros(size), 0.0)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (size, DIMENSIONS)).astype(np.float32)
    output = rng.normal(0, 0.3, (DIMENSIONS, 2))
    share_of_1 = (sum(label for label, _, _ in rows) + 1) / (len(rows) + 2)
    bias = np.log([1 - share_of_1, share_of_1])
    steps, step = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            rate = RATE * (1 - step / steps)
            step += 1
            label, ids, counts = rows[i]
            if not len(ids):
                continue
            part = (counts / counts.sum())[:, None]
            by_vector, by_output = gradients(vectors[ids], part, output, bias, label)
            output -= 0.05 * rate * by_output
            vectors[ids] -= rate * 0.25 * by_vector / np.sqrt(part)  # rare buckets take larger steps
    return Model(vectors @ (output[:, 1] - output[:, 0]), float(bias[1] - bias[0]))


def logits(model: Model, column: pa.Array) -> np.ndarray:
    whole = np.rint(model.share * (1 << _BITS)).astype(np.int64)
    out = np.empty(len(column))
    for first, end, raw, offsets in tk.slices(column):
        total, n = np.zeros(end - first, np.int64), np.zeros(end - first, np.int64)
        for ids, a, b in _features(raw, offsets):
            running = np.zeros(len(ids) + 1, np.int64)
            np.cumsum(whole[ids], out=running[1:])
            total += running[b] - running[a]
            n += b - a
        out[first:end] = total / (1 << _BITS) / np.maximum(n, 1) + model.prior
    return out


def predict(model: Model, column: pa.Array) -> list[pa.Array]:
    z = np.clip(logits(model, column), -60, 60)
    score = 1 / (1 + np.exp(-z))
    return [pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, counts = [], []
        for first, end, raw, offsets in tk.slices(batch.column("text")):
            kinds = list(_features(raw, offsets))
            for i in range(end - first):
                u, c = np.unique(np.concatenate([x[a[i] : b[i]] for x, a, b in kinds]), return_counts=True)
                ids.append(u.astype(np.int32).tobytes())
                counts.append(c.astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("draw"), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())], names=["label", "draw", "ids", "counts"])


def learn(docs: DataFrame, labels: DataFrame, train_rows: Column, label: str = "quality", rows: int = SAMPLE_ROWS, features: int = SAMPLE_FEATURES) -> Model:
    """A model from the labelled rows of least hash, `rows` and `features` at most.

    Whole texts are counted on executors; the driver gets one sparse row a document, no
    longer than the number of buckets, up to `features` in all.  Rows of one id and text
    count once.
    """
    chosen = labels.where(train_rows & F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    chosen = chosen.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    texts = texts.withColumn("draw", F.xxhash64("doc_id", "text"))
    picks = texts.select("draw").distinct().orderBy("draw").limit(rows)
    once = texts.join(F.broadcast(picks), "draw", "left_semi").groupBy("draw").agg(F.max("label").alias("label"), F.first("text").alias("text"))
    found = saved(map_arrow(once.select("label", "draw", "text"), _extract, FEATURES), "features")
    upto = Window.orderBy("draw").rowsBetween(Window.unboundedPreceding, 0)  # `rows` rows at most
    sizes = found.select("draw", F.sum(F.octet_length("ids") / 4).over(upto).alias("upto")).where(F.col("upto") <= features)
    got = sorted(found.join(F.broadcast(sizes), "draw").collect(), key=lambda r: r["draw"])
    return train([(min(1, max(0, r["label"])), np.frombuffer(r["ids"], np.int32), np.frombuffer(r["counts"], np.float32)) for r in got])


def score(docs: DataFrame, model: Model, text_col: str = "text", names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """docs with score (0 to 1) and predicted (1 from THRESHOLD on) of each whole text."""
    share = model.share.astype(np.float32)
    prior = model.prior
    shared = docs.sparkSession.sparkContext.broadcast((share, prior))  # 4 * BUCKETS numbers

    def kernel():
        got = Model(shared.value[0].astype(np.float64), shared.value[1])
        return lambda column: predict(got, column)

    return with_text_columns(docs, text_col, [T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())], kernel)


def op4_quality(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = learn(docs, labels, ~held_out)
    return score(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
