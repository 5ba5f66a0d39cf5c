import random

import numpy as np
from pyspark.sql import functions as F

from understory.llm import quality


def table(n=160):
    rng = random.Random(4)
    words = ["lorem", "ipsum", "dolor", "amet", "elit", "sed", "tempor", "magna"]
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        w = [rng.choice(words) for _ in range(rng.randint(8, 60))]
        rows.append((i, " ".join(w) if good else " ".join(x.upper() + "!!" for x in w) if i % 8 else " ".join(x for x in w for _ in range(9))))
        labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_quality(spark, docs):
    rows, labels = table()
    df, lab = docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = quality.learn(df, lab, ~held_out)
    got = quality.score(df, model).join(lab, "doc_id").where(held_out).collect()
    high, low = ([r["score"] for r in got if r["quality"] == q] for q in (1, 0))
    assert high and low and np.mean([a > b for a in high for b in low]) > 0.97
    again = quality.learn(df.orderBy(F.rand()), lab, ~held_out)
    assert np.allclose(model.share, again.share)


def test_nulls_empty_and_long_texts(spark, docs):
    rows, labels = table(40)
    df = docs([*rows, (None, None), (900, ""), (901, "lorem ipsum " * 60_000)]).withColumn("predicted", F.lit("x"))
    lab = spark.createDataFrame([*labels, (901, None, None), (None, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.learn(df, lab, F.lit(True))
    got = quality.score(df, model).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    prior = 1 / (1 + np.exp(-model.prior))
    assert [r["score"] for r in got[-3:-1]] == [prior, prior]
    nothing = quality.learn(df, lab.limit(0), F.lit(True))
    assert {r["score"] for r in quality.score(df, nothing).collect()} == {0.5}
    assert quality.score(df.limit(0), model).count() == 0


def test_scores_do_not_depend_on_neighbours():
    import pyarrow as pa

    model = quality.train([(1, np.array([3, 5], np.int32), np.ones(2, np.float32)), (0, np.array([4], np.int32), np.ones(1, np.float32))])
    texts = ["ab cd", "x", "", None, "ab cd ab", "é"]
    together = quality.logits(model, pa.array(texts))
    assert together.tolist() == [quality.logits(model, pa.array([t], pa.string()))[0] for t in texts]
    many = quality.logits(model, pa.array((texts * 700)[:4000]))
    assert {tuple(many[i :: len(texts)]) == (many[i],) * len(many[i :: len(texts)]) for i in range(len(texts))} == {True}


def features(text):
    """Buckets of a text, one by one."""
    out = []
    for kind, n in ((0, 3), (1, 4)):
        for i in range(len(text) - n + 1):
            h = 0
            for c in text[i : i + n]:
                h = (h * 0x01000193 + ord(c)) % 2**32
            h ^= h >> 15
            h = h * 0x85EBCA6B % 2**32
            h ^= h >> 13
            out.append(kind * quality.BUCKETS + h % quality.BUCKETS)
    return out


def test_scoring_equals_brute_force():
    """Character n-grams of mixed scripts one by one; words as the kernel hashes them; the mean of the buckets' shares."""
    import pyarrow as pa

    from understory.llm import textkernel as tk

    rng = np.random.default_rng(3)
    model = quality.Model(np.round(rng.normal(0, 1, 4 * quality.BUCKETS), 6), 0.25)
    texts = ["abc défg", "日本語 text", "x", "", None, "Ж" * 9 + "\n\ta b a b"]
    got = quality.logits(model, pa.array(texts, pa.string()))
    for t, z in zip(texts, got, strict=True):
        raw = (t or "").encode()
        found = tk.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), tk.TOKEN_BYTE).hashes.tolist()
        ids = features(t or "") + [2 * quality.BUCKETS + h % quality.BUCKETS for h in found]
        ids += [3 * quality.BUCKETS + int(tk.mix(np.array([a ^ b], np.uint64))[0]) % quality.BUCKETS for a, b in zip(found, found[1:], strict=False)]
        assert abs(z - (sum(model.share[i] for i in ids) / max(len(ids), 1) + 0.25)) < 1e-8


def test_a_step_goes_down_the_loss():
    """The change of the output layer and vectors in one step, against differences of the loss."""
    ids, counts = np.array([2, 7, 9], np.int32), np.array([1.0, 3.0, 2.0], np.float32)
    part = counts / counts.sum()

    def loss(vectors, output, bias, label):
        z = part @ vectors[ids] @ output + bias
        return -(z[label] - np.log(np.exp(z).sum()))

    rng = np.random.default_rng(1)
    vectors, output, bias = rng.normal(0, 1, (12, quality.DIMENSIONS)), rng.normal(0, 1, (quality.DIMENSIONS, 2)), np.zeros(2)
    down_vectors, down_output = quality.gradients(vectors[ids], part[:, None], output, bias, 1)
    for i, j in ((0, 0), (1, 3), (2, 11)):
        moved = vectors.copy()
        moved[ids[i], j] += 1e-6
        assert abs((loss(moved, output, bias, 1) - loss(vectors, output, bias, 1)) / 1e-6 - down_vectors[i, j]) < 1e-4
    for j, k in ((0, 0), (5, 1)):
        moved = output.copy()
        moved[j, k] += 1e-6
        assert abs((loss(vectors, moved, bias, 1) - loss(vectors, output, bias, 1)) / 1e-6 - down_output[j, k]) < 1e-4


def test_the_sample_is_bounded(spark, docs):
    df = docs([(1, f"text {i} of one id") for i in range(300)] + [(2, "other"), (2, "other")])
    lab = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    seen = []
    real = quality.train
    quality.train = lambda rows: seen.append(len(rows)) or real(rows)
    try:
        quality.learn(df, lab, F.lit(True), rows=2)
        quality.learn(df, lab, F.lit(True), rows=1000, features=500)
    finally:
        quality.train = real
    assert seen[0] <= 2 and 0 < seen[1] < 30
