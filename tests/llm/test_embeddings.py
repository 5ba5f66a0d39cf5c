import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from understory.llm import blocks, embeddings


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def brute(rows, threshold=0.95):
    links, label = [0] * len(rows), list(range(len(rows)))
    unit = []
    for _, v in rows:
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.array(v, np.float32).astype(float) if ok else None
        unit.append(x / np.sqrt((x * x).sum()) if ok else None)
    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (d, _), c in zip(rows, label, strict=True):
        least[c] = min(least.get(c, d), d)
    return links, [least[c] for c in label]


@pytest.mark.parametrize("block", [1024, 3])
def test_links_equal_comparing_all(spark, block, monkeypatch):
    monkeypatch.setattr(blocks.block_pairs, "__defaults__", (block,))
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(60):
        base = rng.normal(size=24)
        for _ in range(rng.integers(1, 8)):
            v = base + rng.normal(size=24) * rng.choice([0, 0.05, 0.2])
            rows.append((len(rows), [float(np.float32(x)) for x in v * rng.choice([1, 5])]))
    rows = [rows[i] for i in rng.permutation(len(rows))]
    got = {r["vec_id"]: r for r in embeddings.link(table(spark, rows)).collect()}
    links, components = brute(rows)
    assert [got[d]["n_links"] for d, _ in rows] == links
    assert [got[d]["component_id"] for d, _ in rows] == components
    assert sql(rows) == {d: (r["n_links"], r["component_id"], r["kept"]) for d, r in got.items()}


def sql(rows):
    c = duckdb.connect()
    c.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    c.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    return {d: (n, of, kept) for d, n, of, kept in c.execute(embeddings.OP8_SQL).fetchall()}


def test_odd_vectors(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, 2.0]), (8, [1.0, 2.0]), (9, [2.0, 4.0]), (10, [1.0, 2.0, 0.0]), (11, [-0.0, 0.0]), (12, [-1.0, -2.0])]
    df = table(spark, rows).withColumn("class", F.lit("clash")).withColumn("row", F.lit(1))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.link(df).collect()}
    assert got == sql(rows)
    assert got == {i: (0, i, True) for i in (1, 2, 3, 4, 5, 6, 10, 11, 12)} | {7: (2, 7, True), 8: (2, 7, False), 9: (2, 7, False)}
    assert embeddings.link(table(spark, [])).count() == 0
    assert embeddings.link(table(spark, [(1, None)])).count() == 1


def test_buckets_do_not_depend_on_the_batch():
    plan = embeddings.plan_for(1000)
    unit = np.random.default_rng(0).normal(size=(5000, 16))
    unit /= np.sqrt((unit**2).sum(axis=1, keepdims=True))
    whole = plan.buckets(unit)
    assert all((plan.buckets(unit[i : i + 1]) == whole[i]).all() for i in (0, 17, 4999))


def test_tables_are_enough_at_the_threshold():
    plan = embeddings.plan_for(5000)
    rng = np.random.default_rng(1)
    a = rng.normal(size=(3000, 64))
    a /= np.sqrt((a**2).sum(axis=1, keepdims=True))
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.sqrt((side**2).sum(axis=1, keepdims=True))
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * side
    assert (plan.buckets(a) == plan.buckets(b)).any(axis=1).mean() > 0.999
