import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.llm.test_textkernel import plain
from understory.llm import blocks, ngram_join


def brute(rows, threshold=0.8):
    """(n_links, component) of each row by comparing all."""
    sets = []
    for _, t in rows:
        w = plain(t)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links, label = [0] * len(rows), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-12:
                links[i] += 1
                links[j] += 1
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (d, _), c in zip(rows, label, strict=True):
        least[c] = min(least.get(c, d), d)
    return links, [least[c] for c in label]


def corpus(seed=8):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for group in range(30):
        base = [rng.choice(words) for _ in range(rng.choice([1, 3, 5, 20, 60, 150]))]
        for _ in range(rng.randint(1, 6)):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(words)
            rows.append((len(rows), " ".join(w).upper() if rng.random() < 0.3 else ", ".join(w)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1024, 2])
def test_join_equals_comparing_all(spark, docs, block, monkeypatch):
    default = blocks.block_pairs.__defaults__
    monkeypatch.setattr(blocks.block_pairs, "__defaults__", (block,))
    rows = corpus()
    got = {r["doc_id"]: r for r in ngram_join.join(docs(rows)).collect()}
    links, components = brute(rows)
    assert [got[d]["n_links"] for d, _ in rows] == links
    assert [got[d]["component_id"] for d, _ in rows] == components
    assert sum(r["kept"] for r in got.values()) == len(set(components))
    assert default == (1024,)


def test_odd_rows(spark, docs):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, "..."), (4, "one"), (5, "ONE"), (6, long), (7, long + " more"), (None, "one"), (8, None)]
    df = docs(rows).withColumn("kept", F.lit("clash")).withColumn("id", F.lit(0))
    got = {r["doc_id"]: r for r in ngram_join.join(df).collect()}
    assert [got[i]["n_links"] for i in (1, 2, 3, 4, 5, 6, 7, None, 8)] == [0, 0, 0, 2, 2, 1, 1, 2, 0]
    assert got[5]["component_id"] == 4 and got[7]["component_id"] == 6 and got[3]["kept"] and not got[None]["kept"]
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 6, 8]
    assert ngram_join.join(docs([(1, "a")]).limit(0)).count() == 0
    assert ngram_join.keep_one(docs([(1, "a")]).limit(0)).count() == 0
    twice = ngram_join.keep_one(docs([(4, "one two"), (4, "one two"), (5, "One two"), (6, "three")]))
    assert sorted(r["doc_id"] for r in twice.collect()) == [4, 6]


def test_pruning_keeps_pairs_at_the_threshold():
    for n, least in ngram_join.least_matches(0.8, 1e-4):
        assert 0.35 * n < least < 0.8 * n


def test_components(spark):
    from understory.llm.common import components

    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(i, i + 1) for i in range(100, 140)] + [(5, 5), (None, 3), (70, 70)]
    label = {x: x for e in edges for x in e if None not in e}
    for _ in range(200):
        for a, b in edges:
            if a is not None:
                label[a] = label[b] = min(label[a], label[b])
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == label
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_copies_of_null_or_equal_ids(spark, docs):
    words = [f"n{i}" for i in range(60)]
    near = [" ".join([*words[:i], "other", *words[i + 1 :]]) for i in (0, 30, 59)]
    for ids in ((None, None, None), (7, 7, 7), (7, None, 3)):
        kept = ngram_join.keep_one(docs([(i, t) for i, t in zip(ids, near, strict=True)] + [(50, "alone here")]))
        assert kept.count() == 2, ids


def test_clashing_columns(spark, docs):
    df = docs([(1, "one two three"), (2, "one two three"), (3, "four")])
    for name in ("_id", "_hash", "_key", "_out", "id", "class", "kept"):
        df = df.withColumn(name, F.lit(name))
    got = ngram_join.keep_one(df)
    assert got.columns == df.columns and sorted((r["doc_id"], r["_key"]) for r in got.collect()) == [(1, "_key"), (3, "_key")]


def test_a_class_of_many_candidate_rows(spark, docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "DEALT_ROWS", 1)
    rows = corpus(9)
    got = {r["doc_id"]: r for r in ngram_join.join(docs(rows)).collect()}
    links, components = brute(rows)
    assert [got[d]["n_links"] for d, _ in rows] == links and [got[d]["component_id"] for d, _ in rows] == components


def test_sql_equals_comparing_all():
    rows = [*corpus(3), (900, None), (901, "..."), (902, "one two"), (903, "One, TWO"), (904, "one")]
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])  # read by name
    found = duckdb.connect().execute(ngram_join.OP6_SQL).fetchdf().set_index("doc_id").loc[documents["doc_id"]]
    links, components = brute(rows)
    assert found["n_links"].tolist() == links
    assert found["component_id"].tolist() == components
    assert found["kept"].tolist() == [d == c for (d, _), c in zip(rows, components, strict=True)]
