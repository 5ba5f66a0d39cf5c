"""Stages take effect on what the stage before kept, and the queries are registered."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from understory.llm import queries


def test_stages(spark, docs, tmp_path, vocabulary):
    rng = random.Random(9)
    fresh = lambda n, lang=0: [rng.choice(vocabulary[lang]) for _ in range(n)]
    rows = [(i, " ".join(fresh(rng.randint(60, 120), i % 2)), ("aa", "bb")[i % 2], f"s{i % 3}") for i in range(60)]
    passage, test = fresh(70), fresh(30)
    near = rows[4][1].split()
    near[30] = "other"
    rows += [
        (100, None, None, "s0"), (101, "123 !!!", "aa", "s0"), (102, rows[4][1], "aa", "s1"), (103, " ".join(near), "aa", None),
        (104, " ".join(fresh(80) + passage + fresh(80)), "aa", "s1"), (105, " ".join(fresh(40) + passage + fresh(90)), "aa", "s1"), (106, " ".join(fresh(30) + test[5:20] + fresh(9)), "aa", "s2"),
    ]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(test))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    current = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        current = stage(spark, current, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert current.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        current.write.parquet(f"{tmp_path}/{name}")
        current = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r["doc_id"]: r.asDict() for r in current.collect()}
    assert set(range(60)) <= set(seen["decontamination"]) and set(seen["mixing"]) <= set(seen["decontamination"])
    assert {100, 101}.isdisjoint(seen["language_id"]) and {102, 103, 106} <= set(seen["language_id"])
    assert {102, 103}.isdisjoint(seen["ngram_join"]) and 4 in seen["ngram_join"]
    assert " ".join(passage) in seen["passage_dedup"][104]["text"] and " ".join(passage[10:20]) not in seen["passage_dedup"][105]["text"]
    assert 106 not in seen["decontamination"] and 105 in seen["decontamination"]
    assert all(r["taken"] == r["copies"] * r["size"] > 0 and r["text"] == seen["decontamination"][d]["text"] for d, r in seen["mixing"].items())
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r.asDict() for r in whole} == seen["mixing"]


def test_odd_tables(spark, docs, tmp_path, vocabulary):
    """Null and repeated ids, ties, long texts, clashing columns, and no rows at all."""
    rng = random.Random(3)
    fresh = lambda n: " ".join(rng.choice(vocabulary[0]) for _ in range(n))
    long, tie = fresh(20_000), fresh(80)
    rows = [(None, fresh(60), "aa", "s"), (None, fresh(60), "aa", "s"), (1, fresh(50), "aa", "s"), (1, fresh(70), None, None), (5, long, "aa", "t"), (6, long, "aa", "t"), (7, tie, "aa", "s"), (7, tie, "aa", "s"), (8, "", "aa", "s"), (9, None)]
    df = docs(rows)
    for name in ("_id", "_key", "_of", "_row", "id", "score", "lang_pred", "spans"):
        df = df.withColumn(name, F.lit(name))
    spark.createDataFrame([(1, "none of these words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    df.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    for table in ("benchmark", "labels"):
        spark.read.parquet(f"{tmp_path}/{table}.parquet").write.parquet(f"{tmp_path}/none/{table}.parquet")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    texts = {t: n for t, n in ((r[1], r[0]) for r in rows) if t}
    for stages in (corpus_pipeline.STAGES[:-1],):
        current = spark.read.parquet(f"{tmp_path}/documents.parquet")
        for _, stage in stages:
            current = stage(spark, current, str(tmp_path))
            assert current.columns == df.columns
    got = current.collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "1", "5", "7", "None", "None"]
    assert {r["text"] for r in got} == set(texts) and all(r["lang"] == "aa" and r["_key"] == "_key" and r["score"] == "score" for r in got)
    mixed = corpus_pipeline.run(spark, str(tmp_path))
    assert set(mixed.columns) >= set(df.columns) and {r["text"] for r in mixed.collect()} <= set(texts)
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_every_operator_is_registered():
    names = queries.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 11)) and "pipeline" in names
    assert set(queries.oracle_sql()) <= set(names)
