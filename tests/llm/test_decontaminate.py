import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.test_textkernel import plain
from understory.llm import decontaminate


def brute(doc, items, window=10):
    w, hit, found = plain(doc), set(), set()
    for item, text in items:
        t = plain(text)
        n = min(window, len(t))
        grams = {tuple(t[i : i + n]) for i in range(len(t) - n + 1)} if t else set()
        for i in range(len(w) - n + 1) if t else ():
            if tuple(w[i : i + n]) in grams:
                hit.update(range(i, i + n))
                found.add(item)
    return len(w), len(hit), sorted(found), sorted(hit)


def corpus(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["É", "é", "ab12"]
    items = [(i, " ".join(rng.choice(words) for _ in range(n))) for i, n in enumerate((25, 10, 40, 3, 1, 9, 12, 10, 0))] + [(50, None), (None, "w1 w2"), (1, "w3 W4. w5 w6"), (7, "Zq")]
    docs = []
    for i in range(120):
        w = [rng.choice(words) for _ in range(rng.randint(0, 40))]
        if i % 3 == 0:
            t = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(0, len(t) - 12))
            w[len(w) // 2 : len(w) // 2] = t[a : a + rng.randint(8, 30)]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(w).upper() if i % 5 == 0 else " ".join(w)))
    docs += [(200, None), (201, ""), (202, (items[0][1] + " ") * 400), (3, docs[3][1]), (None, items[1][1]), (None, items[1][1])]
    return docs, items


@pytest.mark.parametrize("limit", [400_000, 0])
def test_hits_equal_brute_force(spark, docs, limit, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", limit)
    rows, items = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(docs(rows).withColumn("items", F.lit("clash")), bench).collect()
    want = []
    for d, t in rows:
        n, hit, found, _ = brute(t, [x for x in items if x[0] is not None])
        want.append((d, n, hit, found))
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], sorted(r["items"])) for r in got), key=str) == sorted(want, key=str)
    spans = {r["doc_id"]: [p for s in r["spans"] for p in range(s["at"], s["end"])] for r in got}
    assert all(spans[d] == brute(t, [x for x in items if x[0] is not None])[3] for d, t in rows if d is not None)


def test_query_equals_sql(spark, docs, tmp_path):
    rows, items = corpus(4)
    rows = [r for r in rows if r[0] is not None]
    rows = list(dict(rows).items())
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([i for i in items if i[0] is not None], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = decontaminate.op10_decontamination(spark, str(tmp_path))
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    found = c.execute(decontaminate.OP10_SQL)
    order = [[d[0] for d in found.description].index(x) for x in got.columns]
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r[i] for i in order) for r in found.fetchall())
    empty = next(r for r in got.collect() if r["doc_id"] == 200)
    assert empty["items_sha256"] == hashlib.sha256(b"").hexdigest() and not empty["contaminated"]


@pytest.mark.parametrize("limit", [500_000, 0])
def test_clean_drops_only_hit_documents(spark, docs, limit, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_DOCS", limit)
    rows, items = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = decontaminate.clean(docs(rows), bench)
    want = sorted(str(d) for d, t in rows if not brute(t, [x for x in items if x[0] is not None])[1])
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want and kept.columns == docs(rows).columns


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.contaminated(docs([(1, "a b"), (2, None)]), none).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in got] == [(2, 0, []), (0, 0, [])]
    assert decontaminate.clean(docs([(1, "a b")]), none).count() == 1
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.contaminated(docs([(1, "a")]).limit(0), bench).count() == 0


def test_clashing_columns(spark, docs):
    rows, items = corpus(5)
    df = docs(rows)
    for name in ("_id", "_hash", "_of", "_hashed", "_text", "id", "items", "w", "h"):
        df = df.withColumn(name, F.lit(name))
    kept = decontaminate.clean(df, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == df.columns and kept.where("_id = '_id' AND _text = '_text'").count() == kept.count() > 0
