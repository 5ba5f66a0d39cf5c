import random

import pytest
from pyspark.sql import functions as F

from understory.llm import mixing


def targets(sizes, share=1.5, epochs=2, weights=(3, 1, 2)):
    """Targets by cutting and sharing again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed, budget = {}, share * sum(sizes.values())
    while True:
        rest = [s for s in names if s not in fixed]
        if not rest:
            return fixed
        left = budget - sum(fixed.values())
        t = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = [s for s in rest if t[s] > epochs * sizes[s]]
        if not over:
            return fixed | t
        fixed |= {s: epochs * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_repeated_sharing(spark, docs, seed):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), "en", rng.choice(["a", "b", "é", "Z", None, "c"]) if rng.random() < 0.5 else "a") for i in range(500)]
    got = mixing.mix(docs(rows)).collect()
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(r[1].split())
    want = targets(sizes)
    assert len(got) == len(rows)
    for s in sizes:
        mine = [r for r in got if r["source"] == s]
        assert mine[0]["source_size"] == sizes[s] and mine[0]["target"] == pytest.approx(want[s])
        assert abs(sum(r["taken"] for r in mine) - want[s]) <= 61
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in got)
    again = mixing.mix(docs(rows).repartition(7)).collect()
    assert sorted(got, key=str) == sorted(again, key=str)


def test_quality_draws_more_of_a_source(spark, docs):
    rows = [(i, "a b c d e f", "en", "big") for i in range(4000)] + [(5000 + i, "a b c d e f", "en", "zsmall") for i in range(4000)]
    df = docs(rows).withColumn("weight", F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.2))
    got = mixing.mix(df, "weight", share=0.5).where("source = 'big'")
    share = {r[0]: r[1] for r in got.groupBy((F.col("doc_id") % 2 == 0).alias("plain")).agg(F.avg("copies")).collect()}
    assert share[True] > 1.5 * share[False]


def test_learned_weights(spark, docs):
    noise, plain = "BUY!! NOW!! CLICK!! HERE!!", "a quiet text about mills and rivers"
    df = docs([(i, f"{noise if i % 2 else plain} {i}", "en", "s") for i in range(80)])
    labels = spark.createDataFrame([(i, (i + 1) % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    rows, weight = mixing.scored(df, labels)
    got = {r["doc_id"]: r[weight] for r in rows.collect()}
    assert min(got[i] for i in range(0, 80, 2)) > max(got[i] for i in range(1, 80, 2)) and all(0.1 <= v <= 1 for v in got.values())
    rows, weight = mixing.scored(df, labels.limit(0))
    assert len({r[weight] for r in rows.collect()}) == 1


def test_selection_equals_sorting_all(spark, docs):
    """Copies of every row, against sorted keys and running sums in one place."""
    rng = random.Random(12)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)) + f" {i}", "en", rng.choice("aabc")) for i in range(700)]
    df = docs(rows).withColumn("weight", F.lit(0.1) + (F.col("doc_id") % 10) / 10)
    got = {r["doc_id"]: r for r in mixing.mix(df, "weight").collect()}
    draw = (F.pmod(F.xxhash64(F.lit(mixing.SEED), F.col("doc_id"), F.xxhash64("text")), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    keys = {r[0]: r[1] for r in df.select("doc_id", -F.log(draw) / F.col("weight")).collect()}
    for source in "abc":
        mine = sorted((keys[d], d, len(t.split())) for d, t, _, s in rows if s == source)
        total = sum(n for _, _, n in mine)
        target = got[mine[0][1]]["target"]
        epochs = min(2, int(target // total))
        rest, filled, want = target - epochs * total, 0, {}
        for _, d, n in mine:
            want[d] = epochs + (filled + n <= rest and not want.get("full"))
            if want[d] > epochs:
                filled += n
            else:
                want["full"] = True
        out = [(abs(rest - filled - n), k, d) for k, d, n in mine if want[d] == epochs]
        if out and min(out)[0] < rest - filled:
            want[min(out)[2]] += 1
        assert {d: got[d]["copies"] for _, d, _ in mine} == {d: c for d, c in want.items() if d != "full"}


def test_stage_leaves_out_what_the_mix_leaves_out(spark, docs, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    df = docs([(i, f"a b c {i}", "en", "big" if i < 90 else "c") for i in range(100)])
    for name in ("_row", "_key", "_score", "copies", "_range", "_id"):
        df = df.withColumn(name, F.lit(name))
    got = mixing.stage(spark, df, str(tmp_path))
    rows = got.collect()
    assert rows and all(r["copies"] > 0 and r["text"] == f"a b c {r['doc_id']}" and r["_row"] == "_row" and r["_score"] == "_score" for r in rows)
    assert set(got.columns) == set(df.columns) | set(mixing.MADE)


def test_a_source_over_several_ranges(spark, docs, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 50)
    rows = [(i, " ".join(["w"] * (1 + i % 9)), "en", "one" if i % 3 else "two") for i in range(1500)]
    got = mixing.mix(docs(rows)).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"))
    assert all(abs(r["t"] - r["g"]) <= 9 for r in got.collect())


def test_odd_rows(spark, docs):
    assert mixing.mix(docs([(1, "a", "x", "y")]).limit(0)).count() == 0
    rows = [(None, None, None, None), (None, None, None, None), (1, "", "en", "s"), (2, "a b c", "en", "s"), (2, "a b c", "en", "s"), (3, "x " * 50_000, "en", "t")]
    got = mixing.mix(docs(rows).withColumn("size", F.lit("clash"))).collect()
    assert len(got) == 6 and [r["size"] for r in got if r["doc_id"] == 2] == [2, 2]
    assert all(r["taken"] == 0 for r in got if r["doc_id"] is None)
    assert {r["source_size"] for r in got if r["source"] == "t"} == {50_000}
