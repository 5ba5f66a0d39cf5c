import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from understory.llm import langid


def phrases(known: str, text: str) -> int:
    """Greedy longest phrases of a text that occur in another, by substring search."""
    n, at = 0, 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in known:
            end += 1
        at = end if text[at:end] in known else at + 1
        n += 1
    return n


def test_phrase_counts_equal_a_substring_search():
    rng = random.Random(1)
    known = {"aa": "".join(rng.choice("ab c") for _ in range(300)).strip(), "bb": "".join(rng.choice("bd e") for _ in range(200)).strip()}
    model = langid.tables(known)
    texts = ["".join(rng.choice("abcde ?") for _ in range(n)) for n in (1, 2, 5, 40, 200)] + ["zzz", "a"]
    cleaned = [langid.normalise(t) for t in texts]
    coded = [langid.coder(model, t)[0] for t in texts]
    got = langid.phrase_counts(model, coded)
    for i, t in enumerate(cleaned):
        plain = "".join(c if c in "abcde " else "\0" for c in t)
        assert got[i].tolist() == [phrases(known[x], plain) for x in model.langs]


def test_languages_are_told_apart(spark, docs, vocabulary):
    rng = random.Random(2)
    rows = []
    for i in range(120):
        lang = i % 2
        rows.append((i, " ".join(rng.choice(vocabulary[lang]) for _ in range(rng.randint(5, 60))), ("aa", "bb")[lang], "s"))
    df = docs(rows)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    texts = langid.sample(df, ~held_out)
    assert list(texts) == ["aa", "bb"] and texts == langid.sample(df.orderBy(F.rand()), ~held_out)
    got = langid.identify(df, texts).where(held_out).collect()
    assert got and all(r["lang_pred"] == r["lang"] and 0.5 < r["score"] <= 1 for r in got)


def test_nulls_empty_texts_and_clashing_columns(spark, docs):
    df = docs([(1, None), (2, ""), (3, " 12 !? "), (None, "ka mo ri"), (4, "Ж" * 20), (4, "ka " * 30_000)]).withColumn("score", F.lit("mine"))
    got = langid.identify(df, {"aa": "ka mo ri tu se", "bb": "schung eit ber"}).collect()
    assert [r["lang_pred"] for r in got] == ["und", "und", "und", "aa", "aa", "aa"]
    assert [r["score"] for r in got[:3]] == [0, 0, 0] and got[4]["score"] == 0.5 and got[4]["known_share"] == 0
    assert langid.identify(df, {}).where("lang_pred <> 'und'").count() == 0
    assert langid.identify(df.limit(0), {"aa": "ka"}).count() == 0
    kept = langid.stage(spark, docs([(1, None), (2, "ka mo", "aa", "s"), (3, "Ж" * 9)]), "")
    assert [r["doc_id"] for r in kept.collect()] == [2]


def test_a_large_script_is_learned_whole(spark, docs, vocabulary):
    """A language of 3,000 letters beside two small ones, and an unseen text of it."""
    rng = random.Random(6)
    signs = ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(rng.randint(1, 3))) for _ in range(2500)]
    words = {"aa": vocabulary[0], "bb": vocabulary[1], "zz": signs}
    text = lambda lang: " ".join(rng.choice(words[lang]) for _ in range(400))
    df = docs([(i, text(lang), lang, "s") for i, lang in enumerate(["aa", "bb", "zz"] * 25)])
    model = langid.tables(langid.sample(df, F.lit(True)))
    assert model.spelled
    assert langid.predict(model, pa.array([text("zz"), text("aa"), text("bb")]))[0].to_pylist() == ["zz", "aa", "bb"]
    unseen = docs([(1, text("zz")), (2, text("aa")), (3, "Ж" * 40), (4, "")])
    found = langid.identify(unseen, langid.sample(df, F.lit(True))).collect()
    assert all(r["known_share"] > 0.9 and r["spelled_share"] < 1 for r in found[:2]) and found[2]["spelled_share"] >= 1


def test_stage_drops_strange_texts_and_fills_labels(spark, docs, vocabulary):
    rng = random.Random(7)
    text = lambda words: " ".join(rng.choice(words) for _ in range(80))
    noise = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(60_000))
    rows = [(i, text(vocabulary[i % 2]), ("aa", "bb")[i % 2], "s") for i in range(40)]
    df = docs([*rows, (100, text(vocabulary[1])), (101, noise, None, "s"), (102, None, "aa", "s"), (None, text(vocabulary[0])), (1, text(vocabulary[0]))])
    kept = langid.stage(spark, df, "")
    got = {r["doc_id"]: r for r in kept.collect()}
    assert kept.columns == df.columns and kept.count() == 43 and got[100]["lang"] == "bb" and got[None]["lang"] == "aa" and not {101, 102} & set(got)
    assert langid.stage(spark, df.limit(0), "").count() == 0


def test_the_sample_is_bounded_by_rows(spark, docs):
    df = docs([(7, f"one text {i}", "aa", "s") for i in range(300)] + [(None, f"other {i}", "bb", "s") for i in range(300)])
    texts = langid.sample(df, F.lit(True), docs_each=3)
    assert sorted(texts) == ["aa", "bb"] and len(texts["aa"].split("one")) == 4


def test_one_language_and_batches():
    model = langid.tables({"aa": "ka mo"})
    got = langid.predict(model, pa.array(["ka", None, "mo ka"]))
    assert got[0].to_pylist() == ["aa", "und", "aa"] and got[1].to_pylist() == [1.0, 0.0, 1.0]
    assert np.array_equal(got[2].to_numpy(), [1, 0, 3])
