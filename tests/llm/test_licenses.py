import random
import re
import textwrap

import pytest
from pyspark.sql import functions as F

from tests.llm.test_textkernel import plain
from understory.llm import licenses


def brute(text, templates, threshold):
    """Words, places of phrases, and the templates' labels with their best containment, from every block of every template."""
    words = plain(text)
    places = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    hits = []
    for label, marks, t in templates:
        whole, length, spans = set(plain(t)), len(plain(t)), []
        for end in range(1, len(words) + 1):
            i = max(0, end - length)
            block = words[i:end]
            held = whole & set(block)
            if len(held) >= threshold * len(whole) - 1e-9 and set(plain(marks)) <= held:
                inside = [i + k for k, w in enumerate(block) if w in whole]
                spans.append((inside[0], inside[-1], len(held)))
        stretches = []
        for a, b, n in sorted(spans):
            if stretches and a <= stretches[-1][0]:
                stretches[-1][0] = max(stretches[-1][0], b)
                stretches[-1][1].append((-n, b, a))
            else:
                stretches.append([b, [(-n, b, a)]])
        for _, found in stretches:
            n, b, a = min(found)
            hits.append((n / len(whole), n, label, min(x for m, y, x in found if (m, y) == (n, b)), b))
    kept = []
    for share, _, label, a, b in sorted(hits):
        if all(a > y or b < x or label == other for _, other, x, y in kept):
            kept.append((-share, label, a, b))
    return words, sorted(places), kept


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_scan_equals_brute_force(spark, docs, threshold):
    rng = random.Random(6)
    pool = sorted({w for _, _, t in licenses.TEMPLATES for w in plain(t)}) + ["zork", "blat", "the"] * 5
    texts = []
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 4)):
            t = rng.choice(licenses.TEMPLATES)[2].split()
            kept = [w for w in t if rng.random() < 0.93] + [rng.choice(pool) for _ in range(rng.randint(0, 5))]
            parts.append(rng.choice(["\n", " "]).join(kept if rng.random() < 0.6 else rng.choices(pool, k=8)))
        texts.append("\n".join(parts))
    texts += ["MIT license mit LICENSE", "cc by, Cc-By", "apache\nlicense", None, "", "gnu general public license " * 2000]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r for r in licenses.scan(docs(rows), threshold=threshold).collect()}
    for i, t in rows:
        words, places, found = brute(t, licenses.TEMPLATES, threshold)
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        base = {label for _, label in places}
        assert r["base_labels"] == ",".join(sorted(base)) and r["labels"] == ",".join(sorted(base | {k for _, k, _, _ in found}))
        assert sorted((m["label"], round(m["containment"], 9)) for m in r["matches"]) == sorted((k, round(s, 9)) for s, k, _, _ in found)
        best = max((s for s, _, _, _ in found), default=0.0)
        assert r["score"] == (1.0 if base else pytest.approx(best))


def test_odd_tables(spark, docs):
    assert licenses.scan(docs([(1, "x")]).limit(0)).count() == 0
    assert not re.search("[A-Z]", licenses.scan(docs([(1, "MIT License")])).first()["labels"])
    rows = [(None, "MIT License"), (None, "MIT License"), (3, None)]
    df = docs(rows).withColumn("score", F.lit("mine")).withColumn("word", F.lit("kept")).withColumn("_key", F.lit("kept"))
    got = licenses.scan(df).collect()
    assert [r["labels"] for r in got] == ["mit", "mit", ""] and all(r["word"] == r["_key"] == "kept" for r in got) and [r["score"] for r in got] == [1, 1, 0]


@pytest.mark.parametrize(("text", "labels"), [
    ("Released under the BSD License", ""),
    ("Licensed under CC BY 4.0", "cc-by"),
    ("Licensed under the MIT License, Version 2.0", "mit"),
    ("the committee released its report under the new license rules", ""),
    (licenses.TEMPLATES[9][2], "lgpl"),
    (licenses.TEMPLATES[0][2], "agpl"),
    (licenses.TEMPLATES[5][2], "cc-by-nc-4.0"),
    (licenses.TEMPLATES[7][2].replace("version 3", "version 2"), "gpl"),
    ("Permission is hereby granted to the\nperson who reads this\n" + "software and files are free\n" * 9, ""),
])
def test_labels_need_their_words(spark, docs, text, labels):
    found = licenses.scan(docs([(1, text)])).first()
    assert set(found["labels"].split(",")) - {"gpl"} == set(labels.split(",")) - {"gpl"} and ("gpl" in found["labels"].split(",")) == ("gnu general public license" in " ".join(plain(text)))


def test_wrapped_notices_are_found(spark, docs, tmp_path):
    rows = []
    for width in (30, 45, 72, 80):
        for _, _, t in licenses.TEMPLATES:
            rows.append((len(rows), "first line here\n" + textwrap.fill(f"Copyright 2020 zork {t} and what follows", width, initial_indent=" * ", subsequent_indent=" * ") + "\nlast line"))
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in licenses.op7_license_scan(spark, str(tmp_path)).collect()}
    for i, _ in rows:
        assert licenses.TEMPLATES[i % len(licenses.TEMPLATES)][0] in got[i]["labels"].split(",") and got[i]["score"] == 1.0, rows[i]
