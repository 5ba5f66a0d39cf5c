import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.test_textkernel import plain
from understory.llm import passages
from understory.llm.common import keyed


def test_winnowing_keeps_the_least_of_every_window():
    rng = np.random.default_rng(1)
    sizes = [0, 3, 10, 11, 50, 200]
    hashes = rng.integers(0, 1 << 63, sum(sizes), dtype=np.uint64)
    bounds = np.cumsum([0, *sizes])
    chosen = set(passages.winnow(hashes, bounds).tolist())
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        for i in range(a, b - passages.WINDOW + 1):
            assert i + int(hashes[i : i + passages.WINDOW].argmin()) in chosen
    assert all(any(b - a >= passages.WINDOW and a <= c < b for a, b in zip(bounds[:-1], bounds[1:], strict=True)) for c in chosen)


def best_chain(fragments):
    """Greatest score of any chain, over all of them."""
    best = 0.0
    for r in range(1, len(fragments) + 1):
        for path in itertools.permutations(fragments, r):
            score, ok = 0.0, True
            for k, (a, b, n) in enumerate(path):
                if k:
                    x, y, m = path[k - 1]
                    gaps = a - x - m, b - y - m
                    ok = ok and min(gaps) >= 0 and max(gaps) <= passages.MAX_GAP
                    score -= passages.GAP_COST * sum(gaps)
                score += n
            best = max(best, score) if ok else best
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 90), st.integers(0, 90), st.integers(1, 12)), min_size=1, max_size=5, unique=True))
def test_chains_have_the_greatest_score(fragments):
    paths = passages.chain(fragments)
    assert sorted(i for p in paths for i in p) == list(range(len(fragments)))

    def score(path):
        total = 0.0
        for k, i in enumerate(path):
            a, b, n = fragments[i]
            total += n
            if k:
                x, y, m = fragments[path[k - 1]]
                total -= passages.GAP_COST * (a - x - m + b - y - m)
        return total

    assert max(map(score, paths)) == pytest.approx(best_chain(fragments))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=9), st.lists(st.integers(0, 3), max_size=9))
def test_matched_is_the_longest_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    got = passages.matched(np.array(a, np.uint32), np.array(b, np.uint32))
    assert got == table[-1][-1]


def corpus(seed=11):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(5000)]
    fresh = lambda n: [rng.choice(words) for _ in range(n)]
    shared = [fresh(n) for n in (60, 80, 130, 400)]
    line = fresh(12)
    rows, planted = [], {}
    for d in range(90):
        w = fresh(rng.randint(30, 200))
        if d % 4 == 0:
            w[10:10] = line
        if d % 3 == 0:
            p = list(shared[d % len(shared)])
            kind = d % 5
            if kind == 1:
                p[len(p) // 2] = "changed"
            if kind == 2:
                del p[len(p) // 3]
            if kind == 3:
                p[len(p) // 2 : len(p) // 2] = ["put", "in"]
            at = rng.randint(0, len(w))
            w[at:at] = p
            planted[d] = (d % len(shared), at, len(p))
        rows.append((d, " ".join(w)))
    return rows, planted


def test_planted_passages_are_found_whole(spark, docs):
    rows, planted = corpus()
    found = {r["key"]: r for r in passages.repeats(*keyed(docs(rows))).collect()}
    first = {}
    for d in sorted(planted):
        first.setdefault(planted[d][0], d)
    later = {d for d in planted if first[planted[d][0]] != d}
    assert set(found) == later
    for d in later:
        group, at, n = planted[d]
        (span,) = found[d]["spans"]
        assert abs(span["start"] - at) <= 2 and abs(span["end"] - at - n) <= 2, (d, span, at, n)
        assert {planted[f][0] for f in found[d]["firsts"]} == {group} and max(found[d]["firsts"]) < d and found[d]["identity"] >= 0.9


def test_cut_leaves_the_first_and_all_else(spark, docs):
    rows, planted = corpus()
    rows += [(95, rows[3][1]), (96, None), (97, ""), (98, "short text"), (99, "!" * 50)]
    df = docs(rows).withColumn("spans", F.lit("clash")).withColumn("key", F.lit(1))
    got = {r["doc_id"]: r for r in passages.cut(df).collect()}
    assert set(got) == {d for d, _ in rows} - {95}
    for d, t in rows:
        if d in got and (d not in planted or got[d]["text"] == t):
            assert got[d]["text"] == t
    trimmed = [d for d in planted if got[d]["text"] != dict(rows)[d]]
    assert len(trimmed) == len(planted) - 4
    for d in trimmed:
        assert len(plain(got[d]["text"])) <= len(plain(dict(rows)[d])) - planted[d][2] + 4 and got[d]["n_chars"] == len(got[d]["text"])
    again = passages.repeats(*keyed(passages.cut(df))).count()
    assert again == 0


def test_long_texts_and_shuffled_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(passages, "BROADCAST_BLOCKS", 0)
    rng = random.Random(2)
    w = [f"x{rng.randrange(100_000)}" for _ in range(30_000)]
    rows = [(1, " ".join(w)), (2, " ".join(w[5000:5100])), (3, " ".join(w)), (4, "the of " * 3000), (5, "the of " * 3000)]
    got = {r["key"]: r["spans"] for r in passages.repeats(*keyed(docs(rows))).collect()}
    assert [(s["start"], s["end"]) for s in got[2]] == [(0, 100)] and [(s["start"], s["end"]) for s in got[3]] == [(0, 30_000)]


def test_repeated_and_null_ids(spark, docs):
    rng = random.Random(3)
    text = " ".join(f"q{rng.randrange(9999)}" for _ in range(90))
    got = passages.cut(docs([(1, text), (1, text), (None, text), (2, "other words here")]).coalesce(1))
    assert sorted(str(r["doc_id"]) for r in got.collect()) == ["1", "2"]
    assert passages.cut(docs([(1, "a")]).limit(0)).count() == 0


def test_a_far_long_run_hides_no_near_one():
    runs = [(0, 0, 300), (600, 600, 12), (614, 615, 12), (628, 630, 12), (642, 645, 12)]
    assert sorted(passages.chain(runs)) == [[0], [1, 2, 3, 4]]


def test_words_inside_a_run_are_compared(spark, docs):
    rng = random.Random(4)
    fresh = lambda n: [f"f{rng.randrange(100_000)}" for _ in range(n)]
    labels = [fresh(11) for _ in range(12)]
    form = lambda: " ".join(w for label in labels for w in label + fresh(6))
    a, b = np.array([1, 2, 3, 4, 5], np.uint32), np.array([1, 2, 9, 4, 5], np.uint32)
    assert passages.equal_runs(a, b, [(0, 0, 5)]) == [(0, 0, 2), (3, 3, 2)]
    assert passages.repeats(*keyed(docs([(1, form()), (2, form())]))).count() == 0
    text = fresh(60)
    changed = [*text[:30], "other", *text[31:]]
    (row,) = passages.repeats(*keyed(docs([(1, " ".join(text)), (2, " ".join(changed))]))).collect()
    assert row["identity"] == pytest.approx(59 / 60)


def test_words_said_over_and_over_are_passages(spark, docs):
    rng = random.Random(5)
    fresh = lambda n: [f"p{rng.randrange(100_000)}" for _ in range(n)]
    line, few = fresh(8), fresh(3)
    rows = [
        (1, fresh(40) + line * 10 + fresh(40)), (2, fresh(20) + line[5:] + line * 20 + fresh(60)), (3, line * 4 + fresh(30)),
        (4, fresh(60) + few * 30), (5, few * 30 + fresh(60)), (6, ["said"] * 70), (7, ["said"] * 300),
    ]
    got = {r["key"]: r for r in passages.repeats(*keyed(docs([(i, " ".join(w)) for i, w in rows]))).collect()}
    assert {k: r["firsts"] for k, r in got.items()} == {2: [1], 5: [4], 7: [6]}
    for k, start, end in ((2, 20, 183), (5, 0, 90), (7, 0, 300)):
        (span,) = got[k]["spans"]
        assert abs(span["start"] - start) <= 7 and abs(span["end"] - end) <= 7, (k, span)


def test_passages_put_together_of_known_parts(spark, docs):
    rng = random.Random(6)
    fresh = lambda n: [f"t{rng.randrange(100_000)}" for _ in range(n)]
    x, y, line = fresh(30), fresh(30), fresh(11)
    rows = [
        (1, x + fresh(40)), (2, fresh(40) + y), (10, fresh(40) + x + y + fresh(20)), (11, fresh(20) + x + y + fresh(40)),
        (12, x + fresh(45)), (13, y + fresh(45)), (14, fresh(30) + x + y + fresh(30)), (15, fresh(60) + line * 10), (16, line * 10 + fresh(60)),
    ]
    got = {r["key"]: r for r in passages.repeats(*keyed(docs([(i, " ".join(w)) for i, w in rows]))).collect()}
    assert {k: r["firsts"][0] for k, r in got.items()} == {11: 10, 14: 10, 16: 15} and set(got[14]["firsts"]) <= {10, 11}
    for k, start, end in ((11, 20, 80), (14, 30, 90), (16, 0, 110)):
        (span,) = got[k]["spans"]
        assert abs(span["start"] - start) <= 2 and abs(span["end"] - end) <= 2, (k, span)


def test_matches_are_the_same_in_any_batches():
    rng = np.random.default_rng(7)
    rows = sorted({(int(s), int(k), int(a)) for s, k, a in zip(rng.integers(0, 5, 400), rng.integers(0, 9, 400), rng.integers(0, 50, 400), strict=True)})
    want = set()
    for s, k, a in rows:
        first = min(r for r in rows if r[0] == s)
        if first[1] < k:
            want.add((k, first[1], a, first[2]))
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int8(), pa.int64(), pa.int32())
    for size in (1, 2, 3, 7, 50, len(rows)):
        parts = [rows[i : i + size] for i in range(0, len(rows), size)]
        more = lambda n: ([passages.K] * n, [0] * n, [None] * n, [None] * n)
        batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([*zip(*p, strict=True), *more(len(p))], kinds, strict=True)], names=["seed", "key", "at", "n", "period", "first", "first_at"]) for p in parts]
        got = {tuple(r.values())[:4] for b in passages._matches(iter(batches)) for r in b.to_pylist()}
        assert got == want, size


def test_maxima_equal_plain_ones():
    rng = random.Random(5)
    tree, plain_values = passages.Maxima(30), {}
    for _ in range(2000):
        at = rng.randint(1, 30)
        if at in plain_values:
            tree.take(at)
            del plain_values[at]
        else:
            plain_values[at] = (rng.randint(0, 9) * 1.0, at)
            tree.put(at, plain_values[at])
        a, b = sorted((rng.randint(1, 30), rng.randint(1, 30)))
        assert tree.best(a, b) == max((v for k, v in plain_values.items() if a <= k <= b), default=passages.Maxima.NONE)


def exact_repeats(rows, least):
    """Words of each document that lie in a run of `least` words an earlier document holds, by comparing all."""
    held, out = {}, {}
    for d, t in sorted(rows):
        w = plain(t)
        runs = [tuple(w[i : i + least]) for i in range(len(w) - least + 1)]
        hit = set()
        for i, r in enumerate(runs):
            if held.get(r, d) < d:
                hit.update(range(i, i + least))
        for r in runs:
            held.setdefault(r, d)
        out[d] = hit
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_no_exact_passage_is_lost(spark, docs, seed):
    """Texts put together of parts of all lengths that many documents share, against all runs of 50 words."""
    rng = random.Random(seed)
    fresh = lambda n: [f"e{rng.randrange(3000)}" for _ in range(n)]
    parts = [fresh(rng.randint(5, 45)) for _ in range(25)] + [fresh(3) * rng.randint(2, 9) for _ in range(4)]
    order = list(range(len(parts)))
    rows = []
    for d in range(220):
        w = fresh(rng.randint(0, 30))
        for _ in range(rng.randint(0, 4)):
            at = rng.choice(order)
            w += sum((parts[(at + i) % len(parts)] for i in range(rng.randint(1, 3))), []) + fresh(rng.choice([0, 0, 1, 12]))
        rows.append((d, " ".join(w)))
    want = exact_repeats(rows, passages.MIN_WORDS)
    got = {r["key"]: {i for s in r["spans"] for i in range(s["start"], s["end"])} for r in passages.repeats(*keyed(docs(rows).repartition(3))).collect()}
    assert sum(bool(v) for v in want.values()) > 20
    for d, words in want.items():
        assert words <= got.get(d, set()), (d, sorted(words - got.get(d, set())))


def test_edited_passages_are_found(spark, docs):
    """Passages with a share of their words changed, put in or left out at random; identities of the edits themselves."""
    rng = random.Random(8)
    fresh = lambda n: [f"r{rng.randrange(20_000)}" for _ in range(n)]
    for rate, least in ((0.05, 0.99), (0.1, 0.9)):
        rows, later = [], []
        for d in range(100):
            passage, copy = fresh(100), []
            for w in passage:
                kind = rng.random() / rate
                copy += [w] if kind >= 1 else ["changed"] if kind < 0.6 else [] if kind < 0.8 else [w, "added"]
            rows += [(d, " ".join(fresh(40) + passage + fresh(40))), (1000 + d, " ".join(fresh(40) + copy + fresh(40)))]
            later.append(1000 + d)
        found = {r["key"] for r in passages.repeats(*keyed(docs(rows))).collect()}
        assert found <= set(later) and len(found) >= least * len(later), (rate, len(found))


def test_clashing_columns(spark, docs):
    text = " ".join(f"q{i}" for i in range(90))
    df = docs([(1, text), (2, text), (3, "other words")])
    for name in ("_key", "_of", "_spans", "_s", "first", "spans", "chain"):
        df = df.withColumn(name, F.lit(name))
    got = passages.cut(df)
    assert got.columns == df.columns
    assert sorted((r["doc_id"], r["_key"], r["_of"]) for r in got.collect()) == [(1, "_key", "_of"), (3, "_key", "_of")]
