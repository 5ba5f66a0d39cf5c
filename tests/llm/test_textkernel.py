import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from understory.llm import textkernel as tk

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    return WORD.findall((text or "").translate(LOW))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aAbZ09éÉß \n\t.-_~\x7f　"), max_size=40)), max_size=8), st.integers(1, 30))
def test_words_and_shingles_equal_a_plain_split(texts, limit):
    got, counts, sets = [], [], []
    for first, end, raw, offsets in tk.slices(pa.array(texts, pa.string()), limit):
        found = tk.words(raw, offsets)
        counts += found.counts.tolist()
        got += [bytes(raw[a:b]).decode().translate(LOW) for a, b in zip(found.starts, found.ends, strict=True)]
        hashes, bounds = tk.shingles(found, 3)
        sets += [hashes[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert end > first
    want = [plain(t) for t in texts]
    assert counts == [len(w) for w in want]
    assert got == [w for ws in want for w in ws]
    grams = [[tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else [] for w in want]
    assert [len(s) for s in sets] == [len(g) for g in grams]
    known = {}
    for hashes, words in zip(sets, grams, strict=True):
        for h, g in zip(hashes, words, strict=True):
            assert known.setdefault(h, g) == g
    assert len(known) == len(set(known.values()))


def test_a_sliced_array_keeps_its_rows():
    column = pa.array(["one two", "three", None, "four five six"]).slice(1)
    counts = [n for _, _, raw, offsets in tk.slices(column) for n in tk.words(raw, offsets).counts]
    assert counts == [1, 0, 3]


def test_words_longer_than_a_slice():
    text = "a" * 50 + " b"
    (first, end, raw, offsets) = next(tk.slices(pa.array([text]), 8))
    assert (first, end) == (0, 1) and tk.words(raw, offsets).counts.tolist() == [2]
    assert np.array_equal(tk.words(raw, offsets).ends, [50, 52])
