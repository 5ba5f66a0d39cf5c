"""Language ID by cross-parsing entropy.

For each language a suffix automaton of labelled text is built.  A text is parsed
greedily into the longest phrases that occur in the language's text; the language
that needs the fewest phrases, each weighed by the bits of a pointer into its text,
wins.

Texts are normalised to lower-case letters with single separators.  The automata are
completed into one transition table, so a step over one character of many texts
and all languages is a single gather; the bit 0 of an entry says that a phrase began.

Letters have codes of their own as far as they are frequent and are spelled in digits
beyond that, so any script is learned whole and tables stay narrow.

Defined results: a null text or one without letters is ``und`` with score 0; ties go
to the language of the smallest code; a letter no language has is spelled in digits that
match little; repeated rows get equal results, rows of a null or repeated id too; a very long text is parsed
whole; input columns of a made column's name are replaced, others kept; an empty table
gives an empty result; with no learned language every text is ``und``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from understory.llm.common import fresh, held, with_text_columns

#: Bounds of the learning sample for each language: documents, and normalised characters.
SAMPLE_DOCS = 64
SAMPLE_CHARS = 40_000
#: Bound over all languages: normalised characters, shared alike where each bound would pass it.
ALL_CHARS = 320_000
#: Characters of texts that are parsed side by side.
PARSE_CHARS = 12 << 20
#: Letters of a code of their own.  With more, the most frequent ones have them and any other
#: letter is spelled in digits, as many as the highest code point needs, from FIRST on.
SINGLE = 62
FIRST = SINGLE + 2
DIGITS = 64
PLACES = 4
#: A text of n letters is of no learned language where its phrases take 1 + STRANGE / sqrt(n) of its letters spelled singly, or more.
STRANGE = 4.0

FIELDS = [
    T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("phrases", T.LongType()),
    T.StructField("known_share", T.DoubleType()),
    T.StructField("spelled_share", T.DoubleType()),
    T.StructField("letters", T.LongType()),
]


def normalise(text: str) -> str:
    """Lower-case letters; each run of other characters is one space."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def sample(docs: DataFrame, train: Column, id_col: str = "doc_id", docs_each: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """Normalised learning text of each language: a bounded sample, the same at each run.

    A language's rows are dealt into docs_each parts by a hash of id and text, and the
    least hash of each part is taken; a row gives its first characters up to what the
    bound can use.  Where the languages would have more
    than ALL_CHARS together, each has an equal share.  Rows come to the driver by rank,
    so a repeated or null id brings no more of them.
    """
    rows = docs.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull())
    draw = F.xxhash64(F.col(id_col).cast("string"), F.xxhash64("text"))
    drawn = rows.select("lang", draw.alias("draw")).groupBy("lang", F.pmod("draw", F.lit(docs_each)).alias("part")).agg(F.min("draw").alias("draw"))
    chosen = [(r["lang"], r["draw"]) for r in drawn.collect()]  # docs_each rows a language at most
    if not chosen:
        return {}
    langs = {lang for lang, _ in chosen}
    chars = max(1, min(chars, ALL_CHARS // len(langs)))
    each = max(1000, 4 * chars // docs_each)
    found = rows.where(draw.isin([d for _, d in chosen])).select("lang", draw.alias("draw"), F.substring("text", 1, 2 * each).alias("text")).dropDuplicates(["lang", "draw"])
    by: dict[str, list[str]] = {}
    for r in sorted(found.collect(), key=lambda r: (r["lang"], r["draw"], r["text"])):
        by.setdefault(r["lang"], []).append(normalise(r["text"])[:each])
    return {lang: " ".join(t for t in texts if t)[:chars] for lang, texts in sorted(by.items()) if any(texts)}


def automaton(text: Sequence) -> list[dict]:
    """Transitions of the suffix automaton of a text; state 0 is the start."""
    out: list[dict] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(out)
        out.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in out[p]:
            out[p][c] = new
            p = link[p]
        if p >= 0:
            q = out[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(out)
                out.append(dict(out[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and out[p].get(c) == q:
                    out[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return out


@dataclass
class Tables:
    """Completed automata: codes by code point (0: none), one flat table, start entries and weights.

    known: code points that are letters of learning texts; spelled: letters of no code are
    spelled in digits, else a phrase each.
    """

    langs: list[str]
    codes: np.ndarray
    known: np.ndarray
    spelled: bool
    table: np.ndarray
    start: np.ndarray
    bits: np.ndarray
    letter_bits: float


def tables(texts: dict[str, str]) -> Tables:
    """The tables of all languages; a worker process keeps them until it needs another large object."""
    key = hashlib.sha256(repr(sorted(texts.items())).encode()).hexdigest()
    return held(key, lambda: _build(texts))


def _spell(points: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Codes of code points; letters without a code of their own as their digits, each place with digits for itself."""
    out = codes[points]
    rare = out == 0
    if not rare.any():
        return out
    lengths = np.where(rare, PLACES, 1)
    spelled = np.repeat(out, lengths)
    first = (np.cumsum(lengths) - lengths)[rare]
    for i in range(PLACES):
        spelled[first + i] = FIRST + ((points[rare] >> (6 * (PLACES - 1 - i))) & (DIGITS - 1))
    return spelled


def _build(texts: dict[str, str]) -> Tables:
    langs = sorted(texts)
    counts: dict[str, int] = {}
    for t in texts.values():
        for c in set(t):
            counts[c] = counts.get(c, 0) + t.count(c)
    counts.pop(" ", None)
    letters = sorted(counts, key=lambda c: (-counts[c], c))
    known = np.zeros(0x110000, bool)
    known[[ord(c) for c in letters]] = True
    codes = np.fromiter((0 if chr(i).isalpha() else 1 for i in range(0x110000)), np.uint8, 0x110000)
    for i, c in enumerate(letters[:SINGLE]):
        codes[ord(c)] = i + 2
    spelled = len(letters) > SINGLE
    width = FIRST + DIGITS * spelled
    points = [np.frombuffer(texts[x].encode("utf-32-le", "surrogatepass"), np.uint32) for x in langs]
    coded = [(_spell(p, codes) if spelled else codes[p])[: max(ALL_CHARS // len(langs), PLACES)].tolist() for p in points]
    # an automaton has two states a character at most; pages that none fills are never touched
    bound = sum(2 * len(text) + 2 for text in coded)
    kind = np.int32 if bound * width * 2 < 2**31 else np.int64
    rows = np.empty((bound, width), kind)
    start, base = [], 0
    for text in coded:
        out = automaton(text)
        states = len(out) + 1  # and one that each phrase starts from
        again = np.full(width, (base + states - 1) * width * 2 + 1, kind)
        for c, to in out[0].items():
            again[c] = (base + to) * width * 2 + 1
        rows[base : base + states] = again
        for s, edges in enumerate(out):
            for c, to in edges.items():
                rows[base + s, c] = (base + to) * width * 2
            edges.clear()
        start.append((base + states - 1) * width)
        base += states
    flat = rows[:base].ravel()
    bits = np.array([math.log2(max(2, len(x))) for x in coded])
    return Tables(langs, codes, known, spelled, flat, np.array(start, flat.dtype), bits, math.log2(max(2, len(letters))))


def phrase_counts(model: Tables, texts: list[np.ndarray]) -> np.ndarray:
    """Phrases of each coded text in each language: an array of texts by languages."""
    lengths = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-lengths, kind="stable")
    joined = np.concatenate([texts[i] for i in order]) if len(texts) else np.zeros(0, np.uint8)
    sorted_lengths = lengths[order]
    begin = np.cumsum(sorted_lengths) - sorted_lengths
    n, langs = len(texts), len(model.langs)
    state = np.repeat(model.start[:, None], n, axis=1)
    count = np.zeros((langs, n), np.int32)
    longest = int(sorted_lengths[0]) if n else 0
    alive = np.searchsorted(-sorted_lengths, -np.arange(1, longest + 1), side="right")
    table, lanes = model.table, n
    position = begin.copy()
    for m in alive.tolist():
        if m < lanes:
            lanes = m
            done, state = state, np.ascontiguousarray(state[:, :m])
            del done
            position = position[:m]
        step = table[state + joined[position]]
        count[:, :m] += step & 1
        state = step >> 1
        position += 1
    out = np.empty((n, langs), np.int64)
    out[order] = count.T
    return out


def coder(model: Tables, text: str | None) -> tuple[np.ndarray, int, int]:
    """(codes, letters, known letters) of a text, with single separators; no codes without letters."""
    if not text:
        return np.zeros(0, np.uint8), 0, 0
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    gap = model.codes[points] == 1
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    keep[0] = not gap[0]
    letters, known = int((~gap).sum()), int(model.known[points].sum())
    codes = _spell(points[keep], model.codes) if model.spelled else model.codes[points[keep]]
    return (codes[:-1] if len(codes) and codes[-1] == 1 else codes), letters, known


def predict(model: Tables | None, column: pa.Array) -> list[pa.Array]:
    """Arrays of FIELDS for the texts of a batch."""
    texts = column.to_pylist()
    nothing = ("und", 0.0, 0, 0.0, 0.0, 0)
    out: list[tuple] = []
    at = 0
    while at < len(texts):
        coded, size = [], 0
        while at < len(texts) and size < PARSE_CHARS:
            coded.append(coder(model, texts[at]) if model else (None, 0, 0))
            size += len(coded[-1][0]) if model else 0
            texts[at] = None
            at += 1
        if not model:
            out += [nothing] * len(coded)
            continue
        counts = phrase_counts(model, [c for c, _, _ in coded])
        cost = counts * model.bits
        best = cost.argmin(axis=1)
        for (_, letters, known), row, raw, i in zip(coded, cost, counts, best.tolist(), strict=True):
            if not letters:
                out.append(nothing)
                continue
            others = np.delete(row, i)
            second = others.min() if len(others) else np.inf
            score = 1.0 if not np.isfinite(second) else second / (second + row[i])
            out.append((model.langs[i], float(score), int(raw[i]), known / letters, float(row[i] / (letters * model.letter_bits)), letters))
    columns = zip(*out, strict=True) if out else [()] * len(FIELDS)
    return [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.float64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()), strict=True)]


def identify(docs: DataFrame, texts: dict[str, str], text_col: str = "text", names: Sequence[str] = tuple(f.name for f in FIELDS)) -> DataFrame:
    """docs with lang_pred, score, phrases, known_share, spelled_share and letters of each whole text.

    texts: learning text by language, from sample().  score is second / (best +
    second) of the weighed phrase counts: 0.5 for a tie, nearer 1 the clearer.
    known_share: the share of the letters that some language has.  spelled_share: the
    bits of the best language's phrases over those of its letters spelled one by one;
    the nearer 1, the less any learned language helps.
    """

    def kernel():
        model = tables(texts) if texts else None
        return lambda column: predict(model, column)

    return with_text_columns(docs, text_col, [T.StructField(n, f.dataType) for n, f in zip(names, FIELDS, strict=True)], kernel)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents of no learned language go; others that have no label get the predicted one.

    A document goes where it has no letters, where most of them are in no learned
    language, or where parsing by the best language takes more bits than spelling its letters singly (unknown scripts, noise), by a margin that
    falls with their number.
    """
    texts = sample(docs, F.lit(True))
    names = fresh(docs, *(f.name for f in FIELDS))
    lang, _, _, known, spelled, letters = (F.col(n) for n in names)
    kept = identify(docs, texts, names=names).where((lang != "und") & (known > 0.5) & (spelled < 1 + STRANGE / F.sqrt(letters)))
    return kept.select(*(F.coalesce("lang", lang).alias("lang") if c == "lang" else F.col(c) for c in docs.columns))


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, phrases of each row of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    texts = sample(docs, ~held_out)
    found = identify(docs.select("doc_id", "text"), texts)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "phrases")
