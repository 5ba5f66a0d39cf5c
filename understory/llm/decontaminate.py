"""Benchmark decontamination in DataFrame operations.

The items' word windows form a hash set that is broadcast when its counted size is
within a bound (joined by shuffle beyond it).  One scan tests every window of every
document: three of its words are hashed and looked up in a bit set made of the items'
windows, what passes is looked up by the hash of all its words, and a hit is verified
word by word before it counts.  The bit set only passes windows over that no item has.
Windows are never written or shuffled, only hits and one row a document.

Defined results: null or empty texts have no words, are hit by nothing and are no item;
an item of fewer words than a window is one window of its own length; an item without
id is left out; rows of the same id and text get equal results, a row each; other
columns are ignored by contaminated() and kept by clean(), whatever their names; a very
long text is one row of words, read whole; empty tables give empty results or none
contaminated.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from understory.llm.common import fresh, saved

WINDOW = 10
#: Windows (about 200 bytes each), and items by window, that are broadcast at most, and hit documents.
BROADCAST_WINDOWS = 400_000
BROADCAST_DOCS = 500_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text: runs of 0-9, a-z and non-ASCII characters after lower-casing A-Z."""
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(low, _GAP), "")


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(h, n, words, items): each distinct window with the ids of its items."""
    items = benchmark.where("item_id IS NOT NULL").select("item_id", words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    items = items.withColumn("n", F.least(F.size("w"), F.lit(window)))
    each = items.select("item_id", "n", F.explode(F.expr("transform(sequence(0, size(w) - n), i -> slice(w, i + 1, n))")).alias("words"))
    return each.groupBy("n", "words").agg(F.collect_set("item_id").alias("items")).select(F.xxhash64("words").alias("h"), "n", "words", "items")


def _bit_set(table: DataFrame, count: int) -> tuple[str, int]:
    """SQL of an array of longs with a bit set for three words of each window, and the bits of its index.

    16 bits a window at least, and 1 MB at most however many windows there are.
    """
    power = max(10, min(17, math.ceil(math.log2(max(1, count) * 16 / 64))))
    h = F.expr(_probe("words", "0", "n"))
    place = F.shiftrightunsigned(h, 64 - power).alias("place")
    rows = table.select(place, F.expr(f"shiftleft(1L, cast({_probe('words', '0', 'n')} & 63 AS int))").alias("bit")).groupBy("place").agg(F.bit_or("bit").alias("bits"))
    longs = [0] * (1 << power)
    for place, bits in rows.collect():  # 2 ** power rows at most
        longs[place] = bits
    return f"cast(split('{','.join(map(str, longs))}', ',') AS array<bigint>)", power


def _probe(words: str, at: str, n: str) -> str:
    """SQL hash of the first, middle and last of n words from a place on."""
    return f"xxhash64({words}[{at}], {words}[{at} + cast({n} div 2 AS int)], {words}[{at} + {n} - 1], {n})"


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", all_rows: bool = True) -> DataFrame:
    """One row for each row of docs (only hit ones unless all_rows).

    id, _text (hash of the text), n_words, spans (hit ranges of words as start and
    end, merged and ordered), n_hit (words within them), items (ids, as an array).
    """
    table = saved(windows(benchmark, window), "windows")
    lengths = [r[0] for r in table.select("n").distinct().orderBy("n").collect()]  # `window` values at most
    count, pairs = table.agg(F.count("*"), F.coalesce(F.sum(F.size("items")), F.lit(0))).first()
    lookup = F.broadcast(table) if max(count, pairs) <= BROADCAST_WINDOWS else table
    bits, power = _bit_set(table, count)
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("_text"), words_of(F.col(text_col)).alias("w"))
    hashed = []
    for n in lengths:
        probed = f"transform(sequence(0, size(w) - {n}), i -> {_probe('w', 'i', str(n))})"
        places = f"array_compact(transform({probed}, (h, i) -> if(getbit({bits}[cast(shiftrightunsigned(h, {64 - power}) AS int)], cast(h & 63 AS int)) = 1, i, NULL)))"
        hashed.append(F.expr(f"if(size(w) >= {n}, transform({places}, i -> named_struct('at', i, 'n', {n}, 'h', xxhash64(slice(w, i + 1, {n})), 'words', slice(w, i + 1, {n}), 'size', cast(NULL AS int))), array())"))
    # a document's own row has no words and meets nothing; its hash deals it evenly where the join shuffles
    mark = F.array(F.struct(F.lit(-1).alias("at"), F.lit(0).alias("n"), F.xxhash64("id", "_text").alias("h"), F.lit(None).cast("array<string>").alias("words"), F.size("w").alias("size")))
    probes = base.select("id", "_text", F.inline(F.concat(*([mark] if all_rows else []), *hashed) if hashed or all_rows else F.slice(mark, 1, 0)))
    same = (F.col("p.n") == F.col("b.n")) & (F.col("p.h") == F.col("b.h")) & (F.col("p.words") == F.col("b.words"))
    found = probes.alias("p").join(lookup.alias("b"), same, "left" if all_rows else "inner")
    if all_rows:
        found = found.where("p.at < 0 OR b.words IS NOT NULL")
    found = found.select("p.id", "p._text", F.col("p.size").alias("n_words"), F.expr("if(p.at < 0, NULL, struct(p.at, p.at + p.n AS end))").alias("span"), "b.items")
    grouped = found.groupBy("id", "_text").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.count("n_words").alias("rows"),
        F.array_sort(F.collect_set("span")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    merged = F.expr("""
        aggregate(spans, cast(array() AS array<struct<at: int, end: int>>), (done, s) ->
          if(size(done) > 0 AND done[size(done) - 1].end >= s.at,
             concat(slice(done, 1, size(done) - 1), array(struct(done[size(done) - 1].at AS at, greatest(done[size(done) - 1].end, s.end) AS end))),
             concat(done, array(struct(s.at AS at, s.end AS end)))))""")
    hit = F.expr("""
        aggregate(spans, struct(0L AS n, 0 AS upto), (acc, s) ->
          struct(acc.n + greatest(0, s.end - greatest(s.at, acc.upto)) AS n, greatest(acc.upto, s.end) AS upto)).n""")
    rows = grouped.withColumn("n_hit", hit).withColumn("spans", merged)
    if all_rows:
        rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("rows")))).drop("_copy")
    return rows.drop("rows").withColumnRenamed("id", id_col)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs without those that hold a window of an item; all columns stay."""
    of, hashed = fresh(docs, "_of", "_hashed")
    found = contaminated(docs.select("doc_id", "text"), benchmark, window, all_rows=False)
    hit = saved(found.select(F.col("doc_id").alias(of), F.col("_text").alias(hashed)), "contaminated")
    hit = F.broadcast(hit) if hit.count() <= BROADCAST_DOCS else hit
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col(of)) & (F.xxhash64("text") == F.col(hashed)), "left_anti")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with a benchmark window go."""
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each row of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: DuckDB SQL for op10.
OP10_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
it AS (SELECT item_id, w, least(len(w), 10) AS n FROM iw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i + 1 : i + n], ' ') AS s FROM (SELECT item_id, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM it)),
lens AS (SELECT DISTINCT n FROM win),
dwin AS (SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS s FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM dw, lens WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, i, n FROM dwin JOIN win USING (n, s)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
