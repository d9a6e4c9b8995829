"""Benchmark decontamination (DataFrame functions only).

The benchmark's texts become word windows (``size`` consecutive words; a shorter item is one
window). Their hashes form a set of fixed size, a bitmap of ``BITMAP_BITS`` bits that goes to
every task as a literal. Each document is scanned once: window hashes that fall on a set bit
leave the scan together with their words, and an exact join with the benchmark's windows
verifies them. That join is broadcast while the counted windows are few, else left to Spark.

Defined results: a null or empty text has no words, no hit and no item. Texts of any length are
scanned whole. Repeated document rows get equal results; repeated items and windows count once
per item id; a null item id hits words but is not listed. Empty tables give no rows or no hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm import common
from trendlake.llm.common import TEXT_HASH

WINDOW = 10
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after lower-casing A-Z
BITMAP_BITS = 1 << 20


def words(text: Column) -> Column:
    return F.filter(F.split(common.lower_ascii(text), SEPARATORS), lambda w: w != "")


def _hashes(size: int) -> str:
    """SQL: hashes of all windows of ``size`` words, from the word hashes in column w."""
    parts = ", ".join(f"w[i + {k}]" for k in range(size))
    return f"if(size(w) < {size}, array(), transform(sequence(0, size(w) - {size}), i -> xxhash64({parts})))"


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct (window, n, item_id); n is the number of words."""
    items = benchmark.select("item_id", words(common.whole_text()).alias("words")).where(F.size("words") > 0)
    cut = F.expr(f"transform(sequence(1, greatest(size(words) - {size} + 1, 1)), i -> slice(words, i, {size}))")
    return (
        items.select("item_id", F.explode(cut).alias("x"))
        .select(F.array_join("x", " ").alias("window"), F.size("x").alias("n"), "item_id")
        .distinct()
    )


def window_set(windows: DataFrame, sizes: list[int]) -> Column:
    """The set of the hashes of windows of ``sizes`` words, hashed as ``scan`` does."""
    split = windows.select(F.split("window", " ").alias("x"), "n").select(F.transform("x", lambda v: F.xxhash64(v)).alias("w"), "n")
    each = F.coalesce(F.lit(None).cast("long"), *[F.when(F.col("n") == k, F.expr(_hashes(k))[0]) for k in sizes])
    return common.hash_set(split.select(each.alias("h")).where("h is not null"), BITMAP_BITS)


def scan(docs: DataFrame, set_bits: Column, sizes: list[int]) -> DataFrame:
    """One row per document row: doc_id, text hash, n_words and the windows that may be in the set."""
    df = docs.select("doc_id", common.text_hash().alias(TEXT_HASH), words(common.whole_text()).alias("words"))
    df = df.withColumn("w", F.transform("words", lambda v: F.xxhash64(v)))
    for k in sizes:
        df = df.withColumn(f"h{k}", F.expr(_hashes(k)))
    df = df.drop("w")
    maybe = []
    for k in sizes:
        at = F.array_compact(F.transform(f"h{k}", lambda h, i: F.when(common.may_be_in(h, set_bits, BITMAP_BITS), i)))
        df = df.withColumn(f"p{k}", at).drop(f"h{k}")
        words_of = f"array_join(slice(words, i + 1, {k}), ' ')"
        maybe.append(F.expr(f"transform(p{k}, i -> struct(cast(i as bigint) as at, {k}L as n, {words_of} as window))"))
    empty = F.array().cast("array<struct<at:bigint,n:bigint,window:string>>")
    found = reduce(lambda a, b: F.concat(a, b), maybe, empty)
    return df.select("doc_id", TEXT_HASH, F.size("words").cast("long").alias("n_words"), found.alias("maybe"))


def covered(spans: str) -> str:
    """SQL: how many words the sorted (at, n) spans in column ``spans`` cover."""
    return (
        f"aggregate({spans}, struct(0L as words, 0L as upto), (a, x) -> struct("
        "a.words + greatest(0L, x.at + x.n - greatest(x.at, a.upto)) as words, greatest(a.upto, x.at + x.n) as upto), a -> a.words)"
    )


def find_hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Every document row: doc_id, text hash, n_words, n_hit, spans (at, n in words), items (sorted ids)."""
    windows = common.materialize(benchmark_windows(benchmark, size), "windows")
    sizes = sorted(r["n"] for r in windows.select("n").distinct().collect())  # at most ``size`` values
    scanned = common.materialize(scan(docs, window_set(windows, sizes), sizes), "scanned")
    few = common.small(windows)
    hint = F.broadcast if few else (lambda df: df)
    each = scanned.select("doc_id", TEXT_HASH, F.explode("maybe").alias("x")).select("doc_id", TEXT_HASH, "x.*")
    hits = each.join(hint(windows.select("window").distinct()), "window")
    spans = hits.groupBy("doc_id", TEXT_HASH).agg(F.sort_array(F.collect_set(F.struct("at", "n"))).alias("spans"))
    items = (
        hits.select("doc_id", TEXT_HASH, "window").distinct().join(hint(windows.select("window", "item_id")), "window")
        .where("item_id is not null").select("doc_id", TEXT_HASH, F.col("item_id").cast("string").alias("item")).distinct()
        .groupBy("doc_id", TEXT_HASH).agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    d, s, i = scanned.drop("maybe").alias("d"), spans.alias("s"), items.alias("i")
    return d.join(s, common.same_row("d", "s"), "left").join(i, common.same_row("d", "i"), "left").select(
        "d.doc_id", f"d.{TEXT_HASH}", "d.n_words",
        F.coalesce(F.expr(covered("s.spans")), F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("s.spans", F.array().cast("array<struct<at:bigint,n:bigint>>")).alias("spans"),
        F.coalesce("i.items", F.array().cast("array<string>")).alias("items"),
    )


def remove_spans(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """``docs`` with the hit words, and the separators after them, cut out of the texts.

    Documents without a hit keep their text as it is, null included.
    """
    kept = (
        "array_join(transform(filter(transform(words, (x, j) -> struct(x as x, cast(j as bigint) as j)), "
        "y -> not exists(spans, s -> y.j >= s.at and y.j < s.at + s.n)), y -> y.x), '')"
    )
    found = hits.where("n_hit > 0").select("doc_id", TEXT_HASH, "spans").dropDuplicates(["doc_id", TEXT_HASH]).alias("h")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", common.text_hash().alias(TEXT_HASH)).alias("d")
    joined = rows.join(found, common.same_row("d", "h"), "left").select("d.row", "h.spans")
    word = r"[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"  # as SEPARATORS, before lower-casing
    gap = r"[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]"
    joined = joined.withColumn("head", F.expr(f"regexp_extract(row.text, '^{gap}*', 0)"))
    joined = joined.withColumn("words", F.expr(f"if(spans is null, null, regexp_extract_all(row.text, '{word}{gap}*', 0))"))
    text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(F.concat("head", F.expr(kept)))
    return joined.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def remove_documents(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a window of the benchmark."""
    return common.keep_rows(docs, hits.where("n_hit > 0"), "left_anti")
