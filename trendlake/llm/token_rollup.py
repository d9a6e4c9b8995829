"""Token counts by source, language and tokenizer version as delta-maintained rollups.

A batch of changes becomes signed rows in a ledger: an insert adds a document and its tokens, a
delete takes away what the ledger holds of the document, and a revised count does both. The
ledger's rows are summed per batch into the rollup, whose totals are sums over batches, so no
batch rereads the corpus. What a batch must take away is found by joining the ledger on its
documents only; ``compact`` folds the ledger of old batches into one table of what they hold.

A batch is written under its number, and counts only once its commit is written, last. Writing
it again, after a failure or by mistake, replaces the same files with the same rows: the ledger
that it reads is that of smaller batch numbers. A committed batch is not written again, and a
different content under its number is refused.

A document is known by its id and its text's hash, so rows that share an id, or have none, keep
their own counts, and totals are sums over all rows.

Defined results: a change of kind ``insert`` or ``revise`` sets a document's count under a
tokenizer, whether or not there was one; ``delete`` with a null tokenizer takes away all of its
counts, and of an unknown document nothing. Several counts for one document and tokenizer in a
batch are so many copies of it, which all count, and deletes come before counts. Null ids, hashes,
sources, languages and tokens (as 0) are values like others. An empty batch commits nothing but
its number; the totals of no batch are empty.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.llm import common, packing
from trendlake.sinks.writers import path_exists

CHANGE = "doc_id long, text_hash long, kind string, source string, lang string, tokenizer string, tokens long"
LEDGER = "doc_id long, text_hash long, source string, lang string, tokenizer string, docs long, tokens long"
ROLLUP = "source string, lang string, tokenizer string, docs long, tokens long"
COMMIT = "batch long, n long, checksum long"
BASE = "base"
DOCUMENT = ["doc_id", "text_hash"]


def _read(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def commits(spark: SparkSession, root: str) -> dict[int, tuple[int, int]]:
    """Committed batches, ascending, with what identifies their content."""
    if not path_exists(spark, f"{root}/commits"):
        return {}
    rows = spark.read.schema(COMMIT).option("recursiveFileLookup", "true").parquet(f"{root}/commits").collect()  # one per batch
    return {r["batch"]: (r["n"], r["checksum"]) for r in sorted(rows, key=lambda r: r["batch"])}


def _ledger(spark: SparkSession, root: str, batches: list[int]) -> DataFrame:
    """Ledger rows of ``batches``, the compacted ones as what they hold together."""
    folded = max((b for b in batches if path_exists(spark, f"{root}/{BASE}/{b}/_SUCCESS")), default=None)
    paths = [f"{root}/ledger/{b}" for b in batches if folded is None or b > folded]
    return _read(spark, paths + ([] if folded is None else [f"{root}/{BASE}/{folded}"]), LEDGER)


def _held(ledger: DataFrame) -> DataFrame:
    sums = ledger.groupBy(*DOCUMENT, "source", "lang", "tokenizer").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    return sums.where("docs <> 0 or tokens <> 0")


def _same(columns: list[str]):
    found = F.lit(True)
    for c in columns:
        found = found & F.col(f"h.{c}").eqNullSafe(F.col(f"c.{c}"))
    return found


def deltas(changes: DataFrame, held: DataFrame) -> DataFrame:
    """Signed ledger rows that bring what is ``held`` to what ``changes`` say."""
    counted = (F.count(F.lit(1)).alias("docs"), F.sum(F.coalesce("tokens", F.lit(0).cast("long"))).alias("tokens"))
    sets = changes.where("kind <> 'delete'").groupBy(*DOCUMENT, "source", "lang", "tokenizer").agg(*counted)
    gone = changes.where("kind = 'delete'").select(*DOCUMENT, "tokenizer").distinct()
    whole = gone.where("tokenizer is null").select(*DOCUMENT)
    single = gone.where("tokenizer is not null").union(sets.select(*DOCUMENT, "tokenizer")).distinct()
    h = held.alias("h")
    away = h.join(whole.alias("c"), _same(DOCUMENT), "left_semi").union(h.join(single.alias("c"), _same([*DOCUMENT, "tokenizer"]), "left_semi")).distinct()
    minus = away.select(*DOCUMENT, "source", "lang", "tokenizer", (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"))
    return minus.union(sets)


def commit(spark: SparkSession, root: str, batch: int, changes: DataFrame) -> bool:
    """Apply a batch of ``changes``; False if just this batch was committed before."""
    changes = changes.select(*[F.col(c.split(" ")[0]).cast(c.split(" ")[1]).alias(c.split(" ")[0]) for c in CHANGE.split(", ")])
    mark = changes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64(F.to_json(F.struct("*")))), F.lit(0).cast("long")).alias("checksum")).first()
    done = commits(spark, root)
    if batch in done:
        if done[batch] != tuple(mark):
            raise ValueError(f"batch {batch} was committed with other changes")
        return False
    if done and batch < max(done):
        raise ValueError(f"batch {batch} comes after batch {max(done)}")
    signed = deltas(changes, _held(_ledger(spark, root, list(done))))
    signed.write.mode("overwrite").parquet(f"{root}/ledger/{batch}")
    written = _read(spark, [f"{root}/ledger/{batch}"], LEDGER)
    rollup = written.groupBy("source", "lang", "tokenizer").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    rollup.where("docs <> 0 or tokens <> 0").write.mode("overwrite").parquet(f"{root}/rollup/{batch}")
    row = spark.range(1).select(F.lit(batch).cast("long").alias("batch"), F.lit(mark["n"]).alias("n"), F.lit(mark["checksum"]).alias("checksum"))
    row.coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/{batch}")
    return True


def compact(spark: SparkSession, root: str) -> None:
    """Fold the ledger of all committed batches into one table of what they hold."""
    done = list(commits(spark, root))
    if done:
        _held(_ledger(spark, root, done)).write.mode("overwrite").parquet(f"{root}/{BASE}/{done[-1]}")


def totals(spark: SparkSession, root: str) -> DataFrame:
    """source, lang, tokenizer, documents and tokens over all committed batches."""
    rows = _read(spark, [f"{root}/rollup/{b}" for b in commits(spark, root)], ROLLUP)
    sums = rows.groupBy("source", "lang", "tokenizer").agg(F.sum("docs").alias("documents"), F.sum("tokens").alias("tokens"))
    return sums.where("documents <> 0 or tokens <> 0")


@lru_cache(maxsize=8)
def counter(path: str) -> Callable[[str], int]:
    """Counts the tokens of a text by the vocabulary file at ``path``: ``tiktoken`` ranks, or a file of ``tokenizers``."""
    if not path.endswith(".tiktoken"):
        ids = packing.ids_of(path)
        return lambda text: len(ids.of(text)) // 4
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(encoding.encode_ordinary(text))


def token_counts(docs: DataFrame, tokenizers: dict[str, str]) -> DataFrame:
    """doc_id, text_hash, source, lang and a column of token counts of the whole text per tokenizer (name: path)."""
    paths = list(tokenizers.values())

    def count(texts: pd.Series) -> pd.Series:
        counters = [counter(p) for p in paths]
        return pd.Series([[c(t) for c in counters] for t in texts], dtype=object)

    counted = docs.select("doc_id", common.text_hash().alias("text_hash"), "source", "lang", F.pandas_udf(count, "array<long>")(common.whole_text()).alias("n"))
    return counted.select("doc_id", "text_hash", "source", "lang", *[F.get("n", F.lit(i)).alias(name) for i, name in enumerate(tokenizers)])


def document_feed(docs: DataFrame, tokenizers: dict[str, str]) -> list[DataFrame]:
    """Three batches of changes made from whole documents, for two tokenizer versions.

    Batch 1 inserts every document with its count by the first tokenizer. Batch 2 revises all of
    them to count an end token too, and inserts the counts of the second tokenizer. Batch 3 deletes
    the copies of a text: all rows of it but those of its smallest id (null last).
    """
    old, new = tokenizers
    counted = common.materialize(token_counts(docs, tokenizers), "counted")

    def change(kind: str, tokenizer: str | None, tokens: F.Column | None, of: DataFrame = counted) -> DataFrame:
        count = F.lit(None) if tokens is None else tokens
        return of.select(*DOCUMENT, F.lit(kind).alias("kind"), "source", "lang", F.lit(tokenizer).cast("string").alias("tokenizer"), count.cast("long").alias("tokens"))

    # written, so that a text in very many documents is split among tasks by the join
    ids = counted.select(*DOCUMENT).distinct()
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("least")
    first = common.materialize(ids.groupBy("text_hash").agg(least, F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "firsts")
    copies = counted.join(first, "text_hash").where(~F.col("doc_id").eqNullSafe(F.col("least.doc_id")))
    return [
        change("insert", old, F.col(old)),
        change("revise", old, F.col(old) + 1).union(change("insert", new, F.col(new))),
        change("delete", None, None, copies),
    ]
