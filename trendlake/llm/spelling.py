"""Spelling variant grouping by PartEnum signatures over letter multisets.

1. Words are counted over the whole corpus, in each task before any shuffle.
2. A word's letters are a binary vector: one place per letter and occurrence number. One inserted
   or deleted letter changes one place, a replaced one two, so near words differ in at most two
   places. Places are dealt by hash into PARTS parts; in at least one of them near words differ
   in at most LEFT = 1 place. Each part is dealt into SUBPARTS, of which all but LEFT must then
   agree: every choice of SUBPARTS - LEFT of them is hashed to a signature, so that near words
   share at least one.
3. Words are joined on equal signatures. As anagrams share all of theirs, the join's key also
   holds what any two words one edit apart have in common: half of the longer one, at its
   beginning or its end. Each pair is verified by its edit distance.
4. A word's form is its most frequent near word, if frequent enough; forms are followed to their
   last by pointer jumping, in as many rounds as the logarithm of the longest chain.

Defined results: a null text has no words; a null doc_id counts as an empty one. Repeated rows
count each time. Words of any length are kept whole. Ties between near words go to the smallest
in code-point order. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from trendlake.llm import common

RUN = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT = 5, 3
FACTOR = 2  # a form is at least so many times as frequent
SPOILT = 97  # one of so many runs loses a letter, in the query
DISTANCE, PARTS, SUBPARTS = 2, 2, 3
LEFT = -(-(DISTANCE + 1) // PARTS) - 1  # differing places in the part where there are fewest
SIDES = 2
BANDED = 64  # longer words are verified in linear time


def spoilt(run: Column, doc_id: Column) -> Column:
    """``run`` without one letter where its hash with the document's id says so, for trying the grouping."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % SPOILT == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def words(docs: DataFrame, spoil: bool = False) -> DataFrame:
    """Words of at least LEAST_LENGTH code points and LEAST_COUNT occurrences: word, n."""
    text = common.lower_ascii(common.whole_text())
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    word = spoilt(F.col("run"), F.col("doc_id")) if spoil else F.col("run")
    counted = runs.select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


@lru_cache(maxsize=1 << 16)
def _place(letter: str, occurrence: int) -> tuple[int, int, int]:
    """Hash, part and subpart of one place of the vector."""
    h = xxh3_64_intdigest(f"{letter}{occurrence}".encode("utf-8", "surrogatepass"))
    return h >> 1, h % PARTS, h // PARTS % SUBPARTS


def signatures(word: str) -> list[int]:
    """The signatures of a word's letters: two words within DISTANCE places share at least one."""
    seen: dict[str, int] = {}
    sums = [[0] * SUBPARTS for _ in range(PARTS)]
    for letter in word:
        seen[letter] = occurrence = seen.get(letter, 0) + 1
        h, part, sub = _place(letter, occurrence)
        sums[part][sub] ^= h
    found = []
    for part in range(PARTS):
        for chosen in combinations(range(SUBPARTS), SUBPARTS - LEFT):
            held = ",".join([str(part), *(f"{sub}:{sums[part][sub]}" for sub in chosen)])
            found.append(xxh3_64_intdigest(held.encode()) - (1 << 63))
    return found


def signed(counted: DataFrame) -> DataFrame:
    """``counted`` with the signatures of each word."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(signatures=[signatures(w) for w in batch["word"]])

    return counted.select("word", "n").mapInPandas(sign, "word string, n long, signatures array<long>")


def _one_edit(a: Column, b: Column) -> Column:
    """Whether ``b``, no longer than ``a``, differs from it by one edit, in linear time: from the first difference on, one is skipped."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x.eqNullSafe(y))
    at = F.array_position(same, F.lit(False)).cast("int")
    rest = F.when(F.length(a) == F.length(b), F.substr(b, at + 1)).otherwise(F.substr(b, at))
    return F.substr(a, at + 1) == rest


def near_pairs(counted: DataFrame) -> DataFrame:
    """Every pair of words one edit apart, once: a, a_n, b, b_n, where a is the longer or, of equal length, the smaller."""
    held = common.materialize(signed(counted), "signatures")

    def half(length: Column, side: Column) -> Column:
        size = F.floor(length / 2).cast("int")
        return F.when(side == 0, F.left("word", size)).otherwise(F.right("word", size))

    def keyed(lengths: list[Column]) -> DataFrame:
        """A row per signature, side and length of the longer word that this word may pair with."""
        each = held.withColumn("side", F.explode(F.array(*[F.lit(i) for i in range(SIDES)])))
        each = each.withColumn("long", F.explode(F.array(*lengths)) if len(lengths) > 1 else lengths[0])
        each = each.withColumn("half", F.xxhash64("long", "side", half(F.col("long"), F.col("side"))))
        each = each.withColumn("signature", F.explode("signatures"))
        return each.select(F.xxhash64("half", "signature").alias("key"), "word", "n", "side")

    size = F.length("word")
    longer, other = keyed([size]).alias("a"), keyed([size, size + 1]).drop("side").alias("b")
    a, b = F.col("a.word"), F.col("b.word")
    start = F.floor(F.length(a) / 2).cast("int")
    met = longer.join(other, (F.col("a.key") == F.col("b.key")) & ((F.length(b) < F.length(a)) | ((F.length(b) == F.length(a)) & (b > a))))
    met = met.where((F.col("a.side") == 0) | (F.left(a, start) != F.left(b, start)))  # else found by its beginning
    met = met.where(F.when(F.length(a) <= BANDED, F.levenshtein(a, b, 1) == 1).otherwise(_one_edit(a, b)))
    return met.select(a.alias("a"), F.col("a.n").alias("a_n"), b.alias("b"), F.col("b.n").alias("b_n")).distinct()


def forms(counted: DataFrame) -> DataFrame:
    """Every word: word, n, n_near, form and form_n (null without one)."""
    counted = common.materialize(counted, "words")
    two = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("m")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("m")),
    )
    sides = near_pairs(counted).select(F.explode(two).alias("x")).select("x.*")
    best = sides.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("least"), "other")).alias("x"))
    frequent = -F.col("x.least") >= FACTOR * F.col("n")
    return counted.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(frequent, F.col("x.other")).alias("form"), F.when(frequent, -F.col("x.least")).alias("form_n"),
    )


def variant_groups(counted: DataFrame) -> DataFrame:
    """Every word with its form and its root: word, form, root, n, n_near, form_n."""
    found = common.materialize(forms(counted), "forms")
    links = found.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        a, b = links.alias("a"), links.alias("b")
        jumped = a.join(b, F.col("a.root") == F.col("b.word"), "left").select(
            "a.word", F.coalesce("b.root", "a.root").alias("root"), F.col("b.root").isNotNull().alias("moved")
        )
        links = common.materialize(jumped, "roots")
        if links.where("moved").isEmpty():
            break
    return found.join(links.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
