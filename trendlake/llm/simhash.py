"""SimHash near-dedup with a Gray-order hierarchical index.

1. Each whole text gives a 64-bit fingerprint of its word shingles (an Arrow-batched function).
2. Equal fingerprints collapse to one, so copies, however many, cost one entry.
3. The distinct fingerprints are range-partitioned and sorted by Gray rank, in which neighbours
   share long bit patterns, and cut into blocks. A block stores the bits that all its members
   share (``mask``, ``bits``); blocks factor into partition nodes, those sixteen at a time into
   upper nodes, each with what its children share.
4. Pairs of nodes descend from the root: a pair's differences are accumulated over the bits
   both share and no ancestor pair has counted, and a pair with more than ``max_bits`` is pruned
   with all below it. Each level is one equi-join on the parents' ids.
5. The surviving block pairs are compared in tasks, again leaf by leaf of shared patterns. A task
   returns a spanning forest of the links it finds, so a dense group of m fingerprints yields
   fewer than m rows per block pair, and no connection is lost.
6. Components of the forests give each document the smallest id reachable.

Defined results: a null or empty text, or one of white space, has no words and fingerprint zero,
which links like any other. Fewer words than a shingle form one shingle. Null ids take part but
are no smallest id unless a component has no other. Repeated rows stay in ``near_duplicates`` and
one of them in ``deduplicate``. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from xxhash import xxh64_intdigest

from trendlake.llm import common
from trendlake.llm.common import TEXT_HASH
from trendlake.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BLOCK = 4096  # fingerprints in a block, the unit that travels
LEAF = 64  # fingerprints in a leaf inside a task
FAN = 4  # bits: an upper node has 16 children
CHUNK = 1 << 16  # shingles hashed at a time

_BYTE_AT = np.arange(8, dtype=np.uint16) * 256
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash as an unsigned integer: a bit is 1 if over half the shingle hashes set it."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    if count == 1:
        return xxh64_intdigest(b" ".join(words), seed)
    tuples = zip(*(words[k:] for k in range(shingle)))
    hashes = map(xxh64_intdigest, map(b" ".join, tuples), repeat(seed))
    ones = np.zeros(64, np.int64)
    for begin in range(0, count, CHUNK):
        part = np.fromiter(hashes, np.dtype("<u8"), min(CHUNK, count - begin))
        seen = np.bincount((part.view(np.uint8).reshape(-1, 8) + _BYTE_AT).ravel(), minlength=2048).reshape(8, 256)
        ones += (seen @ _BITS).ravel()
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text hash and ``fp`` (the fingerprint's 64 bits as a signed long) of every row."""

    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return docs.select("doc_id", common.text_hash().alias(TEXT_HASH), F.pandas_udf(of, LongType())(common.whole_text()).alias("fp"))


def gray_rank(fp: Column) -> Column:
    """The place of ``fp`` in Gray order, as a long that sorts like the unsigned rank."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def _shared(fps: np.ndarray) -> tuple[int, int]:
    mask = ~(np.bitwise_or.reduce(fps) ^ np.bitwise_and.reduce(fps))
    return int(mask), int(fps[0] & mask)


def blocks(fps: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks of at most ``block`` distinct fingerprints, consecutive in Gray order: id, partition, fps, mask, bits."""
    parts = max(1, math.ceil(fps.count() / block))
    ordered = fps.select("fp", gray_rank(F.col("fp")).alias("rank")).repartitionByRange(parts, "rank").sortWithinPartitions("rank")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, pid, made = np.empty(0, np.int64), 0, 0

        def rows(pieces: list[np.ndarray]) -> pd.DataFrame:
            shared = [_shared(p) for p in pieces]
            numbers = range(made, made + len(pieces))
            mask, bits = zip(*shared)
            return pd.DataFrame({"pid": pid, "no": numbers, "fps": pieces, "mask": mask, "bits": bits})

        for batch in batches:
            if len(batch):
                pid = int(batch["pid"].iloc[0])
                held = np.concatenate([held, batch["fp"].to_numpy()])
                full = [held[i : i + block] for i in range(0, len(held) - block + 1, block)]
                if full:
                    yield rows(full)
                    made, held = made + len(full), held[len(full) * block :]
        if len(held):
            yield rows([held])

    made = ordered.select("fp", F.spark_partition_id().cast("long").alias("pid")).mapInPandas(
        cut, "pid long, no long, fps array<long>, mask long, bits long"
    )
    # a block's id keeps its partition in the upper bits
    return made.withColumn("id", F.shiftleft("pid", 32).bitwiseOR(F.col("no")))


def _parents(nodes: DataFrame, parent: Column) -> DataFrame:
    differ = F.bit_or("bits").bitwiseXOR(F.bit_and("bits"))
    return (
        nodes.groupBy(parent.alias("id"))
        .agg(F.bit_and("mask").alias("m"), differ.alias("x"), F.bit_and("bits").alias("b"))
        .select("id", F.col("m").bitwiseAND(F.bitwise_not("x")).alias("mask"), F.col("b").alias("bits"))
        .withColumn("bits", F.col("bits").bitwiseAND(F.col("mask")))
    )


def block_pairs(made: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b) of block ids, a <= b, that may hold a link, by descent through the tree."""
    leaves = made.select("id", "mask", "bits", F.col("pid").alias("parent"))
    levels = [leaves]
    nodes, top = _parents(leaves, F.col("parent")), made.agg(F.max("pid")).first()[0] or 0
    while True:
        above = F.shiftright("id", FAN) if top else F.lit(0).cast("long")
        nodes = nodes.withColumn("parent", above)
        levels.append(nodes)
        if top >> FAN == 0:
            break
        nodes, top = _parents(nodes.select("id", "mask", "bits", F.col("parent")), F.col("parent")), top >> FAN
    zero = F.lit(0).cast("long")
    pairs = made.sparkSession.range(1).select(zero.alias("a"), zero.alias("b"), zero.alias("counted"), zero.alias("diff"))
    for nodes in reversed(levels):
        x = nodes.select(*[F.col(c).alias(f"x_{c}") for c in ("id", "mask", "bits", "parent")])
        y = nodes.select(*[F.col(c).alias(f"y_{c}") for c in ("id", "mask", "bits", "parent")])
        both = F.col("x_mask").bitwiseAND(F.col("y_mask"))
        fresh = F.col("x_bits").bitwiseXOR(F.col("y_bits")).bitwiseAND(both).bitwiseAND(F.bitwise_not("counted"))
        pairs = (
            pairs.join(x, F.col("a") == F.col("x_parent"))
            .join(y, (F.col("b") == F.col("y_parent")) & (F.col("x_id") <= F.col("y_id")) & (F.col("diff") + F.bit_count(fresh) <= max_bits))
            .select(
                F.col("x_id").alias("a"), F.col("y_id").alias("b"), F.col("counted").bitwiseOR(both).alias("counted"),
                (F.col("diff") + F.bit_count(fresh)).cast("long").alias("diff"),
            )
        )
    return pairs.select("a", "b")


def _leaves(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shared masks and patterns of each run of LEAF fingerprints."""
    at = np.arange(0, len(fps), LEAF)
    ones, any_ = np.bitwise_and.reduceat(fps, at), np.bitwise_or.reduceat(fps, at)
    mask = ~(ones ^ any_)
    return mask, ones & mask


def link_forest(a: np.ndarray, b: np.ndarray, same: bool, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Edges (u, v) of a spanning forest of all links between (or, if ``same``, within) two sorted blocks."""
    a, b, size = a.view(np.uint64), b.view(np.uint64), len(a)
    (mask_a, bits_a), (mask_b, bits_b) = _leaves(a), _leaves(b)
    differ = np.bitwise_count((bits_a[:, None] ^ bits_b) & mask_a[:, None] & mask_b)
    near = differ <= max_bits
    left, right = np.nonzero(np.triu(near) if same else near)
    padded = [np.resize(x, -(-len(x) // LEAF) * LEAF) for x in (a, b)]  # the padding is cut off below
    rows, cols = (x.reshape(-1, LEAF) for x in padded)
    label = np.arange(size if same else size + len(b))
    for begin in range(0, len(left), 64):
        l, r = left[begin : begin + 64], right[begin : begin + 64]
        at, i, j = np.nonzero(np.bitwise_count(rows[l][:, :, None] ^ cols[r][:, None, :]) <= max_bits)
        u, v = l[at] * LEAF + i, r[at] * LEAF + j
        real = (u < size) & (v < len(b))
        u, v = u[real], v[real] + (0 if same else size)
        while len(u):
            lu, lv = label[u], label[v]
            apart = lu != lv
            if not apart.any():
                break
            u, v, lu, lv = u[apart], v[apart], lu[apart], lv[apart]
            np.minimum.at(label, np.maximum(lu, lv), np.minimum(lu, lv))
            while not np.array_equal(label, up := label[label]):
                label = up
    fps = a if same else np.concatenate([a, b])
    linked = np.nonzero(label != np.arange(len(label)))[0]
    return fps[linked].view(np.int64), fps[label[linked]].view(np.int64)


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Edges (u, v) between distinct fingerprints that keep every connection at ``max_bits`` or fewer bits."""
    made = common.materialize(blocks(fps, block), "blocks")
    data = made.select("id", "fps")
    pairs = common.materialize(block_pairs(made, max_bits), "pairs")
    both = pairs.join(data.toDF("a", "left"), "a").join(data.toDF("b", "right"), "b")

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                u, v = link_forest(np.asarray(row.left), np.asarray(row.right), row.a == row.b, max_bits)
                yield pd.DataFrame({"u": u, "v": v})

    return both.select("a", "b", "left", "right").mapInPandas(find, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Every document row: doc_id, text hash, fp and component_id (the smallest doc_id reachable)."""
    printed = common.materialize(fingerprints(docs, shingle), "simhash")
    fps = common.materialize(printed.groupBy("fp").agg(F.min("doc_id").alias("least")), "fps")
    rooted = components(links(fps, max_bits)).alias("c")
    classed = fps.alias("f").join(rooted, F.col("f.fp") == F.col("c.node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    classed = common.materialize(classed, "classes")
    least = classed.groupBy("root").agg(F.min("least").alias("component_id"))
    return printed.join(classed.join(least, "root").select("fp", "component_id", "root"), "fp").select(
        "doc_id", TEXT_HASH, "fp", "component_id", "root"
    )


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document row of each group: that with the smallest id (then text hash)."""
    found = near_duplicates(docs, shingle, max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", TEXT_HASH)).alias("first")
    chosen = found.groupBy("root").agg(first).select("first.doc_id", f"first.{TEXT_HASH}").alias("c")
    copies = found.groupBy("doc_id", TEXT_HASH).agg(F.count(F.lit(1)).alias("copies")).alias("n")
    kept = common.materialize(
        chosen.join(copies, common.same_row("c", "n")).select("c.doc_id", f"c.{TEXT_HASH}", "copies"), "kept"
    )
    rows = docs.select(F.struct("*").alias("row"), "doc_id", common.text_hash().alias(TEXT_HASH)).alias("d")
    joined = rows.join(kept.alias("k"), common.same_row("d", "k")).select("d.row", "d.doc_id", f"d.{TEXT_HASH}", "copies")
    once = joined.where("copies = 1")
    repeated = joined.where("copies > 1").dropDuplicates(["doc_id", TEXT_HASH])
    return once.union(repeated).select("row.*")
