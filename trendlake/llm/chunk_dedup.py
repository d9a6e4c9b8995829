"""Substring dedup by content-defined chunking with a gear rolling hash.

1. A gear hash rolls over each text's UTF-8 bytes (each byte shifts it by one bit and adds a
   table entry; 16 bytes determine it). A chunk begins where the hash is the least among the
   REACH places on either side, so chunks vary in length, and a boundary depends on less than 50
   bytes around it: an insertion moves boundaries near it only. Runs without such a place are cut
   at MAX_CHUNK bytes.
2. Chunks are deduplicated over the corpus by 64-bit digest: of equal chunks the first (by
   doc_id, null last, then text hash and place) stays. Digests are counted before any chunk is
   joined, and only repeated ones are.
3. Neighbouring repeated chunks of a document merge into spans; spans of ``min_bytes`` or more, and
   those that are whole documents, are reported, so that single short chunks that are equal by
   chance, or by a collision of digests, are left alone.

Defined results: a null or empty text has no chunk. Repeated document rows are judged alike (so
none of them is a copy of the other). Texts of any length are chunked whole, a piece at a time.
Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from xxhash import xxh3_64_intdigest

from trendlake.llm import common
from trendlake.llm.common import TEXT_HASH

ROLL = (1, 2, 4, 8)  # doubling steps: 16 bytes in a hash
REACH = 16
MAX_CHUNK = 1024
MIN_BYTES = 150
PAD = 64  # zero bytes around each text, more than any boundary looks at
PIECE = 1 << 20  # bytes hashed at a time
CHUNK = f"doc_id long, {TEXT_HASH} long, no int, start int, stop int, bytes int, last boolean, digest long"


def _gear() -> np.ndarray:
    """One 32-bit entry per byte value, by the mixing steps of splitmix64."""
    x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def boundaries(data: np.ndarray) -> np.ndarray:
    """Places in ``data`` where a chunk may begin; ``data`` has PAD zero bytes at both ends."""
    found = []
    for begin in range(PAD, len(data) - PAD, PIECE):
        low, high = begin - PAD, min(begin + PIECE, len(data) - PAD) + PAD
        h = GEAR[data[low:high]]
        for step in ROLL:
            h = h + np.concatenate([np.zeros(step, np.uint32), h[:-step] << np.uint32(step)])
        least = h
        for step in ROLL:  # the least of REACH = 16 places from each on
            least = np.minimum(least[:-step], least[step:])
        at = np.arange(PAD, len(h) - PAD)
        found.append(begin - PAD + at[(h[at] < least[at - REACH]) & (h[at] <= least[at + 1])])
    return np.concatenate(found) if found else np.empty(0, np.int64)


def chunk_batch(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Chunks of several texts: index of the text, first and end code point, bytes, digest."""
    blank = bytes(PAD)
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    buffer = blank + blank.join(encoded) + blank
    sizes = np.array([len(e) for e in encoded], np.int64)
    first = PAD + np.concatenate([[0], np.cumsum(sizes + PAD)[:-1]]).astype(np.int64)
    data = np.frombuffer(buffer, np.uint8)
    letter = (data & 0xC0) != 0x80
    cuts = boundaries(data)
    cuts = cuts + np.argmax(letter[cuts[:, None] + np.arange(4)], axis=1)  # on to the next code point
    cuts = np.unique(np.concatenate([cuts, first[sizes > 0]]))
    owner = np.searchsorted(first, cuts, side="right") - 1
    inside = cuts < first[owner] + sizes[owner]
    cuts, owner = cuts[inside], owner[inside]
    end = np.minimum(np.append(cuts[1:], len(buffer)), first[owner] + sizes[owner])
    long = np.nonzero(end - cuts > MAX_CHUNK)[0]
    if len(long):
        more = np.concatenate([np.arange(cuts[i] + MAX_CHUNK, end[i], MAX_CHUNK) for i in long])
        more = more + np.argmax(letter[more[:, None] + np.arange(4)], axis=1)
        cuts = np.unique(np.concatenate([cuts, more]))
        owner = np.searchsorted(first, cuts, side="right") - 1
        inside = cuts < first[owner] + sizes[owner]
        cuts, owner = cuts[inside], owner[inside]
        end = np.minimum(np.append(cuts[1:], len(buffer)), first[owner] + sizes[owner])
    digest = np.fromiter((xxh3_64_intdigest(buffer[a:b]) for a, b in zip(cuts.tolist(), end.tolist())), np.uint64, len(cuts))
    points = np.concatenate([[0], np.cumsum(letter, dtype=np.int64)])
    base = points[first[owner]]
    return owner, points[cuts] - base, points[end] - base, end - cuts, digest.view(np.int64)


def chunks(docs: DataFrame) -> DataFrame:
    """Every chunk: doc_id, text hash, its number, code points [start, stop), bytes, whether it ends its text, and digest."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            group = (batch["t"].str.len().cumsum() // PIECE).to_numpy()  # of bounded size, or one text
            for _, rows in batch.groupby(group, sort=False):
                owner, start, stop, size, digest = chunk_batch(rows["t"].tolist())
                first = np.searchsorted(owner, owner, side="left")
                yield pd.DataFrame({
                    "doc_id": rows["doc_id"].astype("Int64").array[owner], TEXT_HASH: rows[TEXT_HASH].to_numpy()[owner],
                    "no": np.arange(len(owner)) - first, "start": start, "stop": stop, "bytes": size,
                    "last": np.append(owner[1:] != owner[:-1], True)[: len(owner)], "digest": digest,
                })

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_hash().alias(TEXT_HASH), common.whole_text().alias("t"))
    return chosen.mapInPandas(cut, CHUNK)


def repeated_spans(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Every repeated span, once per document row's id and text: doc_id, text hash, start, stop
    (code points, end exclusive), bytes, and ``first_doc_id``, where its first chunk stays."""
    each = chunks(docs)
    again = each.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    copies = common.materialize(each.join(again.hint("merge"), "digest"), "chunks")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col(TEXT_HASH), F.col("no"))
    # written, so that the join has an exchange of its own and a digest of very many chunks is split among tasks
    first = common.materialize(copies.groupBy("digest").agg(F.min(place).alias("first")), "firsts")
    later = copies.join(first, "digest").where(place != F.col("first")).select(
        "doc_id", TEXT_HASH, "no", "start", "stop", "bytes", "last", F.col("first.doc_id").alias("first_doc_id")
    )
    inside = Window.partitionBy("doc_id", TEXT_HASH).orderBy("no")  # one document's chunks
    runs = later.distinct().withColumn("run", F.col("no") - F.row_number().over(inside))
    return (
        runs.groupBy("doc_id", TEXT_HASH, "run")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("bytes").alias("bytes"), F.min_by("first_doc_id", "no").alias("first_doc_id"), F.max("last").alias("last"))
        .where((F.col("bytes") >= min_bytes) | ((F.col("start") == 0) & F.col("last"))).drop("run", "last")
    )


def dedup_substrings(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``docs`` with the repeated spans cut out of the texts; n_chars follows, if there is that column."""
    spans = repeated_spans(docs, min_bytes).groupBy("doc_id", TEXT_HASH).agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("s"))
    spans = common.materialize(spans.select("doc_id", TEXT_HASH, F.col("s.start").alias("starts"), F.col("s.stop").alias("stops")), "spans")

    def without(texts: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.Series:
        def one(text, begin, end):
            if text is None or begin is None:
                return text
            keep = zip([0, *end], [*begin, len(text)])
            return "".join(text[a:b] for a, b in keep)

        return pd.Series([one(*row) for row in zip(texts, starts, stops)], dtype=object)

    rows = docs.select(F.struct("*").alias("row"), "doc_id", common.text_hash().alias(TEXT_HASH)).alias("d")
    joined = rows.join(spans.alias("s"), common.same_row("d", "s"), "left")
    joined = joined.select("d.row", F.pandas_udf(without, StringType())("d.row.text", "s.starts", "s.stops").alias("left"))
    changed = {"text": F.col("left")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("left") == F.col("row.text"), F.col("row.n_chars")).otherwise(F.length("left").cast("long"))
    return joined.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
