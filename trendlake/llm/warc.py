r"""WARC archives: a writer with revisit records, and a reader by boundary-chain verification.

Writing uses Spark's text sink: a record's head and block are one value, and the line separator
CR LF CR LF ends the record, so archives land through the commit protocol on any file system.
Of equal payloads of at least ``min_revisit`` bytes the row with the smallest page_id (null last)
is a response; the others are revisits that refer to it and hold no payload.

Reading doesn't trust the magic ``WARC/1.``, which payloads may hold as well:

1. Spark splits the files at the magic, wherever blocks of a file begin. Each task numbers the
   pieces of its blocks, parses what may be a head, and emits for each candidate record its
   offset and that of its successor (by Content-Length). A candidate's chain is followed inside
   its block at once, so it also carries its exit: where the chain leaves the block.
2. Running sums of block lengths turn offsets in blocks into offsets in files.
3. Pointer jumping over the exits, from the start of each file, doubles the step every round:
   the entries of all blocks are marked after log2(blocks of a file) rounds.
4. From its entry each block marks its reachable records. Any other candidate is payload of the
   record before it; such pieces go back to their record, bounded by that record's length.

Defined results: a null html is an empty payload. Payloads may be of any length and hold any
bytes, heads and magic included. Repeated pages give repeated records; of equal payloads all
rows with the smallest page_id are responses. A file that doesn't begin with a record, or the
rest of one whose chain breaks, gives no records. Empty tables and folders give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendlake.llm import common
from trendlake.session import scratch_dir

MAGIC = "WARC/1."  # no proper end of it is a beginning of it, so splits agree wherever they start
END = "\r\n\r\n"
MIN_REVISIT = 100
REPEAT_BITS = 1 << 20
ID = "urn:page:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
DATE = "2024-01-01T00:00:00Z"  # archives are made from undated pages

SCANNED = "file string, block long, no long, at long, size long, next long, exit long"


def _digested(pages: DataFrame) -> DataFrame:
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    page = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"))
    return page.withColumns({"digest": F.sha2("payload", 256), "bytes": F.octet_length("payload")})


def write_warc(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) as WARC files under ``path``."""
    page = _digested(pages)
    # only payloads that come again are looked up; the copies of one spread over tasks by their ids
    again = page.where(F.col("bytes") >= min_revisit).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")
    )
    again = common.materialize(again.where("n > 1").select("digest", "first"), "again")
    # a set of fixed size tells most payloads that come once; only the others meet the join
    hash_ = F.xxhash64("digest")
    known = common.hash_set(again.select(hash_.alias("h")), REPEAT_BITS)
    maybe = common.may_be_in(hash_, known, REPEAT_BITS)
    once = page.where(~maybe).withColumn("first", F.lit(None).cast("long"))
    joined = once.unionByName(page.where(maybe).join(again, "digest", "left"))
    revisit = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    name = F.concat(F.lit(ID), F.coalesce(F.col("page_id").cast("string"), F.lit("null")))
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "")
    kind = F.when(revisit, "revisit").otherwise("response")
    head = F.concat_ws(
        "\r\n",
        F.lit(MAGIC + "1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: <"), name, F.lit(">")),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.when(revisit, F.concat(F.lit(f"WARC-Refers-To: <{ID}"), F.col("first").cast("string"), F.lit(">"))),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, 0).otherwise(F.col("bytes")).cast("string")),
    )
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))  # a cast keeps the bytes
    joined.select(F.concat(head, F.lit(END), block).alias("value")).write.option("lineSep", END).text(path)


def _head(piece: bytes) -> tuple[str | None, int, int]:
    """Head text, where the block begins and its length, if ``piece`` (after the magic) starts a record."""
    end = piece.find(b"\r\n\r\n")
    if end < 0 or not re.match(rb"[01]\r\n", piece):
        return None, 0, -1
    head = piece[:end].decode("utf-8", "replace")
    length = re.search(r"\r\nContent-Length:[ \t]*([0-9]+)[ \t]*(?:\r\n|$)", head, re.IGNORECASE)
    return (head, end + 4, int(length[1])) if length else (None, 0, -1)


def _exits(block: pd.DataFrame) -> pd.DataFrame:
    """Adds each candidate's exit: the first offset on its chain that is no later candidate of the block."""
    ahead: dict[int, int] = {}
    exits = []
    for at, after in zip(block["at"][::-1], block["next"][::-1]):
        if after >= 0:
            ahead[at] = ahead.get(after, after)
            exits.append(ahead[at])
        else:
            exits.append(-1)
    return block.assign(exit=exits[::-1])


def scan(spark: SparkSession, path: str) -> DataFrame:
    """One row per piece between magics: its block, offset there, candidate successor and exit.

    ``at`` is where the piece's magic begins, counted from the block's first whole piece.
    """
    m = len(MAGIC)

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, rows, at = None, [], 0

        def done() -> pd.DataFrame:
            return _exits(pd.DataFrame(rows, columns=["file", "block", "no", "at", "size", "next"]))

        for batch in batches:
            for file, block, piece in zip(batch["file"], batch["block"], batch["piece"]):
                if (file, block) != now:
                    if rows:
                        yield done()
                    now, rows, at = (file, block), [], 0
                _, skip, length = _head(piece)
                # the chain counts from the magic before the piece, the lengths from the piece
                after = at + skip + length + len(END) if length >= 0 else -1
                rows.append((file, block, len(rows), at - m, len(piece), after))
                at += len(piece) + m
        if rows:
            yield done()

    return _pieces(spark, path).mapInPandas(number, SCANNED)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("piece")
    )


def entries(scanned: DataFrame) -> DataFrame:
    """Per block: file, block, its ``base`` in the file, the offset of its ``entry`` (its first
    reachable record, if any), and the last record before it with that one's successor."""
    m = len(MAGIC)
    lengths = scanned.groupBy("file", "block").agg(F.sum(F.col("size") + m).alias("length"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = lengths.select("file", "block", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("base"))
    placed = scanned.select("file", "block", "no", "at", "next", "exit", "size").join(bases, ["file", "block"])
    placed = placed.select(
        "file", "block", "no", (F.col("at") + F.col("base")).alias("offset"), "size",
        F.when(F.col("next") >= 0, F.col("next") + F.col("base")).alias("next"),
        F.when(F.col("exit") >= 0, F.col("exit") + F.col("base")).alias("exit"),
    )
    placed = common.materialize(placed, "pieces")
    # nodes of the jump: each file's start and every candidate that some chain enters a block by
    candidates = placed.where("next is not null").select("file", "offset", "exit")
    entered = candidates.where("exit is not null").select("file", F.col("exit").alias("offset")).distinct()
    starts = placed.where("offset = 0").select("file", "offset")
    nodes = candidates.join(entered.union(starts).distinct(), ["file", "offset"])
    jump = common.materialize(nodes, "jump")
    known = jump.select("file", "offset")
    marked = common.materialize(known.where("offset = 0"), "marked")
    blocks = lengths.groupBy("file").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    for _ in range(blocks.bit_length()):
        steps = jump.withColumnRenamed("exit", "to")
        onward = marked.join(steps, ["file", "offset"]).select("file", F.col("to").alias("offset"))
        marked = common.materialize(marked.union(onward.join(known, ["file", "offset"], "left_semi")).distinct(), "marked")
        twice = jump.toDF("file", "offset", "mid").join(jump.toDF("file", "mid", "exit"), ["file", "mid"]).select("file", "offset", "exit")
        jump = common.materialize(twice.where("exit is not null"), "jump")
    entry = marked.withColumn("entry", F.lit(True))
    joined = placed.join(entry, ["file", "offset"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    walked = joined.groupBy("file", "block").applyInPandas(_walk, "file string, block long, entry long, owner long, due long")
    # a block's first pieces may belong to the last record of an earlier block
    record = F.when(F.col("owner").isNotNull(), F.struct("owner", "due"))
    carried = walked.select("file", "block", "entry", F.last(record, True).over(before).alias("carried"))
    return bases.join(carried, ["file", "block"]).select(
        "file", "block", "base", "entry", F.col("carried.owner").alias("carried_owner"), F.col("carried.due").alias("carried_due")
    )


def _walk(block: pd.DataFrame) -> pd.DataFrame:
    """Of one block: its entry and, from there, its last record with that one's successor."""
    block = block.sort_values("no")
    first = owner = due = last = None
    for offset, after, entry in zip(block["offset"], block["next"], block["entry"]):
        if entry or offset == due:
            first = offset if entry else first
            owner, due = (None, None) if pd.isna(after) else (offset, int(after))
            last = (owner, due) if owner is not None else last
    owner, due = last or (None, None)
    row = {"file": block["file"].iloc[0], "block": block["block"].iloc[0], "entry": first, "owner": owner, "due": due}
    return pd.DataFrame([row]).astype({"entry": "Int64", "owner": "Int64", "due": "Int64"})


def _records(pieces: list[bytes], file: str, base: int, entry: int | None, owner: int | None, due: int | None) -> list[tuple]:
    """Rows of one block, from its pieces in order: whole records (part -1, the block as data) and
    parts of records that lie in several pieces."""
    rows, start, own, m = [], base, None, len(MAGIC)
    due = -1 if due is None else due
    for piece in pieces:
        offset = start - m
        if offset == entry or offset == due and own is not None:
            head, skip, length = _head(piece)
            own, due = (offset, start + skip + length + len(END)) if length >= 0 else (None, -1)
            if own is not None and len(piece) >= skip + length:
                rows.append((file, own, -1, head, skip, length, piece[skip : skip + length]))
            elif own is not None:
                rows.append((file, own, offset, head, skip, length, piece))
        elif offset < due and (own if own is not None else owner) is not None:
            rows.append((file, own if own is not None else owner, offset, None, None, None, MAGIC.encode() + piece))
        start += len(piece) + m
    return rows


RECORD = "file string, owner long, part long, head string, skip long, length long, data binary"


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["file", "owner", "part", "head", "skip", "length", "data"])
    return frame.astype({"skip": "Int64", "length": "Int64"})


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every verified record: file, offset, head (text) and payload (the whole block).

    Few entries (one per block of a file) go to all tasks, so no payload is shuffled but those
    of records that hold the magic; if there are many, blocks are joined with them.
    """
    found = common.materialize(entries(common.materialize(scan(spark, path), "scanned")), "entries")
    pieces = _pieces(spark, path)
    if common.small(found):
        known = {(r["file"], r["block"]): r[2:] for r in found.collect()}

        def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            now, held = None, []
            for batch in batches:
                for file, block, piece in zip(batch["file"], batch["block"], batch["piece"]):
                    if (file, block) != now and held:
                        yield _frame(_records(held, now[0], *known[now]))
                        held = []
                    now = (file, block)
                    held.append(piece)
            if held:
                yield _frame(_records(held, now[0], *known[now]))

        records = pieces.mapInPandas(read, RECORD)
    else:

        def read_block(block: pd.DataFrame) -> pd.DataFrame:
            block = block.sort_values("no")
            values = [None if pd.isna(v) else int(v) for v in block[["base", "entry", "carried_owner", "carried_due"]].iloc[0]]
            return _frame(_records(block["piece"].tolist(), block["file"].iloc[0], *values))

        numbered = pieces.mapInPandas(_number, "file string, block long, piece binary, no long")
        records = numbered.join(found, ["file", "block"]).groupBy("file", "block").applyInPandas(read_block, RECORD)
    single = records.where("part = -1").select("file", F.col("owner").alias("offset"), "head", "length", F.col("data").alias("payload"))
    # one record's own pieces, so no more than its length
    gathered = records.where("part <> -1").groupBy("file", "owner").agg(
        F.array_sort(F.collect_list(F.struct("part", "data"))).alias("x"), *[F.max(c).alias(c) for c in ("head", "skip", "length")]
    )
    whole = gathered.withColumn("piece", F.aggregate(F.col("x.data"), F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p)))
    rejoined = whole.select("file", F.col("owner").alias("offset"), "head", "length", _block("piece").alias("payload"))
    return single.union(rejoined).where("octet_length(payload) = length").drop("length")


def _number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Numbers the pieces of each block."""
    now, no = None, 0
    for batch in batches:
        numbers = []
        for key in zip(batch["file"], batch["block"]):
            now, no = key, (no + 1 if key == now else 0)
            numbers.append(no)
        yield batch.assign(no=numbers)


def _block(piece: str) -> Column:
    """The block in a record's bytes: after the head, as long as the head says."""
    return F.substring(F.col(piece), (F.col("skip") + 1).cast("int"), F.col("length").cast("int"))


def header(name: str) -> Column:
    return F.regexp_extract("head", rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1)


def archive(pages: DataFrame, path: str | None = None, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write ``pages`` as WARC, read the archives back, and resolve revisits.

    Per record: page_id, payload_bytes, payload_digest (both of the full payload, measured on the
    response's bytes as read), record_type and refers_to.
    """
    path = path or scratch_dir(pages.sparkSession, "warc")
    write_warc(pages, path, min_revisit)
    number = lambda c: F.nullif(F.regexp_extract(c, rf"<{ID}([^>]*)>", 1), F.lit("null"))
    records = read_warc(pages.sparkSession, path).select(
        number(header("WARC-Record-ID")).cast("long").alias("page_id"),
        F.octet_length("payload").cast("long").alias("bytes"),
        F.sha2("payload", 256).alias("digest"),
        F.substring_index(header("WARC-Payload-Digest"), ":", -1).alias("stated"),
        header("WARC-Type").alias("record_type"),
        F.nullif(number(header("WARC-Refers-To")), F.lit("")).cast("long").alias("refers_to"),
    )
    records = common.materialize(records, "records")
    target = records.where("record_type = 'response'").groupBy("page_id", "digest").agg(F.first("bytes").alias("bytes"))
    r, t = records.alias("r"), target.alias("t")
    same = (F.col("r.refers_to") == F.col("t.page_id")) & (F.col("r.stated") == F.col("t.digest"))
    return r.join(t, same, "left").select(
        "r.page_id",
        F.when(F.col("r.record_type") == "revisit", F.col("t.bytes")).otherwise(F.col("r.bytes")).alias("payload_bytes"),
        F.when(F.col("r.record_type") == "revisit", F.col("t.digest")).otherwise(F.col("r.digest")).alias("payload_digest"),
        "r.record_type", "r.refers_to",
    )
