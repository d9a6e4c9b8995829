"""Quotation linking: reply-ordered conversations without quotes.

1. Each message's lines are parsed into quote levels (one per leading ``>``); runs of lines of a
   level, split at blank lines, are passages. A passage is hashed with ASCII case and white space
   normalised.
2. Passages of level 0 are a message's own. Per conversation and hash the earliest message that
   wrote a passage is its original: one row per key, however often the passage is repeated.
3. A message's parent is the latest original of its level-1 passages. A passage of level k + 1
   that follows one of level k tells of the parent of a message that itself quotes nothing.
   Passages that no message of the conversation wrote are looked up in the whole corpus and
   reported as foreign.
4. Pointer jumping over parents gives each message its root and depth in log2(depth) rounds. In
   the order (conversation, root, depth, turn) every message comes after its parent.

Defined results: a null text is empty; it has no passage and can't be quoted. Rows with a null
conversation or turn have no parent and are their own roots. Repeated rows, and rows that share
conversation and turn, are nodes of one message and share its links. Quoted passages that match
nothing link nothing, but go from the text like others. Empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_hexdigest

from trendlake.llm import common

QUOTE = re.compile(r"[ \t]*((?:>[ \t]?)+)")
BLANK = " \t\r"
LEVELS = 2  # how deep `quoted_replies` nests
PARSED = "conv_id long, turn long, role string, body string, own array<string>, quoted array<struct<level:int,hash:string,outer:string>>"


def passage_hash(passage: str) -> str | None:
    """Hash of a passage with white space runs as one space and A-Z as a-z; None if it has no word."""
    words = passage.encode("utf-8", "surrogatepass").lower().split()
    return xxh3_128_hexdigest(b" ".join(words)) if words else None


def parse(text: str) -> tuple[str, list[str], list[tuple[int, str, str | None]]]:
    """Own text, hashes of own passages, and quoted (level, hash, hash of the passage that quotes it)."""
    passages: list[tuple[int, list[str]]] = []
    own = []
    for line in text.split("\n"):
        quote = QUOTE.match(line)
        level, rest = (quote[1].count(">"), line[quote.end() :]) if quote else (0, line)
        if not level:
            own.append(line)
        if not rest.strip(BLANK):
            passages.append((-1, []))  # a blank line ends a passage
        elif passages and passages[-1][0] == level:
            passages[-1][1].append(rest)
        else:
            passages.append((level, [rest]))
    while own and not own[-1].strip(BLANK):
        own.pop()
    while own and not own[0].strip(BLANK):
        own.pop(0)
    mine, quoted, latest = [], [], {}
    for level, lines in passages:
        found = passage_hash("\n".join(lines))
        if found and level > 0:
            quoted.append((level, found, latest.get(level - 1)))
            latest[level] = found
        elif found:
            mine.append(found)
    return "\n".join(own), mine, quoted


def _parsed(messages: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            body, own, quoted = zip(*map(parse, batch["t"])) if len(batch) else ((), (), ())
            quoted = [[{"level": a, "hash": b, "outer": c} for a, b, c in q] for q in quoted]
            yield batch.drop(columns="t").assign(body=body, own=own, quoted=quoted).astype({"conv_id": "Int64", "turn": "Int64"})

    chosen = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", common.whole_text().alias("t"))
    return chosen.mapInPandas(run, PARSED)


def _links(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, turn, parent), and per message how many passages it quotes, links and finds elsewhere."""
    own = parsed.where("conv_id is not null and turn is not null").select("conv_id", "turn", F.explode("own").alias("hash"))
    original = common.materialize(own.groupBy("conv_id", "hash").agg(F.min("turn").alias("first")), "originals")
    quotes = common.materialize(parsed.select("conv_id", "turn", F.explode("quoted").alias("x")).select("conv_id", "turn", "x.*").distinct(), "quotes")
    here = quotes.join(original, ["conv_id", "hash"], "left").withColumn("known", F.coalesce(F.col("first") < F.col("turn"), F.lit(False)))
    direct = here.where("known and level = 1").groupBy("conv_id", "turn").agg(F.max("first").alias("parent"))
    # what a nested passage tells of the message that quoted it
    outer = original.select("conv_id", F.col("hash").alias("outer"), F.col("first").alias("child"))
    told = here.where("known and level > 1").join(outer, ["conv_id", "outer"]).where("first < child")
    told = told.groupBy("conv_id", F.col("child").alias("turn")).agg(F.max("first").alias("told"))
    parents = direct.join(told, ["conv_id", "turn"], "full").select("conv_id", "turn", F.coalesce("parent", "told").alias("parent"))
    corpus = original.select("hash").distinct().withColumn("elsewhere", F.lit(True))
    each = here.select("conv_id", "turn", "level", "hash", "known").distinct().join(corpus, "hash", "left")
    counts = each.groupBy("conv_id", "turn").agg(
        F.count(F.lit(1)).alias("n_quoted"), F.count_if("known").alias("n_linked"),
        F.count_if(~F.col("known") & F.col("elsewhere").isNotNull()).alias("n_foreign"),
    )
    return common.materialize(parents, "parents"), counts


def _roots(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, root, depth) of every message that has a parent."""
    now = common.materialize(parents.select("conv_id", "turn", F.col("parent").alias("up"), F.lit(1).cast("long").alias("depth")), "up")
    while True:
        above = now.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        stepped = now.join(above, ["conv_id", "up"], "left").select(
            "conv_id", "turn", F.coalesce("next", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("next").isNotNull().alias("moved"),
        )
        stepped = common.materialize(stepped, "up")
        if not stepped.where("moved").limit(1).count():
            return stepped.select("conv_id", "turn", F.col("up").alias("root"), "depth")
        now = stepped.drop("moved")


def link_conversations(messages: DataFrame) -> DataFrame:
    """Every message row without its quotes: conv_id, turn, role, text, parent_turn, root_turn, depth,
    n_quoted, n_linked and n_foreign passages."""
    parsed = common.materialize(_parsed(messages), "parsed")
    parents, counts = _links(parsed)
    key = ["conv_id", "turn"]
    found = parents.join(_roots(parents), key)
    joined = parsed.select("conv_id", "turn", "role", F.col("body").alias("text")).join(found, key, "left").join(counts, key, "left")
    none = F.lit(0).cast("long")
    return joined.select(
        "conv_id", "turn", "role", "text", F.col("parent").alias("parent_turn"), F.coalesce("root", "turn").alias("root_turn"),
        F.coalesce("depth", none).alias("depth"), *[F.coalesce(c, none).alias(c) for c in ("n_quoted", "n_linked", "n_foreign")],
    )


def reply_ordered(linked: DataFrame) -> DataFrame:
    """``linked`` sorted so that conversations lie together and replies follow what they answer."""
    return linked.orderBy("conv_id", "root_turn", "depth", "turn")


def quoted_replies(messages: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``messages`` as mails: below its text each quotes the turn before, that one's predecessor a level deeper, and so on.

    The turns are joined by number, so a long conversation is no large group.
    """
    texts = messages.where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(F.min(common.whole_text()).alias("t"))
    out = messages.select("conv_id", "turn", "role", common.whole_text().alias("text"))
    for level in range(1, levels + 1):
        earlier = texts.select("conv_id", (F.col("turn") + level).alias("turn"), F.col("t").alias("earlier"))
        quoted = F.concat(F.lit("\n\n"), F.regexp_replace("earlier", "(?m)^", "> " * level))
        out = out.join(earlier, ["conv_id", "turn"], "left").select(
            "conv_id", "turn", "role", F.concat("text", F.coalesce(quoted, F.lit(""))).alias("text")
        )
    return out
