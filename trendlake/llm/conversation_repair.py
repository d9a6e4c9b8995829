"""Conversation structure repair by an auction shortest-path algorithm.

A conversation's rows, in order, are a lattice: node (i, q) stands before row i with q for the
roles written so far (nothing, system, user, assistant). Arcs are edits: Keep, Rerole and Delete
lead to row i + 1, Insert stays before row i. A repaired conversation reads ``(s?(ua)+)?``.

1. Rows are numbered by a global sort and cut into blocks of BLOCK rows, so that no task holds a
   conversation; a row is one character there, its role's class and its fault.
2. Within a block, prices of the nodes are found column by column from the right. A path starts
   at a node; the node at its end is raised to its cheapest arc and the path contracted, or the
   path is extended along its tight arc that is least in ASCII, until it meets a node whose price
   has converged. Prices are integers and never above the true distances, so those on such a
   path are exact. A column starts from the least price of the next, so it takes a few steps.
3. Blocks of one conversation are joined by their 4 x 4 distances, composed by doubling over the
   blocks; this gives each block the prices behind it, and then, likewise, its first node.
4. With converged prices every tight arc is on a cheapest path, so the trace takes the
   ASCII-least tight arc at each node: the least audit of all cheapest ones.
5. The audit and the hash of the repaired text are folded in one pass over the sorted rows, a
   batch at a time: a hash over a whole conversation has to read it in order.

Defined results: null roles and texts are one space, a null conv_id is a conversation of its own.
Rows are taken by turn (nulls first), then role and text. Only a role that begins with s, u or a
can be kept; an empty one can't. Repeated rows are duplicates. A conversation without rows left
has no edits; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm import common
from trendlake.operators.ranking import distributed_row_number

BLOCK = 4096
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # costs; Keep is free
SPACE = " \t\n\x0b\x0c\r"
CLASSES = "sua"  # and others
CODES = "0123456789AB"  # 3 * class + (clean, truncated, to be deleted)
INSERTS = (("u", 2), ("u", 2), ("a", 3), ("u", 2))  # by state: role and next state
ABSENT = -1

Prices = list[int | None]


@lru_cache(maxsize=None)
def row_arcs(code: str) -> list[list[tuple[str, str, int, int]]]:
    """Arcs over a row by state, in ASCII order: edit, role (- none, k its own), next state, cost."""
    kind, fault = divmod(CODES.index(code), 3)
    found = []
    for state in range(4):
        arcs = [("D", "-", state, DELETE)]
        if fault < 2:
            more, (role, to) = TRUNCATED * fault, INSERTS[state]
            if CLASSES[kind : kind + 1] == role:
                arcs.append(("K", "k", to, more))
            elif state == 0 and kind == 0:
                arcs.append(("K", "k", 1, more))
            arcs.append(("R", role, to, REROLE + more))
        found.append(arcs)
    return found


END_ARCS = [[("", "", 0, 0)], [], [], [("", "", 0, 0)]]


def column(arcs: list[list[tuple[str, str, int, int]]], after: Prices) -> Prices:
    """Exact prices of a column's states, given those of the next; None where no path leads on."""
    ways = [[(cost + after[to], edit) for edit, _, to, cost in arcs[q] if after[to] is not None] for q in range(4)]
    alive = [bool(w) for w in ways]
    for _ in range(3):
        alive = [a or alive[INSERTS[q][1]] for q, a in enumerate(alive)]
    least = min((p for p in after if p is not None), default=0)
    price: Prices = [least if a else None for a in alive]
    done = [not a for a in alive]
    for origin in range(4):
        path = [] if done[origin] else [origin]
        while path:
            state = path[-1]
            to = INSERTS[state][1]
            options = ways[state] + ([(INSERT + price[to], "I")] if alive[to] else [])
            best = min(options)  # cheapest, then ASCII-least
            if price[state] < best[0]:
                price[state] = best[0]  # raise, and contract the path
                if len(path) > 1:
                    path.pop()
            elif best[1] != "I" or done[to]:
                for x in path:  # it meets a converged node
                    done[x] = True
                path = []
            else:
                path.append(to)
    return price


def columns(codes: str, right: Prices | None) -> list[Prices]:
    """Prices of a block's columns and of the one behind it; ``right`` is None behind the last row of all."""
    found = [column(END_ARCS, [0, None, None, None]) if right is None else right]
    for code in reversed(codes):
        found.append(column(row_arcs(code), found[-1]))
    return found[::-1]


def trace(codes: str, prices: list[Prices], state: int, last: bool) -> tuple[list[str], int]:
    """Steps of the ASCII-least cheapest path, per row (and behind the last one), and the state it ends in.

    A step is the edits before and of its row, two letters each: the edit and its role.
    """
    steps, step = [], ""
    for at, code in enumerate([*codes, ""] if last else codes):
        arcs = row_arcs(code) if code else END_ARCS
        while True:
            here, (role, to) = prices[at][state], INSERTS[state]
            after = prices[at + 1] if code else [0, None, None, None]
            tight = [(e, r, t) for e, r, t, cost in arcs[state] if after[t] is not None and here == cost + after[t]]
            if prices[at][to] is not None and here == INSERT + prices[at][to]:
                tight.append(("I", role, to))
            edit, role, to = min(tight)
            step += edit + role
            if edit != "I":
                break
            state = to
        steps.append(step)
        step, state = "", to if code else state
    return steps, state


def _class(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def key(column_: str = "conv_id") -> Column:
    """A conversation's id as a string that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(column_).cast("string")), F.lit(""))


def faulted(conversations: DataFrame) -> DataFrame:
    """Rows c, pos (from 1), turn, role, text and ``fault``: blank, duplicate, truncated or empty."""
    rows = conversations.select(
        key().alias("c"), "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text")
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = common.materialize(distributed_row_number(rows, ["c"], order, "pos"), "turns")
    # written, so that the join below has an exchange of its own, which can be split
    again = rows.groupBy("c", "role", "text").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    joined = rows.join(common.materialize(again, "again"), ["c", "role", "text"], "left")
    shown = F.rtrim("text", F.lit(SPACE))
    fault = (
        F.when(shown == "", "blank").when(F.col("pos") > F.col("first"), "duplicate")
        .when(~F.substring(shown, -1, 1).isin(".", "!", "?"), "truncated").otherwise("")
    )
    return joined.select("c", "pos", "turn", "role", "text", fault.alias("fault"))


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """c, block, n (rows of the conversation) and codes; from the second block on, the first code is that of the row before."""
    harm = F.when(F.col("fault").isin("blank", "duplicate"), 2).when(F.col("fault") == "truncated", 1).otherwise(0)
    code = F.substr(F.lit(CODES), 3 * _class(F.col("role")) + harm + 1, F.lit(1))
    number = F.floor((F.col("pos") - 1) / block)
    places = F.when(F.col("pos") % block == 0, F.array(number, number + 1)).otherwise(F.array(number))
    each = rows.select("c", "pos", code.alias("code"), F.explode(places).alias("block"))
    of = each.groupBy("c", "block").agg(F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("x"))  # at most a block and one
    sizes = rows.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    return of.join(sizes, "c").where(F.col("block") * block < F.col("n")).select("c", "block", "n", F.array_join("x.code", "").alias("codes"))


def _own(codes: str, block: int) -> str:
    return codes[1:] if block else codes


def _listed(prices: Prices) -> list[int]:
    return [ABSENT if p is None else p for p in prices]


def _prices(listed) -> Prices:
    return [None if p == ABSENT else int(p) for p in listed]


def _product(a, b) -> list[int]:
    """Distances over two neighbouring parts, 4 x 4 each."""
    ways = [[[a[4 * q + k] + b[4 * k + e] for k in range(4) if a[4 * q + k] != ABSENT and b[4 * k + e] != ABSENT] for e in range(4)] for q in range(4)]
    return [min(ways[q][e], default=ABSENT) for q in range(4) for e in range(4)]


def _scan(parts: DataFrame, combine: Callable, direction: int, most: int) -> DataFrame:
    """Each block's value composed with those of all blocks on one side, by doubling."""

    def both(mine: pd.Series, other: pd.Series) -> pd.Series:
        return pd.Series([a if b is None else combine(a, b) for a, b in zip(mine, other)], dtype=object)

    step = 1
    while step < most:
        a = parts.alias("a")
        b = parts.select("c", (F.col("block") - direction * step).alias("block"), F.col("v").alias("w")).alias("b")
        joined = a.join(b, ["c", "block"], "left")
        parts = common.materialize(joined.select("c", "block", F.pandas_udf(both, "array<long>")("v", "w").alias("v")), "scan")
        step *= 2
    return parts


def _placed(blocks: DataFrame, block: int) -> DataFrame:
    """``blocks`` with the prices behind each (null behind the last) and its first state."""
    most = blocks.agg(F.max("block")).first()[0]
    if not most:
        return blocks.withColumns({"behind": F.lit(None).cast("array<long>"), "state": F.lit(0).cast("long")})

    def distances(number: pd.Series, n: pd.Series, codes: pd.Series) -> pd.Series:
        found = []
        for b, rows, x in zip(number, n, codes):
            if (b + 1) * block >= rows:
                ends = [columns(_own(x, b), None)[0]] * 4
            else:
                ends = [columns(_own(x, b), [0 if q == e else None for q in range(4)])[0] for e in range(4)]
            found.append([ABSENT if ends[e][q] is None else ends[e][q] for q in range(4) for e in range(4)])
        return pd.Series(found, dtype=object)

    def exits(number: pd.Series, codes: pd.Series, behind: pd.Series) -> pd.Series:
        found = []
        for b, x, right in zip(number, codes, behind):
            own, last = _own(x, b), right is None
            prices = columns(own, None if last else _prices(right))
            found.append([trace(own, prices, q, last)[1] for q in range(4)])
        return pd.Series(found, dtype=object)

    several = blocks.where(F.col("n") > block)
    parts = common.materialize(several.select("c", "block", F.pandas_udf(distances, "array<long>")("block", "n", "codes").alias("v")), "scan")
    right = _scan(parts, _product, 1, most + 1).where("block > 0").select(
        "c", (F.col("block") - 1).alias("block"), F.transform(F.array(*[F.lit(4 * q) for q in range(4)]), lambda i: F.get("v", i)).alias("behind")
    )
    known = common.materialize(blocks.join(right, ["c", "block"], "left"), "priced")
    ends = known.where(F.col("n") > block).select("c", "block", F.pandas_udf(exits, "array<long>")("block", "codes", "behind").alias("v"))
    ends = _scan(common.materialize(ends, "scan"), lambda mine, before: [mine[int(q)] for q in before], -1, most + 1)
    first = ends.select("c", (F.col("block") + 1).alias("block"), F.get("v", F.lit(0)).alias("state"))
    return known.join(first, ["c", "block"], "left").withColumn("state", F.coalesce("state", F.lit(0).cast("long")))


def steps(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """c, pos, step of every row (and at n + 1 behind the last), illegal, cost; the last two are to be summed."""
    placed = _placed(common.materialize(_blocks(rows, block), "blocks"), block)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for c, b, codes, behind, state in zip(batch["c"], batch["block"], batch["codes"], batch["behind"], batch["state"]):
                own, last = _own(codes, b), behind is None
                prices = columns(own, None if last else _prices(behind))
                told, _ = trace(own, prices, int(state), last)
                kinds = [CODES.index(x) // 3 for x in codes]
                illegal = sum((x, y) not in ((0, 1), (1, 2), (2, 1)) for x, y in zip(kinds, kinds[1:]))
                cost = prices[0][0] if b == 0 else 0
                out += [(c, b * block + i + 1, s, 0 if i else illegal, 0 if i else cost) for i, s in enumerate(told)]
            yield pd.DataFrame(out, columns=["c", "pos", "step", "illegal", "cost"])

    return placed.select("c", "block", "codes", "behind", "state").mapInPandas(walk, "c string, pos long, step string, illegal long, cost long")


def repaired_rows(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Edits with their rows: c, pos (that of the row edited or stood before), step, role and text as they were, illegal, cost."""
    rows = common.materialize(faulted(conversations), "faulted")
    return _edited(rows, block)


def _edited(rows: DataFrame, block: int) -> DataFrame:
    return common.materialize(steps(rows, block), "steps").join(rows.select("c", "pos", "role", "text"), ["c", "pos"], "left")


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per conversation from rows sorted by conversation and place, whatever the batches' bounds."""
    names = {"u": "user", "a": "assistant"}
    now, audit, digest, illegal, cost, empty = None, [], None, 0, 0, True
    for batch in batches:
        out = []
        for c, step, role, text, wrong, price in zip(batch["c"], batch["step"], batch["role"], batch["text"], batch["illegal"], batch["cost"]):
            if c != now:
                if now is not None:
                    out.append((now, illegal, cost, "".join(audit), digest.hexdigest()))
                now, audit, digest, illegal, cost, empty = c, [], hashlib.sha256(), 0, 0, True
            illegal, cost = illegal + wrong, cost + price
            audit.append(step[::2])
            for edit, own in zip(step[::2], step[1::2]):
                if edit != "D":
                    line = f"{role if edit == 'K' else names[own]}:{'' if edit == 'I' else text}"
                    digest.update((line if empty else "\n" + line).encode("utf-8", "surrogatepass"))
                    empty = False
        if out:
            yield pd.DataFrame(out)
    if now is not None:
        yield pd.DataFrame([(now, illegal, cost, "".join(audit), digest.hexdigest())])


def repair(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per conversation with rows: c, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    rows = common.materialize(faulted(conversations), "faulted")
    turns = rows.groupBy("c", "turn").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    span = F.max("turn").cast("decimal(38,0)") - F.min("turn").cast("decimal(38,0)") + 1 - F.count("turn")
    counts = turns.groupBy("c").agg(
        F.coalesce(span.try_cast("long"), F.lit(0).cast("long")).alias("gaps"), *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")]
    )
    edits = _edited(rows, block).repartition("c").sortWithinPartitions("c", "pos")
    told = edits.mapInPandas(_fold, "c string, illegal long, cost long, audit string, repaired_sha256 string")
    return counts.join(told, "c")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by the crc32 of ``conv_id:turn``, for trying the repair: a twentieth of the turns each is
    dropped, emptied, robbed of its stops, said twice, or given to the user."""
    text = [F.coalesce(F.col(x).cast("string"), F.lit(" ")).alias(x) for x in ("role", "text")]
    named = F.concat_ws(":", *[F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn")])
    rows = conversations.select("conv_id", "turn", *text, F.pmod(F.crc32(named), F.lit(20)).alias("__kind")).where("__kind <> 0")
    changed = F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("__kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("__kind") == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"), F.explode(copies).alias("__copy")
    ).drop("__copy")


def audited(conversations: DataFrame, rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every conv_id of ``conversations`` with the repair of its ``rows``; zeros, an empty audit and the hash of nothing if it has none."""
    ids = conversations.select("conv_id", key().alias("c")).distinct()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return ids.join(repair(rows, block), "c", "left").select(
        "conv_id", *[F.coalesce(x, F.lit(0).cast("long")).alias(x) for x in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
