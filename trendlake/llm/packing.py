"""Best-fit packing: length patterns fitted by non-negative least squares.

1. Each whole text is tokenized in an Arrow-batched function; only texts beyond the sequence
   length are cut, into full pieces after a first one that may be shorter. A task numbers its
   pieces of each length as it goes.
2. The histogram of lengths (at most ``length`` rows) is all that reaches the driver. There,
   patterns of up to three lengths that fill a sequence exactly get repeat counts by
   non-negative least squares; rounded counts are used as far as documents last, and best-fit
   decreasing packs the residual, many equal documents in one step.
3. The resulting slots (a range of ranks of one length to a range of sequences) number at most
   the patterns, whatever the corpus's size. Each piece finds its slot by its rank within its
   length: the rank in its task plus the counts of earlier tasks, a small join.

Defined results: a null text is empty, and an empty text is one piece of the end token alone.
Repeated rows and null ids are packed like others. An empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlake.llm import common

LENGTH = 2048
END_TOKEN = 0
FIT_ROUNDS = 300
PIECE = "pid long, doc_id long, piece int, start long, length long, ids_crc32 long, local long"


class Ids:
    """Token ids of texts as little-endian unsigned 32-bit bytes, by the byte-level BPE file at ``path``.

    Texts of Latin-1 characters, where both libraries split words alike, go through the faster
    merge loop of ``tiktoken`` with the file's own vocabulary as ranks (an id is a merge's rank);
    all others, and those that hold the string of an added token (which gets that token's id),
    through ``tokenizers``. A file whose ids aren't its merges' ranks uses only the latter.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = _ranked(path)

    def of(self, text: str) -> bytes:
        if self.fast and not any(t in text for t in self.added):
            try:
                text.encode("latin-1")
                return np.array(self.fast.encode_ordinary(text), dtype="<u4").tobytes()
            except UnicodeEncodeError:
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones stand for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _ranked(path: str):
    """A ``tiktoken`` encoding equal to the file, or None if its ids aren't in the order of its merges."""
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    letters, vocabulary = _byte_letters(), model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [vocabulary.get(a + b) for a, b in pairs]
    if None in ids or ids != sorted(ids) or any(vocabulary.get(c, len(vocabulary)) >= ids[0] for c in letters):
        return None
    tokens = {*letters, *(a + b for a, b in pairs)}
    ranks = {bytes(letters[c] for c in token): vocabulary[token] for token in tokens}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def ids_of(path: str) -> Ids:
    return Ids(path)


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end_token: int = END_TOKEN) -> DataFrame:
    """Pieces of every document row, with ``pid`` (the task's partition) and ``local`` (its rank there within its length)."""
    end = np.array([end_token], dtype="<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, seen, pid = ids_of(path), np.zeros(length + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["t"]):
                data = memoryview(ids.of(text) + end)
                total = len(data) // 4
                stop = (total - 1) % length + 1  # of the first piece
                start = number = 0
                while start < total:
                    size = stop - start
                    rows.append((pid, doc_id, number, start, size, zlib.crc32(data[4 * start : 4 * stop]), seen[size]))
                    seen[size] += 1
                    start, stop, number = stop, stop + length, number + 1
            out = pd.DataFrame(rows, columns=["pid", "doc_id", "piece", "start", "length", "ids_crc32", "local"])
            yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.whole_text().alias("t")).mapInPandas(cut, PIECE)


def _patterns(sizes: np.ndarray, length: int) -> np.ndarray:
    """Rows (a, b, c) of lengths in ``sizes`` with a >= b >= c >= 0 that sum to ``length``; 0 means none."""
    present = np.zeros(length + 1, bool)
    present[sizes] = present[0] = True
    found = []
    for a in sizes:
        b = np.arange((length - a + 1) // 2, min(a, length - a) + 1)
        c = length - a - b
        good = present[b] & present[c] & ((b > 0) | (c == 0))
        found.append(np.stack([np.full(good.sum(), a), b[good], c[good]], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - counts|^2, by accelerated projected gradient.

    A has a column per pattern with how often it uses each length; only its entries are stored.
    """
    size = len(counts)
    target = counts.astype(float)
    target[0] = 0

    def use(x: np.ndarray) -> np.ndarray:
        y = sum(np.bincount(patterns[:, k], x, size) for k in range(patterns.shape[1]))
        y[0] = 0
        return y

    def back(r: np.ndarray) -> np.ndarray:
        return r[patterns].sum(axis=1)

    v = np.ones(len(patterns))
    for _ in range(20):  # largest eigenvalue of A'A
        w = back(use(v))
        top = np.linalg.norm(w)
        v = w / top
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - back(use(y) - target) / (1.01 * top))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def best_fit(left: np.ndarray, length: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts by length: (lengths of a sequence, repeats).

    Sequences with the same content are one group, filled in one step.
    """
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for size in range(length, 0, -1):
        todo = int(left[size])
        while todo:
            free = min((f for f in open_ if f >= size), default=length)
            group = open_.pop(free, None) or [((), -(-todo // (length // size)))]
            content, repeats = group.pop()
            if group:
                open_[free] = group
            each = min(free // size, todo)
            full = min(repeats, todo // each)
            open_.setdefault(free - each * size, []).append((content + (size,) * each, full))
            if repeats > full and content:
                open_.setdefault(free, []).append((content, repeats - full))
            todo -= each * full
    return [g for groups in open_.values() for g in groups]


def plan(counts: np.ndarray, length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """How to pack: (lengths of a sequence, repeats), using every counted length exactly."""
    left = counts.copy()
    chosen = []
    sizes = np.nonzero(left)[0]
    patterns = _patterns(sizes[sizes > 0], length)
    if len(patterns):
        x = fit(patterns, left)
        for k in np.argsort(-x, kind="stable"):
            lengths = [int(n) for n in patterns[k] if n]
            if x[k] < 0.5:
                break
            most = min(int(left[n]) // lengths.count(n) for n in lengths)
            repeats = min(int(round(x[k])), most)
            if repeats:
                chosen.append((tuple(lengths), repeats))
                for n in lengths:
                    left[n] -= repeats
    return chosen + best_fit(left, length)


def slots(packed: list[tuple[tuple[int, ...], int]], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Sorted keys (length and first rank), first sequence and offset of each slot."""
    used = np.zeros(length + 1, np.int64)
    rows, sequence = [], 0
    for lengths, repeats in packed:
        offset = 0
        for n in lengths:
            rows.append((n << 44 | int(used[n]), int(used[n]), sequence, offset))
            used[n] += repeats
            offset += n
        sequence += repeats
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return table[:, 0], table[:, 1], table[:, 2], table[:, 3]


def pack(docs: DataFrame, path: str, length: int = LENGTH, end_token: int = END_TOKEN) -> DataFrame:
    """Every piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    made = common.materialize(pieces(docs, path, length, end_token), "pieces")
    per_task = common.materialize(made.groupBy("length", "pid").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = np.zeros(length + 1, np.int64)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``length`` rows
        counts[row["length"]] = row["n"]
    keys, first, sequence, offset = slots(plan(counts, length), length)
    earlier = Window.partitionBy("length").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("length", "pid", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    # bases grow with the tasks, so they are not to be broadcast
    ranked = made.join(bases.hint("merge"), ["length", "pid"]).withColumn("rank", F.col("base") + F.col("local"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rank, size = batch.pop("rank").to_numpy(), batch["length"].to_numpy()
            at = np.searchsorted(keys, size << 44 | rank, side="right") - 1
            yield batch.assign(sequence_id=sequence[at] + rank - first[at], offset=offset[at])

    shown = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return ranked.select(*shown, "rank").mapInPandas(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
