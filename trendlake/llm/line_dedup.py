"""Line dedup by a segment-partition edit join (DataFrame functions only).

Two lines are alike if they are equal or, both being of at least ``min_chars`` code points, within
``max_edits`` edits; classes are closed over such links. Lines of white space alone don't take part.

1. Equal lines collapse to one id, so copies never pair up.
2. A line of length l is split into ``max_edits + 1`` segments. Of two lines within that many
   edits one segment is untouched, so the shorter line's segment occurs in the longer one at a
   place that the lengths allow. Each line emits hashes of its own segments and of the substrings
   to probe for each allowed length; equal hashes make candidates.
3. A segment shared by more than GROUP lines is not paired up. Its lines are split anew into more
   segments, of which now all but ``max_edits`` must agree, and so on until groups are small or
   segments are single characters (when a group is as large as the alphabet allows). With more
   than one edit the second split is the last, and what it leaves is paired up whatever its size.
4. Candidates are verified by edit distance with a banded bit-parallel recurrence; for one edit,
   those that still differ after their first difference leave before it.
5. Of each class with at least ``min_copies`` lines the first (by doc_id, null last, then text
   hash and line number) stays; the others are removed.

The texts are split once: every line's place, id and keys are written, and all steps but the
fetching of candidates' lines read those.

Defined results: a null or empty text has no such line. Blank lines always stay.
Repeated document rows are judged alike. Lines are compared whole, whatever their length. Empty
tables give no rows.
"""

from __future__ import annotations

from itertools import combinations, product

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlake.llm import common
from trendlake.llm.common import TEXT_HASH
from trendlake.llm.components import components

MAX_EDITS = 1
MIN_CHARS = 20
MIN_COPIES = 2
GROUP = 64
SHOWN = r"[^\x20\x09-\x0D]"
FINER = 4  # the next split has this many times as many segments that must agree


def _segment_keys(edits: int, agree: int) -> list[tuple[str, bool]]:
    """SQL of the hashes that a line (columns line, n) emits, each with whether it is the line's own.

    A line of length l has ``edits + agree`` segments of which ``agree`` are untouched. Untouched
    neighbours form a run; a run lies ``shift`` places further on in the longer line, and the
    shifts along a line can't change by more than the edits.
    """
    parts = edits + agree
    found = []
    for longer in range(edits + 1):
        length = f"(n - {longer})"

        def at(i: int) -> str:
            return f"({i} * {length} div {parts})"

        for number, touched in enumerate(combinations(range(parts), edits)):
            runs, clean = [], [i for i in range(parts) if i not in touched]
            for i in clean:
                if runs and runs[-1][1] == i - 1:
                    runs[-1][1] = i
                else:
                    runs.append([i, i])
            options = []
            for first, last in runs:
                before = sum(t < first for t in touched)
                options.append([0] if not before else [longer] if before == edits else range(-edits, edits + 1))
            for shifts in product(*options):
                path = [0, *shifts, longer]
                if sum(abs(b - a) for a, b in zip(path, path[1:])) <= edits:
                    texts = [
                        f"substring(line, cast({at(a)} + 1 + {s} as int), cast({at(b + 1)} - {at(a)} as int))"
                        for (a, b), s in zip(runs, shifts)
                    ]
                    found.append((f"xxhash64({number}, {length}, {', '.join(texts)})", not longer and not any(shifts)))
    return found


def _finer_keys(agree: int) -> list[tuple[str, bool]]:
    """For one edit and any number of segments: SQL of arrays of hashes, one per touched segment."""
    found = []
    for longer in (0, 1):
        length, parts = f"(n - {longer})", f"least({agree + 1}, n - {longer})"
        before = f"substring(line, 1, cast(t * {length} div {parts} as int))"
        after = f"substring(line, cast((t + 1) * {length} div {parts} + 1 + {longer} as int))"
        keys = f"transform(sequence(0L, cast({parts} - 1 as bigint)), t -> xxhash64(t, {length}, {before}, {after}))"
        found.append((keys, not longer))
    return found


def _emit(lines: DataFrame, edits: int, agree: int) -> DataFrame:
    """Rows (key, id, own) from ``lines`` (id, line, n) split so that ``agree`` segments must agree."""
    if edits == 1:
        arrays = _finer_keys(agree)
    else:
        arrays = [(f"array({sql})", own) for sql, own in _segment_keys(edits, agree)]
    each = F.expr("flatten(array(" + ", ".join(f"transform({sql}, k -> struct(k as key, {own} as own))" for sql, own in arrays) + "))")
    return lines.select("id", F.explode(each).alias("x")).select("x.key", "id", "x.own")


def _grouped(emitted: DataFrame) -> DataFrame:
    """Rows (key, id, own, size) of the keys that two or more lines emit, one of them as its own."""
    sizes = emitted.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.max("own").alias("any_own"))
    return common.materialize(emitted.join(sizes.where("size > 1 and any_own").select("key", "size"), "key"), "groups")


def _pairs(grouped: DataFrame) -> DataFrame:
    a, b = grouped.where("own").alias("a"), grouped.alias("b")
    once = (F.col("a.id") < F.col("b.id")) | (~F.col("b.own") & (F.col("a.id") != F.col("b.id")))
    both = a.join(b, (F.col("a.key") == F.col("b.key")) & once)
    return both.select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b")).distinct()


def _agreeing(pairs: DataFrame) -> DataFrame:
    """Rows of ``pairs`` (with the lengths sn and tn of s and t) whose strings can be one edit apart:
    beyond the first place where they differ, and one edit there, they agree. The place is found by
    halving, which is far cheaper than the recurrence, and all that this drops are further apart."""
    # as an array's one element, each end and length is computed once per pair, not wherever it is used
    ends = "if(sn > tn, struct(t as x, s as y, tn as l, sn - tn as more), struct(s as x, t as y, sn as l, tn - sn as more))"
    # the code points known to agree grow by falling powers of two
    agree = (
        "aggregate(transform(sequence(0, 30), i -> shiftleft(1, 30 - i)), 0, (a, w) -> "
        "if(w <= e.l - a and substring(e.x, a + 1, w) = substring(e.y, a + 1, w), a + w, a))"
    )
    rest = f"exists(array({agree}), a -> substring(e.x, a + 2 - e.more) = substring(e.y, a + 2))"
    return pairs.where("abs(sn - tn) <= 1").where(F.expr(f"exists(array({ends}), e -> {rest})"))


def verified(pairs: DataFrame, edits: int) -> DataFrame:
    """The rows of ``pairs`` whose strings s and t are within ``edits`` edits (s longer than that).

    Bit-parallel over a band: of a column of the distance table only the 2 * edits + 1 rows around
    the diagonal are held, as vertical differences +1 (p) and -1 (m) in a word that slides down a
    row per character of t; d follows the band's lower edge and then the last row.
    """
    width, ones = 2 * edits + 1, (1 << 2 * edits + 1) - 1
    near = pairs.where(F.abs(F.length("s") - F.length("t")) <= edits)
    # a generator of one row, or the filter below would split s again for every character of t
    split = F.explode(F.array(F.struct(F.split("s", "").alias("sc"), F.split("t", "").alias("tc"))))
    chars = near.select("*", split.alias("z")).select("*", "z.sc", "z.tc")
    # which rows of the band match each character of t; places outside s match nothing
    bits = " | ".join(f"if(coalesce(get(sc, i + {b - edits}), '') = c, {1 << b}L, 0L)" for b in range(width))
    matches = chars.withColumn("ys", F.expr(f"transform(tc, (c, i) -> struct({bits} as x, cast(i - size(sc) + {edits} as int) as past))"))
    # z is the step's diagonal word, computed once per character
    word = f"((((y.x & a.p) + a.p) ^ a.p) | y.x | a.m) & {ones}L"
    up, down = f"(a.m | (~(z | a.p) & {ones}L))", "(z & a.p)"
    edge = f"shiftright({1 << max(0, 2 * edits - 1)}L, y.past)"
    change = f"if(y.past < 0, if((z & {1 << 2 * edits}L) = 0, 1, 0), if(({up} & {edge}) <> 0, 1, 0) - if(({down} & {edge}) <> 0, 1, 0))"
    after = f"struct(({down} | (~(shiftright(z, 1) | {up}) & {ones}L)) as p, (shiftright(z, 1) & {up}) as m, a.d + {change} as d)"
    step = f"transform(array({word}), z -> {after})[0]"
    start = f"struct({ones ^ ((1 << edits) - 1)}L as p, 0L as m, {edits} as d)"
    distance = matches.withColumn("distance", F.expr(f"aggregate(ys, {start}, (a, y) -> {step}, a -> a.d)"))
    return distance.where(F.col("distance") <= edits).select(*pairs.columns)


def occurrences(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """One row per line of ``min_chars`` or more that isn't blank: doc_id, text hash, no (from 0), id (128-bit digest), line, n (code points)."""
    # beside a generator all else is computed per generated row, so the text's hash comes first
    split = docs.select("doc_id", common.text_hash().alias(TEXT_HASH), F.split(common.whole_text(), "\n").alias("lines"))
    lines = split.select("doc_id", TEXT_HASH, F.posexplode("lines").alias("no", "line"))
    taken = (F.col("n") >= min_chars) & F.col("line").rlike(SHOWN)
    return lines.select("*", F.length("line").alias("n")).where(taken).withColumn("id", F.unhex(F.md5("line")))


def _keyed(docs: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """One written row per line: doc_id, text hash, no, id and the keys k0, k1 and so on, null below ``min_chars``."""
    keys = [F.expr(f"if(n >= {min_chars}, {sql}, null)").alias(f"k{i}") for i, (sql, _) in enumerate(_segment_keys(edits, 1))]
    return common.materialize(occurrences(docs).select("doc_id", TEXT_HASH, "no", "id", *keys), "keyed")


def _texts(docs: DataFrame, ids: DataFrame, min_chars: int) -> DataFrame:
    """(id, line, n) of the given distinct ids."""
    found = occurrences(docs, min_chars).join(ids, "id", "left_semi")
    return common.materialize(found.groupBy("id").agg(F.first("line").alias("line"), F.first("n").alias("n")), "lines")


def links(
    docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, group: int = GROUP, keyed: DataFrame | None = None
) -> DataFrame:
    """Pairs (a, b) of ids of different lines within ``max_edits`` edits, each once; ``keyed`` are the
    lines of ``docs`` as ``_keyed`` writes them, if that is done."""
    if min_chars <= max_edits:
        raise ValueError("lines must be longer than the edits allowed")
    keyed = _keyed(docs, max_edits, min_chars) if keyed is None else keyed
    owns = [own for _, own in _segment_keys(max_edits, 1)]
    each = F.array(*[F.struct(F.min(f"k{i}").alias("key"), F.lit(own).alias("own")) for i, own in enumerate(owns)])
    distinct = keyed.where("k0 is not null").groupBy("id").agg(each.alias("x")).select("id", F.explode("x").alias("x"))
    grouped = _grouped(distinct.select("x.key", "id", "x.own"))
    few = [_pairs(grouped.where(F.col("size") <= group))]
    crowded = grouped.where(F.col("size") > group).select("id").distinct()
    lines = _texts(docs, few[0].selectExpr("a as id").union(few[0].selectExpr("b as id")).union(crowded).distinct(), min_chars)
    hot, agree = lines.join(crowded, "id", "left_semi"), 1
    longest = hot.agg(F.max("n")).first()[0]
    while longest:
        agree *= FINER
        last = max_edits > 1 or agree >= longest
        grouped = _grouped(_emit(hot, max_edits, agree))
        few.append(_pairs(grouped if last else grouped.where(F.col("size") <= group)))
        if last:
            break
        hot = common.materialize(hot.join(grouped.where(F.col("size") > group).select("id").distinct(), "id", "left_semi"), "lines")
        longest = hot.agg(F.max("n")).first()[0]
    pairs = few[0]
    for more in few[1:]:
        pairs = pairs.union(more)
    text = lines.select("id", "line", "n")
    both = pairs.distinct().join(text.toDF("a", "s", "sn"), "a").join(text.toDF("b", "t", "tn"), "b")
    if max_edits == 1:
        both = _agreeing(both)
    return common.materialize(verified(both, max_edits).select("a", "b"), "links")


def line_classes(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, keyed: DataFrame | None = None) -> DataFrame:
    """(id, root) of every line that has a different line in its class; the root is the least id."""
    return components(links(docs, max_edits, min_chars, keyed=keyed).toDF("u", "v")).toDF("id", "root")


def repeated_lines(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, min_copies: int = MIN_COPIES) -> DataFrame:
    """Every line to remove: doc_id, text hash, no, whether it differs from the line that stays (``edited``), its class
    (``root``) and the document row of the line that stays (``source``)."""
    keyed = _keyed(docs, max_edits, min_chars)
    found = keyed.select("doc_id", TEXT_HASH, "no", "id")
    counts = found.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    rooted = counts.join(line_classes(docs, max_edits, min_chars, keyed), "id", "left")
    # ids of classes with too few lines leave here, those that are their whole class first, before the occurrences are joined
    rooted = rooted.where(F.col("root").isNotNull() | (F.col("n") >= min_copies)).select("id", F.coalesce("root", "id").alias("root"), "n")
    rooted = common.materialize(rooted, "rooted")
    sizes = rooted.groupBy("root").agg(F.sum("n").alias("copies")).where(F.col("copies") >= min_copies)
    member = rooted.join(sizes, "root", "left_semi").select("id", "root")
    # written, as it is used twice, and so that the lines of a very common id are split among tasks
    each = common.materialize(found.join(member, "id"), "each")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col(TEXT_HASH), F.col("no"))
    first = each.groupBy("root").agg(F.min(F.struct(place.alias("place"), F.col("id").alias("id"))).alias("first"))
    # written, so that the join has an exchange of its own and the lines of a large class are split among tasks
    first = common.materialize(first, "firsts")
    source = F.struct("first.place.none", "first.place.doc_id", f"first.place.{TEXT_HASH}")
    return (
        each.join(first, "root").where(place != F.col("first.place"))
        .select("doc_id", TEXT_HASH, "no", (F.col("id") != F.col("first.id")).alias("edited"), "root", source.alias("source"))
    )


def _without_copies(docs: DataFrame, gone: DataFrame, share: float) -> DataFrame:
    """``gone`` without the lines of near copies that stay in them: of a document that has at least ``share`` of its lines
    from one other, those lines, each where it comes first. What the other loses too goes from both, so they stay alike."""
    main = gone.groupBy("doc_id", TEXT_HASH, "source").agg(F.count(F.lit(1)).alias("n"))
    main = main.groupBy("doc_id", TEXT_HASH).agg(F.max(F.struct("n", "source")).alias("x")).alias("m")
    lines = F.size(F.filter(F.split(common.whole_text(), "\n"), lambda x: x.rlike(SHOWN)))
    sizes = docs.select("doc_id", common.text_hash().alias(TEXT_HASH), lines.alias("lines")).distinct().alias("s")
    alike = main.join(sizes, common.same_row("m", "s")).where(F.col("x.n") >= F.col("lines") * share)
    alike = alike.select("m.doc_id", f"m.{TEXT_HASH}", F.col("x.source").alias("main")).alias("a")
    here = Window.partitionBy("doc_id", TEXT_HASH, "root")  # lines of one document
    rows = gone.withColumn("first_here", F.min("no").over(here)).alias("g")
    joined = rows.join(alike, common.same_row("g", "a"), "left")
    stays = F.col("source").eqNullSafe(F.col("main")) & (F.col("no") == F.col("first_here"))
    return joined.where(~F.coalesce(stays, F.lit(False))).select("g.*")


def decisions(
    docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, min_copies: int = MIN_COPIES, spare: float | None = None
) -> DataFrame:
    """Per document row that loses lines, once: doc_id, text hash, ``removed`` (sorted line numbers) and n_edited.

    With ``spare``, documents that have at least this share of their lines from one other document are near copies of
    it, and are left as it is for a near-duplicate stage to find.
    """
    gone = repeated_lines(docs, max_edits, min_chars, min_copies).groupBy("doc_id", TEXT_HASH, "no").agg(
        F.max("edited").alias("edited"), F.first("root").alias("root"), F.first("source").alias("source")  # equal in repeated rows
    )
    if spare is not None:
        gone = _without_copies(docs, common.materialize(gone, "gone"), spare)
    return gone.groupBy("doc_id", TEXT_HASH).agg(
        F.sort_array(F.collect_list("no")).alias("removed"), F.count_if("edited").alias("n_edited")
    )


def dedup_lines(
    docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, min_copies: int = MIN_COPIES, spare: float | None = None
) -> DataFrame:
    """``docs`` without the repeated lines; a text that loses lines gets a new n_chars, if there is that column."""
    found = common.materialize(decisions(docs, max_edits, min_chars, min_copies, spare), "removed").alias("r")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", common.text_hash().alias(TEXT_HASH)).alias("d")
    joined = rows.join(found, common.same_row("d", "r"), "left").select("d.row", "r.removed").withColumn(
        "lines", F.when(F.col("removed").isNotNull(), F.split("row.text", "\n"))
    )
    left = "transform(array_except(sequence(0, size(lines) - 1), removed), i -> lines[i])"
    text = F.when(F.col("lines").isNull(), F.col("row.text")).otherwise(F.array_join(F.expr(left), "\n"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("lines").isNull(), F.col("row.n_chars")).otherwise(F.length(text).cast("long"))
    return joined.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
