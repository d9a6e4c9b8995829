"""Quality rules with risk-controlled thresholds (DataFrame functions only).

Each document gets whole-text counts, a fixed base test, and scores in thousandths of which a
higher one is worse. The scores make one nested rule: a document's rank is the largest, over the
scores, of the lift of its score, the logarithm of how much more often documents labelled bad reach
that score than unlabelled ones do (both pass the base test; never less than the lift of a smaller
score). Good documents choose no lift, so for them the ranks are a fixed rule.

The cutoff of the rank is chosen per stratum (language) on the labelled holdout: among the good
documents of the stratum that pass the base test, the number rejected may not exceed the largest
``k`` for which the exact binomial test still shows a false rejection rate of at most ``risk``:
``P[Bin(n, risk) <= k] <= delta`` (the Clopper-Pearson bound of k of n is then at most ``risk``).
Cutoffs are tried from lax to strict up to the first failure, which needs no correction; over the
strata ``delta`` is divided by their number (Bonferroni). A stratum too small for any rejection
(under 217 good documents with four strata), or without labels, has no cutoff.

One of the scores is toxicity: the sum, over the whole text, of the weights of the distinct words
of a lexicon. A weight is the log-odds of a word in documents labelled toxic and of good quality
against unlabelled ones; the lexicon is fitted on about FIT_DOCS of each at most, chosen by hash of
the id, and holds the LEXICON words that tell most, of those more frequent in toxic documents than
chance explains. Without toxic labels the score is 0. Without bad labels a lift tells how rare a
score is; without unlabelled documents lifts tell nothing apart and nothing is rejected but by the
base test.

Defined results: a null or empty text has no words and fails the base test. Documents of a
stratum (null included) without a cutoff are judged by the base test alone. Repeated document
rows are judged alike; a document with several label rows is good only if all of them say so.
Labels of unknown documents and null label ids count nothing. Empty tables give no rows, or no
cutoffs.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlake.llm import common, decontam

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
RISK = 0.02  # false rejections among good documents, at most, per stratum
DELTA = 0.05  # chance that any stratum breaks that bound
SCORE_MAX = 1000  # scores are whole thousandths, so a stratum has at most this many cutoffs
LEXICON = 256
FIT_DOCS = 20_000
MIN_TOXIC = 5  # documents labelled toxic that a word of the lexicon is in, at least
TOXICITY = "__toxicity"


def _rate(part: Column, whole: Column) -> Column:
    """``part`` in thousandths of ``whole`` (none: 0), at most SCORE_MAX, in exact integers."""
    of = F.greatest(whole, F.lit(1))
    return F.least((part * 1000 - part * 1000 % of) / of, F.lit(float(SCORE_MAX))).cast("int")


def measure(docs: DataFrame, carry: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """Whole-text counts of every document row, beside the ``carry`` columns and the text hash.

    Repeated windows are found by 64-bit hash within one document. Only a text that has any is
    sorted; the others end at a hash-set distinct.
    """
    text = common.whole_text()
    word = "x -> x <> ''"
    df = docs.select(*carry, common.text_hash().alias(common.TEXT_HASH), text.alias("t"))
    df = df.withColumn("words", F.expr(f"filter(split(t, '[\\\\x20\\\\x09-\\\\x0D]+'), {word})"))
    df = df.withColumn("lines", F.expr("filter(split(t, '\\\\n'), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')"))
    df = df.select(
        *carry,
        common.TEXT_HASH,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size(F.regexp_extract_all("t", F.lit("[#*$%&|<>]"), F.lit(0))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("w"),
    )
    parts = ", ".join(f"w[i + {k}]" for k in range(WINDOW))
    df = df.withColumn(
        "h", F.expr(f"if(n_words < {WINDOW}, array(), transform(sequence(0, size(w) - {WINDOW}), i -> xxhash64({parts})))")
    ).drop("w")
    repeats = F.size("h") > F.size(F.array_distinct("h"))
    df = df.withColumn("s", F.when(repeats, F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))).drop("h")
    # places of windows that occur twice or more, in text order
    df = df.withColumn(
        "p",
        F.expr(
            "sort_array(transform(filter(s, (x, j) -> (j > 0 and s[j - 1].h = x.h) or "
            "(j < size(s) - 1 and s[j + 1].h = x.h)), x -> x.i))"
        ),
    ).drop("s")
    covered = F.expr(
        f"coalesce(aggregate(transform(p, (x, j) -> if(j = size(p) - 1, {WINDOW}, least({WINDOW}, p[j + 1] - x))),"
        " 0L, (a, x) -> a + x), 0L)"
    )
    return df.withColumn("n_repeat_words", covered).drop("p")


def base_failed() -> Column:
    n, r = F.col("n_words"), F.col("n_repeat_words")
    return (n < MIN_WORDS) | (r * 100 > n * MAX_REPEAT_PERCENT)


def scores() -> dict[str, Column]:
    n, chars = F.col("n_words"), F.col("word_chars")
    length = _rate(chars, n * 100)  # mean word length in tenths of a character
    return {
        "symbols": _rate(F.col("n_symbols"), chars),
        "dup_lines": _rate(F.col("n_dup_lines"), F.col("n_lines")),
        "repeats": _rate(F.col("n_repeat_words"), n),
        "long_words": length,
        "short_words": F.lit(SCORE_MAX) - length,
    }


def max_rejections(n: Column, risk: float, delta: Column) -> Column:
    """Largest k with P[Bin(n, risk) <= k] <= delta, or -1, by exact summation in logarithms."""
    log_odds = F.log(F.lit(risk / (1 - risk)))
    zero = (n * F.log(F.lit(1 - risk))).cast("double")
    start = F.struct(
        zero.alias("term"), zero.alias("cdf"), F.when(zero <= F.log(delta), 0).otherwise(-1).cast("long").alias("k")
    )

    def step(a: Column, i: Column) -> Column:
        term = a["term"] + F.log((n - i + 1) / i) + log_odds
        high, low = F.greatest(a["cdf"], term), F.least(a["cdf"], term)
        cdf = high + F.log1p(F.exp(low - high))
        return F.struct(term.alias("term"), cdf.alias("cdf"), F.when(cdf <= F.log(delta), i).otherwise(a["k"]).cast("long").alias("k"))

    # k stays below the mean, as delta is below a half
    top = F.greatest(F.ceil(n * F.lit(risk)), F.lit(1)).cast("long")
    return F.aggregate(F.sequence(F.lit(1).cast("long"), F.least(top, n)), start, step, lambda a: a["k"])


def good_documents(labels: DataFrame) -> DataFrame:
    """Ids that every label row calls of good quality and not toxic."""
    good = F.min(F.when((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0), 1).otherwise(0))
    return labels.where("doc_id is not null").groupBy("doc_id").agg(good.alias("good")).where("good = 1").select("doc_id")


def label_kinds(labels: DataFrame) -> DataFrame:
    """Per labelled document: ``good`` (see good_documents) and ``bad`` (a row of poor quality or toxic)."""
    rows = labels.where("doc_id is not null").select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("x"))
    bad = rows.groupBy("doc_id").agg(F.max(F.coalesce("x", F.lit(False))).alias("bad"))
    return bad.join(good_documents(labels).withColumn("good", F.lit(True)), "doc_id", "left").select(
        "doc_id", F.coalesce("good", F.lit(False)).alias("good"), "bad"
    )


def lexicon(docs: DataFrame, labels: DataFrame) -> dict[str, int]:
    """Words that tell toxic documents, at most LEXICON, with their weights in hundredths."""
    rows = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"), F.min(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("well")
    )
    known = docs.select("doc_id").join(rows, "doc_id", "left")  # ids alone are shuffled, no texts
    known = known.where("toxic is null or (toxic and well)").select("doc_id", F.coalesce("toxic", F.lit(False)).alias("toxic"))
    share = {bool(r["toxic"]): FIT_DOCS / r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = 1 << 30
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(parts))
    chosen = known.where(F.when(F.col("toxic"), spot < int(share.get(True, 0) * parts)).otherwise(spot < int(share.get(False, 0) * parts)))
    ids = common.materialize(chosen.distinct(), "fit-ids").alias("i")  # about FIT_DOCS of each kind at most
    ids = F.broadcast(ids) if common.small(ids) else ids
    texts = docs.alias("d").join(ids, F.col("d.doc_id").eqNullSafe(F.col("i.doc_id"))).select("i.toxic", "d.text")
    sets = common.materialize(texts.select("toxic", F.array_distinct(decontam.words(common.whole_text())).alias("words")), "words")
    size = {bool(r["toxic"]): r["n"] for r in sets.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, other = size.get(True, 0), size.get(False, 0)
    seen = sets.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.count_if("toxic").alias("a"), F.count_if(~F.col("toxic")).alias("b"))
    rate = (F.col("b") + 0.5) / (other + 1)
    weight = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log(rate)
    chance = rate * toxic + F.sqrt(rate * toxic) * 4 + 4
    telling = seen.where((F.col("a") >= MIN_TOXIC) & (F.col("a") >= chance) & (weight >= 1))
    top = telling.select("word", weight.alias("weight")).orderBy((weight * F.col("a")).desc(), "word").limit(LEXICON)
    return {r["word"]: round(100 * r["weight"]) for r in top.collect()}


def toxicity(found: dict[str, int]) -> Column:
    """Sum of the weights of the text's distinct words in ``found``, at most SCORE_MAX."""
    if not found:
        return F.lit(0)
    listed = F.split(F.lit(" ".join(found)), " ")
    weights = F.map_from_arrays(listed, F.split(F.lit(" ".join(map(str, found.values()))), " ").cast("array<int>"))
    each = F.transform(F.array_intersect(decontam.words(common.whole_text()), listed), lambda w: F.element_at(weights, w))
    return F.least(F.aggregate(each, F.lit(0), lambda a, x: a + x), F.lit(SCORE_MAX))


def lifts(measured: DataFrame, rules: dict[str, Column]) -> dict[str, list[int]]:
    """For each rule the lift of every score, in thousandths, not negative and never falling.

    ``measured`` has the columns of ``label_kinds``, null where a document has no label.
    """
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), v.alias("score")) for k, v in rules.items()]))
    seen = measured.where(~base_failed()).where("bad is null or bad").select(each.alias("x"), F.col("bad").isNotNull().alias("bad"))
    # at most SCORE_MAX + 1 rows per rule
    tally = seen.groupBy("x.rule", "x.score").agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("other")).collect()
    found = {}
    for rule in rules:
        bad, other = [0] * (SCORE_MAX + 2), [0] * (SCORE_MAX + 2)
        for r in tally:
            if r["rule"] == rule:
                bad[r["score"]], other[r["score"]] = r["bad"], r["other"]
        for v in range(SCORE_MAX, -1, -1):  # documents with at least this score
            bad[v] += bad[v + 1]
            other[v] += other[v + 1]
        lift, top = [], 0
        for v in range(SCORE_MAX + 1):
            if bad[v] + other[v]:
                top = max(top, round(1000 * (log((bad[v] + 0.5) / (bad[0] + 1)) - log((other[v] + 0.5) / (other[0] + 1)))))
            lift.append(top)
        found[rule] = lift
    return found


def cutoffs(ranked: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """From the holdout's ``stratum`` and ``worst``: stratum, held, allowed (-1: none) and cutoff (null: none)."""
    counts = common.materialize(ranked.groupBy(F.col(stratum).alias("stratum"), "worst").agg(F.count(F.lit(1)).alias("n")), "ranks")
    share = F.lit(delta / max(1, counts.select("stratum").distinct().count()))
    group = Window.partitionBy("stratum")  # at most a row per rank
    above = group.orderBy(F.col("worst").desc()).rowsBetween(Window.unboundedPreceding, -1)
    tails = counts.select("stratum", "worst", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("rejected"), F.sum("n").over(group).alias("held"))
    tested = tails.groupBy("stratum").agg(F.max("held").alias("held"), F.collect_list(F.struct("worst", "rejected")).alias("steps"))
    allowed = tested.withColumn("allowed", max_rejections(F.col("held"), risk, share))
    cutoff = F.array_min(F.transform(F.filter("steps", lambda x: x["rejected"] <= F.col("allowed")), lambda x: x["worst"]))
    return allowed.select("stratum", "held", "allowed", cutoff.alias("cutoff"))


def quality_rules(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Every document row with its counts, ``good`` and ``bad``, ``base_failed``, ``worst`` (rank) and ``kept``."""
    rules = scores() | {"toxicity": F.col(TOXICITY)}
    scored = docs.withColumn(TOXICITY, toxicity(lexicon(docs, labels)))
    measured = common.materialize(measure(scored, ("doc_id", "lang", TOXICITY)).join(label_kinds(labels), "doc_id", "left"), "quality")
    # of fixed size, whatever the corpus
    tables = {k: F.split(F.lit(",".join(map(str, v))), ",").cast("array<int>") for k, v in lifts(measured, rules).items()}
    ranked = measured.withColumn("worst", F.greatest(*[tables[k][rules[k]] for k in rules]))
    chosen = cutoffs(ranked.where(~base_failed() & F.col("good")), "lang", risk, delta)
    r, c = ranked.alias("r"), chosen.alias("c")
    joined = r.join(c, F.col("r.lang").eqNullSafe(F.col("c.stratum")), "left")
    beyond = F.coalesce(F.col("worst") > F.col("c.cutoff"), F.lit(False))
    return joined.select("r.*", base_failed().alias("base_failed"), (~base_failed() & ~beyond).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """``docs`` without the documents that the rules reject."""
    return common.keep_rows(docs, quality_rules(docs, labels, risk, delta).where(~F.col("kept")), "left_anti")
