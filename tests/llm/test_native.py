"""Quality rules, decontamination, secrets and line dedup on awkward rows and against plain versions."""

import hashlib
import random
import re
from math import comb, log

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from trendlake.llm import decontam, line_dedup, quality, secret_scan

AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (4, "é"), (None, "Some words that nobody else has in any text"), (5, "a b"), (5, "a b"), (6, "x " * 5000)]


def spread(seed, n, k=8):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdéfgh") for _ in range(rnd.randrange(2, 9))) for _ in range(60)]
    return [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(0, k * 10)))) for i in range(n)]


# ------------------------------------------------------------------ quality rules
def plain_measure(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_measure(docs_of):
    rows = [(d, t) for d, t in AWKWARD if d not in (6,)] + [(7, "one two three four five six seven eight nine " * 3 + "#*|"), (8, "l 1\n\nl 1\nl 2\nl 1")]
    rows += [(10 + i, t) for i, t in spread(1, 30)]
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.measure(docs_of(rows)).collect()}
    assert got == {d: plain_measure(t) for d, t in rows}


@pytest.mark.parametrize("n", [1, 10, 180, 600, 3000])
def test_max_rejections_is_the_exact_binomial_bound(spark, n):
    risk, delta = 0.02, 0.01
    cdf = [sum(comb(n, i) * risk**i * (1 - risk) ** (n - i) for i in range(k + 1)) for k in range(min(n, 80) + 1)]
    want = max((k for k, p in enumerate(cdf) if p <= delta), default=-1)
    got = spark.range(1).select(quality.max_rejections(F.lit(n), risk, F.lit(delta)).alias("k")).first().k
    assert got == want


def test_cutoffs_hold_the_risk_and_strata_without_labels_keep_all(spark, docs_of):
    words = " ".join(f"word{j}" for j in range(30))
    rows = [(i, words + " #" * (i % 3)) for i in range(4000)] + [(10_000 + i, words.replace("word", "####w")) for i in range(200)]
    docs = docs_of(rows).withColumn("lang", F.when(F.col("doc_id") % 20 == 1, None).otherwise(F.col("lang")))
    labels = [(i, 1, 0) for i in range(4000) if i % 20 != 1 and i % 4] + [(10_000 + i, 0, 0) for i in range(0, 200, 4)] + [(None, 1, 0), (77_777, 1, 0)]
    judged = quality.quality_rules(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert not any(r.base_failed for r in judged)
    kept = {r.doc_id: r.kept for r in judged}
    good = [i for i, q, _ in labels if q and i in kept]
    assert sum(kept[i] for i in good) >= len(good) * (1 - quality.RISK)
    junk = {i: kept[10_000 + i] for i in range(200)}
    assert junk == {i: i % 20 == 1 for i in range(200)}  # those of the stratum without labels stay


def small_languages(spark, docs_of):
    """Good documents of four languages too few for the query's split bound, two of them for any; every tenth unlabelled one is junk."""
    sizes = {"en": 600, "de": 400, "fr": 150, "es": 120}
    rnd, rows, labels = random.Random(3), [], []
    for lang, n in sizes.items():
        for i in range(2 * n + 40):
            d = len(rows)
            junk = i >= 2 * n or (i < n and i % 10 == 0)  # n unlabelled, n labelled good, 40 labelled bad
            rows.append((d, " ".join(rnd.choice(["abc", "de", "fghi"]) + str(rnd.randrange(99)) + ("###" if junk else "") for _ in range(30)), lang, junk))
            if i >= n:
                labels.append((d, int(not junk), 0))
    docs = docs_of([r[:2] for r in rows]).drop("lang").join(spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, lang string"), "doc_id")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def test_small_languages_have_no_cutoff(spark, docs_of):
    docs, labels, rows = small_languages(spark, docs_of)
    kept = {r.doc_id for r in quality.keep_good(docs, labels).collect()}
    assert {lang for d, _, lang, junk in rows if junk and d in kept} == {"fr", "es"}
    assert all(d in kept for d, _, lang, junk in rows if lang in ("fr", "es"))
    assert len(kept) >= (1 - quality.RISK) * sum(not junk for *_, junk in rows)


def plain_allowed(n, delta, risk=0.02):
    cdf = [sum(comb(n, i) * risk**i * (1 - risk) ** (n - i) for i in range(k + 1)) for k in range(40)]
    return max((k for k, p in enumerate(cdf) if p <= delta), default=-1)


def test_cutoffs_are_the_exact_bound(spark):
    held = [("en", i % 150) for i in range(600)] + [("de", i) for i in range(300)] + [("fr", i) for i in range(100)] + [(None, i) for i in range(180)]
    got = {r.stratum: (r.held, r.allowed, r.cutoff) for r in quality.cutoffs(spark.createDataFrame(held, "lang string, worst int")).collect()}

    def want(ranks):
        allowed = plain_allowed(len(ranks), 0.05 / 4)
        return len(ranks), allowed, min((c for c in ranks if sum(x > c for x in ranks) <= allowed), default=None)

    assert got == {x: want([w for s, w in held if s == x]) for x in ("en", "de", "fr", None)}
    assert got["fr"][1:] == (-1, None) and got["en"][2] < 149


def plain_kept(rows, labels):
    """{doc_id: kept} of (doc_id, text, lang) with distinct ids: the rules with a loop for each of their steps."""
    marks = {}
    for d, quality_, toxic in labels:
        marks.setdefault(d, []).append((quality_, toxic))
    good = {d for d, m in marks.items() if all(q == 1 and not t for q, t in m)}
    bad = {d for d, m in marks.items() if any(q == 0 or t == 1 for q, t in m)}
    toxic = {d for d, m in marks.items() if any(t == 1 for _, t in m) and all(q == 1 for q, _ in m)}
    known = {d: set(plain_words(t)) for d, t, _ in rows if d not in marks or d in toxic}
    size, other = sum(d in toxic for d in known), sum(d not in toxic for d in known)
    weights = {}
    for w in set().union(*known.values()):
        a, b = sum(w in x for d, x in known.items() if d in toxic), sum(w in x for d, x in known.items() if d not in toxic)
        rate = (b + 0.5) / (other + 1)
        weight = log((a + 0.5) / (size + 1)) - log(rate)
        if a >= 5 and a >= rate * size + 4 * (rate * size) ** 0.5 + 4 and weight >= 1:
            weights[w] = (-weight * a, w, round(100 * weight))
    lexicon = {w: n for _, w, n in sorted(weights.values())[:256]}
    score, failed, lang = {}, set(), {d: x for d, _, x in rows}
    for d, t, _ in rows:
        n, chars, symbols, dup, repeated = plain_measure(t)
        lines = len([x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)])
        if n < 20 or repeated * 100 > n * 30:
            failed.add(d)
        mean = min(1000, chars * 1000 // max(1, n * 100))
        tox = min(1000, sum(lexicon.get(w, 0) for w in set(plain_words(t))))
        score[d] = [min(1000, symbols * 1000 // max(1, chars)), min(1000, dup * 1000 // max(1, lines)), min(1000, repeated * 1000 // max(1, n)), mean, 1000 - mean, tox]
    seen = [(d in bad, score[d]) for d in score if d not in failed and (d not in marks or d in bad)]
    all_bad, all_other = sum(b for b, _ in seen), sum(not b for b, _ in seen)
    lift = []
    for k in range(6):
        top, found = 0, []
        for v in range(1001):
            a, b = sum(s[k] >= v for x, s in seen if x), sum(s[k] >= v for x, s in seen if not x)
            if a + b:
                top = max(top, round(1000 * (log((a + 0.5) / (all_bad + 1)) - log((b + 0.5) / (all_other + 1)))))
            found.append(top)
        lift.append(found)
    rank = {d: max(lift[k][s[k]] for k in range(6)) for d, s in score.items()}
    strata = {x: [rank[d] for d in good if d in score and d not in failed and lang[d] == x] for x in set(lang.values())}
    strata = {x: r for x, r in strata.items() if r}
    allowed = {x: plain_allowed(len(r), 0.05 / len(strata)) for x, r in strata.items()}
    cutoff = {x: min((c for c in r if sum(y > c for y in r) <= allowed[x]), default=None) for x, r in strata.items()}
    return {d: d not in failed and not (cutoff.get(lang[d]) is not None and rank[d] > cutoff[lang[d]]) for d in score}


def test_rules_equal_the_plain_version_and_sql_where_there_are_cutoffs(spark, docs_of):
    import duckdb

    from trendlake.llm.oracle import SQL

    docs, labels, rows = small_languages(spark, docs_of)
    rnd = random.Random(11)
    toxic = {d for d, *_ in rows if rnd.random() < 0.06}
    texts = [(d, t + (" vile scummy rotten" if d in toxic else ""), lang) for d, t, lang, _ in rows]
    docs = spark.createDataFrame([(d, t, lang, "s", len(t)) for d, t, lang in texts], "doc_id long, text string, lang string, source string, n_chars long")
    marked = [(r.doc_id, r.quality, int(r.doc_id in toxic)) for r in labels.collect()]
    labels = spark.createDataFrame(marked, "doc_id long, quality int, toxic int")
    want = plain_kept(texts, marked)
    got = {r.doc_id: r.kept for r in quality.quality_rules(docs, labels).collect()}
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    con.register("labels", labels.toPandas())
    assert got == want == dict(con.execute(f"SELECT doc_id, kept FROM ({SQL['op5_quality_rules']})").fetchall())
    assert sum(not x for x in want.values()) > 100


def test_toxic_documents_go(spark, docs_of):
    rnd, rows, labels = random.Random(4), [], []
    for i in range(1500):  # every tenth document has two of four words, a third of those are labelled
        words = [f"word{rnd.randrange(400)}" for _ in range(40)]
        toxic = i % 10 == 0
        if toxic:
            words[5], words[30] = rnd.sample(["vile", "SCUMMY,", "rotten.", "hateful"], 2)
        rows.append((i, " ".join(words)))
        if i % 3 == 0:
            labels.append((i, 1, int(toxic)))
    docs, labels = docs_of(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert set(quality.lexicon(docs, labels)) == {"vile", "scummy", "rotten", "hateful"}
    judged = quality.quality_rules(docs, labels).select("doc_id", "kept").collect()
    assert not [r for r in judged if r.kept and r.doc_id % 10 == 0]
    assert sum(not r.kept for r in judged if r.doc_id % 10) <= quality.RISK * 1350
    none = quality.quality_rules(docs, labels.where("toxic is null"))
    assert none.agg(F.max(quality.TOXICITY)).first()[0] == 0 and none.where("kept").count() == 1500


def test_quality_of_empty_tables(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.quality_rules(docs_of([]), labels).count() == 0
    judged = quality.quality_rules(docs_of(AWKWARD), labels)
    assert judged.count() == len(AWKWARD) and judged.where("kept").count() == 0  # short or repeating


# ------------------------------------------------------------------ decontamination
def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered) if w]


def plain_hits(text, items, size=10):
    words, hit, found = plain_words(text), set(), set()
    for item, t in items:
        w = plain_words(t)
        n = min(size, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(words), len(hit), sorted(str(i) for i in found if i is not None)


def test_hits(spark, docs_of):
    base = " ".join(f"Term{i}" for i in range(40))
    items = [(3, base), (20, "short ITEM"), (20, "short item"), (5, ""), (6, None), (None, "lonely-one"), (7, " ".join(f"term{i}" for i in range(5, 16)))]
    rows = AWKWARD[:-1] + [(10, "x " + base[:100].upper() + " y"), (11, "a Short, item! b short item"), (12, "lonely one"), (13, base + " " + base), (14, "é" + base)]
    rows += [(20 + i, t) for i, t in spread(2, 10)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in decontam.find_hits(docs_of(rows), benchmark).collect()}
    assert got == {d: plain_hits(t, items) for d, t in rows}


@pytest.mark.parametrize("size", [4, 13])
def test_hits_of_other_window_sizes(spark, docs_of, size):
    docs, items = spread(8, 40), []
    for n, length in enumerate((2, 11, 12, 13, 20)):
        items.append((n, " ".join(f"item{n}x{j}" for j in range(length))))
        docs.append((100 + n, f"before it {items[-1][1]} and after it"))
    found = decontam.find_hits(docs_of(docs), spark.createDataFrame(items, "item_id long, text string"), size)
    want = {d: plain_hits(t, items, size) for d, t in docs}
    assert all(want[100 + n][1] for n in range(5))
    assert {r.doc_id: (r.n_words, r.n_hit, sorted(r["items"])) for r in found.collect()} == {d: (w, h, i) for d, (w, h, i) in want.items()}


def test_hits_do_not_depend_on_the_broadcast(spark, docs_of, monkeypatch):
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    monkeypatch.setattr(decontam.common, "small", lambda df: False)
    assert [r.n_hit for r in decontam.find_hits(docs_of([(1, "zero one two three")]), items).collect()] == [3]


def test_removal(spark, docs_of):
    docs = docs_of([(1, "Keep, one two three! Keep"), (2, None), (3, "nothing")])
    hits = decontam.find_hits(docs, spark.createDataFrame([(1, "one two three")], "item_id long, text string"))
    out = decontam.remove_spans(docs, hits)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "Keep, Keep", 2: None, 3: "nothing"}
    assert {r.doc_id for r in decontam.remove_documents(docs, hits).collect()} == {2, 3}
    none = decontam.find_hits(docs, spark.createDataFrame([], "item_id long, text string"))
    assert none.where("n_hit > 0").count() == 0 and none.count() == 3


# ------------------------------------------------------------------ secrets
def plain_spans(text):
    text, found = text or "", []
    kinds = [(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6), (r"AKIA[A-Z0-9]+", 0, 20), (r"[0-9a-f]+", 0, 24)]
    for no, (pattern, group, least) in enumerate(kinds):
        found += [(m.start(), no, m.end(), m[group]) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return sorted(found)


def test_spans(docs_of):
    key, digest = "AKIA" + "Q1" * 9, "0123456789abcdef" * 2
    rows = AWKWARD[:-1] + [
        (10, f'é Token = "{digest}" {key} password: token = abcdef1 secret:x'), (11, f"{digest}{digest} {key[:19]} API_KEY='{key}'"),
        (12, f"secret=token=abcdef passwd : : {digest}"), (13, digest), (14, "apikey:abcdef,apikey:abcdefg"),
    ]
    got = {r.doc_id: [(x.start, x.kind_no, x.stop, x.value) for x in r.spans] for r in secret_scan.scan(docs_of(rows)).collect()}
    assert got == {d: plain_spans(t) for d, t in rows}


def test_ownership(docs_of):
    shared, own = "a" * 30, "b" * 30
    docs = docs_of([(i, f"{shared} {own if i == 1 else ''}") for i in range(6)]).withColumn("source", F.concat(F.lit("s"), (F.col("doc_id") % 3).cast("string")))
    out = {r.doc_id: (r.n_live, r.n_example, r.n_unclear) for r in secret_scan.secret_scan(docs.union(docs.where("doc_id = 1"))).collect()}
    assert out == {i: (int(i == 1), 1, 0) for i in range(6)}
    assert secret_scan.secret_scan(docs_of([])).count() == 0


def test_null_owners_and_repositories_are_values(docs_of):
    value = "c" * 30
    docs = docs_of([(i, value) for i in range(3)]).withColumns({  # (null, a), (a, null) and (null, null) are three repositories of two owners
        "source": F.when(F.col("doc_id") == 1, "a"), "lang": F.when(F.col("doc_id") == 0, "a")})
    scanned = secret_scan.scan(docs)
    found = secret_scan.ownership(scanned, F.struct("source", "lang"), F.col("source")).first()
    assert (found.n_repositories, found.n_owners, found.n_spans) == (3, 2, 3)
    assert {(r.n_live, r.n_example, r.n_unclear) for r in secret_scan.secret_scan(docs).collect()} == {(0, 0, 1)}


def test_long_texts_are_scanned_whole(docs_of):
    text = "x " * 400_000 + "secret: abcdef"
    assert [(s.start, s.stop) for r in secret_scan.scan(docs_of([(1, text)])).collect() for s in r.spans] == [(800_000, len(text))]


# ------------------------------------------------------------------ line dedup
def mutated(rnd, s, edits):
    s = list(s)
    for _ in range(edits):
        i, kind = rnd.randrange(len(s) + 1), rnd.randrange(3)
        if kind == 0:
            s.insert(i, rnd.choice("abé"))
        elif i < len(s):
            s[i : i + 1] = [] if kind == 1 else [rnd.choice("abé")]
    return "".join(s)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_edit_distance(spark, edits):
    rnd = random.Random(edits)
    rows = []
    for n in range(400):
        s = "".join(rnd.choice("abé") for _ in range(rnd.randrange(6, 30)))
        rows.append((n, s, mutated(rnd, s, rnd.randrange(0, 6))))
    got = {r.n for r in line_dedup.verified(spark.createDataFrame(rows, "n int, s string, t string"), edits).collect()}
    assert got == {n for n, s, t in rows if brute.edit_distance(s, t) <= edits}


def line_rows(seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcdefgh é") for _ in range(rnd.randrange(18, 60))) for _ in range(30)]
    return [(d, "\n".join(mutated(rnd, rnd.choice(base), rnd.choice([0, 0, 1, 2])) for _ in range(6))) for d in range(80)]


@pytest.mark.parametrize(("edits", "group"), [(1, 64), (1, 2), (2, 3)])
def test_links_are_all_pairs_within_the_edits(docs_of, edits, group):
    docs = line_rows(edits)
    lines = sorted({x for _, t in docs for x in t.split("\n") if len(x) >= 20})
    ids = {x: hashlib.md5(x.encode()).digest() for x in lines}
    want = {tuple(sorted((ids[a], ids[b]))) for i, a in enumerate(lines) for b in lines[:i] if abs(len(a) - len(b)) <= edits and brute.edit_distance(a, b) <= edits}
    assert {(bytes(r.a), bytes(r.b)) for r in line_dedup.links(docs_of(docs), edits, 20, group).collect()} == want


def test_pairs_beyond_one_edit_leave_before_the_recurrence(spark):
    rnd = random.Random(11)
    rows = []
    for n in range(400):
        s = "".join(rnd.choice("abé") for _ in range(rnd.randrange(2, 40)))
        t = mutated(rnd, s, rnd.randrange(0, 4))
        rows.append((n, s, t, len(s), len(t)))
    s = "x" * 99 + "ab" + "y" * 99
    rows += [(400, s, s.replace("ab", "cd"), 200, 200), (401, s, s.replace("ab", "a"), 200, 199), (402, s, s.replace("ab", "😀b"), 200, 200)]
    got = {r.n for r in line_dedup._agreeing(spark.createDataFrame(rows, "n int, s string, t string, sn int, tn int")).collect()}
    assert got == {n for n, s, t, *_ in rows if brute.edit_distance(s, t) <= 1}
    assert 400 not in got and {401, 402} <= got


def test_texts_are_read_twice_whatever_the_steps(spark):
    docs, read = line_rows(7), spark.sparkContext.accumulator(0)

    def counted(row):
        read.add(1)
        return row

    frame = spark.createDataFrame(spark.sparkContext.parallelize(docs, 2).map(counted), "doc_id long, text string")
    got = {r.doc_id: (list(r.removed), r.n_edited) for r in line_dedup.decisions(frame).collect()}
    assert got == brute.removed_lines(docs) and any(edited for _, edited in got.values())
    assert read.value <= 2 * len(docs)


def test_lines_removed(docs_of):
    docs = line_rows(5) + [(d, t) for d, t in AWKWARD if d in (1, 2, 3)] + [(0, "Yes.\nno\n" + "z" * 300), (0, "no\n \n" + "z" * 301 + "\nYes.")]
    docs = [(100 + i, t) for i, (_, t) in enumerate(docs)]
    want = brute.removed_lines(docs)
    got = {r.doc_id: (list(r.removed), r.n_edited) for r in line_dedup.decisions(docs_of(docs)).collect()}
    assert got == want
    assert any(len(t.split("\n")[i]) < 20 for d, t in docs if d in want for i in want[d][0])  # short lines too
    frame = docs_of(docs)
    out = line_dedup.dedup_lines(frame)
    assert out.columns == frame.columns
    for r in out.collect():
        text = dict(docs)[r.doc_id]
        if r.doc_id in want:
            text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in want[r.doc_id][0])
        assert r.text == text and r.n_chars == len(text or "")


def test_repeated_rows_keep_their_lines(docs_of):
    line = "the very same line of text"
    assert line_dedup.decisions(docs_of([(1, line), (1, line)])).count() == 0
    assert [(r.doc_id, list(r.removed)) for r in line_dedup.decisions(docs_of([(1, line), (2, line), (None, line)])).orderBy("doc_id").collect()] == [(None, [0]), (2, [0])]
    assert line_dedup.dedup_lines(docs_of([])).count() == 0
