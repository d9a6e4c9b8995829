"""Conversation repair, main text and spelling variants against plain versions and on awkward rows."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm import brute
from trendlake.llm import catalog, common, conversation_repair, html_text, spelling

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


# ------------------------------------------------------------------ conversation repair
def plain_edits(rows):
    """(cost, audit, repaired rows) of [(role, text, fault)], by relaxing all states from the right."""
    step = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
    after = None
    for i in range(len(rows), -1, -1):
        best = {}
        for _ in range(6):
            for q in range(4):
                ways = [best[q]] if q in best else []
                if i == len(rows):
                    ways += [(0, "", ())] if q in (0, 3) else []
                else:
                    role, text, fault = rows[i]
                    (c, a, r), more = after[q], 5 * (fault == "truncated")
                    ways.append((c + 2, "D" + a, r))
                    if fault not in ("blank", "duplicate"):
                        name, to = step[q]
                        ways.append((after[to][0] + 1 + more, "R" + after[to][1], (f"{name}:{text}", *after[to][2])))
                        if role[:1] == name[0]:
                            ways.append((after[to][0] + more, "K" + after[to][1], (f"{role}:{text}", *after[to][2])))
                        if q == 0 and role[:1] == "s":
                            ways.append((after[1][0] + more, "K" + after[1][1], (f"{role}:{text}", *after[1][2])))
                name, to = step[q]
                if to in best:
                    c, a, r = best[to]
                    ways.append((c + 5, "I" + a, (f"{name}:", *r)))
                if ways:
                    best[q] = min(ways)
        after = best
    return after[0]


def plain_audit(conversations, damage=True):
    """{conv_id: columns} of (conv_id, turn, role, text)."""
    out, told = {}, {}
    say = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in conversations:
        rows = told.setdefault(conv, [])
        kind = zlib.crc32(f"{say(conv)}:{say(turn)}".encode()) % 20 if damage else 9
        role, text = say(role), say(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    for conv, rows in told.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faulty = set(), []
        for _, role, text in rows:
            shown = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
            seen.add((role, text))
            faulty.append((role, text, fault))
        count = Counter(f for *_, f in faulty)
        turns = {t for t, *_ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(faulty, faulty[1:]))
        cost, audit, repaired = plain_edits(faulty)
        digest = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest)
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def found_audits(df):
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in df.collect()}


@needs_data
def test_audits_equal_the_plain_version(spark):
    rows = common.table(spark, SF, "conversations")
    got = found_audits(catalog.op11_conversation_repair(spark, SF))
    assert got == plain_audit([(r.conv_id, r.turn, r.role, r.text) for r in rows.collect()])


AWKWARD_TALK = [
    (None, None, None, None), (None, 3, "user", "Hello."), (None, 3, "user", "Hello."), (1, 0, "", "x."), (1, 2, "system", "Rules!"), (1, 2, "assistant", "And?"),
    (2, None, "user", " \t"), (3, 5, "assistant", "a."), (3, -4, "umpire", "é…"), (4, 7, "tool", "z" * 300_000 + "."), (5, 1, "system", "Only rules."),
]


@pytest.mark.parametrize("damage", [False, True])
def test_audits_of_awkward_rows(spark, damage):
    rnd = random.Random(5)
    talk = list(AWKWARD_TALK)
    for conv in range(20, 60):
        talk += [(conv, t, rnd.choice(["user", "assistant", "user", "assistant", "system", None, "x"]), rnd.choice(["Yes.", "No", "", "Why?", f"w{t}!"])) for t in range(rnd.randrange(1, 30))]
    df = spark.createDataFrame([(*r, 1, "k", 2) for r in talk], "conv_id long, turn long, role string, text string, pos int, c string, step int")
    rows = conversation_repair.damaged(df) if damage else df
    got = found_audits(conversation_repair.audited(df, rows, 7))  # several blocks
    assert got == plain_audit(talk, damage)
    none = df.where("false")
    assert conversation_repair.audited(none, conversation_repair.damaged(none)).count() == 0


def test_long_blocks_take_few_steps():
    rnd = random.Random(6)
    codes = "".join(rnd.choice(conversation_repair.CODES) for _ in range(50_000))
    prices = conversation_repair.columns(codes, None)
    steps, _ = conversation_repair.trace(codes, prices, 0, True)
    letters = "".join(s[::2] for s in steps)
    assert prices[0][0] == sum({"D": 2, "I": 5, "R": 1, "K": 0}[x] for x in letters) + 5 * sum(
        conversation_repair.CODES.index(c) % 3 == 1 and s[-2] != "D" for c, s in zip(codes, steps)
    )


# ------------------------------------------------------------------ main text
PROSE = "It was the best of the days that we had in that year, and all of it is told here as it was. " * 3
OTHER = "This is what one of the readers has to say about it, and it is as long as the text of the page itself was. " * 3


def page(body):
    return f"<!doctype html><html><head><title>T the</title><style>p{{}}</style></head><body class='has-sidebar'>{body}</body></html>"


CASES = {
    "marked up": ("<header><p>The site of the year</p></header><nav><a href=x>Home</a></nav><article><h1>Title</h1><p>" + PROSE + "<p>Short.<aside>" + OTHER + "</aside></article>"
                  "<section id='comments'><p>" + OTHER + "</p></section><footer>&copy; it</footer>", ["Title", PROSE, "Short."]),
    "plain": ("<div class=menu><a href=a>One</a> <a href=b>Two</a></div><div><h2>Of it</h2><p>" + PROSE + "</p><p>And so.</p><p>" + PROSE + "</p></div><div id=cookieNotice>" + OTHER + "</div>"
              "<ul><li><a href=x>More of the same in that place</a></li></ul>", ["Of it", PROSE, "And so.", PROSE]),
    "references": ("<article><p>Fish &amp; chips &lt;b&gt; &#233;&nbsp;&eacute; &amp; &amp  \n\t it" + "</p></article>", ["Fish & chips <b> é é & & it"]),
    "form around": ("<form id=all><input name=q><article><p>" + PROSE + "</p><button>Send it</button></article></form><form><p>" + OTHER + "</p></form>", [PROSE]),
    "scripts": ("<article><p>" + PROSE + "<script>if (a<b) document.write('<p>The " + OTHER + "</p>')</script></p><!-- <p>" + OTHER + "</p> --><noscript>" + OTHER + "</noscript></article>", [PROSE]),
    "nested article": ("<article><p>" + PROSE + "</p><article><p>" + OTHER + "</p></article></article>", [PROSE]),
    "linked list": ("<main><p>" + PROSE + "</p><ul><li><a href=1>" + OTHER + "</a></li></ul></main><div><p>" + OTHER + "</p></div>", [PROSE]),
    "hidden": ("<article><div hidden>" + OTHER + "</div><div style='display: none'>" + OTHER + "</div><p>" + PROSE + "</p><div class='post-ad'>" + OTHER + "</div></article>", [PROSE]),
    "line breaks": ("<article><p>One of<br>the two<br><br>is <b>bold</b>er</p></article>", ["One of the two", "is bolder"]),
    "another language": ("<article><p>" + "слово за словом " * 20 + "</p></article>", ["слово за словом " * 20]),
    "open quote": ("<article><p title=\"x>" + PROSE + "</p></article>", [PROSE]),
}


@pytest.mark.parametrize("name", CASES)
def test_main_text(name):
    body, want = CASES[name]
    assert html_text.main_text(page(body)) == "\n\n".join(" ".join(w.split()) for w in want)


@needs_data
def test_main_text_of_every_page_is_its_article(spark):
    import html

    pages = common.table(spark, SF, "pages")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in catalog.op12_html_text(spark, SF).collect()}
    want = {}
    for r in pages.collect():
        inner = re.search("<article>(.*)</article>", r.html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("</?b>", "", x)).split()) for x in re.split("</?(?:p|h1)>", inner)]
        text = "\n\n".join(b for b in blocks if b)
        want[r.page_id] = (r.url, text, len(text))
    assert got == want


def test_awkward_pages(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<"), (3, "u", "<"), (None, "u", "<p"), (4, "u", "a < b & c"), (5, "u", "<!--"), (6, "u", "</p></div></x>"), (7, "u", PROSE)]
    rows += [(8, "u", page("<article><p>" + PROSE * 3000 + "</p></article>")), (9, "u", "<a \"" * 50_000), (10, "u", "<div>" * 50_000 + PROSE), (11, "u", "&#xD800; &#0; &#x110000;")]
    df = spark.createDataFrame([(*r, 5, "t") for r in rows], "page_id long, url string, html string, n_chars int, text string")
    got = sorted(((r.page_id or 0, r.text) for r in html_text.extract(df).collect()), key=lambda r: r[0])
    text = dict(got)
    assert len(got) == len(rows) and text[7] == text[10] == " ".join(PROSE.split()) and text[8] == " ".join((PROSE * 3000).split())
    assert all(text[i] == "" for i in (0, 1, 2, 5, 6, 9))
    assert html_text.extract(df.where("false")).count() == 0
    blocks = html_text.page_blocks(df.where("page_id in (7, 8)")).orderBy("page_id", "number").collect()
    assert [(b.page_id, b.number, b.label, b.heading, b.dropped) for b in blocks] == [(7, 0, "good", False, False), (8, 0, "bad", False, True), (8, 1, "good", False, False)]


# ------------------------------------------------------------------ spelling variants
def plain_words(docs, spoil=True):
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if spoil and h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def plain_variants(words):
    near = {w: [] for w in words}
    holes = {}
    for w in words:  # words one edit apart share a hole, or one is the other's
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1 :]), set()).add(w)
    for (a, b), held in holes.items():
        for w in held:
            near[w] += [x for x in held if x != w]
        if a + b in near:
            near[a + b] += held
            for w in held:
                near[w].append(a + b)
    out = {}
    for w, n in words.items():
        close = sorted(set(near[w]), key=lambda x: (-words[x], x))
        form = close[0] if close and words[close[0]] >= 2 * n else None
        out[w] = (form, n, len(close), form and words[form])
    def root(w):
        return root(out[w][0]) if out[w][0] else w
    return {w: (form, root(w), n, k, m) for w, (form, n, k, m) in out.items()}


def found_variants(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@needs_data
def test_variants_equal_the_plain_version(spark):
    docs = [(r.doc_id, r.text) for r in common.table(spark, SF, "documents").collect()]
    got = found_variants(catalog.op13_spelling_variants(spark, SF))
    assert got == plain_variants(plain_words(docs)) and any(v[0] for v in got.values())


def test_variants_of_awkward_words(spark, docs_of):
    rnd = random.Random(7)
    base = ["aaaaa", "aaaab", "aaaaaa", "baaaa", "listen", "silent", "enlist", "éàüöñ", "éàüöñÿ", "x" * 20_000, "x" * 20_001, "x" * 9_999 + "y" + "x" * 10_000, "Word's"]
    base += ["".join(rnd.choice("abcé") for _ in range(rnd.randrange(4, 8))) for _ in range(150)]
    rows = [(i if i % 9 else None, " ".join(rnd.choice(base) for _ in range(40))) for i in range(60)] + [(1, None), (2, ""), (3, "1 2 3"), (3, "1 2 3")]
    rows += [(300 + i, ("chain" + "b" * i + " ") * (3 * 2**i)) for i in range(9)]
    for spoil in (True, False):
        got = found_variants(spelling.variant_groups(spelling.words(docs_of(rows), spoil)))
        assert got == plain_variants(plain_words(rows, spoil))
    assert got["chain"][1] == "chain" + "b" * 8
    assert spelling.variant_groups(spelling.words(docs_of(rows[:0] + [(1, None)]))).count() == 0


def test_near_words_share_a_signature():
    rnd = random.Random(8)
    for _ in range(3000):
        w = "".join(rnd.choice("abcdé") for _ in range(rnd.randrange(5, 14)))
        i, c = rnd.randrange(len(w)), rnd.choice("abcxyz")
        x = rnd.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]])
        assert brute.edit_distance(w, x) <= 1 and set(spelling.signatures(w)) & set(spelling.signatures(x))
