"""WARC, SimHash, chunks, packing, chat and rollups on awkward rows and against plain versions."""

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from trendlake.llm import catalog, chat, chunk_dedup, components, packing, simhash, token_rollup, warc
from trendlake.session import scratch_dir


# ------------------------------------------------------------------ components
def test_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000, 1000 + i) for i in range(50)] + [(2000 + i, 2001 + i) for i in range(40)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame([*edges, (None, 1)], "u long, v long")).collect()}
    want = brute.roots({n for e in edges for n in e}, edges)
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: r for n, r in want.items() if n in linked}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


# ------------------------------------------------------------------ WARC
def payload(rnd):
    return rnd.choice([
        lambda: "", lambda: "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" * rnd.randrange(1, 30),
        lambda: "x" * rnd.randrange(2000) + "WARC/1.1\r\n" + "\r\n" * rnd.randrange(9), lambda: "\r\n\r\n" * rnd.randrange(1, 300),
        lambda: "WARC/1." * rnd.randrange(1, 200), lambda: "é€" * rnd.randrange(500),
    ])()


@pytest.fixture()
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k, v in zip(before, ("6000", "1")):
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("few", [True, False])
def test_archives_hold_every_payload_whatever_it_holds(spark, small_blocks, few, monkeypatch):
    monkeypatch.setattr(warc.common, "small", lambda df: few)
    rnd = random.Random(3)
    pages = [(i, f"http://h/{i}\r\nX: y", payload(rnd)) for i in range(50)]
    pages += [(60 + i, "u", pages[rnd.randrange(50)][2]) for i in range(20)] + [(500, None, None), (None, "n", "nul" * 80), (7, "again", pages[7][2])]
    frame = spark.createDataFrame([(*p, 1, "z") for p in pages], "page_id long, url string, html string, file int, digest string").coalesce(2)
    path = scratch_dir(spark, "warc")
    warc.write_warc(frame, path)
    read = warc.read_warc(spark, path)
    assert read.count() == len(pages)
    first = {}
    for i, _, h in pages:
        first[h or ""] = min(first.get(h or "", 10**9), 10**9 if i is None else i)
    whole = [(h or "").encode() for i, _, h in pages if len((h or "").encode()) < 100 or first[h or ""] == (10**9 if i is None else i)]
    assert sorted(bytes(r.payload) for r in read.where(warc.header("WARC-Type") == "response").collect()) == sorted(whole)
    out = warc.archive(frame)
    assert out.where("payload_bytes is null").count() == 0
    got = sorted((r.page_id is None, r.page_id or 0, r.payload_bytes, -1 if r.refers_to is None else r.refers_to) for r in out.collect())
    want = [(i is None, i or 0, len((h or "").encode()), first[h or ""] if len((h or "").encode()) >= 100 and first[h or ""] not in (i, 10**9) else -1) for i, _, h in pages]
    assert got == sorted(want)


def test_broken_files(spark, tmp_path):
    good = b"WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    for name, data in {"a": good + good, "b": b"junk" + good, "c": good + b"WARC/1.0\r\nno length\r\n\r\n" + good, "d": good + good[:-6], "e": b""}.items():
        (tmp_path / f"{name}.warc").write_bytes(data)
    got = sorted((r.file[-6:], r.offset, bytes(r.payload)) for r in warc.read_warc(spark, str(tmp_path)).collect())
    n = len(good)
    assert got == [("a.warc", 0, b"abc"), ("a.warc", n, b"abc"), ("c.warc", 0, b"abc"), ("d.warc", 0, b"abc")]


def test_empty_archive(spark):
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# ------------------------------------------------------------------ SimHash
def near_docs():
    rnd = random.Random(9)
    texts = [" ".join(rnd.choice("alpha beta gamma delta épsilon zeta Eta theta".split()) for _ in range(rnd.randrange(1, 60))) for _ in range(60)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, t in enumerate(texts[:20])]
    docs += [(200 + i, t + " omega") for i, t in enumerate(texts[:30])]
    return docs + [(300, None), (301, ""), (302, " \n"), (303, "One"), (304, "one two"), (None, "one"), (5, texts[5])]


@pytest.mark.parametrize("bits", [3, 8])
def test_near_duplicates(docs_of, bits):
    docs = near_docs()
    prints = [brute.simhash(t) for _, t in docs]
    linked = [(i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= bits]
    root = brute.roots(range(len(docs)), linked)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[root[i]] = min(least.get(root[i], 10**9), 10**9 if d is None else d)
    want = sorted((d is None, d or 0, prints[i], least[root[i]]) for i, (d, _) in enumerate(docs))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs_of(docs), max_bits=bits).collect())
    assert got == want


def test_tree_of_many_small_blocks_loses_no_link(spark):
    rnd = random.Random(11)
    base = [rnd.getrandbits(64) for _ in range(150)]
    fps = {b ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randrange(0, 4))) & (2**64 - 1) for b in base for _ in range(4)}
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in fps]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), 3, block=8).collect()
    got = brute.roots(fps, [(r.u % 2**64, r.v % 2**64) for r in edges])
    want = brute.roots(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3])
    assert got == want


def test_one_of_each_group_stays(docs_of):
    docs = docs_of(near_docs())
    out = simhash.deduplicate(docs)
    assert out.columns == docs.columns
    groups = simhash.near_duplicates(docs).select("root").distinct().count()
    assert out.count() == groups
    assert out.where("doc_id = 5").count() <= 1
    assert simhash.deduplicate(docs_of([])).count() == 0


# ------------------------------------------------------------------ chunks
def chunk_docs():
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefghijé") for _ in range(rnd.randrange(2, 9)))
    passage = " ".join(word() for _ in range(60))
    docs = [(i, " ".join(word() for _ in range(100))) for i in range(12)]
    docs += [(20 + i, " ".join(word() for _ in range(40)) + f" {passage} " + " ".join(word() for _ in range(40))) for i in range(5)]
    return docs + [(30, docs[0][1]), (31, docs[1][1][:300] + " inserted " + docs[1][1][300:]), (40, None), (41, ""), (42, "é" * 5000), (43, "a" * 3000)], passage


def plain_chunks(text):
    """(start, stop, bytes, content) by the rule: a chunk begins where the hash of 16 bytes is less than at the 16 places
    before and at most that at the 16 after, or 1024 bytes on, at the next whole letter."""
    gear = []
    for i in range(256):
        x = (i + 1) * 0x9E3779B97F4A7C15 % 2**64
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
        x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
        gear.append(x >> 32)
    data = text.encode()
    padded = bytes(64) + data + bytes(64)
    h = [sum(gear[padded[i - k]] << k for k in range(16)) % 2**32 for i in range(16, len(padded))]  # h[j] ends at padded[16 + j]
    at = lambda i: h[i + 64 - 16]
    whole = lambda i: next(j for j in range(i, i + 5) if j >= len(data) or data[j] & 0xC0 != 0x80)
    cuts = {whole(i) for i in range(len(data)) if at(i) < min(at(i - k) for k in range(1, 17)) and at(i) <= min(at(i + k) for k in range(1, 17))}
    cuts = sorted((cuts | {0}) - {len(data)})
    found = []
    for a, b in zip(cuts, [*cuts[1:], len(data)]):
        found += [a, *(whole(c) for c in range(a + 1024, b, 1024))]
    ends = [*found[1:], len(data)]
    return [(len(data[:a].decode()), len(data[:b].decode()), b - a, data[a:b]) for a, b in zip(found, ends)]


def test_repeated_spans(docs_of):
    docs, passage = chunk_docs()
    docs += [(50, "tiny"), (51, "tiny"), (52, "tiny one"), (53, "é"), (54, "é")]
    cut = lambda t: plain_chunks(t) if t else []
    want = brute.repeated_spans(docs, cut, chunk_dedup.MIN_BYTES)
    got = {(r.doc_id, r.start, r.stop, r.bytes, r.first_doc_id) for r in chunk_dedup.repeated_spans(docs_of(docs)).collect()}
    assert got == want
    assert {21, 22, 23, 24, 30, 31, 51, 54} <= {g[0] for g in got} <= {21, 22, 23, 24, 30, 31, 42, 43, 51, 54}
    frame = docs_of(docs)
    out = chunk_dedup.dedup_substrings(frame)
    assert out.columns == frame.columns
    for r in out.collect():
        text = dict(docs)[r.doc_id]
        for _, start, stop, *_ in sorted((g for g in want if g[0] == r.doc_id), reverse=True):
            text = text[:start] + text[stop:]
        assert r.text == text


def test_chunks_do_not_depend_on_what_is_around_a_text():
    docs, _ = chunk_docs()
    texts = [t or "" for _, t in docs]
    together = chunk_dedup.chunk_batch(texts)
    for i, t in enumerate(texts):
        mine = together[0] == i
        assert "".join(t[a:b] for a, b in zip(together[1][mine], together[2][mine])) == t
        if t:
            assert (together[4][mine] == chunk_dedup.chunk_batch([t])[4]).all()


def test_chunks_of_a_text_beyond_a_piece(docs_of, monkeypatch):
    rnd = random.Random(13)
    text = "".join(rnd.choice("abcdé \n") for _ in range(9000))
    monkeypatch.setattr(chunk_dedup, "PIECE", 1 << 11)
    owner, start, stop, size, _ = chunk_dedup.chunk_batch([text, "x", text])
    mine = owner == 2
    assert list(zip(start[mine].tolist(), stop[mine].tolist(), size[mine].tolist())) == [c[:3] for c in plain_chunks(text)]


def test_repeated_rows_are_no_copies(docs_of):
    docs, _ = chunk_docs()
    assert chunk_dedup.repeated_spans(docs_of([docs[0], docs[0]])).count() == 0
    assert chunk_dedup.repeated_spans(docs_of([])).count() == 0


# ------------------------------------------------------------------ packing
def encoded(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(catalog.tokenizer_path())
    return t.encode(text or "", add_special_tokens=False).ids


def test_token_ids_are_the_file_s_own():
    rnd = random.Random(8)
    ids = packing.ids_of(catalog.tokenizer_path())
    letters = [chr(c) for c in range(256)] + list("œ€漢😀​")
    for _ in range(3000):
        text = "".join(rnd.choice(letters) if rnd.random() < 0.5 else rnd.choice(" \n\t'abcs1") for _ in range(rnd.randrange(30)))
        assert ids.of(text) == np.array(ids.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    for text in ("<|endoftext|>", "a<|endoftext|> b <|endoftext|", "é<|endoftext|>漢", "<|endoftext|>\n<|endoftext|>"):
        assert ids.of(text) == np.array(encoded(text), "<u4").tobytes()
    assert encoded("<|endoftext|>") == [50256]


def test_pack(docs_of):
    rnd = random.Random(2)
    docs = [(i, " ".join(rnd.choice("of the and spark plan ésprit".split()) for _ in range(rnd.randrange(0, 90)))) for i in range(200)]
    docs += [(500, None), (501, ""), (503, "plain<|endoftext|>text"), (502, "word " * 700), (None, "no id"), (3, docs[3][1])]
    rows = packing.pack(docs_of(docs), catalog.tokenizer_path(), length=64).collect()
    pieces, places = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, text in docs:
        ids = np.array([*encoded(text), 0], "<u4")
        mine = sorted(pieces[doc_id], key=lambda r: r.piece)[:: 2 if doc_id == 3 else 1]
        assert [r.start for r in mine] == [0, *np.cumsum([r.length for r in mine])[:-1]]
        assert sum(r.length for r in mine) == len(ids) and all(r.length == 64 for r in mine[1:])
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in mine)
    for held in places.values():
        held.sort()
        assert [o for o, _ in held] == [0, *np.cumsum([n for _, n in held])[:-1]] and sum(n for _, n in held) <= 64
    total = sum(r.length for r in rows)
    assert len(places) <= 1.02 * -(-total // 64) + 1
    assert packing.pack(docs_of([]), catalog.tokenizer_path()).count() == 0


@pytest.mark.parametrize("scale", [1, 50])
def test_plan_uses_every_length_exactly(scale):
    rnd = np.random.default_rng(1)
    counts = np.bincount(np.minimum(rnd.gamma(2, 150, 3000).astype(int) + 1, 512), minlength=513) * scale
    plan = packing.plan(counts, 512)
    used = np.zeros(513, int)
    for lengths, repeats in plan:
        assert sum(lengths) <= 512 and repeats > 0
        for n in lengths:
            used[n] += repeats
    assert (used == counts).all()
    assert sum(r for _, r in plan) <= 1.01 * -(-(counts * np.arange(513)).sum() // 512) + 1


# ------------------------------------------------------------------ chat
def test_quotes_link_to_their_originals(spark):
    rows = [
        (1, 0, "user", "First question\nof two lines\n\nand a second part"),
        (1, 1, "assistant", "An answer\n\n> first   QUESTION\n> of two lines"),
        (1, 2, "user", "> > first question of two lines\n> An answer\nThanks"),
        (1, 3, "user", ">and a second part\n\nand what of this?"),
        (1, 4, "user", "> never written\n> > An answer\nhm"),
        (2, 0, "user", "> An answer\nseen elsewhere"), (2, 1, "user", None), (2, 2, "user", ""), (None, 0, "user", "> An answer\nx"), (3, None, "user", "y"),
        (1, 0, "user", "First question\nof two lines\n\nand a second part"),
    ]
    frame = spark.createDataFrame([(*r, "q", 5) for r in rows], "conv_id long, turn long, role string, text string, own string, depth int")
    out = chat.link_conversations(frame)
    got = {(r.conv_id, r.turn): (r.text, r.parent_turn, r.root_turn, r.depth, r.n_quoted, r.n_linked, r.n_foreign) for r in out.collect()}
    assert out.count() == len(rows)
    assert got[1, 1] == ("An answer", 0, 0, 1, 1, 1, 0)
    assert got[1, 2] == ("Thanks", 1, 0, 2, 2, 2, 0)
    assert got[1, 3] == ("and what of this?", 0, 0, 1, 1, 1, 0)
    assert got[1, 4] == ("hm", None, 4, 0, 2, 1, 0)
    assert got[2, 0] == ("seen elsewhere", None, 0, 0, 1, 0, 1)
    assert got[2, 1] == ("", None, 1, 0, 0, 0, 0)
    assert got[None, 0][1] is None and got[3, None][2] is None
    ordered = [(r.conv_id, r.turn) for r in chat.reply_ordered(out.where("conv_id = 1")).collect()]
    assert ordered == [(1, 0), (1, 0), (1, 1), (1, 3), (1, 2), (1, 4)]
    assert chat.link_conversations(frame.limit(0)).count() == 0


def test_nested_quotes_tell_parents_of_bare_messages(spark):
    rows = [(1, 0, "u", "zero"), (1, 1, "u", "one, with no quote"), (1, 2, "u", "two\n\n> one, with no quote\n>\n> > zero")]
    out = chat.link_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert {r.turn: (r.parent_turn, r.depth) for r in out.collect()} == {0: (None, 0), 1: (0, 1), 2: (1, 2)}


def test_quoting_and_linking_is_a_round_trip(spark):
    rows = [(c, t, "u", f"message {t} of {c}\n\nwith a part {t * c}") for c in range(3) for t in range(40)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.link_conversations(chat.quoted_replies(frame)).where("conv_id = 1").collect()
    assert {(r.turn, r.text, r.parent_turn, r.depth) for r in out} == {(t, x, t - 1 if t else None, t) for c, t, _, x in rows if c == 1}


# ------------------------------------------------------------------ rollups
CHANGE = "doc_id long, kind string, source string, lang string, tokenizer string, tokens long"


def test_rollup_follows_signed_changes(spark):
    root = scratch_dir(spark, "rollup")
    batch = lambda *rows: spark.createDataFrame(list(rows), CHANGE).withColumn("text_hash", F.lit(7).cast("long"))
    state = lambda: {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in token_rollup.totals(spark, root).collect()}
    assert state() == {}
    one = batch((1, "insert", "a", "en", "v1", 10), (2, "insert", "a", None, "v1", 5), (2, "insert", "a", None, "v1", 5), (3, "insert", "b", "en", "v1", None), (None, "insert", "b", "en", "v1", 2))
    assert token_rollup.commit(spark, root, 1, one) and not token_rollup.commit(spark, root, 1, one)
    assert state() == {("a", "en", "v1"): (1, 10), ("a", None, "v1"): (2, 10), ("b", "en", "v1"): (2, 2)}
    two = batch((1, "revise", "a", "en", "v1", 12), (2, "delete", None, None, None, None), (9, "delete", None, None, None, None), (3, "insert", "c", "en", "v1", 4), (1, "insert", "a", "en", "v2", 6))
    # a run that died before its commit leaves rows that a second one replaces
    token_rollup.deltas(two, token_rollup._held(token_rollup._ledger(spark, root, [1]))).limit(1).write.parquet(f"{root}/ledger/2")
    assert state()["a", "en", "v1"] == (1, 10)
    assert token_rollup.commit(spark, root, 2, two)
    want = {("a", "en", "v1"): (1, 12), ("a", "en", "v2"): (1, 6), ("b", "en", "v1"): (1, 2), ("c", "en", "v1"): (1, 4)}
    assert state() == want
    with pytest.raises(ValueError):
        token_rollup.commit(spark, root, 2, one)
    token_rollup.compact(spark, root)
    assert state() == want
    assert token_rollup.commit(spark, root, 4, batch((None, "delete", None, None, "v1", None)))
    assert state() == {k: v for k, v in want.items() if k[0] != "b"}
    assert token_rollup.commit(spark, root, 5, batch())
    with pytest.raises(ValueError):
        token_rollup.commit(spark, root, 3, one)


def plain_totals(rows):
    """Totals after the feed's three batches of (doc_id, text, source, lang)."""
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(x.split()[0]): int(x.split()[1]) for x in file}
    second = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    least, found = {}, {}
    for d, t, *_ in rows:
        least[t or ""] = min((d is None, d or 0), least.get(t or "", (True, 0)))
    for d, t, source, lang in rows:
        if (d is None, d or 0) == least[t or ""]:
            for name, n in (("byte_bpe_50k", len(first.encode(t or "", add_special_tokens=False).ids) + 1), ("byte_bpe_multi_50k", len(second.encode_ordinary(t or "")))):
                docs, tokens = found.get((source, lang, name), (0, 0))
                found[source, lang, name] = docs + 1, tokens + n
    return found


def test_feed_of_documents_is_the_sum_of_its_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "a b"), (4, "a b"), (None, "a b"), (5, "é! x<|endoftext|>"), (5, "shared id"), (5, "shared id"), (None, "no id"), (None, "no id"), (None, "none"), (6, "x" * 70_000)]
    docs = docs_of(rows).withColumn("source", F.when(F.col("doc_id") > 3, "s"))
    root = scratch_dir(spark, "rollup")
    for number, changes in enumerate(token_rollup.document_feed(docs, catalog.tokenizers())):
        token_rollup.commit(spark, root, number, changes)
    got = {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in token_rollup.totals(spark, root).collect()}
    assert got == plain_totals([(r.doc_id, r.text, r.source, r.lang) for r in docs.collect()])
    assert got[None, "en", "byte_bpe_50k"][0] == 5 and got["s", "en", "byte_bpe_50k"][0] == 4


def test_totals_of_the_corpus(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.exists(folder):
        pytest.skip("driver test data not present")
    rows = [(r.doc_id, r.text, r.source, r.lang) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in catalog.op10_token_rollup(spark, folder).collect()}
    assert got == plain_totals(rows)
