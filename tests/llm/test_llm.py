"""Operators against brute force, round trips, and their defined cases: nulls, empty and long texts, ties, repeated rows,
empty tables, extra columns."""

from __future__ import annotations

import collections
import hashlib
import math
import os
import random
import zlib

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from pitchside.llm import mixing, mpegts, ngram, packing, quality, queries, rules, sharding, simhash, tokenfile, warc
from pitchside.llm.shared import materialise
from pitchside.llm.tokens import MemoTokenizer

SF = "/root/testdata/sf0.001"
LONG = "word other third " * 20_000
TEXTS = ["", None, " ", "a", "one two three", "one two three", "ONE  two\tthree", "x\n\n\ny x\x0bz", "日本 語 é　x \x85 y", "<|endoftext|> it's 'tis  ", LONG, LONG, "the same line here now\n" * 30]


@pytest.fixture(scope="module")
def odd(spark):
    """Awkward documents, some repeated, one without an id, with columns named like the operators' own."""
    rows = [(k, t, "en", [None, "b", "a", "hot"][k % 4], len(t or ""), "x", 1) for k, t in enumerate(TEXTS)]
    rows += [rows[4], rows[4], (None, "no id at all", None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size string, shard int")


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def path():
    return queries.tokenizer_path()


@pytest.fixture(scope="module")
def model(path):
    return MemoTokenizer(path)


def words(text):
    return (text or "").encode().split()


# --- tokens


CUTS = ["a,b", "it's,'s 't", "a.\nB c", "a.\n\nB", "a\nB\n", "a\n b", "A\n", "\nA", "a.\n'sB", "ab?! c)d é,x x,é \u2028a,\u2028 a\u2028\nB", "one,two.\nThree don't.", ",,, a,, \n,a \n", "a\x0b\nB a \nB", "9.\nA 9,a a9,", "a\r\nb\n\nc", "x.\n\t\nY", "(a)\n(b)", "a'\nB 's\nC", "\n\nA.\nB"]


@pytest.mark.parametrize("most", [5, 1000])
def test_memo_gives_the_librarys_ids(path, docs, most):
    memo = MemoTokenizer(path, most)
    for texts in (TEXTS, [r.text for r in docs.limit(40).collect()], TEXTS, ["a  b", " a b", "a b ", "\n a\n b", "a \n b", "  ", "x  y z"]):
        ids, counts = memo.encode(texts, 7)
        at = 0
        for text, n in zip(texts, counts.tolist(), strict=True):
            assert ids[at : at + n].tolist() == [*memo.model.encode(text or "", add_special_tokens=False).ids, 7]
            at += n
        assert at == len(ids)


def test_memo_on_random_texts(path):
    rng = random.Random(8)
    memo = MemoTokenizer(path, 500)
    for _ in range(30):
        texts = ["".join(rng.choice("ab AZ,.'\n\n!s t9é\u2028\t  ") for _ in range(rng.randint(0, 40))) for _ in range(200)]
        ids, counts = memo.encode(texts, 7)
        at = 0
        for text, n, own in zip(texts, counts.tolist(), memo.model.encode_batch(texts, add_special_tokens=False), strict=True):
            assert ids[at : at + n].tolist() == [*own.ids, 7], repr(text)
            at += n


# --- 1


def test_archives_and_index(spark):
    same = "y" * 200
    rows = [(None, None, None), (1, "http://a.b/x", same), (2, "http://a.b/x", same), (2, "http://a.b/x", same), (1, "http://a.b/x", same), (5, "q r", "z"), (6, "http://C.d:81/?\n", "z"), (7, None, same), (None, "http://a.b/x", same), (8, "http://e/", "é" * 30_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("file", F.lit("x"))
    root, index = warc.archive(spark, pages)
    got = warc.resolved(warc.read_records(index.find(warc.keyed(pages)), root)).collect()
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        again = len(data) >= 100 and html == same and page != 1
        want.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 1 if again else None))
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=key) == sorted(want, key=key)
    assert [x[1] for x in warc.Finder(index).find("b,a)/x")] == [warc.NONE, 1, 1, 2, 2]
    assert list(warc.Finder(index).find("nowhere")) == []


def test_index_over_many_blocks(spark):
    pages = spark.range(500).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), F.col("id") % 7, F.lit(".org/"), F.col("id") % 50).alias("url"), F.col("id").cast("string").alias("html"))
    root = warc.shared_dir(spark, "test")
    index = warc.CaptureIndex.build(warc.write_archives(pages, root, roll=2000), root, block=4, ranges=5)
    assert len(index.ranges) == 5
    finder = warc.Finder(index)
    for r in pages.collect():
        found = list(finder.find(warc.url_key(r.url), r.page_id))
        assert len(found) == 1
        _, _, file, offset, length = found[0]
        at, folder = warc.filesystem(f"{root}/warc")
        with at.open_input_file(f"{folder}/{file}") as f:
            assert warc.parse(f.read_at(length, offset)).payload == r.html.encode()
    assert len(list(finder.find("org,h0)/0"))) == sum(k % 7 == 0 and k % 50 == 0 for k in range(500))


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    root, index = warc.archive(spark, pages)
    assert warc.resolved(warc.read_records(index.find(warc.keyed(pages)), root)).count() == 0


# --- 2


def brute_rules(text):
    own = words(text)
    lines, n_dup, seen = (text or "").split("\n"), 0, set()
    for line in lines:
        if words(line):
            n_dup += line in seen
            seen.add(line)
    windows = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
    count = collections.Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    chars = sum(len(w.decode()) for w in own)
    return len(own), chars, sum((text or "").count(c) for c in "#*$%&|<>"), n_dup, len(inside), len(own) < 10 or 100 * len(inside) > 20 * len(own)


def test_base_rules(odd, docs):
    for df in (odd, docs.withColumn("removed", F.lit(1))):
        texts = {(r.doc_id, r.text): brute_rules(r.text) for r in df.collect()}
        got = rules.verdicts(df).collect()
        assert len(got) == df.count()
        by_id = collections.defaultdict(list)
        for (i, _), v in texts.items():
            by_id[i].append(v)
        for r in got:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) in by_id[r.doc_id]


def brute_verdicts(rows, most, least_share=0.3, least_words=10):
    """Removed words, lines and whether a document is kept, by (doc_id, host, text)."""
    lower = {c: c + 32 for c in range(65, 91)}
    normal = lambda line: b" ".join(words(line.translate(lower)))
    documents = {(i, t or "", h) for i, t, h in rows}
    holders = collections.defaultdict(set)
    for i, t, h in documents:
        for line in t.split("\n"):
            if words(line):
                holders[h, normal(line)].add((i, t))
    out = {}
    for i, t, h in documents:
        gone, n = set(), 0
        first = min((j for j, u, g in documents if (u, g) == (t, h) and j is not None), default=None)
        for line in t.split("\n"):
            own = holders.get((h, normal(line)), set())
            if words(line) and len(own) > most and not (len({u for _, u in own}) <= most and i == first):
                n += len(words(line))
                gone.add(normal(line))
        left = len(words(t)) - n
        failed = brute_rules(t)[-1]
        out[i, t, h] = n, gone, not failed and not (n and (left < least_words or left < least_share * len(words(t))))
    return out


def check_verdicts(docs, most):
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    want = brute_verdicts(rows, most)
    got = rules.verdicts(docs, most=most).collect()
    assert collections.Counter((r.doc_id, r.host, r.removed_words, r.kept) for r in got) == collections.Counter((i, h, want[i, t or "", h][0], want[i, t or "", h][2]) for i, t, h in rows)
    lower = {c: c + 32 for c in range(65, 91)}
    strip = lambda t, gone: "\n".join(x for x in t.split("\n") if b" ".join(words(x.translate(lower))) not in gone or not words(x)) if gone else t
    left = rules.cleaned(docs, most=most)
    assert left.columns == docs.columns
    assert collections.Counter((r.doc_id, r.source, r.text) for r in left.collect()) == collections.Counter((i, h, strip(t or "", want[i, t or "", h][1])) for i, t, h in rows if want[i, t or "", h][2])
    return want


def test_shared_lines(spark, none):
    own = lambda k: " ".join(f"w{k}x{i}" for i in range(20))
    rows = [(k, f"Shared  LINE of a site here {own(k)}\nthis line is on every page of it", "h") for k in range(6)]
    rows += [(10 + k, "this Line is on every\tpage of it\n" + " ".join(f"t{k}x{i}" for i in range(8)), "h") for k in range(3)]  # little else
    rows += [(20 + k, own(99), "h") for k in range(9)] + [(None, own(99), "h")]  # copies: one stays
    rows += [(30, "this line is on every page of it\n" + own(30), "other"), (None, "this line is on every page of it\n" + own(31), None), (31, None, "h"), (31, " \n\n", "h")]
    rows += [(40, own(40) + "\n" + own(41), "h"), (40, own(40) + "\n" + own(41), "h"), (40, own(42), "h"), (None, own(43), None), (None, own(43), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_chars", F.length("text")).withColumns({c: F.lit(1) for c in ("removed", "mark", "host", "kept", "rules_0")})
    want = check_verdicts(docs, 5)
    kept = {i for (i, t, _), v in want.items() if v[2] and t}
    assert 20 in kept and not kept & {10, 11, 12, *range(21, 29)}
    assert all("every page" not in r.text and r.n_chars == len(r.text) for r in rules.cleaned(docs, most=5).where("source = 'h'").collect())
    assert rules.cleaned(none).count() == 0 and rules.cleaned(none).columns == none.columns


@pytest.mark.parametrize("most", [1, 3, 25])
def test_verdicts_on_odd_and_plain(odd, docs, most):
    check_verdicts(odd, most)
    check_verdicts(docs.select("doc_id", "text", "source"), most)


# --- 3


def check_pieces(model, df, got, capacity=1024):
    want = collections.defaultdict(list)
    for r in df.collect():
        ids = [*model.model.encode(r.text or "", add_special_tokens=False).ids, 0]
        want[r.doc_id].append(ids)
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(want)
    for doc, pieces in by_doc.items():
        assert sum(r.length for r in pieces) == sum(map(len, want[doc]))
        for r in pieces:
            assert any(len(ids) == r.doc_tokens and zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for ids in want[doc])
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        padding += 0 if at & at - 1 == 0 else capacity - at
    return padding


def test_packing(odd, docs, path, model, none):
    for df in (odd, docs.repartition(3)):
        assert check_pieces(model, df, packing.pack_documents(df, path, wave=8).collect()) == 0
    assert packing.pack_documents(none, path).count() == 0
    ids = packing.pack_documents(docs.limit(5), path, with_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in ids)


def test_closest_is_the_best_subset():
    rng = random.Random(3)
    for _ in range(200):
        counts = sorted(((rng.randint(1, 40), rng.randint(1, 3)) for _ in range(5)), reverse=True)
        counts = sorted(dict(counts).items(), reverse=True)
        room = rng.randint(1, 120)
        sums = {0}
        for length, many in counts:
            sums = {s + length * k for s in sums for k in range(many + 1)}
        use = packing.closest(counts, room)
        assert sum(x * n for x, n in use.items()) == max(s for s in sums if s <= room)
        assert all(n <= dict(counts)[x] for x, n in use.items())


# --- 4


def brute_fingerprint(text):
    own = [w.decode() for w in words((text or "").translate({c: c + 32 for c in range(65, 91)}))]
    grams = [" ".join(own[i : i + 4]) for i in range(len(own) - 3)] if len(own) >= 4 else [" ".join(own)] if own else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    distinct = sorted(set(fps))
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    return {f: find(f) for f in distinct}


def test_near_duplicates(odd, docs, none):
    for df in (odd, docs):
        texts = [(r.doc_id, brute_fingerprint(r.text)) for r in df.collect()]
        root = brute_components([f for _, f in texts])
        least = collections.defaultdict(list)
        for i, f in texts:
            if i is not None:
                least[root[f]].append(i)
        want = sorted((str(i), f, min(least[root[f]], default=None)) for i, f in texts)
        got = sorted((str(r.doc_id), r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(df).collect())
        assert got == want
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("plan", [{}, {"rounds": 1}, {"blocks": 3, "keep": 2}, {"blocks": 3, "keep": 2, "crowd": 2}])
def test_links_of_crowded_fingerprints(spark, plan):
    rng = random.Random(5)
    center = rng.getrandbits(64)
    fps = {center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))) for _ in range(150)} | {rng.getrandbits(64) for _ in range(50)}
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in fps]
    found = simhash.components(simhash.links(materialise(spark.createDataFrame(signed, "fp long"), "test"), **plan)).collect()
    got = {r.node % 2**64: r.root % 2**64 for r in found}
    parts = lambda m: sorted(sorted(k for k in fps if m(k) == v) for v in {m(f) for f in fps})
    root = brute_components(fps)
    assert parts(lambda f: got.get(f, f)) == parts(root.__getitem__)


def test_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {k: 0 for k in range(1, 201)} | {501: 500}


def test_one_of_each(odd, none):
    kept = simhash.one_of_each(odd)
    assert simhash.one_of_each(none).count() == 0
    assert kept.columns == odd.columns
    texts = [r.text for r in kept.collect()]
    assert texts.count(LONG) == 1 and sum((t or "").lower().split() == ["one", "two", "three"] for t in texts) == 1


def test_one_of_each_group_whatever_the_ids(spark):
    text = lambda k: " ".join(f"g{k}x{i}" for i in range(40))
    rows = [(None, text(1), "a"), (None, text(2), "a"), (None, text(2), "a"), (None, text(3), "a"), (3, text(3), "a")]  # no ids, one a copy of an id'd text
    rows += [(0, text(0), "a"), (4, text(4), "a"), (4, text(5), "a"), (4, text(5), "b"), (4, text(5), "a")]  # an id on two texts, one of them thrice
    rows += [(6, text(6), "a"), (7, text(6), "a"), (7, text(7), "a"), (8, text(8), "a"), (9, text(8), "a"), (9, text(9), "a"), (9, text(9), "a")]  # 7 and 9: a copy of another's, and a text of its own
    docs = spark.createDataFrame(rows, "doc_id long, text string, key_id string")
    got = sorted(((r.doc_id, r.text, r.key_id) for r in simhash.one_of_each(docs).collect()), key=lambda r: r[1])
    ids = {0: 0, 1: None, 2: None, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, 8: 8, 9: 9}
    assert got == [(i, text(k), "a") for k, i in ids.items()]


# --- 5


def test_id_files(odd, docs, path, model, none):
    for df in (odd, docs):
        rows = sorted(df.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
        got = sorted(tokenfile.write_and_read(df, path).collect(), key=lambda r: r.start)
        at = 0
        for r, g in zip(rows, got, strict=True):
            ids = [*model.model.encode(r.text or "", add_special_tokens=False).ids, 2]
            assert (g.doc_id, g.start, g.n_tokens, g.ids_crc32) == (r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
            at += len(ids)
    assert tokenfile.write_and_read(none, path).count() == 0


@pytest.mark.parametrize("n", [1, 2, 31, 33, 4095, 4096, 4097, 9000])
def test_coder_round_trip(n, monkeypatch):
    monkeypatch.setattr(tokenfile, "LANES", 2)
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 65536, n), np.full(n, 65535), np.zeros(n), rng.integers(0, 3, n), np.arange(n) % 700, rng.zipf(1.3, n) % 50_000, np.where(rng.random(n) < 0.001, rng.integers(0, 65536, n), 5)):
        ids = ids.astype(np.uint16)
        data = tokenfile.encode_file([None, 3], np.array([1, n - 1]), ids)
        doc_ids, counts, back = tokenfile.decode_file(data)
        assert doc_ids == [None, 3] and counts.tolist() == [1, n - 1] and (back == ids).all()


def test_coder_compresses_and_notices_damage(model, docs):
    ids, counts = model.encode([r.text for r in docs.collect()], 2)
    data = tokenfile.encode_file(list(range(len(counts))), counts, ids)
    blocks = [ids[a : a + tokenfile.BLOCK].astype("<u2").tobytes() for a in range(0, len(ids), tokenfile.BLOCK)]
    assert len(data) < 0.9 * sum(len(zlib.compress(x, 6)) for x in blocks) and len(data) < 0.9 * sum(len(zstandard.compress(x, 3)) for x in blocks)
    for at in (100, len(data) // 2, len(data) - 70):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(ValueError, match="checksum"):
            tokenfile.decode_file(bytes(bad))


# --- 6


def test_streams(odd, none):
    got = mpegts.read_streams(mpegts.stored(odd)).collect()
    streams = collections.Counter((r.doc_id, len(r.media), hashlib.sha256(r.media).hexdigest()) for r in mpegts.with_streams(odd).collect())
    assert collections.Counter((r.doc_id, r.media_bytes, r.media_sha256) for r in got) == streams
    want = collections.Counter()
    for r in odd.collect():
        data = (r.text or "").encode()
        payload = data.ljust(max(192, -(-len(data) // 192) * 192))
        want[r.doc_id, len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:])] += 1
    assert collections.Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == want
    assert all(r.errors == 0 and r.media_bytes % 188 == 0 and r.first_pts == 0 for r in got)
    for r in got:  # the feature, from the payload's length alone
        units = -(-r.payload_bytes // 4096)
        raps = -(-units // 8)
        packets = 2 * raps + sum(-(-(14 + min(4096, r.payload_bytes - 4096 * k) + 8 * (k % 8 == 0)) // 184) for k in range(units))
        last, step = (units - 1) * 4096 * 90_000 // 8000, 46080 if units > 1 else ""
        assert r.feature == f"pids=256:6;packets={packets};units={units};raps={raps};pts=0..{last};step={step};pcr=0;errors=0"
        assert r.last_pts == last and [x.pts for x in r.raps] == [8 * 46080 * k for k in range(raps)] and r.media_bytes == 188 * packets
    assert mpegts.read_streams(mpegts.with_streams(none)).count() == 0


def test_damaged_streams():
    payload = mpegts.padded(os.urandom(30_000))
    stream = mpegts.encode(payload)
    whole = mpegts.decode(stream)
    assert (whole.payload, whole.errors, whole.programs, whole.streams) == (payload, 0, {1: 0x1000}, {0x100: 6})
    assert [x[0] for x in whole.stamps] == list(range(0, 30_144, 4096)) and whole.stamps[0][3] == 0 and [x[2] for x in whole.stamps] == [True] + [False] * 7
    lost = mpegts.decode(stream[: 188 * 5] + stream[188 * 6 :])
    assert lost.errors and lost.payload == payload[4096:]
    table = bytearray(stream)
    table[188 + 20] ^= 1
    assert mpegts.decode(bytes(table)).errors
    assert mpegts.decode(b"").payload == b"" and mpegts.decode(stream[:-7]).errors


def test_streams_can_be_read_from_any_random_access_point():
    payload = mpegts.padded(os.urandom(150_000))
    stream = mpegts.encode(payload)
    whole = mpegts.decode(stream)
    points = [x for x in whole.stamps if x[2]]
    assert whole.errors == 0 and whole.payload == payload and len(points) == 5
    for byte, pts, _, at in points:
        part = mpegts.decode(stream[at:])
        assert part.errors == 0 and part.payload == payload[byte:] and part.stamps[0][:3] == (0, pts, True) and part.clock == pts
        for later in (pts, pts + 46080 * 7 + 5):
            assert mpegts.seek(stream, later)[0] == at and mpegts.seek(stream, later)[1].payload == payload[byte:]
    assert mpegts.seek(stream, -1) == (0, whole)


def test_streams_of_other_writers():
    """A packet that comes twice, an announced jump of the counter, and a table over two packets are no errors."""
    payload = mpegts.padded(os.urandom(30_000))
    stream = mpegts.encode(payload)
    packets = [stream[i : i + 188] for i in range(0, len(stream), 188)]
    twice = mpegts.decode(b"".join([*packets[:6], packets[5], *packets[6:]]))
    assert (twice.payload, twice.errors) == (payload, 0)
    assert mpegts.decode(b"".join([*packets[:6], packets[5], packets[5], *packets[6:]])).errors
    second = next(k for k in range(3, len(packets)) if packets[k][1] & 0x40)  # the second unit's first packet
    jumped = [p if k < second else p[:3] + bytes([p[3] & 0xF0 | (p[3] & 15) + 5 & 15]) + p[4:] for k, p in enumerate(packets)]
    assert mpegts.decode(b"".join(jumped)).errors == 1
    body = packets[second][4:]
    told = packets[second][:3] + bytes([0x30 | jumped[second][3] & 15]) + b"\x01\x80" + body
    tail = told[188:]
    own = mpegts.PACKET - 4 - 2  # the two bytes more go into a packet of their own
    extra = packets[second][:1] + bytes([packets[second][1] & 0x1F]) + packets[second][2:3] + bytes([0x30 | (jumped[second][3] & 15) + 1 & 15 | 0x30, 181, 0]) + b"\xff" * 180 + tail
    rest = [p[:3] + bytes([p[3] & 0xF0 | (p[3] & 15) + 1 & 15]) + p[4:] for p in jumped[second + 1 :]]
    announced = mpegts.decode(b"".join([*jumped[:second], told[:188], extra, *rest]))
    assert own and (announced.payload, announced.errors) == (payload, 0)
    pmt = mpegts.STREAMS
    first = bytes([0x47, 0x40 | 0x10, 0, 0x30, 183 - 9, 0]) + b"\xff" * (183 - 10) + b"\0" + pmt[:8]
    other = bytes([0x47, 0x10, 0, 0x31, 183 - len(pmt[8:]), 0]) + b"\xff" * (182 - len(pmt[8:])) + pmt[8:]
    assert len(first) == len(other) == 188
    split = mpegts.decode(b"".join([packets[0], first, other, *packets[2:]]))
    assert (split.payload, split.errors, split.streams) == (payload, 0, {0x100: 6})


# --- 7


def brute_targets(sizes, most=3.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, total, free = {}, float(sum(sizes.values())), set(order)
    while free:
        unit = total / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] > most * sizes[s]]
        if not over:
            return target | {s: unit * weight[s] for s in free}
        for s in over:
            target[s] = most * sizes[s]
            total -= target[s]
            free.remove(s)
    return target


def test_mix(odd, docs, none):
    skew = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "src0").when(F.col("doc_id") % 40 == 1, None).when(F.col("doc_id") % 50 == 2, "tiny").otherwise(F.col("source")))
    for df in (odd, skew):
        got = mixing.mix(df, fan=8, held=2).collect()
        sizes = collections.defaultdict(int)
        for r in df.collect():
            sizes[r.source] += len(words(r.text))
        want = brute_targets(sizes)
        assert collections.Counter((r.doc_id, r.size) for r in got) == collections.Counter((r.doc_id, len(words(r.text))) for r in df.collect())
        taken, largest = collections.defaultdict(int), collections.defaultdict(int)
        for r in got:
            assert math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-6) and r.source_size == sizes[r.source] and r.taken <= 3 * r.size and r.taken == r.copies * r.size
            taken[r.source] += r.taken
            largest[r.source] = max(largest[r.source], r.size)
        assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6 for s in sizes)
        assert sorted(map(str, mixing.mix(df, fan=8, held=2).collect())) == sorted(map(str, got))
    assert mixing.mix(none).count() == 0
    copies = mixing.mixed_documents(skew)
    assert copies.columns == skew.columns and copies.count() == sum(r.copies for r in mixing.mix(skew).collect())


def test_mixed_documents_are_what_the_mix_takes(spark, odd):
    rows = [(1, "same text of six words here", "a", "x")] * 41 + [(None, f"t{k % 3} b c", "a" if k % 2 else None, "y") for k in range(30)] + [(k, "w " * (k % 9), "b", str(k)) for k in range(60)] + [(2, "two", "b", "p"), (2, "two", "b", "q")]
    for df in (spark.createDataFrame(rows, "doc_id long, text string, source string, mixed_copies string"), odd.withColumn("key_id", F.lit(1))):
        taken = collections.Counter()
        for r in mixing.mix(df, fan=4, held=2).collect():
            taken[r.doc_id, r.size, r.source] += r.copies
        got = mixing.mixed_documents(df, fan=4, held=2)
        assert got.columns == df.columns
        got = got.collect()
        assert collections.Counter((r.doc_id, len(words(r.text)), r.source) for r in got) == +taken
        assert {tuple(r) for r in got} <= {tuple(r) for r in df.collect()}
    assert mixing.times(spark.range(3).withColumn("n", F.lit(5)), F.col("n"), "k", 2).groupBy("id").agg(F.array_sort(F.collect_list("k")).alias("k")).collect()[0].k == [0, 1, 2, 3, 4]


def test_mix_is_unbiased(spark):
    docs = spark.range(30).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 20, "a").otherwise("b").alias("source"), F.repeat(F.lit("w "), 10).alias("text"))
    seen = collections.Counter()
    for seed in range(12):
        seen.update({r.doc_id: r.copies for r in mixing.mix(docs, seed=seed).collect()})
    assert {k < 20 for k, n in seen.items() if n > 0} == {True, False} and len({n for k, n in seen.items() if k < 20}) > 1


# --- 8


def brute_scores(rows, held, least=2, d=0.75):
    """rows: (doc_id, words). Scores by order 3, interpolated, with the states of the production parameters."""
    one, two, three = collections.Counter(), collections.Counter(), collections.Counter()
    for i, own in rows:
        if not held(i):
            t = [b"", *own, b""]  # a text begins after an end
            one.update(t[1:])
            two.update(zip(t, t[1:], strict=False))
            three.update(zip(t, t[1:], t[2:], strict=False))
    n, v = sum(one.values()), len(one)
    after, after2, mass, mass2 = (collections.Counter() for _ in range(4))
    for (u, _), c in two.items():
        after[u] += 1
        mass[u] += c
    for x, c in three.items():
        after2[x[:2]] += 1
        mass2[x[:2]] += c
    out = []
    for i, own in rows:
        t = [b"", *own, b""]
        score = base = 0.0
        for k in range(1, len(t)):
            root = p = (one[t[k]] + 1) / (n + v + 1)
            u, pair = t[k - 1], tuple(t[k - 2 : k]) if k > 1 else None
            if one[u]:
                p = (1 - (mass[u] - d * after[u]) / one[u]) * root + max(0, two[u, t[k]] - d) / one[u]
            if pair is not None and two[pair] >= least:
                p = (1 - (mass2[pair] - d * after2[pair]) / two[pair]) * p + max(0, three[*pair, t[k]] - d) / two[pair]
            score, base = score + math.log10(p), base + math.log10(root)
        out.append((i, held(i), len(t) - 1, sum(one[w] > 0 for w in t[1:]), n, round(base, 5), round(score, 5)))
    return collections.Counter(out)


def test_scores(odd, docs, none, monkeypatch):
    """With the query's own parameters, and with small blocks, few buckets and common contexts."""
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    for df in (odd, docs):
        rows = [(r.doc_id, words((r.text or "").translate({c: c + 32 for c in range(65, 91)}))) for r in df.collect()]
        want = brute_scores(rows, held)
        for block, options in ((ngram.BLOCK, {}), (3000, {"salts": 3, "bits": 1})):
            monkeypatch.setattr(ngram, "BLOCK", block)
            got = ngram.scores(df.repartition(3), ~queries.learnt(7, 2), **options).collect()
            assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5)) for r in got) == want
    assert ngram.scores(none, ~queries.learnt(7, 2)).count() == 0
    assert {r.n_known for r in ngram.scores(docs, F.lit(True)).collect()} == {0}


def test_probabilities_add_up(spark):
    """Over all words, the unknown one and the end, after a pair that is a state."""
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdef") for _ in range(30)) for _ in range(20)]
    vocabulary = [*"abcdef", "unknown"]
    tries = [f"a b {w}" for w in vocabulary] + ["a b"]
    docs = spark.createDataFrame([*enumerate(texts), *((100 + k, t) for k, t in enumerate(tries))], "doc_id long, text string")
    got = {r.doc_id: r.score for r in ngram.scores(docs, F.col("doc_id") >= 100).collect()}
    one, two = collections.Counter(w for t in texts for w in [*t.split(), ""]), collections.Counter(p for t in texts for p in zip(["", *t.split()], [*t.split(), ""], strict=True))
    three = collections.Counter(p for t in texts for p in zip(["", *t.split()], [*t.split(), ""], [*t.split()[1:], ""], strict=False))
    n, v = sum(one.values()), len(one)

    def chance(u, pair, w):
        p = (one[w] + 1) / (n + v + 1)
        types = len({b for a, b in two if a == u})
        p = 0.75 * types / one[u] * p + max(0, two[u, w] - 0.75) / one[u] if one[u] else p
        if pair and two[pair] >= 2:
            types = len({x[2] for x in three if x[:2] == pair})
            p = 0.75 * types / two[pair] * p + max(0, three[*pair, w] - 0.75) / two[pair]
        return p

    assert math.isclose(sum(chance("b", ("a", "b"), w) for w in [*vocabulary, ""]), 1, rel_tol=1e-9)
    for k, t in enumerate(tries):
        own = t.split()
        want = sum(math.log10(chance(([""] + own)[i], tuple(([""] + own)[i - 1 : i + 1]) if i else None, w)) for i, w in enumerate([*own, ""]))
        assert math.isclose(got[100 + k], want, rel_tol=1e-9)


def test_query_counts_every_pair(spark, tmp_path):
    """Words and pairs that training holds once have their arcs."""
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    out, inside = [i for i in range(100) if held(i)][:2], [i for i in range(100) if not held(i)][:3]
    rare = [f"rare{k}" for k in range(20)]
    texts = dict(zip(inside, (rare, ["some", "other", "words"], ["more", "words"]), strict=True)) | dict(zip(out, (rare, rare[::-1]), strict=True))
    spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op8_ngram(spark, str(tmp_path)).collect()}
    assert got[out[0]].score > got[out[0]].base_score and got[out[0]].score > got[out[1]].score


# --- 9


def test_classifier(spark, odd, none):
    sf = "/root/testdata/sf0.01"
    got = queries.op9_quality(spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert got.score.between(0, 1).all() and ((held.score >= 0.3) == (held.quality == 1)).mean() > 0.9 and (held.predicted == (held.score >= 0.3)).all()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"), queries.learnt())
    scored = quality.with_scores(odd, model)
    assert quality.with_scores(scored.withColumn("score", F.lit("x")), model).columns == scored.columns
    assert scored.columns == [*odd.columns, "score"] and scored.where("score between 0 and 1").count() == odd.count()
    assert quality.with_scores(none, model).count() == 0
    kept = quality.with_scores(odd, model, 0.3, None)
    assert kept.columns == odd.columns and kept.count() == scored.where("score >= 0.3").count()


def test_classifier_against_another_computation(spark):
    """The rows that teach, the dictionaries, the curve and every score, computed once more."""
    import struct

    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    own = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 != 0}
    long = lambda x: struct.pack("<q", x)
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    taught = {}
    for label in (0, 1):
        ids = [i for i in own if own[i] == label and texts[i]]
        ids.sort(key=lambda i: signed(xxhash.xxh64_intdigest(texts[i], xxhash.xxh64_intdigest(long(i), 42))))
        spread = lambda t: t if len(t) <= 8192 else b"".join(t[a : a + 1024] for a in ((len(t) - 1024) * k // 7 for k in range(8)))
        taught[label] = [spread(texts[i]) for i in ids]
    books = [zstandard.train_dictionary(1 << 16, [t[a : a + 1024] for t in taught[k][::2] for a in range(0, len(t), 1024)]).as_bytes() for k in (0, 1)]

    def difference(text):
        a, b = (sum(len(zstandard.ZstdCompressor(3, dict_data=zstandard.ZstdCompressionDict(book), write_content_size=False, write_dict_id=False).compress(text[i : i + 1024])) for i in range(0, len(text), 1024)) for book in books)
        return 10 * (a - b) / (a + b) if text else 0.0

    model = quality.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"), queries.learnt())
    assert list(model.dictionaries) == books
    x = {k: np.array([difference(t) for t in taught[k][1::2]]) for k in (0, 1)}
    prior = sum(own.values()) / len(own)
    n = sum(map(len, x.values()))
    slope = np.zeros(2)  # of the penalised likelihood, at the weights
    for k, share in ((0, 1 - prior), (1, prior)):
        p = 1 / (1 + np.exp(-(model.weights[0] + model.weights[1] * x[k])))
        slope += share * n / len(x[k]) * np.array([(k - p).sum(), ((k - p) * x[k]).sum()])
    assert np.abs(slope - 1e-2 * model.weights).max() < 1e-4
    some = sorted(texts)[::9]
    got = {r.doc_id: r.score for r in queries.op9_quality(spark, sf).collect()}
    assert all(math.isclose(got[i], 1 / (1 + math.exp(-(model.weights[0] + model.weights[1] * difference(texts[i])))), rel_tol=1e-9) for i in some)


def test_classifier_without_labels(spark, odd):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.fit(odd, empty, queries.learnt())
    assert {r.score for r in quality.with_scores(odd, model).collect()} == {0.5}
    one = quality.fit(odd, spark.createDataFrame([(1, 1), (3, 1)], "doc_id long, quality int"), F.lit(True))
    assert {r.score for r in quality.with_scores(odd, one).collect()} == {1.0}


def test_classifier_on_long_texts(spark):
    """Labelled texts that are all longer than the driver gets still teach, and from all over."""
    rng = random.Random(2)
    text = lambda k: " ".join(rng.choice(("alpha", "beta", "gamma", "delta") if k % 2 else ("one", "two", "three", "four")) + str(rng.randint(0, 99)) for _ in range(6000))
    rows = [(k, text(k)) for k in range(48)]
    assert min(len(t) for _, t in rows) > 1 << 15
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, quality int")
    model = quality.fit(docs, labels, F.col("doc_id") < 40)
    assert model.dictionaries is not None
    assert all((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in quality.with_scores(docs, model).where("doc_id >= 40").collect())
    long = b"".join(b"%07d " % k for k in range(20_000))
    part = quality.spread(long, 1 << 15, 1024)
    assert len(part) == 1 << 15 and part[:1024] == long[:1024] and part[-1024:] == long[-1024:] and quality.spread(long[:500], 1 << 15, 1024) == long[:500]


# --- 10


def brute_jump(key, shards):
    at, ahead = -1, 0
    while ahead < shards:
        at = ahead
        key = (key * 2862933555777941757 + 1) % 2**64
        ahead = int((at + 1) * (2**31 / ((key >> 33) + 1)))
    return at


def test_jump():
    keys = np.random.default_rng(1).integers(0, 2**64, 2000, np.uint64)
    for n in (1, 2, 8, 9, 100):
        assert sharding.jump(keys, n).tolist() == [brute_jump(int(k), n) for k in keys]
    a, b = sharding.jump(keys, 8), sharding.jump(keys, 9)
    assert set(b[a != b].tolist()) == {8} and 0.07 < (a != b).mean() < 0.16


def test_shards(odd, docs, none):
    for df in (odd, docs):
        got = sharding.assign(df, bucket_rows=16).collect()
        want = collections.Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in df.collect())
        assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
        slots = collections.defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
            key = xxhash.xxh64_intdigest(np.int64(r.doc_id).tobytes(), 42) if r.doc_id is not None else 42
            assert r.law == "key" and (r.shard, r.grown_shard) == (brute_jump(key, 8), brute_jump(key, 9)) and r.grown_shard in (r.shard, 8)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign(none).count() == 0


def test_written_shards(odd, tmp_path, spark):
    sharding.write_shards(odd, f"{tmp_path}/shards")
    back = spark.read.parquet(f"{tmp_path}/shards")
    want = {(r.doc_id, r.text): brute_jump(xxhash.xxh64_intdigest(np.int64(r.doc_id).tobytes(), 42) if r.doc_id is not None else 42, 8) for r in odd.collect()}
    assert collections.Counter((r.doc_id, r.text, r.shard) for r in back.collect()) == collections.Counter((r.doc_id, r.text, want[r.doc_id, r.text]) for r in odd.collect())


def test_shared_folders_can_be_released(spark):
    from pitchside import store
    from pitchside.llm import shared

    kept = list(store.made)
    store.made.clear()
    df = materialise(spark.range(5).withColumn("a", F.lit("x")), "test")
    assert df.count() == 5
    at, folder = shared.filesystem(store.made[0])
    assert at.get_file_info(folder).type.name == "Directory"
    shared.release(spark)
    assert at.get_file_info(folder).type.name == "NotFound" and store.made == []
    store.made.extend(kept)


# --- SQL twins


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_twin(spark, name):
    import duckdb

    db = duckdb.connect()
    for table in ("documents", "pages"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got, want = queries.QUERIES[name](spark, SF), db.sql(queries.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(str, want.select(*columns).fetchall()))


# --- the pipeline


def test_pipeline_stages(spark, tmp_path, odd):
    import corpus_pipeline as p

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    start = docs
    for k, (name, stage) in enumerate(p.STAGES[:-1]):
        out = materialise(stage(spark, docs, sf), "test")
        assert out.columns == docs.columns, name
        assert k == 3 or out.count() <= docs.count()
        if k == 0:
            model = quality.fit(start, spark.read.parquet(f"{sf}/labels.parquet"), queries.learnt())
            assert out.count() == quality.with_scores(start, model).where("score >= 0.3").count()
        if k == 1:
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in rules.verdicts(docs).where("kept").collect()}
        if k == 2:
            classes = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
            assert sorted(r.doc_id for r in out.collect()) == sorted(set(classes.values()))
        docs = out
    model = MemoTokenizer(queries.tokenizer_path())
    got = p.STAGES[-1][1](spark, docs, sf).collect()
    assert sum(r.length for r in got) == int(model.encode([r.text for r in docs.collect()], 0)[1].sum())
    empty = start.where("false")
    for _, stage in p.STAGES:
        assert stage(spark, empty, sf).count() == 0
    awkward = odd
    for _, stage in p.STAGES[:-1]:
        awkward = materialise(stage(spark, awkward, sf), "test")
        assert awkward.columns == odd.columns
    p.STAGES[-1][1](spark, awkward, sf).count()
