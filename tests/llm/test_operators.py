"""Every operator against a brute-force version or its check SQL, on hand-made edge rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amihan.llm import byte_bpe, chat, lang_id, mixing, near_dedup, pii, piecewise_hash, suffix_dedup, topk_nra, wacz
from amihan.llm.components import components
from amihan.llm.run_index import RunIndex

DOCS = "doc_id long, text string, lang string, source string, n_chars long, label string, start long, key long, n_copies string"


def words(seed, n):
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abdeiknorstu") for _ in range(pick.randint(2, 8))) for _ in range(n))


def documents(spark, rows):
    """Rows (doc_id, text, lang, source) with further columns, some named as operators name their own."""
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", 1, 2, "y") for r in rows], DOCS)


@pytest.fixture(scope="module")
def edge_rows():
    base = words(1, 120)
    edited = base.replace(base.split()[60], "changed")
    shared = words(2, 20)
    return [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (2, base, "en", "a"),
        (3, edited, None, None),
        (4, None, "en", "a"),
        (5, "", "en", "b"),
        (6, " \t\n", None, "b"),
        (7, "123 456 .", "de", "b"),
        (8, "one two", "de", "b"),
        (9, words(3, 30) + " " + shared + " " + words(4, 30), "de", "b"),
        (10, words(5, 30) + " " + shared + " " + words(6, 30), "fr", "c"),
        (None, base + " more", "fr", "c"),
        (12, "Größe naïve 日本語 🙂 " * 40, "fr", None),
        (13, words(7, 30_000), "en", "c"),
    ]


def empty(spark):
    return documents(spark, [])


# Near duplicates ---------------------------------------------------------------


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def brute_components(rows, percent):
    sets = defaultdict(list)
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            sets[doc_id].append(shingles(text))
    label = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                linked = any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b])
                if linked and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(spark, edge_rows, percent):
    rows = list(edge_rows)
    base = words(20, 200).split()
    pick = random.Random(5)
    for i in range(40):
        w = list(base)
        for _ in range(pick.randint(1, 6)):
            w[pick.randrange(len(w))] = f"edit{pick.randrange(9)}"
        rows.append((100 + i, " ".join(w), "en", "a"))
    out = near_dedup.near_duplicates(documents(spark, rows), percent).collect()
    label = brute_components(rows, percent)
    assert len(out) == len(rows)
    for r in out:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == label[r["doc_id"]] and r["kept"] == (r["component_id"] == r["doc_id"])
    sizes = {d: len(shingles(t)) for d, t, *_ in rows}
    assert all(r["n_shingles"] == sizes[r["doc_id"]] for r in out)
    assert near_dedup.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("block", [2, 5, 512])
def test_near_duplicates_in_blocks(spark, monkeypatch, block):
    """Texts more and less far from one text: large and small components meet in buckets of several blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    base, pick, rows = words(30, 100).split(), random.Random(31), []
    for i in range(60):
        own = list(base)
        for place in pick.sample(range(100), i % 8):
            own[place] = f"w{pick.randint(0, 3)}"
        rows.append((i, " ".join(own), "en", "a"))
    want = brute_components(rows, 80)
    assert 1 < len(set(want.values())) < 60
    out = near_dedup.near_duplicates(documents(spark, rows), 80).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == want


def test_pruning_keeps_what_may_reach_the_threshold():
    least = near_dedup.least_matches(0.85, 64)
    for n in (16, 32, 64):
        lost = sum(math.comb(n, m) * 0.85**m * 0.15 ** (n - m) for m in range(least[n]))
        assert lost < 1e-4 and least[n] > n // 3


def test_components_of_a_long_path(spark):
    edges = spark.range(1, 60).select(F.col("id").alias("u"), (F.col("id") - 1).alias("v"))
    found = {tuple(r) for r in components(edges).collect()}
    assert found == {(i, 0) for i in range(1, 60)}


# Repeated strings ----------------------------------------------------------------


def brute_repeats(rows, length):
    first = {}
    for doc_id, text, *_ in rows:
        data, key = (text or "").encode(), math.inf if doc_id is None else doc_id
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            first[s] = min(first.get(s, math.inf), key)
    out = []
    for doc_id, text, *_ in rows:
        data, key = (text or "").encode(), math.inf if doc_id is None else doc_id
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if first[data[p : p + length]] < key:
                gone[p : p + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("shard_bytes, index_bytes", [(1_500, 12 << 20), (1 << 20, 12 << 20), (1_500, 300), (1 << 20, 1)])
def test_repeats_equal_brute_force(spark, edge_rows, shard_bytes, index_bytes):
    """With small indexes, some or all grams are too common for one and are dealt by windows."""
    rows = [r for r in edge_rows if r[0] != 13]
    for i in range(25):
        rows.append((50 + i, words(i, 9) + " " + words(99, 14)[i:] + " " + words(i + 40, 9) + "ab" * 60 * (i % 3 == 0), "en", "a"))
    out = suffix_dedup.remove_repeats(documents(spark, rows), shard_bytes=shard_bytes, index_bytes=index_bytes)
    got = [tuple(r) for r in out.collect()]
    assert Counter(got) == Counter(brute_repeats(rows, 50))
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


@pytest.mark.parametrize("places", [1, 8_192])
@pytest.mark.parametrize("shard_bytes, index_bytes", [(1_500, 12 << 20), (1 << 20, 12 << 20), (1_500, 300), (1 << 20, 1)])
def test_repeats_in_one_document_and_under_one_id(spark, monkeypatch, shard_bytes, index_bytes, places):
    """Groups that a document or rows of one id hold several times, their windows starting in an earlier document."""
    monkeypatch.setattr(suffix_dedup, "PLACES", places, raising=False)
    a, b, c, d, p = (words(60 + i, 30)[:n] for i, n in enumerate((70, 70, 55, 55, 60)))
    rows = [(1, a + p + b, "en", "a"), (2, c + p + d + c + p + d, "en", "a")]
    rows += [(3, d + p + c, "en", "a"), (3, "." + d + p + c + a[:49], "en", "a"), (None, b + p + d, "en", "a"), (None, b + p + d + b + p + d, "en", "a")]
    rows += [(4, "b" + "a" * 55, "en", "a"), (5, "a" * 400 + c[:20] + "a" * 90, "en", "a"), (0, words(70, 300), "en", "a")]
    got = [tuple(r) for r in suffix_dedup.remove_repeats(documents(spark, rows), shard_bytes=shard_bytes, index_bytes=index_bytes).collect()]
    want = brute_repeats(rows, 50)
    assert Counter(got) == Counter(want)
    assert [r[2] for r in want if r[0] == 2] == [120]


def test_repeats_leave_no_dealt_texts_on_disk(spark, monkeypatch):
    """Only groups are stored, no whole texts, and the shuffle files of the texts are freed before the result is asked for."""
    import os
    import tempfile
    import time
    from pathlib import Path

    rows = [(i, words(200 + i, 4_000) + " " + words(99, 12) + " " + words(400 + i, 4_000), "en", "a") for i in range(30)]
    size = sum(len(r[1]) for r in rows)
    docs = documents(spark, rows).cache()
    docs.count()
    root = Path(os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", tempfile.gettempdir()))
    files = lambda: {p: p.stat().st_size for p in root.glob("**/blockmgr-*/*/shuffle_*.data") if p.exists()}
    kept, stored = [], suffix_dedup.stored
    monkeypatch.setattr(suffix_dedup, "stored", lambda df, *a, **k: kept.append(stored(df, *a, **k)) or kept[-1])
    before = files()
    out = suffix_dedup.remove_repeats(docs, shard_bytes=size // 4)
    for _ in range(50):
        left = sum(n for p, n in files().items() if p not in before)
        if left < size // 4:
            break
        time.sleep(0.2)
    assert left < size // 4
    texts = [df.agg(F.max(F.octet_length("text"))).first()[0] or 0 for df in kept if "text" in df.columns]
    assert texts and max(texts) < 100
    assert Counter(tuple(r) for r in out.collect()) == Counter(brute_repeats(rows, 50))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
    docs.unpersist()


def test_groups_that_share_no_side_of_their_anchor_are_left_out():
    import numpy as np

    from amihan.llm.window_groups import GRAM

    pick = random.Random(8)
    letters = lambda n: bytes(pick.choice(b"abc") for _ in range(n))
    for _ in range(60):
        gram, sides = letters(GRAM), [letters(30) for _ in range(3)]
        groups = []
        for _ in range(8):
            before, after = letters(30 - (n := pick.choice((0, 14, 15, 16, 30)))) + pick.choice(sides)[30 - n :], pick.choice(sides)[: (m := pick.choice((0, 14, 15, 16, 30)))] + letters(30 - m)
            cut, end = pick.randint(0, 30), pick.randint(0, 30)
            if cut + end <= 30:
                groups.append((before[cut:] + gram + after[: 30 - end], 30 - cut))
        if not groups:
            continue
        texts, place = [t for t, _ in groups], np.array([p for _, p in groups])
        lengths = np.array([len(t) for t in texts])
        got = suffix_dedup._shares_a_side(np.frombuffer(b"".join(texts), np.uint8), np.cumsum(lengths) - lengths, lengths, np.zeros(len(texts), np.int64), place, 50)
        windows = [{(t[i : i + 50], p - i) for i in range(max(0, p - 30), min(p, len(t) - 50) + 1)} for t, p in groups]
        for i, own in enumerate(windows):
            assert got[i] or not any(own & w for j, w in enumerate(windows) if j != i)
    assert not suffix_dedup._shares_a_side(np.frombuffer(b"a" * 60 + b"b" * 60, np.uint8), np.array([0, 60]), np.array([60, 60]), np.zeros(2, np.int64), np.array([20, 20]), 50).any()


def test_grams_shared_by_chance_leave_groups_decided(spark, monkeypatch):
    """Of texts that have one gram in common, but neither side of it, no group is sent to the index."""
    kept, stored = [], suffix_dedup.stored
    monkeypatch.setattr(suffix_dedup, "stored", lambda df, *a, **k: kept.append(stored(df, *a, **k)) or kept[-1])
    pick = random.Random(11)
    letters = lambda n: "".join(pick.choice("abcdefgh") for _ in range(n))
    gram = letters(20)
    rows = [(i, letters(200) + gram + letters(200), "en", "a") for i in range(60)]
    shared = letters(55)
    rows += [(100, letters(90) + shared + letters(90), "en", "a"), (101, letters(90) + shared + letters(90), "en", "a")]
    out = suffix_dedup.remove_repeats(documents(spark, rows), shard_bytes=5_000)
    assert Counter(tuple(r) for r in out.collect()) == Counter(brute_repeats(rows, 50))
    marked = next(df for df in kept if "text" in df.columns)
    assert {r["key"] for r in marked.where("kind = 1").select("key").collect()} <= {100, 101}


def brute_groups(rows, length):
    first = {}
    for r in rows:
        for i in range(len(r["text"]) - length + 1):
            at = (r["anchor"], r["text"][i : i + length])
            first[at] = min(first.get(at, math.inf), r["key"])
    out = []
    for r in rows:
        found = [i for i in range(len(r["text"]) - length + 1) if first[r["anchor"], r["text"][i : i + length]] < r["key"]]
        if found:
            places = [(r["uid"], r["begin"]), *zip(r["more_uids"] or [], r["more_starts"] or [])]
            out += [(uid, at + found[0], at + found[-1] + length) for uid, at in places]
    return Counter(out)


@pytest.mark.parametrize("bits", [64, 9, 0])
def test_index_step_equals_brute_force_whatever_hashes_collide(monkeypatch, bits):
    """Windows of equal hashes only say which groups meet; the index decides."""
    import numpy as np
    import pyarrow as pa

    mix = suffix_dedup.mix
    monkeypatch.setattr(suffix_dedup, "mix", lambda x: mix(x) & np.uint64((1 << bits) - 1))
    pick = random.Random(6)
    letters = lambda n: bytes(pick.choice(b"ab") for _ in range(n))
    rows = []
    for anchor in range(12):
        gram, sides = letters(20), [letters(30) for _ in range(4)]
        for i in range(pick.choice((1, 2, 9, 40))):
            before, after = pick.choice(sides), pick.choice(sides)
            before, after = letters(n := pick.choice((0, 3, 12))) + before[n:], after[: 30 - (n := pick.choice((0, 3, 12)))] + letters(n)
            cut, end = pick.randint(0, 15), pick.randint(0, 15)
            more = [1 << 40, 2 << 40] if i % 5 == 0 else None
            rows.append(dict(uid=len(rows), begin=pick.randint(0, 99), text=before[cut:] + gram + after[: 30 - end], anchor=anchor, place=30 - cut, key=pick.randint(0, 30), more_uids=more, more_starts=more and [5, 7]))
    pick.shuffle(rows)
    kinds = {"text": pa.binary(), "place": pa.int32(), "more_uids": pa.list_(pa.int64()), "more_starts": pa.list_(pa.int64())}
    table = pa.table({c: pa.array([r[c] for r in rows], kinds.get(c, pa.int64())) for c in rows[0]})
    got = suffix_dedup.match_groups(50)(table)
    assert Counter(zip(*(got.column(c).to_pylist() for c in ("uid", "begin", "end")))) == brute_groups(rows, 50)


def test_suffixes_are_told_apart_to_their_ends():
    """Suffixes of long equal passages; in either order, rows would step to the places of others."""
    import numpy as np

    from amihan.llm.run_index import packed, suffix_order

    pick = random.Random(9)
    for size in (100, 160, 700):
        passage = [pick.randint(1, 90) for _ in range(size)]
        text = [x for i in range(6) for x in [*passage, 91 + pick.randint(0, 5), i + 1]] + [0]
        key, known, _ = packed(RunIndex(np.array(text)).text)
        assert suffix_order(key, known).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_order_and_shared_lengths_equal_brute_force():
    import numpy as np

    from amihan.llm.run_index import packed, suffix_order

    pick = random.Random(4)
    for letters in (2, 5, 300, 1 << 33):
        for n in (1, 2, 40, 200):
            text = [pick.randint(1, letters) if pick.random() < 0.3 else 1 for _ in range(n)] + [0]
            index = RunIndex(np.array(text))
            key, known, _ = packed(index.text)
            order = suffix_order(key, known).tolist()
            assert order == sorted(range(n + 1), key=lambda i: text[i:])
            a, b, limit = (np.array([pick.randint(0, n) for _ in range(100)]) for _ in range(3))
            for i, j, most, got in zip(a.tolist(), b.tolist(), limit.tolist(), index._shared(a, b, limit).tolist()):
                want = next((k for k in range(min(most, n + 1 - max(i, j))) if text[i + k] != text[j + k]), max(0, min(most, n + 1 - max(i, j))))
                assert got == want


def test_matching_statistics_equal_brute_force():
    import numpy as np

    pick = random.Random(3)
    for _ in range(40):
        text = [pick.randint(0, 3) for _ in range(pick.randint(2, 60))] + [0]
        patterns = sorted(([pick.randint(1, 4) for _ in range(pick.randint(1, 12))] for _ in range(5)), key=len, reverse=True)
        lengths = np.array([len(p) for p in patterns])
        wide = np.zeros((5, lengths.max()), np.int64)
        for i, p in enumerate(patterns):
            wide[i, : len(p)] = p
        got = RunIndex(np.array(text)).matching_statistics(wide, lengths)
        for i, p in enumerate(patterns):
            for k in range(len(p)):
                n = 0
                while k + n < len(p) and bytes(p[k : k + n + 1]) in bytes(text):
                    n += 1
                assert got[i, k] == n


# Tokens --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    tokenizers = pytest.importorskip("public_tokenizers")
    return tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN


def test_tokens_equal_the_library_and_decode(spark, edge_rows, vocabulary):
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern = vocabulary
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    more = ["a" * 3000, "\n \n  x  y\t z ", " lead", "trail  ", "it's we'll", "́​\x00\x1c"]
    rows = [*edge_rows, *((200 + i, t, "en", "a") for i, t in enumerate(more))]
    docs = documents(spark, rows)
    coded = byte_bpe.encode_texts(docs, path, pattern)
    expected = Counter((d, tuple(library.encode_ordinary(t or ""))) for d, t, *_ in rows)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in coded.collect()) == expected
    back = byte_bpe.decode_ids(coded, path, pattern).collect()
    assert Counter(map(tuple, back)) == Counter((d, t or "") for d, t, *_ in rows)
    digests = byte_bpe.token_digests(docs, path, pattern).collect()
    hashed = Counter((d, hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()) for d, ids in expected.elements())
    assert Counter((r["doc_id"], r["ids_sha256"]) for r in digests) == hashed
    assert all(r["valid_utf8"] for r in digests)
    assert byte_bpe.encode_texts(empty(spark), path, pattern).count() == 0


def test_utf8_stream_at_every_cut():
    data = "aé日🙂".encode() + b"\xff\xe2\x82"
    for cut in range(len(data) + 1):
        stream = byte_bpe.Utf8Stream()
        assert stream.feed(data[:cut]) + stream.feed(data[cut:]) + stream.close() == data.decode("utf-8", "replace")


# Languages -----------------------------------------------------------------------


def test_languages(spark, edge_rows):
    rows = [(1000 + i, words(i, 60) if i % 2 else words(i, 60).translate(str.maketrans("aeiou", "öäüéè")), "xx" if i % 2 else "yy", "a") for i in range(80)]
    docs = documents(spark, [*edge_rows, *rows])
    out = lang_id.identify(docs).collect()
    for r in out:
        assert r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
    by_id = {r["doc_id"]: r["lang_pred"] for r in out}
    assert [by_id[d] for d in (4, 5, 6, 7)] == ["und"] * 4
    held = [(by_id[d], lang) for d, _, lang, _ in rows if zlib.crc32(str(d).encode()) % 3 == 1]
    assert held and sum(p == lang for p, lang in held) >= 0.9 * len(held)
    assert lang_id.identify(empty(spark)).count() == 0
    unlabelled = documents(spark, [(1, "some words", None, None)])
    assert lang_id.identify(unlabelled).first()["lang_pred"] == "und"


def test_cross_parsing_counts_longest_matches():
    parse = lang_id.CrossParser((("en", "the cat sat on the mat"), ("de", "die katze")))
    pieces, letters = parse.pieces(["the mat", "katze", "", "cat the"])
    assert letters.tolist() == [6, 5, 0, 6]
    assert pieces[0, 0] == 1 and pieces[1, 1] == 1 and pieces[0, 1] > 1
    assert pieces[3, 0] == 2


# Fingerprints --------------------------------------------------------------------


def test_fingerprints(spark, edge_rows):
    rows = [r for r in edge_rows if r[0] is not None and r != (2, *edge_rows[1][1:])] + [edge_rows[1]]
    out = {r["doc_id"]: r for r in piecewise_hash.neighbour_fingerprints(documents(spark, rows)).collect()}
    ordered = sorted(rows, key=lambda r: -r[0])
    for own, following in zip(ordered, ordered[1:] + ordered[:1]):
        r, text, after = out[own[0]], own[1] or "", following[1] or ""
        assert r["edited_text"] == piecewise_hash.edited_text(text, after) and r["n_chars"] == len(text)
        prints = [piecewise_hash.fingerprint(t.encode()) for t in (text, r["edited_text"], after)]
        assert (r["fingerprint"], r["edited_fingerprint"]) == (str(prints[0]), str(prints[1]))
        assert r["near_edited"] == piecewise_hash.likeness([(prints[0], prints[1])])[0]
        assert r["near_next"] == piecewise_hash.likeness([(prints[0], prints[2])])[0]
    assert out[1]["fingerprint"] == out[2]["fingerprint"] and out[2]["near_next"] == 1.0
    assert out[13]["near_edited"] > 0.5 and out[13]["near_next"] < 0.2
    assert piecewise_hash.neighbour_fingerprints(empty(spark)).count() == 0
    repeated = documents(spark, [(1, "b", None, None), (1, "a", None, None), (None, None, None, None)])
    assert piecewise_hash.neighbour_fingerprints(repeated).count() == 3


def test_likeness_is_an_edit_distance():
    import numpy as np

    pick = random.Random(2)
    for _ in range(30):
        a, b = ([pick.randint(0, 5) for _ in range(pick.randint(1, 64))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        make = lambda c: piecewise_hash.Fingerprint(3, np.array(c, np.uint16), np.array([], np.uint16))
        expected = 1.0 if a == b else 2 * table[-1][-1] / (len(a) + len(b))
        assert piecewise_hash.likeness([(make(a), make(b))])[0] == pytest.approx(expected)


def test_long_texts_are_read_in_segments(monkeypatch):
    text = words(8, 4000).encode()
    whole = str(piecewise_hash.fingerprint(text))
    monkeypatch.setattr(piecewise_hash, "SEGMENT", 1000)
    piecewise_hash._powers.cache_clear()
    assert str(piecewise_hash.fingerprint(text)) == whole
    piecewise_hash._powers.cache_clear()


# Personal data -------------------------------------------------------------------

BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_personal_data_equals_brute_force(spark, edge_rows):
    pick = random.Random(11)
    parts = ["a@b.c_d@e.f", "x.y@mail.example.com.", "1.2.3.4", "1.2.3.4.5.6.7.8", "300.1.1.1", "0001.02.3.255", "4845168114407329", "7536784127813050 4845168114407329", "4111-1111-1111-1111", "5-5 5", "+1 (017) 555-7713", "+49 30 1234567 +1", "é🙂", " ", "\n", "@", "12", "-", "GB82 WEST 1234 5698 7654 32", "my ssn 123-45-6789", "%%%"]
    texts = ["".join(pick.choice(parts) + pick.choice(["", " ", "é"]) for _ in range(pick.randint(1, 14))) for _ in range(300)]
    texts.append(" ".join(f"u{i}@h.example" for i in range(700)))
    docs = documents(spark, [*edge_rows, *((500 + i, t, "en", "a") for i, t in enumerate(texts))]).withColumn("spans", F.lit("clash"))
    found = pii.find_spans(docs)
    for r in found.collect():
        listed = [f"{s['kind']}:{s['start']}:{s['end']}" for s in r["spans"]]
        expected = base_spans(r["text"])
        assert [s for s in listed if s.split(":")[0] in dict(BASE)] == expected, r["text"]
    texts_out = {r["doc_id"]: r["text"] for r in pii.redact(found).collect()}
    assert texts_out[4] is None and texts_out[8] == "one two"
    single = documents(spark, [(1, "Mail a@b.cd now, iban GB82 WEST 1234 5698 7654 32, ssn 123-45-6789.", None, None)])
    assert pii.redact(pii.find_spans(single)).first()["text"] == "Mail <EMAIL> now, iban <IBAN>, ssn <SSN>."
    assert pii.find_spans(empty(spark)).count() == 0


def test_ibans_end_at_their_countrys_length(spark):
    de, gb, no = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947"
    other = "ZZ" + next(f"{c:02d}" for c in range(2, 99) if (int("12345678901" + "3535" + f"{c:02d}")) % 97 == 1) + " 1234 5678 901"
    cases = [
        (f"{de} BIC COBADEFFXXX", [de]),
        (f"{gb} 500 EUR", [gb]),
        (f"pay {gb.replace(' ', '')} 500 EUR to {no} NOW", [gb.replace(" ", ""), no]),
        (f"{de} {gb} {no}", [de, gb, no]),
        (f"REF AB12 BE12 {de} 7 {other} BIC X", [de, other]),
        (f"é🙂 {de}, {no}.", [de, no]),
        (f"{de}1 and {gb[:-1]}3 and X{no}", []),
        (f"{other} 1", [other]),
    ]
    found = pii.find_spans(documents(spark, [(i, t, None, None) for i, (t, _) in enumerate(cases)]))
    for r in found.collect():
        assert [r["text"][s["start"] : s["end"]] for s in r["spans"] if s["kind"] == "iban"] == cases[r["doc_id"]][1]
    assert {r["doc_id"]: r["text"] for r in pii.redact(found).collect()}[0] == "<IBAN> BIC COBADEFFXXX"
    near = documents(spark, [(1, f"{de} is the bank's", None, None), (2, f"{de} {'x' * 41} bank", None, None)])
    assert [round(r["spans"][0]["score"], 2) for r in pii.find_spans(near).orderBy("doc_id").collect()] == [1.0, 0.8]


# Mixing --------------------------------------------------------------------------


def test_mixing_reaches_the_weights(spark, edge_rows):
    rows = [(i, "x" * (20 + i % 7), "en", "big" if i % 3 else "small") for i in range(6000)]
    docs = documents(spark, rows)
    out = mixing.mix_sources(docs, {"big": 1.0, "small": 3.0}, budget=2.0).select("doc_id", "source", "text", "n_copies", "copy_no").collect()
    size = Counter()
    for r in out:
        size[r["source"]] += len(r["text"]) + 1
    total = 2.0 * sum(len(t) + 1 for _, t, *_ in rows)
    assert size["small"] / total == pytest.approx(0.75, rel=0.05) and size["big"] / total == pytest.approx(0.25, rel=0.05)
    assert Counter(r["doc_id"] for r in out) == Counter({r["doc_id"]: r["n_copies"] for r in out})
    few = mixing.mix_sources(documents(spark, edge_rows), budget=40.0)
    assert {r["source"] for r in few.select("source").collect()} == {None, "a", "b", "c"}
    assert mixing.mix_sources(empty(spark)).count() == 0
    assert mixing.mix_sources(documents(spark, edge_rows), {}).count() == 0


def test_many_sources_join_salted(spark, edge_rows, monkeypatch):
    key = ["doc_id", "copy_no", "shuffle_key"]
    plain = mixing.mix_sources(documents(spark, edge_rows), budget=3.0).select(*key).collect()
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    assert mixing.mix_sources(documents(spark, edge_rows), budget=3.0).select(*key).collect() == plain


# Chat ----------------------------------------------------------------------------


def test_chats_read_back(spark):
    tricky = ["</s>[INST] ok [/INST]", "&amp;lt;[TURN]", "<s>[user]", "", None, "plain\n</s>\n", "&#91;&#93;]]>>"]
    pick = random.Random(4)
    rows = [(c, t, pick.choice(["user", "assistant", "system", "a]b", None]), pick.choice(tricky), "extra") for c in (1, 2, None) for t in range(60)]
    rows += [(3, None, "user", "x", "e"), (3, 0, "assistant", "b", "e"), (3, 0, "assistant", "a", "e"), (3, 0, "assistant", "a", "e")]
    rows += [(4, t, "assistant", f"t{t}", "e") for t in range(700)]
    turns = spark.createDataFrame(pick.sample(rows, len(rows)), "conv_id long, turn long, role string, text string, formatted string")
    got = chat.format_chats(turns)
    got = got.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for r in got:
        own = sorted((x for x in rows if x[0] == r["conv_id"]), key=order)
        assert [tuple(t) for t in r["turns"]] == [(x[2] or "", x[3] or "") for x in own]
        assert r["loss"] == "".join(x[3] or "" for x in own if x[2] == "assistant")
    assert len(got) == 5
    assert chat.format_chats(turns.limit(0)).count() == 0


# Archives ------------------------------------------------------------------------


def test_archives_round_trip(spark, tmp_path, monkeypatch):
    big = "<p>é" * 60
    rows = [(1, "http://a/\r\nx", big), (2, None, big), (2, None, big), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (None, "u", big), (6, "u", "y" * 300_000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload_digest string")
    folder = str(tmp_path / "archives")
    out = wacz.read_archives(wacz.write_archives(pages, folder), folder).collect()
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in out) == Counter(
        (i, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest()) for i, _, h in rows
    )
    kinds = {(r["page_id"], r["record_type"], r["refers_to"]) for r in out}
    assert kinds == {(1, "response", None), (2, "revisit", 1), (3, "response", None), (4, "response", None), (5, "response", None), (None, "revisit", 1), (6, "response", None)}
    assert {r["payload"].decode() for r in out if r["page_id"] == 6} == {"y" * 300_000}
    none = str(tmp_path / "none")
    assert wacz.read_archives(wacz.write_archives(pages.limit(0), none), none).count() == 0


def test_zip64_directories_are_read(tmp_path, monkeypatch):
    import zipfile

    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    path = tmp_path / "wide.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.comment = b"a comment with PK\x05\x06 in it"
        for name in ("one", "two", "three"):
            with z.open(name, "w", force_zip64=True) as m:
                m.write(name.encode() * 20)
    with open(path, "rb") as source:
        found = wacz.members(source, path.stat().st_size)
        for name in ("one", "two", "three"):
            assert wacz.read_at(source, found[name].begin, found[name].size) == name.encode() * 20
    (tmp_path / "bad").write_bytes(b"no archive at all")
    with open(tmp_path / "bad", "rb") as source, pytest.raises(wacz.Damaged):
        wacz.members(source, 17)


# Search --------------------------------------------------------------------------


def test_search_equals_brute_force(spark, monkeypatch):
    pick = random.Random(6)
    rows = [(i, [pick.choice([-0.5, 0.0, 0.25, 0.5, pick.gauss(0, 1)]) for _ in range(8)], "e") for i in range(400)]
    rows += [(400, None, "e"), (450, [0.1, None] * 4, "e"), (500, [float("nan")] * 8, "e"), (550, [float("inf")] * 8, "e"), (600, [], "e"), (650, [1.0] * 5, "e"), (0, rows[0][1], "e"), (None, [1.0] * 8, "e")]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("score", T.StringType())])
    table = spark.createDataFrame(rows, schema)
    monkeypatch.setattr(topk_nra, "CANDIDATE_BLOCK", 150)
    monkeypatch.setattr(topk_nra, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk_nra, "PART", 40)
    got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk_nra.search(table, F.pmod("vec_id", F.lit(50)) == 0).collect()}
    import numpy as np

    whole = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    expected = set()
    for q in (i for i in whole if i % 50 == 0):
        scored = sorted((-sum(x * y for x, y in zip(whole[q], v)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
        expected |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:5])}
    assert got == expected
    assert topk_nra.search(table.limit(0), F.pmod("vec_id", F.lit(50)) == 0).count() == 0
