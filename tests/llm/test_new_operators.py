"""Shards along a curve, collocations and the filter audit against brute force; long texts of two older operators."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from amihan.llm import byte_bpe, chat, collocations, common, filter_audit, hilbert, lang_id, mixing, pii, piecewise_hash
from amihan.llm.arrays import last_not_above, running_ends, running_most, with_cutter
from amihan.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard string, place string, phrase long, value int, range int"


def documents(spark, rows):
    """Rows (doc_id, text, lang, source) with further columns, some named as operators name their own."""
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", "y", 1, 2, 3) for r in rows], DOCS)


# Shards along a curve ----------------------------------------------------------------


@pytest.mark.parametrize(("dims", "bits"), [(1, 3), (2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_by_single_steps(spark, dims, bits):
    names = [f"c{d}" for d in range(dims)]
    cells = spark.range(1 << bits * dims).select(
        *[((F.col("id") / (1 << bits * d)).cast("long") % (1 << bits)).cast("int").alias(n) for d, n in enumerate(names)]
    )
    rows = cells.withColumn("at", hilbert.curve_index([F.col(n) for n in names], bits)).orderBy("at").collect()
    assert [r["at"] for r in rows] == list(range(1 << bits * dims))
    for a, b in itertools.pairwise(rows):
        assert sum(abs(a[n] - b[n]) for n in names) == 1


def curve_place(cell, bits):
    """The same index by plain arithmetic."""
    digits, following = hilbert.curve_steps(len(cell))
    state = index = 0
    for level in reversed(range(bits)):
        at = state << len(cell) | sum((c >> level & 1) << d for d, c in enumerate(cell))
        index, state = index << len(cell) | digits[at], following[at]
    return index


def magnitude(value, bits=8):
    if not value or value < 1:
        return 0
    digits = f"{value:b}"
    return min((1 << bits) - 1, (len(digits) - 1) * 8 + int(digits[1:4].ljust(3, "0"), 2) + 1)


def expected_order(rows):
    """(curve, doc_id, crc, row) in order, rows being (doc_id, text, lang, source)."""

    def cells(values):
        first = lambda v: (v is not None, v or "")
        ordered = sorted(values, key=first)
        return {v: ordered.index(v) * 256 // len(ordered) for v in set(values)}

    langs, sources = cells([r[2] for r in rows]), cells([r[3] for r in rows])
    out = []
    for i, text, lang, source in rows:
        raw = (text or "").encode()
        size = len(raw) + 1
        out.append((curve_place((langs[lang], sources[source], magnitude(size)), 8), i is not None, i or 0, zlib.crc32(raw), size))
    return sorted(out)


def read_shards(df):
    return sorted((r["shard"], r["slot"], r["curve"], r["doc_id"], r["text_crc32"], r["size"]) for r in df.collect())


def test_shards_of_whole_table_equal_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    out = QUERIES["op11_hilbert_shards"](spark, SF_DIR)
    assert {r["law"] for r in out.select("law").distinct().collect()} == {"rows"}
    n = len(rows)
    expected = [(k * 16 // n, k - -(-(k * 16 // n) * n // 16), c, i, crc, size) for k, (c, _, i, crc, size) in enumerate(expected_order(rows))]
    assert read_shards(out) == expected


def test_shards_of_edge_rows(spark):
    pick = random.Random(2)
    rows = [(pick.choice([None, 1, 2, i]), pick.choice([None, "", "a", "é" * i, "copy"]), pick.choice([None, "de", "fr"]), pick.choice([None, "", "x"])) for i in range(203)]
    rows += [(7, "same", "de", "x")] * 90
    docs = documents(spark, rows).withColumn("size", F.lit(1).cast("long") + F.coalesce(F.octet_length("text"), F.lit(0)))
    docs = docs.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    out = hilbert.shards(docs, 7, ("lang", "source"), ("size",), ("doc_id", "text_crc32"))
    assert set(out.columns) == {*docs.columns, "curve", "slot"} and out.columns[-3:] == ["curve", "shard", "slot"]
    found, n = out.collect(), len(rows)
    counts = Counter(r["shard"] for r in found)
    assert len(found) == n and set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(7):
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(counts[s]))
    ordered = sorted(found, key=lambda r: (r["shard"], r["slot"]))
    assert [(r["curve"], r["text_crc32"]) for r in ordered] == [(c, crc) for c, _, _, crc, _ in expected_order(rows)]
    assert {r["place"] for r in found} == {"y"} and {r["range"] for r in found} == {3}
    few = hilbert.shards(docs.limit(3), 7, ("lang",), (), ("doc_id",))
    assert sorted(r["slot"] for r in few.collect()) == [0, 0, 0]
    assert hilbert.shards(docs.limit(0), 7, ("lang", "source"), ("size",), ("doc_id",)).count() == 0


def test_files_of_a_curve_are_skipped(spark, tmp_path):
    rows = spark.range(4_000).select(
        F.col("id").alias("doc_id"),
        F.format_string("l%d", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(8))).alias("lang"),
        F.format_string("s%02d", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(16))).alias("source"),
        F.pow(2, F.pmod(F.xxhash64("id", F.lit(3)), F.lit(15))).cast("long").alias("size"),
    )
    out = hilbert.shards(rows, 8, ("lang", "source"), ("size",), ("doc_id",))
    runs = hilbert.bounds(out, ("lang", "source", "size"), 50).collect()
    assert sum(r["rows"] for r in runs) == 4_000 and max(r["rows"] for r in runs) <= 50
    for c, v in (("lang", "l3"), ("source", "s05"), ("size", 64)):
        kept = sum(r[f"least_{c}"] <= v <= r[f"most_{c}"] for r in runs)
        # In the order of ids, or sorted by one other column, nearly all runs hold every value.
        assert kept < 0.6 * len(runs), (c, kept, len(runs))
    hilbert.write_shards(out, str(tmp_path / "s"), 100)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 4_000 and back.groupBy(F.input_file_name()).count().where("count > 100").count() == 0


# Collocations ------------------------------------------------------------------------


def brute_collocations(rows, least, top):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            total[lang] += len(words)
            for n in range(1, 5):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, found in counts.items():
        frequent = {p: a for p, a in found.items() if a >= least}
        scored = []
        for p, a in frequent.items():
            longer = (b for q, b in frequent.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)))
            if len(p) > 1 and not any(100 * b >= 80 * a for b in longer):
                score, k = min((2_000_000 * a // (found[p[:k]] + found[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def collocation_rows():
    pick = random.Random(5)
    words = ["new", "York", "time", "of", "the", "day", "é", "日本", "a-b", "x" * 40, "Größe"]
    rows = []
    for i in range(120):
        text = "".join(pick.choice(words) + pick.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for _ in range(pick.randint(0, 60)))
        rows.append((pick.choice([None, 1, i]), text, pick.choice(["en", "en", "de", None, "und"]), "s"))
    rows += [(5, "New York Times of the day. New York Times of the day.", "en", "s")] * 25
    return rows + [(6, None, "en", "s"), (7, "", "fr", None), (8, " \t.,", "fr", None), (None, "one", "it", None)]


@pytest.mark.parametrize("mask", [2**64 - 1, 0x3F])
def test_collocations_equal_brute_force(spark, mask):
    """The narrow mask leaves 64 fingerprints, so that nearly all phrases collide."""
    rows = collocation_rows()
    out = collocations.collocations(documents(spark, rows), least=6, top=25, mask=mask)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, out.collect())) == brute_collocations([(r[2], r[1]) for r in rows], 6, 25)


def test_collocations_of_long_texts(spark, monkeypatch):
    pick = random.Random(8)
    text = "".join(pick.choice(["alpha", "beta", "gamma", "delta"]) + pick.choice([" ", " ", ". "]) for _ in range(400_000))
    assert len(text) > 2 * collocations.SLICE
    rows = [(1, text, "en", "s"), (2, "x" * 2_500_000 + " alpha beta", "en", "s")]
    out = collocations.collocations(documents(spark, rows), least=5_000, top=40)
    assert sorted(map(tuple, out.collect())) == brute_collocations([(r[2], r[1]) for r in rows], 5_000, 40)
    assert collocations.collocations(documents(spark, [])).count() == 0
    assert collocations.collocations(documents(spark, [(1, None, None, None)])).count() == 0


def test_collocation_bitmap_holds_every_fingerprint(spark):
    values = [0, 1, -1, 2**63 - 1, -(2**63), *(random.Random(1).getrandbits(64) - 2**63 for _ in range(500))]
    import numpy as np

    bitmap = collocations.bitmap_of(spark.createDataFrame([(v,) for v in values], "fingerprint long"))
    assert collocations.in_bitmap(bitmap, np.array(values, np.int64).view(np.uint64)).all()
    assert len(bitmap) == 2**23 and int(np.unpackbits(bitmap).sum()) <= len(values)


# Filter audit --------------------------------------------------------------------------


def failing_sets(rows):
    first = {}
    for i, text, _, _ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    out = []
    for i, text, _, source in rows:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        bad = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text)}
        bad |= {"D": bool(re.search("[#$%&*|]", text)), "E": i is not None and first[text] < i}
        out.append((i, source or "", {f for f, b in bad.items() if b}))
    return out


def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = defaultdict(list)
    for i, part, bad in failing_sets(rows):
        parts[part].append((i, bad))
    out, shares = {}, Counter()
    for part, docs in parts.items():
        for order in map("".join, itertools.permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [(i, bad) for i, bad in left if f in bad]
                left = [(i, bad) for i, bad in left if f not in bad]
                redundant = sum(f in bad for _, bad in docs) - len(gone)
                unique = sum(bad == {f} for _, bad in docs)
                out[part, order, step] = [len(left), len(gone), redundant, unique, sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
                shares[part, f] += len(gone)
    return sorted((p, o, s, *v, shares[p, o[s - 1]]) for (p, o, s), v in out.items())


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit_equals_brute_force(spark):
    pick = random.Random(4)
    texts = [None, "", "few words", "FEW WORDS", "a # b", " \t\n"]
    texts += [" ".join(f"w{pick.randint(0, n)}" for _ in range(n)) for n in (199, 200, 201, 400)]
    texts += [" ".join(["same"] * 150 + [f"u{i}" for i in range(100)]), " ".join(["same"] * 300) + " $", "X" * 30 + " ".join(f"v{i}" for i in range(250))]
    rows = [(pick.choice([None, i, i, 3]), pick.choice(texts), "en", pick.choice([None, "", "s", "t"])) for i in range(150)]
    rows += [(1000 + i, "copied " * 250, "en", "hot") for i in range(80)] + [(1000, "copied " * 250, "en", "hot")] * 2
    labels = [(pick.choice([None, i, 1000 + i]), pick.choice([0, 1, None]), pick.choice([0, 1, None])) for i in range(120)] + [(5, 1, 0), (5, 0, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = filter_audit.audit(documents(spark, rows).withColumn("failed", F.lit(1)), marks)
    assert out.columns == COLUMNS
    assert sorted(map(tuple, out.collect())) == brute_audit(rows, labels)
    assert filter_audit.audit(documents(spark, []), marks).count() == 0
    alone = filter_audit.audit(documents(spark, [(None, None, None, None)]), marks.limit(0)).collect()
    assert len(alone) == 600 and all(r["kept"] == ("A" not in r["filter_order"][: r["step"]]) and r["part"] == "" for r in alone)


def test_least_squares_give_shapley_values():
    pick = random.Random(6)
    for n in range(1, 6):
        weights = filter_audit.shapley_weights(n)
        value = [0] + [pick.randint(0, 10**12) for _ in range(2**n - 1)]
        for player in range(n):
            total = 0
            for order in itertools.permutations(range(n)):
                before = sum(1 << p for p in order[: order.index(player)])
                total += value[before | 1 << player] - value[before]
            assert sum(w * v for w, v in zip(weights[player], value)) == total
    assert filter_audit.solve([[Fraction(0), Fraction(2)], [Fraction(4), Fraction(1)]], [[Fraction(6)], [Fraction(7)]]) == [[1], [3]]


# Long texts of earlier operators -------------------------------------------------------


def test_bound_array_expressions(spark):
    values = [random.Random(9).randint(0, 50) for _ in range(1_000)]
    df = spark.createDataFrame([(values,), ([],), ([3],)], "v array<bigint>")
    ends, most = (df.select(f("v").alias("x")).collect() for f in (running_ends, running_most))
    assert [r["x"] for r in ends] == [list(itertools.accumulate(values)), [], [3]]
    assert [r["x"] for r in most] == [list(itertools.accumulate(values, max)), [], [3]]
    ordered = sorted(values)
    found = spark.range(-1, 52).select("id", last_not_above(F.array(*map(F.lit, ordered[::10])), F.col("id")).alias("at")).collect()
    assert all(r["at"] == sum(v <= r["id"] for v in ordered[::10]) - 1 for r in found)
    text = "aé🙂\n" * 500
    cuts = [(0, 0), (0, 2_000), (1_999, 1), (255, 2), (256, 256), (511, 600), (3, 0)]
    df = spark.createDataFrame([(text,)], "t string").select(*[with_cutter(F.col("t"), lambda cut: cut(F.lit(b), F.lit(n))).alias(f"c{b}_{n}") for b, n in cuts])
    assert list(df.first()) == [text[b : b + n] for b, n in cuts]


@pytest.mark.parametrize(
    ("text", "spans", "rest"),
    [
        ("x a@b" + ".c" * 100_000 + " y", 1, "x <EMAIL> y"),
        ("mail u@ex.org now " * 50_000, 50_000, "mail <EMAIL> now " * 50_000),
        ("4111 1111 1111 1111, " * 5_000, 5_000, "<CARD>, " * 5_000),
        ("1234567890" * 50_000, 0, "1234567890" * 50_000),
    ],
    ids=["labels", "addresses", "cards", "digits"],
)
def test_personal_data_in_long_texts(spark, text, spans, rest):
    found = pii.redact(pii.find_spans(documents(spark, [(1, text, None, None)])))
    row = found.select(F.size("spans").alias("n"), "text").first()
    assert row["n"] == spans and row["text"] == rest


def test_card_parts_outside_whole_numbers_only(spark):
    text = "4111 1111 1111 1111 and 4111111111111111 4111111111111111 9 and 12 4845168114407329 7536784127813050"
    found = pii.find_spans(documents(spark, [(1, text, None, None)])).first()["spans"]
    assert [(s["kind"], s["start"], s["end"]) for s in found if s["kind"].startswith("card")] == [
        ("card", 0, 19),
        ("card_part", 24, 40),
        ("card_part", 41, 57),
        ("card_part", 67, 83),
        ("card_part", 84, 100),
    ]


def test_long_conversations(spark):
    turns = spark.range(100_000).selectExpr(
        "1L as conv_id", "id as turn", "if(id % 3 = 0, 'user', 'assistant') as role", "concat('t<', id, '>') as text"
    )
    chats = chat.format_chats(turns)
    row = chats.select(chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).first()
    assert [(t["role"], t["text"]) for t in row["turns"]] == [("user" if i % 3 == 0 else "assistant", f"t<{i}>") for i in range(100_000)]
    assert row["loss"] == "".join(f"t<{i}>" for i in range(100_000) if i % 3)


# Cross-parsing, fingerprints, tokens and mixing against plain versions ------------------


def spelled_symbols(text, own):
    out = []
    for c in text.lower():
        if not c.isalpha():
            if not out or out[-1] != "gap":
                out.append("gap")
        else:
            out += [c] if c in own else list(c.encode())
    return out


def brute_pieces(sample, text, own):
    known, asked = spelled_symbols(sample, own), spelled_symbols(text, own)
    parts, current = min(1, len(asked)), []
    inside = lambda run: any(known[i : i + len(run)] == run for i in range(len(known) - len(run) + 1))
    for symbol in asked:
        if inside([*current, symbol]):
            current.append(symbol)
        else:
            parts, current = parts + 1, [symbol] if inside([symbol]) else []
    return parts


def test_cross_parsing_equals_substring_search(monkeypatch):
    """More letters than have symbols: the others are spelled and stay apart."""
    monkeypatch.setattr(lang_id, "MAX_LETTERS", 30)
    pick = random.Random(12)
    alphabets = ["abcdeéß ", "абвгдежз ", "日本語文字列一二三四五 ", "αβγδ🙂12 "]
    text = lambda letters, n: "".join(pick.choice(letters) for _ in range(n))
    samples = tuple((f"l{i}", text(a, 300)) for i, a in enumerate(alphabets))
    parse = lang_id.CrossParser(samples)
    counted = Counter(c for _, t in samples for c in t.lower() if c.isalpha() and c not in lang_id.ASCII)
    own = set(lang_id.ASCII) | set(sorted(counted, key=lambda c: (-counted[c], c))[:4])
    texts = [text(a, n) for a in (*alphabets, "abzжß日ж") for n in (0, 1, 40, 200)] + ["", " ", "q"]
    pieces, letters = parse.pieces(texts)
    assert letters.tolist() == [sum(c.isalpha() for c in t.lower()) for t in texts]
    for i, t in enumerate(texts):
        assert pieces[i].tolist() == [brute_pieces(s, t, own) for _, s in samples], t


def test_tables_of_many_languages_stay_within_their_bound():
    pick = random.Random(13)
    samples = tuple((f"l{i:03d}", "".join(chr(0x4E00 + 40 * i + pick.randint(0, 39)) for _ in range(2_000))) for i in range(60))
    parse = lang_id.CrossParser(samples, table_bytes=4 << 20)
    assert sum(t.nbytes for t in parse.tables) <= 4 << 20
    names, _, _ = parse.predict([t[:50] for _, t in samples])
    assert names == [lang for lang, _ in samples]


def brute_fingerprint(data):
    rolling = []
    for i in range(len(data)):
        h = 0
        for k in range(i - 6, i + 1):
            h = (h * 0x9E3779B1 + (data[k] if k >= 0 else 0) + 1) & 0xFFFFFFFF
        h = ((h ^ h >> 15) * 0x2C1B3C6D) & 0xFFFFFFFF
        rolling.append(h ^ h >> 13)
    ends = lambda bits: [i + 1 for i, h in enumerate(rolling) if h & (1 << bits) - 1 == (1 << bits) - 1]
    bits = next(b for b in range(2, 34) if len(ends(b)) < 64)
    shown = []
    for b in (bits, bits + 1):
        cuts = ends(b)
        cuts += [len(data)] if data and (not cuts or cuts[-1] < len(data)) else []
        out = ""
        for begin, end in zip([0, *cuts], cuts):
            x = sum((c + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, c in enumerate(data[begin:end])) % (1 << 64)
            x = ((x ^ x >> 31) * 0xBF58476D1CE4E5B9) % (1 << 64) >> 52
            out += piecewise_hash.ALPHABET[x >> 6] + piecewise_hash.ALPHABET[x & 63]
        shown.append(out)
    return f"{1 << bits}:{shown[0]}:{shown[1]}"


def test_fingerprints_equal_byte_by_byte(monkeypatch):
    pick = random.Random(14)
    texts = [b"", b"a", bytes(300), bytes(pick.randrange(256) for _ in range(2_000)), "wörter und sätze ".encode() * 40]
    texts += [bytes(pick.choice(b"abc ") for _ in range(n)) for n in (3, 64, 255, 256, 700)]
    expected = [brute_fingerprint(t) for t in texts]
    assert [str(piecewise_hash.fingerprint(t)) for t in texts] == expected
    monkeypatch.setattr(piecewise_hash, "SEGMENT", 97)
    piecewise_hash._powers.cache_clear()
    assert [str(piecewise_hash.fingerprint(t)) for t in texts] == expected
    piecewise_hash._powers.cache_clear()


def test_small_tables_change_no_token(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pick = random.Random(15)
    texts = ["".join(pick.choice(["the", "Thing", "é", "日本", " ", "  ", "\n", "123", "'s", "unhappily"]) + pick.choice(["", " "]) for _ in range(60)) for _ in range(80)]
    ranks = byte_bpe.read_ranks(path)
    wide = byte_bpe.Transducer(ranks, public_tokenizers.PATTERN)
    expected = [[i for ids in wide.encode(t) for i in ids] for t in texts]
    for name in ("MAX_PAIRS", "MAX_PIECES", "MAX_UNITS", "MAX_HEADS"):
        monkeypatch.setattr(byte_bpe, name, 3)
    narrow = byte_bpe.Transducer(ranks, public_tokenizers.PATTERN)
    assert [[i for ids in narrow.encode(t) for i in ids] for t in texts] == expected
    assert max(len(narrow.units), len(narrow.pieces), len(narrow.old_units)) <= 4


def test_a_worker_keeps_one_state():
    made = []
    make = lambda name: lambda: made.append(name) or [name]
    first = common.worker_state("a", make("a"))
    assert common.worker_state("a", make("a")) is first
    common.worker_state("b", make("b"))
    assert common.worker_state("a", make("a")) == ["a"] and made == ["a", "b", "a"]


def test_mixing_keeps_columns_named_as_its_own(spark, monkeypatch):
    docs = documents(spark, [(i, "x" * i, "en", "s" if i % 2 else None) for i in range(40)])
    plain = mixing.mix_sources(docs, budget=2.0).select("doc_id", "copy_no", "shuffle_key").collect()
    clashing = docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(("__source", "__pieces", "__cdf", "__salt", "__PART", "copy_no"))])
    for rows in (10_000, 0):
        monkeypatch.setattr(mixing, "BROADCAST_ROWS", rows)
        out = mixing.mix_sources(clashing, budget=2.0)
        assert out.columns == [c for c in clashing.columns if c != "copy_no"] + ["n_copies", "copy_no", "shuffle_key"]
        assert out.select("doc_id", "copy_no", "shuffle_key").collect() == plain
        assert {tuple(r) for r in out.select("__source", "__salt", "__PART").collect()} == {(0, 3, 4)}


def test_automaton_knows_exactly_the_substrings():
    rng = random.Random(11)
    for size in (0, 1, 2, 7, 40, 90):
        symbols = [rng.choice((2, 3, 4)) for _ in range(size)]
        rows = lang_id.suffix_automaton(symbols, 6)
        assert len(rows) <= max(1, 2 * size)
        known = {tuple(symbols[i:j]) for i in range(size) for j in range(i, size + 1)} | {()}
        found, waiting = set(), [((), 0)]
        while waiting:
            read, state = waiting.pop()
            found.add(read)
            waiting += [((*read, s), int(to)) for s, to in enumerate(rows[state]) if to]
        assert found == known
