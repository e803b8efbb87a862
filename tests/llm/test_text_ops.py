"""Decontamination, license scans, SentencePiece, language ID, substring dedup and pseudonyms against plain versions."""

import functools
import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import common, decontaminate, language_id, license_scan, pii, sentencepieces, substring_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, item_id long, labels string, spans int"
ODD = [None, "", " ", "\n\n", "x", "é ü", "☃☃", "1 2 3", "word " * 20_000]


def docs(spark, texts, lang=None):
    return spark.createDataFrame([(i, t, lang[i] if lang else None, None, None, 5, "x", 1) for i, t in enumerate(texts)], SCHEMA)


def prose(r, n, pool):
    return " ".join(r.choices(pool, k=n))


POOL = [f"{a}{b}" for a in ("ba", "co", "du", "fe", "gi", "ha") for b in ("la", "mo", "nu", "re", "si", "ta", "vo")]

# Decontamination ------------------------------------------------------------------------------------------------------------


def plain_tiles(pattern, text, least):
    """Greedy string tiling without hashes: the longest match of unmarked tokens first, by place in pattern then text."""
    free_p, free_t, out = [True] * len(pattern), [True] * len(text), 0
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(pattern)):
            for j in range(len(text)):
                n = 0
                while i + n < len(pattern) and j + n < len(text) and pattern[i + n] == text[j + n] and free_p[i + n] and free_t[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return out
        free_p[i : i + n] = [False] * n
        free_t[j : j + n] = [False] * n
        out += n


def test_tiles_cover_what_plain_tiling_covers():
    r = random.Random(5)
    for _ in range(120):
        p = [r.randrange(6) for _ in range(r.randrange(1, 50))]
        t = [r.randrange(6) for _ in range(r.randrange(0, 40))]
        for _ in range(r.randrange(3)):
            a = r.randrange(len(p))
            t[r.randrange(len(t) + 1) : 0] = p[a : a + r.randrange(3, 30)]
        found = decontaminate.tiles(p, t, 3, first=r.choice([3, 8, 20]))
        marked = [k for i, _, n in found for k in range(i, i + n)]
        placed = [k for _, j, n in found for k in range(j, j + n)]
        assert len(marked) == len(set(marked)) and len(placed) == len(set(placed))
        assert all(p[i : i + n] == t[j : j + n] and n >= 3 for i, j, n in found)
        want = plain_tiles(p, t, 3)
        assert abs(len(marked) - want) <= 0.35 * max(want, 6)  # ties are broken in another order
        assert bool(marked) == bool(want)


def test_tiles_mark_what_plain_tiling_marks():
    r = random.Random(6)
    for _ in range(400):
        p = [r.randrange(r.choice([3, 6, 40])) for _ in range(r.randrange(1, 45))]
        t = [r.randrange(6) for _ in range(r.randrange(0, 20))]
        for _ in range(r.randrange(5)):
            a = r.randrange(len(p))
            t[r.randrange(len(t) + 1) : 0] = p[a : a + r.randrange(3, 30)]
        for first in (3, 8, 20):
            assert sum(n for *_, n in decontaminate.tiles(p, t, 3, first=first)) == plain_tiles(p, t, 3)
    item = list(range(1, 25))
    assert sorted(decontaminate.tiles(item, [*item[:8], -1, *item[5:14]], 5)) == [(0, 0, 5), (5, 9, 9)]


def test_overlapping_pieces_of_an_item_count(spark):
    words = [f"w{k}" for k in range(24)]
    bench = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    got = decontaminate.contamination(docs(spark, [" ".join([*words[:8], "and", *words[5:14]])]), bench).collect()
    assert [(x.doc_id, x.item_id, x.matched, x.tiles) for x in got] == [(0, 7, 14, 2)]


def test_running_hashes():
    r = random.Random(1)
    x = [r.randrange(1 << 40) for _ in range(50)]
    for width in (1, 5, 50, 51):
        want = [sum(t * pow(decontaminate.BASE, width - 1 - k, decontaminate.PRIME) for k, t in enumerate(x[i : i + width])) % decontaminate.PRIME for i in range(len(x) - width + 1)]
        assert list(decontaminate.running_hashes(x, width)) == want


@pytest.mark.parametrize("block", [4 << 20, 300])
def test_contamination(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    r = random.Random(2)
    items = [prose(r, 30, [f"{w}{k}" for w in POOL]) for k in range(6)]
    w = items[2].split()
    texts = [
        prose(r, 200, POOL), f"{prose(r, 50, POOL)} {items[0]} {prose(r, 50, POOL)}", f"{items[1].upper()}!", " ".join([*w[20:], "and", *w[:10], "or", *w[10:20]]),
        " ".join(items[3].split()[:10]) + " " + prose(r, 90, POOL), f"{items[4]}\n{items[5]}", *ODD,
    ]
    bench = spark.createDataFrame([*enumerate(items), (6, None), (7, ""), (8, "..."), (9, "two words"), (0, items[0])], "item_id long, text string")
    got = sorted((x.doc_id, x.item_id, x.matched, x.tiles) for x in decontaminate.contamination(docs(spark, texts), bench).collect())
    assert got == [(1, 0, 30, 1), (1, 0, 30, 1), (2, 1, 30, 1), (3, 2, 30, 3), (5, 4, 30, 1), (5, 5, 30, 1)]
    kept = decontaminate.decontaminated(docs(spark, texts), bench)
    assert kept.columns == docs(spark, []).columns and sorted(x.doc_id for x in kept.collect()) == [0, 4, *range(6, len(texts))]
    none = bench.where("item_id > 100")
    assert decontaminate.contamination(docs(spark, texts), none).count() == 0 and decontaminate.decontaminated(docs(spark, texts), none).count() == len(texts)


# License scans --------------------------------------------------------------------------------------------------------------


def plain_base(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, label) for phrase, label in license_scan.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), len(places), min((p[0] for p in places), default=None), max((p[0] for p in places), default=None), ",".join(sorted({p[1] for p in places}))


def test_base_phrases(spark):
    r = random.Random(3)
    pool = ["cc", "by", "CC-BY", "general", "public", "License", "all", "rights", "reserved", "é", "x y", "\n", "ALL RIGHTS", "1", "sa", "\x00"]
    texts = [r.choice([" ", "-", ", "]).join(r.choices(pool, k=r.randrange(0, 40))) for _ in range(300)] + ODD + ["cc by cc by"]
    for row in license_scan.scan_licenses(docs(spark, texts)).collect():
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == plain_base(texts[row.doc_id])
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(",")) and 0 <= row.score <= 1


@pytest.mark.parametrize(("text", "labels"), [
    ("Licensed under the Apache License, Version 2.0", "apache-2.0"), ("SPDX-License-Identifier: MIT", "mit"), ("This is submitted.", ""),
    ("CC-BY-SA 4.0", "cc-by,cc-by-sa-4.0"), ("GNU Lesser General Public License v2.1", "gpl,lgpl-2.1"), ("Mozilla Public License", "mpl"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy", "mit"), ("the apache tribe", ""), ("GPL v3 and the MIT License", "gpl-3.0,mit"),
])
def test_rules(text, labels):
    assert license_scan.Scanner().scan(text.encode())["labels"] == labels


def test_words_stand_next_to_each_other_whatever_parts_them():
    scan = license_scan.Scanner().scan
    for phrase, label in license_scan.BASE.items():
        for between in ("  ", ", ", "\r\n", " - ", "\n    * "):
            for text in (phrase.replace(" ", between), f"({phrase.upper().replace(' ', between)}) Ann"):
                got = scan(text.encode())
                assert (got["n_base"], got["first_word"], got["base_labels"]) == (1, 0, label), text
    for stem in filter(lambda x: b" " in x, license_scan.Scanner().stems):
        for rule in license_scan.Scanner().by_keyword.get(stem, ()):
            if re.fullmatch(rb"[a-z0-9 ]+", body := rule.pattern.pattern.replace(rb"(?:(?<= )|(?<=^))", b"").replace(rb"(?= |$)", b"")):
                assert scan(body.replace(b" ", b" \n"))["labels"] == scan(body)["labels"] != "", body
    assert scan(b"(cc) by Ann")["n_base"] == 1 and scan(b"into the public  \n domain")["labels"] == "public-domain"


def test_contained_hits_go():
    h = license_scan.Hit
    assert license_scan.resolve([h(0, 9, 50, "a"), h(2, 5, 50, "b"), h(2, 5, 90, "c"), h(4, 12, 10, "d"), h(5, 9, 10, "e")]) == [h(0, 9, 50, "a"), h(2, 5, 90, "c"), h(4, 12, 10, "d")]
    assert len(license_scan.rules()) > 300


def plain_resolve(hits):
    """Each hit against all others, from high priority to low."""
    kept = []
    for h in sorted(hits, key=lambda h: (-h.priority, h.start - h.end, h.start, h.label)):
        if not any(k.start <= h.start and h.end <= k.end for k in kept):
            kept.append(h)
    return sorted(kept)


def test_suppression_is_that_of_all_pairs_and_takes_long_notices():
    r = random.Random(13)
    for _ in range(300):
        hits = [license_scan.Hit(a, a + r.randrange(1, 12), r.choice([10, 50, 90]), r.choice("abc")) for a in (r.randrange(40) for _ in range(r.randrange(0, 40)))]
        assert license_scan.resolve(hits) == plain_resolve(hits)
    many = [license_scan.Hit(a, a + 1 + a % 7, a % 5, "x") for a in range(100_000)]
    began = time.perf_counter()
    license_scan.resolve(many)
    assert time.perf_counter() - began < 10


def test_labels_are_those_of_all_rules():
    """Against every rule on every text, without the prefilter."""
    s, r = license_scan.Scanner(), random.Random(14)
    pool = [*WORDS_OF_RULES, "the", "of", "1.0", "2.0", "v3", "license", "MIT", "x"]
    for _ in range(150):
        text = r.choice([" ", "-", "\n", ", "]).join(r.choices(pool, k=r.randrange(0, 60)))
        line = b" ".join(text.encode().translate(license_scan.WORD_BYTES).split())
        hits = [license_scan.Hit(m.start(), m.end(), rule.priority, rule.label) for rule in s.rules for m in rule.pattern.finditer(line)]
        want = {h.label for h in plain_resolve(hits)} | set(filter(None, plain_base(text)[4].split(",")))
        assert s.scan(text.encode())["labels"] == ",".join(sorted(want))


WORDS_OF_RULES = sorted({w for *_, text, _ in license_scan.TEXTS for w in re.findall("[a-z0-9]{2,}", text)} | {phrase for phrase in license_scan.BASE} | {"apache license version 2 0", "gnu general public license", "creative commons attribution", "this font software is licensed under the sil open font license"})


def example(tree, r):
    """A random string that a parsed pattern matches."""
    from re import _constants as c

    out = ""
    for op, arg in tree:
        if op is c.LITERAL:
            out += chr(arg)
        elif op is c.ANY:
            out += r.choice("abc ")
        elif op is c.IN:
            kind, value = r.choice(arg)
            out += chr(value) if kind is c.LITERAL else chr(r.randint(*value))
        elif op is c.BRANCH:
            out += example(r.choice(arg[1]), r)
        elif op is c.SUBPATTERN:
            out += example(arg[-1], r)
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT):
            out += "".join(example(arg[2], r) for _ in range(r.randint(arg[0], min(arg[1], arg[0] + 3))))
    return out


def test_the_prefilter_lets_every_rule_through():
    from re import _parser

    s, r = license_scan.Scanner(), random.Random(12)
    for rule in s.rules:
        body = rule.pattern.pattern.replace(rb"(?:(?<= )|(?<=^))", b"").replace(rb"(?= |$)", b"").decode()
        for _ in range(12):
            text = example(_parser.parse(body), r)
            assert rule.pattern.search(text.encode()), (text, body)
            assert rule.keyword.decode() in text and any(stem.decode() in text for stem in s.stems), (text, rule.keyword)


# SentencePiece --------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def bpe():
    sentencepiece = pytest.importorskip("sentencepiece")
    try:
        raw = sentencepieces.read_model(common.MODEL)
    except OSError:
        pytest.skip("no model file")
    return raw, sentencepiece.SentencePieceProcessor(model_proto=raw)


@pytest.fixture(scope="module")
def unigram(bpe):
    """The same pieces and scores, read as a unigram model by both sides."""
    sentencepiece = pytest.importorskip("sentencepiece")
    trainer = next(sentencepieces.field(bpe[0], 2))
    raw = bpe[0].replace(trainer, trainer.replace(b"\x18\x02", b"\x18\x01", 1))
    return raw, sentencepiece.SentencePieceProcessor(model_proto=raw)


def samples(sp):
    r = random.Random(4)
    pieces = [sp.id_to_piece(i).replace("▁", " ") for i in range(3, len(sp))]
    out = ["a", " ", "   x", " a  b   c    d", "aaaaaaaaaaaaaaaaaaaaa", "=====----====", "日本語テキスト梦", "hello\r\n\tworld 12345", "a\u0000b", "👍🏽 ok"]
    out += ["".join(r.choice(pieces) for _ in range(r.randrange(1, 8))) for _ in range(1500)]
    out += ["".join(r.choice("ab=-* /#ercthion\né") for _ in range(r.randrange(1, 50))) for _ in range(1500)]
    return out


def scan(encoder, text, chunk):
    m, around = sentencepieces.marked(text), encoder.spec.longest
    n = -(-len(m) // chunk)
    parts = []
    for k in range(n):
        lo, begin = min(k * chunk, around), max(k * chunk - around, 0)
        hi = lo + min(chunk, len(m) - k * chunk)
        parts.append((m[begin : begin + hi + (0 if k == n - 1 else around)], lo, hi, k == 0, k == n - 1))
    states = sentencepieces.best_states([(k, encoder.matrix(*p)) for k, p in enumerate(parts)])
    return [i for (_, a, b), p in zip(states, parts, strict=True) for i in encoder.chunk(p[0], p[1], p[2], a, b)]


def test_bpe_ids_are_the_librarys(bpe):
    raw, sp = bpe
    encoder = sentencepieces.Encoder(sentencepieces.load(raw))
    for text in samples(sp):
        assert encoder.encode(sentencepieces.marked(text)).tolist() == sp.encode(text), text


def test_any_cut_gives_the_same_ids(bpe):
    raw, sp = bpe
    encoder = sentencepieces.Encoder(sentencepieces.load(raw))
    for text in samples(sp)[::12]:
        for chunk in (1, 2, 7, 30):
            assert scan(encoder, text, chunk) == sp.encode(text), (text, chunk)


def test_unigram_paths_weigh_as_the_librarys(unigram):
    raw, sp = unigram
    encoder = sentencepieces.Encoder(sentencepieces.load(raw))
    assert encoder.spec.kind == "unigram"
    for text in samples(sp)[::8]:
        if all(sp.piece_to_id(c) != sp.unk_id() for c in sentencepieces.marked(text)):  # unknown characters are bytes on both sides
            ids = encoder.encode(sentencepieces.marked(text)).tolist()
            assert encoder.score(ids) == pytest.approx(encoder.score(sp.encode(text)), rel=1e-5), text
            for chunk in (3, 16):
                assert encoder.score(scan(encoder, text, chunk)) == pytest.approx(encoder.score(ids), rel=1e-6), (text, chunk)


def test_products_are_associative(bpe):
    """Any bracketing of a text's matrices is the same matrix, and runs of any length give the states that one pass gives."""
    raw, sp = bpe
    encoder, r = sentencepieces.Encoder(sentencepieces.load(raw)), random.Random(16)
    for text in samples(sp)[5::200]:
        m, around, chunk = sentencepieces.marked(text), encoder.spec.longest, 3
        n = -(-len(m) // chunk)
        cells = []
        for k in range(n):
            lo, begin = min(k * chunk, around), max(k * chunk - around, 0)
            hi = lo + min(chunk, len(m) - k * chunk)
            cells.append(encoder.matrix(m[begin : begin + hi + (0 if k == n - 1 else around)], lo, hi, k == 0, k == n - 1))
        once = sorted(functools.reduce(sentencepieces.product, cells))
        while len(cells) > 1:
            i = r.randrange(len(cells) - 1)
            cells[i : i + 2] = [sentencepieces.product(cells[i], cells[i + 1])]
        assert sorted(cells[0]) == once


@pytest.mark.parametrize("fan", [16, 3])
def test_encoding_and_decoding_tables(spark, bpe, fan, monkeypatch):
    monkeypatch.setattr(sentencepieces, "FAN", fan)
    raw, sp = bpe
    r = random.Random(6)
    texts = [*ODD, prose(r, 3000, POOL), "z" * 3000, prose(r, 3000, POOL), "日本" * 900, "a b\n" * 700]
    texts.append(texts[9])
    encoded = sentencepieces.encode(docs(spark, texts), raw, chunk=500)
    got = {x.doc_id: x for x in encoded.collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i].ids == sp.encode(t or ""), i
    for x in sentencepieces.decode(encoded, raw).collect():
        t = texts[x.doc_id] or ""
        assert x.text == t and x.n_tokens == len(sp.encode(t)) and x.ids_sha256 == hashlib.sha256(np.array(sp.encode(t), "<i4").tobytes()).hexdigest()
    assert sentencepieces.decode(sentencepieces.encode(docs(spark, []), raw), raw).count() == 0


# Language ID ----------------------------------------------------------------------------------------------------------------

TONGUES = {"aa": ["ba", "lo", "mi", "ka"], "bb": ["sch", "tz", "ung", "ver"], "cc": ["é", "eau", "çon", "oui"]}


def spoken(r, lang, n):
    return " ".join("".join(r.choices(TONGUES[lang], k=r.randrange(1, 4))) for _ in range(n))


def test_language_id(spark):
    r = random.Random(7)
    langs = [r.choice(list(TONGUES)) for _ in range(600)]
    texts = [spoken(r, x, r.randrange(15, 120)) for x in langs] + ODD
    got = {x.doc_id: x for x in language_id.predict(docs(spark, texts, [*langs, *[None] * len(ODD)])).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got) and len(got) == len(texts)
    held = [i for i in range(600) if got[i].held_out]
    assert sum(got[i].lang_pred == langs[i] for i in held) / len(held) > 0.98
    assert sum(got[i].rejected for i in range(600)) <= 3
    for i, t in enumerate(ODD, 600):
        und = t is None or not any(c.isalpha() for c in t)
        assert (got[i].lang_pred == "und") == und and 0 <= got[i].score <= 1
    kept = language_id.accepted(docs(spark, texts, [*langs, *[None] * len(ODD)]))
    assert {x.doc_id for x in kept.collect()} == {i for i in got if not got[i].rejected} and kept.columns == docs(spark, []).columns


def test_language_of_a_held_out_row_is_not_learned(spark):
    r = random.Random(8)
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(i, spoken(r, "aa", 40), "zz" if i in ids else "aa", None, None, 5, "x", 1) for i in range(400)]
    assert {x.lang_pred for x in language_id.predict(spark.createDataFrame(rows, SCHEMA)).collect()} == {"aa"}


def test_an_unseen_language_is_rejected():
    r = random.Random(15)
    tongues = TONGUES | {"dd": ["pra", "sto", "gli", "nen"], "ee": ["wa", "zu", "ngi", "kho"]}

    def said(lang, n):
        return " ".join("".join(r.choices(tongues[lang], k=r.randrange(1, 4))) for _ in range(n))

    for left_out in tongues:
        known = [x for x in tongues if x != left_out]
        model = language_id.fit([(i, lang, said(lang, 40)) for i in range(800) for lang in [r.choice(known)]])
        seen = [(lang, *model.predict(said(lang, r.randrange(12, 200)))) for lang in known for _ in range(200)]
        assert sum(a == b for a, b, *_ in seen) / len(seen) > 0.99 and sum(x[3] for x in seen) / len(seen) < 0.01
        assert sum(model.predict(said(left_out, r.randrange(30, 200)))[2] for _ in range(200)) / 200 > 0.9, left_out


def test_nothing_to_learn_from(spark):
    assert {(x.lang_pred, x.score) for x in language_id.predict(docs(spark, ODD)).collect()} == {("und", 0.0)}
    assert language_id.predict(docs(spark, [])).count() == 0


# Substring dedup ------------------------------------------------------------------------------------------------------------

WORDS = [f"{a}{b}{c}" for a in "abcdef" for b in POOL for c in "xyz"]


@pytest.mark.parametrize("some", [500, 1])
def test_repeats(spark, monkeypatch, some):
    monkeypatch.setattr(common, "SOME", some)
    r = random.Random(9)
    passage, para = prose(r, 55, WORDS), prose(r, 60, WORDS)
    words = para.split()
    words[30] = "changed"
    near = " ".join(words)
    plain = [prose(r, 300, WORDS) for _ in range(6)]
    texts = [
        plain[0], f"{plain[1]} {passage} {plain[2]}", f"{prose(r, 80, WORDS)} {passage.upper()} {prose(r, 3, WORDS)}", f"{plain[3]}\n{para}", f"{near}\n{prose(r, 70, WORDS)}",
        plain[4], plain[4], prose(r, 30, WORDS) + "\n" + prose(r, 12, WORDS), *ODD, f"{plain[5]}\n{plain[5]}", plain[4], "word " * 7000 + passage, "odd even " * 4000,
    ]
    found = substring_dedup.repeats(docs(spark, texts))
    got = {x.doc_id: x for x in found.collect()}
    n = len(texts)
    assert len(got) == n and all(got[i].n_words == len((t or "").split()) for i, t in enumerate(texts))
    assert {i: list(x.keepers) for i, x in got.items() if x.n_removed} == {2: [1], 4: [3], 6: [5], n - 3: [5], n - 2: [1, 16]}
    assert [got[i].n_removed for i in (2, 4, 6, n - 3, n - 2)] == [55, 60, 300, 300, 7055]
    assert [got[i].class_id for i in (1, 2, 3, 4, 5, 6, 16, n - 3, n - 2)] == [1, 1, 3, 3, 5, 5, 1, 5, 1]
    for x in got.values():
        assert x.n_removed == len({k for s in x.spans for k in range(s["first"], s["end"])})
    left = {x.doc_id: x.text for x in substring_dedup.removed(docs(spark, texts), found).collect()}
    assert left[6] == "" and left[1] == texts[1] and left[8] is None
    w = texts[2].split()
    assert left[2].split() == w[:80] + w[135:] and left[4].split() == texts[4].split()[60:]
    assert substring_dedup.repeats(docs(spark, [])).count() == 0


def plain_repeats(texts):
    """The words of each text that stand in PARAGRAPH equal words of an earlier one; every stretch of words is looked up."""
    first, out = {}, []
    for i, t in enumerate(texts):
        w = t.lower().split()
        gone = set()
        for k in range(len(w) - substring_dedup.PARAGRAPH + 1):
            if first.setdefault(tuple(w[k : k + substring_dedup.PARAGRAPH]), i) != i:
                gone.update(range(k, k + substring_dedup.PARAGRAPH))
        out.append(gone)
    return out


def test_passages_go_whole_and_nothing_else(spark):
    r = random.Random(22)
    texts, planted = [], []
    for case in range(500):
        n = r.choice([30, 40, 49, 50, 51, 52, 55, 64, 80, 120, 200, 400])
        passage = [f"p{case}x{k}" for k in range(n)]
        for upper in (False, True):
            around = [[r.choice(WORDS) + str(r.randrange(10**6)) for _ in range(r.choice([0, 1, 3, 20, 45, 90, 150]))] for _ in range(2)]
            words = [*around[0], *passage, *around[1]]
            texts.append("".join(w.upper() + r.choice([" ", " ", "\t", "\n"]) if upper else w + " " for w in words))
        planted.append(n)
    want = plain_repeats(texts)
    got = {x.doc_id: x for x in substring_dedup.repeats(docs(spark, texts)).collect()}
    for i in range(len(texts)):
        assert {k for s in got[i].spans for k in range(s["first"], s["end"])} == want[i], (i, planted[i // 2])
    assert sum(bool(w) for w in want) == sum(n >= 50 for n in planted)


def test_an_earlier_document_may_have_less_of_a_passage(spark):
    r = random.Random(23)
    passage = [f"q{k}" for k in range(150)]
    texts = [" ".join([*r.choices(WORDS, k=30), *p, *r.choices(WORDS, k=30)]) for p in (passage[50:110], passage, passage)]
    got = {x.doc_id: x for x in substring_dedup.repeats(docs(spark, texts)).collect()}
    assert [got[i].n_removed for i in range(3)] == [0, 60, 150] and list(got[2].keepers) == [0, 1]
    assert {x.class_id for x in got.values()} == {0}


def test_rows_that_share_an_id(spark):
    r = random.Random(24)
    a, b, c = (prose(r, 120, WORDS) for _ in range(3))
    rows = [(1, a), (1, b), (1, b), (1, c), (2, f"x\n{b}"), (2, None), (3, f"{c} y {a}"), (None, a), (None, b), (3, "")]
    df = spark.createDataFrame([(i, t, None, None, None, 5, "x", 1) for i, t in rows], SCHEMA)
    found = substring_dedup.repeats(df)
    got = sorted((x.doc_id or 0, x.n_words, x.n_removed, x.class_id) for x in found.collect())
    assert got == sorted([(1, 120, 0, 1), (1, 120, 0, 1), (1, 120, 0, 1), (1, 120, 0, 1), (2, 121, 120, 1), (2, 0, 0, 1), (3, 241, 240, 1), (0, 120, 0, None), (0, 120, 0, None), (3, 0, 0, 1)])
    left = sorted((x.doc_id or 0, x.text) for x in substring_dedup.removed(df, found).where("text is not null").collect())
    assert left == sorted([(1, a), (1, b), (1, b), (1, c), (2, "x"), (3, " y"), (0, a), (0, b), (3, "")])


@pytest.mark.parametrize("most", [1000, 3])
def test_near_copies_are_what_all_pairs_give(spark, monkeypatch, most):
    monkeypatch.setattr(substring_dedup, "GROUP", most)
    monkeypatch.setattr(common, "SOME", most)
    monkeypatch.setattr(common, "HOT", 10)
    r = random.Random(25)
    texts = []
    for _ in range(6):
        words = r.choices(WORDS, k=r.choice([60, 100, 160]))
        for _ in range(r.choice([1, 4, 14])):
            own = list(words)
            for _ in range(r.choice([0, 1, 2, 3])):
                at = r.randrange(len(own))
                own[at : at + 1] = r.choice([[], ["new"], ["new", own[at]]])
            texts.append(r.choice([" ", "\n"]).join(own))
            words = r.choice([words, own])
    grams = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    root = list(range(len(texts)))
    for _ in texts:
        root = [min(root[j] for j in range(len(texts)) if len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j])) for i in range(len(texts))]
    got = {x.doc_id: x.root for x in substring_dedup.near_copies(docs(spark, texts)).collect()}
    same = {}  # equal words: only the first is returned
    for i, t in enumerate(texts):
        first = same.setdefault(tuple(t.split()), i)
        assert got.get(first, first) == root[i]


def test_edits_inside_a_passage_go_with_it():
    a = np.arange(400, dtype=np.uint64)
    b = a.copy()
    b[[150, 210]] = 9999
    assert substring_dedup.same_stretches(a, b) == [(0, 400)]
    b[200:300] += np.uint64(5000)
    assert substring_dedup.same_stretches(a, b) == [(0, 200), (300, 400)]
    assert substring_dedup.same_stretches(a[:49], a[:49]) == [] and substring_dedup.same_stretches(a[:50], a[:50]) == [(0, 50)]


def test_bands_find_similar_paragraphs():
    r = np.random.default_rng(11)
    met = 0
    for _ in range(300):
        a = r.integers(0, 1 << 63, 90, dtype=np.uint64)
        b = np.r_[a[:80], r.integers(0, 1 << 63, 10, dtype=np.uint64)]  # similarity 0.8
        keys = substring_dedup.bands(np.r_[a, b], np.array([0, 90]), np.array([90, 180]))
        met += bool((keys[0] == keys[1]).any())
    assert met >= 295


def test_similar_pairs_join_chains():
    base = np.arange(100, dtype=np.int64)
    sets = [base, base[5:], np.r_[base[10:], [200, 201]], np.arange(500, 600)]
    edges = substring_dedup.similar_pairs(sets, 0.8)
    assert len(edges) == 2 and {x for e in edges for x in e} == {0, 1, 2}


# Pseudonyms -----------------------------------------------------------------------------------------------------------------


def test_feistel_is_a_permutation():
    for size in (1, 2, 10, 97, 1000):
        assert sorted(pii.permuted(i, size, b"k", "t") for i in range(size)) == list(range(size))
    odd = [pii.permuted(i, 1000, b"k", "t", lambda x: x % 2 == 1) for i in range(1, 1000, 2)]
    assert sorted(odd) == list(range(1, 1000, 2))
    assert [pii.permuted(i, 1000, b"k", "t") for i in range(50)] != [pii.permuted(i, 1000, b"l", "t") for i in range(50)]


FORMS = {
    "4418452524842581": ("card", r"4\d{15}"), "4418 4525 2484 2581": ("card", r"4\d{3}( \d{4}){3}"), "+1 (414) 555-7134": ("phone", r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}"),
    "24.50.146.129": ("ip", r"\d+(\.\d+){3}"), "isprr.51@mail2.example.com": ("email", r"[a-z]{5}\.\d\d@mail2\.example\.com"), "2001-02-28": ("date", r"\d{4}-\d\d-\d\d"),
    "28.02.2001": ("date", r"\d\d\.\d\d\.\d{4}"), "02/28/2001": ("date", r"\d\d/\d\d/\d{4}"), "123-45-6789": ("ssn", r"\d{3}-\d\d-\d{4}"), "DE89 3704 0044 0532 0130 00": ("iban", r"DE\d\d( \d{4}){4} \d\d"),
}


@pytest.mark.parametrize("value", FORMS)
def test_forms(value):
    kind, form = FORMS[value]
    new, kinds = pii.pseudonymized(f"see {value}, ok", b"k")
    got = re.fullmatch(r"see (.*), ok", new)[1]
    assert kinds == [kind] and got != value and re.fullmatch(form, got)
    again, kinds = pii.pseudonymized(f"({got})", b"k")
    assert kinds == [kind]  # the pseudonym is valid itself


@pytest.mark.parametrize("value", ["4418452524842582", "999.50.146.129", "1.2.3.4.5", "2001-02-30", "000-45-6789", "DE88370400440532013000", "12345", "x@y", "v1.2.3", "3.14159"])
def test_invalid_values_stay(value):
    assert pii.pseudonymized(f"see {value} ok", b"k") == (f"see {value} ok", [])


@pytest.mark.parametrize(("kind", "value", "text"), [
    ("card", "4111 1111 1111 1111", "{} 123"), ("card", "4111111111111111", "{} 12/27"), ("card", "4111111111111111", "7 {}"), ("card", "4111-1111-1111-1111", "{}-123"),
    ("card", "4111 1111 1111 1111", "12 34 {} 56 7"), ("card", "378282246310005", "1 {} 1234"), ("card", "3782 822463 10005", "22 {} 333"), ("card", "41111111 11111111", "{} 124"),
    ("iban", "BE68 5390 0754 7034", "{} BIC"), ("iban", "BE68 5390 0754 7034", "{} BANK"), ("iban", "BE68539007547034", "{} A"), ("iban", "DE89 3704 0044 0532 0130 00", "AB12 {} BIC XY"),
])
def test_neighbours_do_not_hide_a_number(kind, value, text):
    alone, _ = pii.pseudonymized(f"see {value}, ok", b"k")
    new, kinds = pii.pseudonymized(f"see {text.format(value)}, ok", b"k")
    assert kinds == [kind] and new == f"see {text.format(alone[4:-4])}, ok" and value not in new


def test_numbers_next_to_each_other():
    for values in (["4111111111111111", "4418452524842581"], ["4111 1111 1111 1111", "4418 4525 2484 2581", "378282246310005"]):
        new, kinds = pii.pseudonymized(" ".join(values), b"k")
        assert kinds == ["card"] * len(values) and new == " ".join(pii.pseudonymized(x, b"k")[0] for x in values)
    assert pii.pseudonymized("123-45-6789 2001-02-28 4111111111111111", b"k")[1] == ["ssn", "date", "card"]
    long = " ".join(str(i) for i in range(20_000))
    assert len(pii.pseudonymized(long, b"k")[0]) == len(long)


@pytest.mark.parametrize("spellings", [
    ["+3531234567", "+353 123 4567", "+353-123-4567", "+353.123.4567", "+353 (0)123 4567"], ["(414) 555-7134", "414-555-7134", "414.555.7134", "+1 414 555 7134", "+14145557134", "+1 (414) 555-7134"],
    ["2001-02-28", "28/02/2001", "28.02.2001", "02/28/2001", "28.2.2001", "2/28/2001"], ["2001-02-01", "01/02/2001", "1/2/2001", "1.2.2001", "01.2.2001"],
    ["4418452524842581", "4418 4525 2484 2581", "4418-4525-2484-2581"], ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00"],
])
def test_one_value_in_all_spellings(spellings):
    new = [re.fullmatch("see (.*) ok", pii.pseudonymized(f"see {x} ok", b"k")[0])[1] for x in spellings]
    for a, b in zip(spellings, new, strict=True):
        assert a != b and re.sub("[0-9]", "9", a) == re.sub("[0-9]", "9", b)  # the form is kept

    def value(x):
        if re.search(r"\d{4}$|^\d{4}-\d\d-", x) and len(x) <= 10 and not x.startswith("+"):
            parts = [int(p) for p in re.split(r"[-/.]", x)]
            year, rest = max(parts), [p for p in parts if p != max(parts)]
            return year, tuple(sorted(rest))
        return re.sub(r"\D", "", x.replace("(0)", "")).removeprefix("1" if len(re.sub(r"\D", "", x)) == 11 else "")

    assert len({value(x) for x in new}) == 1, new


def test_dates_are_permuted_within_their_class():
    days = [f"{y}-{m:02}-{d:02}" for y in (1999, 2024) for m in range(1, 13) for d in range(1, 29)]
    new = [pii.date(x, b"k") for x in days]
    assert len(set(new)) == len(days) and all(pii.date(x, b"k") for x in new)
    assert all((a[8:] > "12") == (b[8:] > "12") and (a[5:7] > "09") == (b[5:7] > "09") for a, b in zip(days, new, strict=True))


def test_equal_values_stay_linked(spark):
    texts = ["4418452524842581 a", "b 4418-4525-2484-2581", "c 4418452524842581 and 10.0.0.1", *ODD]
    got = {x.doc_id: x for x in pii.pseudonymize(docs(spark, texts), b"k").collect()}
    number = lambda i: re.sub(r"\D", "", re.search(r"4[\d-]{15,}", got[i].text)[0])
    assert number(0) == number(1) == number(2) and got[2].kinds == "card,ip" and got[2].n_private == 2
    assert all(got[i].text == t and got[i].n_private == 0 and got[i].kinds == "" for i, t in enumerate(ODD, 3))
    assert pii.pseudonymize(docs(spark, []), b"k").count() == 0
