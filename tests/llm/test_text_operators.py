"""Piece coding, HTML, licenses and quality against brute force, round trips and held-out accuracy."""

from __future__ import annotations

import os
import random
import re
import zlib

import numpy as np
import pytest

from tidewatch.llm import html_field, license_scan, pieces, quality_crf

need_model = pytest.mark.skipif(not os.path.exists(pieces.MODEL_PATH), reason="no model file")
TEXTS = ["", None, "the", "Hello  world", " lead and trail ", "\n\n tabs\t", "日本語 😀 é", "x" * 5000, "a▁b", "under, the; bridge!", "naïve café — résumé"]


@pytest.fixture(scope="module")
def coder():
    return pieces.Automaton(pieces.Model.parse(pieces.read_model()))


def brute_score(model, coder, text):
    """The best score of any segmentation, trying every piece at every place."""
    of = {p: s for p, s, k in zip(model.pieces, model.scores, model.kinds, strict=True) if k == pieces.NORMAL}
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 24), end):
            part = text[start:end]
            score = of.get(part, coder.unknown_score if len(part) == 1 else None)
            if score is not None:
                best[end] = max(best[end], best[start] + score)
    return best[-1]


@need_model
def test_viterbi_is_optimal_and_decodes(coder):
    table = coder.decode_table()
    model = coder.model
    rng = random.Random(1)
    for text in [t or "" for t in TEXTS if len(t or "") < 100] + ["".join(rng.choice("abet hn.\n") for _ in range(40)) for _ in range(40)]:
        ids = coder.encode(text).tolist()
        assert coder.decode(ids, table) == text.replace("▁", " ")
        marked = coder.normalise(text)
        own = coder.viterbi(marked) if marked else []
        assert own == ids
        score = 0.0
        for i in ids:
            score += model.scores[i] if model.kinds[i] == pieces.NORMAL else 0.0
        loose = [c for c in marked if c not in {p for p, k in zip(model.pieces, model.kinds, strict=True) if k == pieces.NORMAL and len(p) == 1}]
        assert score + coder.unknown_score * len(loose) == pytest.approx(brute_score(model, coder, marked))


@need_model
def test_equals_the_library_read_as_unigram(coder):
    sentencepiece = pytest.importorskip("sentencepiece")

    def varint(n):
        out = b""
        while n > 127:
            out += bytes([n & 127 | 128])
            n >>= 7
        return out + bytes([n])

    flipped = b""
    for number, value in pieces._fields(pieces.read_model()):
        value += varint(3 << 3) + varint(1) if number == 2 else b""
        flipped += varint(number << 3 | 2) + varint(len(value)) + value
    library = sentencepiece.SentencePieceProcessor()
    library.LoadFromSerializedProto(flipped)
    for word in ["the", "he", "bridge", "thereof", "encoding", "naive", "the,"]:
        best = library.NBestEncodeAsIds(word, 5)[0]
        own = coder.encode(word).tolist()
        score = lambda ids: sum(coder.model.scores[i] for i in ids)
        assert score(own) == pytest.approx(score(best))


@need_model
def test_encode_and_decode_documents(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)] + [(None, "the", 1)], "doc_id long, text string, ids int")
    data = pieces.read_model()
    encoded = pieces.encode_documents(df, data)
    rows = encoded.collect()
    assert len(rows) == len(TEXTS) + 1 and all(r.round_trip for r in rows)
    assert {r.doc_id: r.n_tokens for r in rows}[0] == 0
    back = {r.doc_id: r.text for r in pieces.decode_documents(encoded, data).collect()}
    assert back[3] == "Hello  world" and back[1] == ""
    assert pieces.encode_documents(df.limit(0), data).collect() == []


def test_html_on_fresh_pages():
    rng = random.Random(77)
    field = html_field.trained()
    good = 0
    for _ in range(150):
        source = html_field.labelled_page(rng)
        page, kept = html_field.labels_of(source)
        good += field.extract([source])[0] == page.main_text(kept)
    assert good >= 145


def test_html_rules(spark):
    article = "<article><h1>T &amp; U</h1><p>One\n <b>two<br>three<p>Four&nbsp;five <a href=x>six</a>.</article>"
    page = f"<html><head><title>no</title><style>p{{}}</style></head><body><nav><ul><li><a href=/>Menu</a></ul></nav><!-- x --><div class=ad>Buy</div>{article}<footer>&copy; foot</footer><script>var a='<p>no</p>'</script>"
    rows = [(1, "u", page), (2, "u", None), (3, "u", ""), (None, None, page), (1, "u", page + "<p cla"), (4, "u", "<" * 3000 + "<a b='")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = html_field.extract_pages(df).collect()
    want = "T & U\nOne two three\nFour five six."
    assert [r.text for r in got if r.page_id in (1, None)] == [want] * 3
    assert all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id in (2, 3)] == ["", ""]
    assert html_field.extract_pages(df.limit(0)).collect() == []


def test_sum_product_against_enumeration():
    rng = np.random.default_rng(5)
    parent = np.array([-1, 0, 0, 1, 1, 2])
    x = {"parent": parent, "kind": np.array([0, 1, 0, 1, 0, 1]), "depth": np.array([0, 1, 1, 2, 2, 2])}
    unary, tie = rng.normal(size=6), rng.normal(size=(2, 2, 2))
    content, pairs = html_field.sum_product(unary, tie, x)
    weight, total, joint = np.zeros(6), 0.0, np.zeros((6, 2, 2))
    for code in range(64):
        y = [(code >> i) & 1 for i in range(6)]
        w = np.exp(sum(unary[i] * y[i] for i in range(6)) + sum(tie[x["kind"][i], y[parent[i]], y[i]] for i in range(1, 6)))
        total += w
        weight += w * np.array(y)
        for i in range(1, 6):
            joint[i, y[parent[i]], y[i]] += w
    assert np.allclose(content, weight / total)
    assert np.allclose(pairs, joint / total)


def brute_license(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts, labels = [], set()
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_licenses(spark):
    notice = next(n for n, label in license_scan.NOTICES.items() if label == "gpl")
    texts = [
        None, "", "Under the MIT License", "under-the (MIT)\nlicense; Apache License, Version 2.0 under the mit license", "CC-BY-NC cc by nc", "cc by", "é under the mit licenses",
        "under the mit " * 500 + "license", "x " * 3000 + "Apache license version 2", notice.upper() + " or later", notice.replace("software", "thing"), "under the under the mit license",
    ]
    rows = list(enumerate(texts)) + [(None, "cc by nc"), (3, texts[3])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, gram string")
    got = license_scan.scan_licenses(df).collect()
    assert len(got) == len(rows)
    for r in got:
        text = "cc by nc" if r.doc_id is None else texts[r.doc_id]
        assert tuple(r)[1:6] == brute_license(text), text
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    assert [r.labels for r in got if r.doc_id in (9, 10)] == ["gpl", "gpl"]
    assert license_scan.scan_licenses(df.limit(0)).collect() == []


def test_license_lines_of_documents(spark):
    lines = {
        "This work is licensed under the GNU General Public License, version 3.": ("", "gpl", 1.0),
        "All rights reserved.": ("", "all-rights-reserved", 1.0),
        "Licensed under the Apache License, Version 2.0.": ("apache-2", "apache-2", 1.0),
        "Released under the MIT License.": ("mit", "mit", 1.0),
        "Licensed under CC BY-NC 4.0.": ("cc-by-nc", "cc-by-nc", 1.0),
        "Creative Commons Attribution 4.0 International": ("", "cc-by", 1.0),
        "Creative Commons Attribution-NonCommercial 4.0 International": ("", "cc-by-nc", 1.0),
        "BSD 3-Clause License": ("", "bsd", 1.0),
        "under the Mozilla Public License, v. 2.0": ("", "mpl-2", 1.0),
        "the GNU Lesser General Public License": ("", "", 0.0),
        "all rights were reserved; a general public license": ("", "", 0.0),
        "Creative Commons Attribution-ShareAlike 4.0": ("", "", 0.0),
    }
    for place in ("{}", "some words before\n{}\nand more after"):
        df = spark.createDataFrame([(i, place.format(t)) for i, t in enumerate(lines)], "doc_id long, text string")
        got = {r.doc_id: r for r in license_scan.scan_licenses(df).collect()}
        for i, (line, want) in enumerate(lines.items()):
            r = got[i]
            assert (r.base_labels, r.labels, r.score) == want, line
            assert tuple(r)[1:6] == brute_license(place.format(line))


def test_further_licenses(spark):
    lines = {
        "Released under the ISC License": "isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.": "isc",
        "This is free and unencumbered software released into the public domain.": "unlicense", "CC0 1.0 Universal": "cc0", "Eclipse Public License - v 2.0": "epl",
        "Distributed under the Boost Software License, Version 1.0.": "boost", "free software in the public domain": "", "permission to use this software is granted": "",
    }
    df = spark.createDataFrame([(i, f"some words\n{t}\nmore") for i, t in enumerate(lines)], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in license_scan.scan_licenses(df).collect()}
    assert got == dict(enumerate(lines.values()))


def test_license_lines_in_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = {r.doc_id: r.labels.split(",") for r in license_scan.scan_licenses(docs).collect()}
    for line, label, least in (("GNU General Public License, version 3.", "gpl", 9), ("All rights reserved.", "all-rights-reserved", 7)):
        ids = [r.doc_id for r in docs.collect() if line in (r.text or "")]
        assert len(ids) >= least and all(label in labels[i] for i in ids)


def test_quality(spark):
    data = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    model = quality_crf.train(docs, labels)
    scored = quality_crf.score_documents(docs, model).join(labels, "doc_id").where("held_out").collect()
    right = [r.predicted == r.quality for r in scored]
    assert len(right) > 80 and np.mean(right) >= 0.95
    odd = spark.createDataFrame([(1, None, "s"), (1, "", "s"), (None, "\n" * 20_000, "s"), (2, "word " * 50_000, "s")], "doc_id long, text string, score string")
    got = quality_crf.score_documents(odd, model).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert got[0].score == got[1].score
    assert quality_crf.score_documents(odd.limit(0), model).collect() == []
    untrained = quality_crf.train(docs, labels.limit(0))
    assert {r.score for r in quality_crf.score_documents(odd, untrained).collect()} == {0.5}


def test_quality_sample_is_bounded(spark, monkeypatch):
    rows = [(i, "good words of a text.\nand more of them." if i % 2 else "|||\n!!! | 1") for i in range(60)]
    rows += [(1, None), (2, rows[2][1]), (4, "\n" * 5000), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 0), (None, 1), (3, None)], "doc_id long, quality int")
    seen = []
    fit = quality_crf.fit
    monkeypatch.setattr(quality_crf, "fit", lambda f, c, y: seen.append((len(f), len(c), len(y))) or fit(f, c, y))
    quality_crf.train(docs, labels)
    quality_crf.train(docs, labels, sample_lines=31)
    quality_crf.train(docs, labels, sample_docs=10)
    free = sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(60))
    assert seen[0][1:] == (free, free)
    assert seen[1][0] in (30, 31) and seen[1][1] in (15, 16)
    assert seen[2][1:] == (10, 10)


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(2)
    counts = np.array([1, 4, 2])
    unary, tie = rng.normal(size=7), rng.normal(size=(2, 2))
    good, pairs = quality_crf.forward_backward(unary, tie, counts)
    want, joint, at = [], np.zeros((2, 2)), 0
    for n in counts:
        weight, total, own = np.zeros(n), 0.0, np.zeros((2, 2))
        for code in range(2**n):
            y = [(code >> i) & 1 for i in range(n)]
            w = np.exp(sum(unary[at + i] * y[i] for i in range(n)) + sum(tie[y[i], y[i + 1]] for i in range(n - 1)))
            total += w
            weight += w * np.array(y)
            for i in range(n - 1):
                own[y[i], y[i + 1]] += w
        want += (weight / total).tolist()
        joint += own / total
        at += n
    assert np.allclose(good, want) and np.allclose(pairs, joint)


def test_character_map_equals_the_library():
    """Every rule that the library carries, on texts of mapped, joined and plain characters."""
    spm = pytest.importorskip("sentencepiece")
    text = "ＡＢＣ　ｱｲｳ ﬁne été  ½ ① 한글 한 a­b \t tab​ Å x"
    for rule in ("nfkc", "nmt_nfkc", "nfkc_cf", "nmt_nfkc_cf"):
        made = spm.SentencePieceNormalizer(rule_name=rule)
        model = pieces.Model.parse(made.serialized_model_proto())
        assert model.char_map
        own = pieces.Automaton(model)
        for t in (text, "", " ", "plain", *text.split(" ")):
            assert own.normalise(t) == made.normalize(t), (rule, t)


def test_character_map_keeps_pieces_that_the_user_defined():
    spm = pytest.importorskip("sentencepiece")
    made = spm.SentencePieceNormalizer(rule_name="nfkc")
    data = pieces.Model.parse(made.serialized_model_proto()).char_map
    assert pieces.CharMap(data, ["ＡＢ"]).apply("ＡＢＣ") == "ＡＢC"


@need_model
def test_one_endless_word(coder):
    text = "abcdefghij" * 20_000
    assert coder.decode(coder.encode(text).tolist(), coder.decode_table()) == text
