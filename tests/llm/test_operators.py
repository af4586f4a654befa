"""The corpus operators against brute force, on small tables with nulls, ties, repeats and empty rows."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from rooflight.llm import exact_dedup, language_id, license_scan, lm_scoring, mixing, piece_lattice, quality, simhash, topk_search, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, path string"
LONG = "lorem ipsum " * 3000
TEXTS = [None, "", " ", "Ab c", "a\tbc ab", "ab c", "abc", "abc ", "the cat sat on the mat", "THE cat sat on the mat", "ünï ▁ cöde\n\n  x", LONG, LONG + "x", "y" * 200]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, 0, 7, "p") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[6], (None, "abc", None, None, 0, 7, "p")], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(docs, nothing):
    rows = docs.collect()
    groups: dict = {}
    for r in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text or ""), []).append(r)
    out = exact_dedup.dedup_report(docs).collect()
    assert len(out) == len(rows) and sum(r.kept for r in out) == len(groups)
    sizes, keep = Counter(), {}
    for g in groups.values():
        best = min(g, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
        for r in g:
            sizes[r.doc_id, len(g)] += 1
            keep[r.doc_id] = best.doc_id
    assert Counter((r.doc_id, r.group_size) for r in out) == sizes
    assert all(r.keep_id == keep[r.doc_id] for r in out)
    assert exact_dedup.keep_distinct(docs).count() == len(groups) and exact_dedup.keep_distinct(docs).columns == docs.columns
    assert exact_dedup.dedup_report(nothing).count() == 0


def test_perfect_hash():
    keys = np.random.default_rng(1).integers(0, 256, (5000, 32)).astype(np.uint8)
    h = exact_dedup.PerfectHash(keys)
    assert sorted(h.slot) == list(range(5000)) and (h.find(keys) == h.slot).all()


def test_golay_keys_meet_within_four_bits():
    rng = np.random.default_rng(2)
    a = rng.integers(-(1 << 63), 1 << 63, 3000, dtype=np.int64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, rng.integers(1, 5), replace=False):
            b[i] ^= np.int64(np.uint64(1 << int(bit)).view(np.int64))
    ka, kb = ({} for _ in range(2))
    for x, k in ((a, ka), (b, kb)):
        key, row = simhash.fuzzy_keys(x)
        for v, r in zip(key.tolist(), row.tolist(), strict=True):
            k.setdefault(r, set()).add(v)
    assert all(ka[i] & kb[i] for i in range(len(a)))


def test_simhash_components(spark, docs, nothing):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choice(words, 120)) for _ in range(20)]
    texts = base + [t.replace(" ", "  ", 3) for t in base[:5]] + [t + " tail" for t in base[:10]]
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(more)
    out = simhash.near_duplicates(every).collect()
    prints = {}
    for r in every.collect():
        prints.setdefault(simhash.fingerprint(r.text) & (1 << 64) - 1, set()).add(r.doc_id)
    head = {p: p for p in prints}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for p in prints:
        for q in prints:
            if (p ^ q).bit_count() <= 4:
                head[find(p)] = find(q)
    low: dict = {}
    for p, ids in prints.items():
        low[find(p)] = min([low.get(find(p), 1 << 60), *(i for i in ids if i is not None)])
    assert len(out) == every.count()
    assert all(r.component_id == low[find(int(r.fingerprint, 16))] for r in out)
    assert simhash.near_duplicates(nothing).count() == 0


def test_near_stage_meets_its_similarity(spark, docs, nothing):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(4000)]
    base = [list(rng.choice(words, 200)) for _ in range(30)]
    texts = [" ".join(b) for b in base]
    for n in (1, 2, 3, 4, 5, 6, 8, 12):
        for b in base[: 2 * n]:
            c = list(b)
            for at in rng.choice(200, n, replace=False):
                c[at] = "new" + str(rng.integers(1 << 30))
            texts.append(" ".join(c))

    def grams(t):
        w = t.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    sets = [grams(t) for t in texts]
    head = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = head[i], head[j]
                head = [min(a, b) if h in (a, b) else h for h in head]
    assert 30 < len(set(head)) < len(texts) - 20
    out = simhash.keep_one_each(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(head))
    assert simhash.keep_one_each(docs).columns == docs.columns and simhash.keep_one_each(nothing).count() == 0


def test_near_stage_with_null_and_repeated_ids(spark):
    other = [f"{w} " * 3 + f"quite another text of {w} and its {w}" for w in ("oak", "elm", "ash", "fir")]
    rows = [(None, other[0]), (None, other[1]), (3, other[2]), (3, other[3]), (None, "one two  three"), (7, "one two three"), (8, "a b"), (8, "A b"), (None, "x y"), (None, "x Y")]
    out = simhash.keep_one_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.text.lower()) for r in out} == {*rows[:4], rows[5], rows[6], rows[8]} and len(out) == 7


def test_mixing(docs, nothing):
    size = {"a": 100, "b": 10, None: 1}
    t = mixing.fill_targets(size, mixing.rotating(["a", "b", None]))
    assert t["b"] == 30 and t[None] == 3 and abs(sum(t.values()) - 111) < 1e-9
    # an overlapping pattern is used where its own source is short; repeats only when needed
    got = mixing.route({("a",): 10, ("a", "b"): 10}, {"a": 10, "b": 10})
    assert got == {("a",): 10, ("a", "b"): 10}
    out = mixing.mix_report(docs).collect()
    assert len(out) == docs.count() and all(r.taken <= 3 * r["size"] for r in out)
    by: dict = {}
    for d, r in ((x.target, x) for x in out):
        by[d] = by.get(d, 0) + r.taken
    assert abs(sum(by.values()) - sum(r["size"] for r in out)) <= 4
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix_report(docs).collect()))
    assert mixing.mix_documents(docs).columns == docs.columns and mixing.mix_report(nothing).count() == 0


def test_single_sources_go_through_the_flow(monkeypatch):
    runs, run = [], mixing._Flow.run
    monkeypatch.setattr(mixing._Flow, "run", lambda *a: runs.append(1) or run(*a))
    assert mixing.route({("a",): 10, (None,): 4, ("b",): 0}, {"a": 7, None: 30, "b": 5}) == {("a",): 7, (None,): 12, ("b",): 0}
    assert len(runs) == 3


def test_topk(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6)], 0) for i in range(400)] + [(400, None, 0), (402, [float("nan")] * 6, 0), (50, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (None, [1.0] * 6, 0)]
    v = topk_search.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int"))
    got = {(r.query_id, r.rank): (r.score, r.vec_id) for r in topk_search.search(v, v.where("vec_id % 50 = 0"), 5).collect()}
    m = {i: np.floor(256 * np.array(x)) for i, x, _ in rows[:400]}
    for q in range(0, 400, 50):
        best = sorted((-int(m[q] @ m[c]), c) for c in m if c != q)[:5]
        assert [got[q, k + 1] for k in range(5)] == [(-s, c) for s, c in best]
    none = v.where("false")
    assert topk_search.search(none, none).count() == 0


def test_topk_streams_blocks_past_groups_of_shards(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "SHARD_ROWS", 8)
    monkeypatch.setattr(topk_search, "GROUP_SHARDS", 2)
    rng = np.random.default_rng(9)
    m = rng.integers(-2, 3, (600, 4)) / 2  # many equal scores
    m[0] *= 2.0**40  # sums that only whole numbers beyond a double hold
    v = topk_search.quantised(spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)], "vec_id long, embedding array<double>"))
    out = topk_search.search(v, v.where("vec_id % 50 = 0"), 5)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan  # no tree is repeated for each block, no side goes to the driver
    whole = [[int(x) for x in 256 * r] for r in m]
    want = []
    for q in range(0, 600, 50):
        best = sorted((-sum(a * b for a, b in zip(whole[q], whole[c], strict=True)), c) for c in range(600) if c != q)[:5]
        want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(best)]
    assert sorted(map(tuple, out.collect())) == want


def test_lm(docs, nothing):
    rows = docs.collect()
    low = {r.doc_id: re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").lower()) for r in rows}
    unseen = {i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i in low}
    c = Counter(w for r in rows if not unseen[r.doc_id] for w in [*low[r.doc_id], None])
    n, v = sum(c.values()), len(c)
    for r in lm_scoring.score_documents(docs).collect():
        words = [*low[r.doc_id], None]
        assert r.held_out == unseen[r.doc_id] and r.train_tokens == n and r.n_tokens == len(words) and r.n_known == sum(c[w] > 0 for w in words)
        assert abs(r.base_score - sum(np.log10((c[w] + 1) / (n + v + 1)) for w in words)) < 1e-6 and np.isfinite(r.score)
    assert lm_scoring.score_documents(nothing).count() == 0


def test_pieces(docs, nothing):
    pieces = piece_lattice.Pieces(piece_lattice.default_model())
    table, unit = {t: (i, s) for t, i, s in pieces.rows}, re.compile(pieces.unit)

    def viterbi(u):
        best = [(0.0, -1, -1)]
        for i in range(1, len(u) + 1):
            ways = [(best[a][0] + table[u[a:i]][1], a, table[u[a:i]][0]) for a in range(max(0, i - pieces.longest), i) if u[a:i] in table]
            best.append(max([(best[i - 1][0] + pieces.fallback, i - 1, -1), *ways]))
        out, i = [], len(u)
        while i:
            _, a, k = best[i]
            out[:0] = [k] if k >= 0 else [pieces.byte_ids[b] for b in u[a:i].encode()]
            i = a
        return out

    text = {r.doc_id: r.text or "" for r in docs.collect()}
    encoded = piece_lattice.encode_documents(docs)
    for r in encoded.collect():
        assert r.round_trip and r.ids == [i for u in piece_lattice.units(text[r.doc_id], unit) for i in viterbi(u)]
    assert all(r.text == text[r.doc_id] for r in piece_lattice.decode_documents(encoded).collect())
    assert piece_lattice.encode_documents(nothing).count() == 0


def test_cells_lose_no_piece():
    pieces = piece_lattice.Pieces(piece_lattice.default_model())
    known, unit = {t for t, _, _ in pieces.rows}, re.compile(pieces.unit)
    texts = [*TEXTS, "\x00a b\x00", "é" * 300, "a\n\nb  c " + "x" * 97 + " " + "日本" * 120, "https://ab.example.com/" + "q1-" * 40, "x,y;  (3.14)*** \r\n"]
    words, lengths, checks = piece_lattice.cut_texts(pa.array(texts), unit)
    plain = [piece_lattice.units(t, unit) for t in texts]
    assert words.to_pylist() == [u for t in plain for u in t] and lengths.tolist() == [len(t) for t in plain]
    assert checks == [xxhash.xxh64_intdigest((t or "").encode()) for t in texts]
    distinct = words.dictionary_encode().dictionary
    cells, counts = piece_lattice.cells(distinct, pieces.pairs, pieces.triples)
    cells, i = cells.to_pylist(), 0
    for u, n in zip(distinct.to_pylist(), counts.tolist(), strict=True):
        assert "".join(cells[i : i + n]) == u
        ends = set(np.cumsum([len(c) for c in cells[i : i + n]]).tolist())
        for a in range(len(u)):
            for b in range(a + 2, min(len(u), a + pieces.longest) + 1):
                assert u[a:b] not in known or not any(a < e < b for e in ends)
        i += n
    assert i == len(cells)
    nothing = piece_lattice.cut_texts(pa.array([None, ""], pa.string()), unit)
    assert len(nothing[0]) == 0 and nothing[1].tolist() == [0, 0]


def test_pieces_of_whole_texts(spark):
    pieces = piece_lattice.Pieces(piece_lattice.default_model())
    import sentencepiece

    model, table = sentencepiece.SentencePieceProcessor(model_file=piece_lattice.default_model()), {}
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            table[model.id_to_piece(i).replace("▁", " ")] = (model.get_score(i), i)
    longest = max(map(len, table))

    def best(t):
        score, back = [0.0], [None]
        for i in range(1, len(t) + 1):
            ways = [(score[a] + table[t[a:i]][0], a, table[t[a:i]][1]) for a in range(max(0, i - longest), i) if t[a:i] in table]
            top = max([(score[i - 1] + pieces.fallback, i - 1, -1), *ways])
            score.append(top[0])
            back.append(top[1:])
        out, i = [], len(t)
        while i:
            a, k = back[i]
            out[:0] = [k] if k >= 0 else [pieces.byte_ids[b] for b in t[a:i].encode()]
            i = a
        return out

    texts = ["internationalization" * 8, "https://example.com/" + "path-to/some_page?id=12&x=" * 12, "return x;\r\n}\r\n", "日本語の文章です" * 40, "a  b\t\r\r\n é\r\né;\r", "QUJDREVGR0hJ" * 200, "if (x) {\r\n    y();\r\n    });\r\n"]
    out = piece_lattice.encode_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(out) == len(texts)
    for r in out:
        assert r.round_trip and r.ids == best(" " + texts[r.doc_id])


def test_urls(spark):
    link = '<link rel="canonical" href="{}">'
    rows = [(1, "http://www.example.com/en/1", None), (2, "https://A.Example.com/en/2", ""), (3, "http://x.net/es/", link.format("http://alias.org/a")), (4, "https://alias.org/a?x", None), (5, None, None), (6, "no scheme", "x"), (7, "http://q.org/b", '<meta http-equiv="refresh" content="0; url=/c">'), (8, "http://q.org/c", link.format("http://y.net/fr/1")), (9, "http://y.net/fr/1", link.format("http://ok.com/"))]
    out = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == {1: ("www.example.com/en/", "allow"), 2: ("example.com/en/", "block"), 3: ("net/es/", "block"), 4: (None, "block"), 5: (None, "allow"), 6: (None, "allow"), 7: (None, "allow"), 8: (None, "allow"), 9: ("net/fr/", "block")}


def test_relative_and_further_links(spark):
    rows = [(1, "http://y.net/fr/x", None), (2, "http://y.net/a/b/p", '<link rel="canonical" href="../../fr/y">'), (3, "http://ok.org/a/c", '<link rel="alternate canonical" href="http://y.net/fr/x">')]
    rows += [(4, "http://q.org/d/1", "<link rel=canonical href=http://q.org/d/1><link rel='canonical' href='//y.net/fr/x'>"), (5, "http://q.org/e/1", '<meta http-equiv="refresh" content="0; url=2.html">'), (6, "http://q.org/e/2.html", '<link rel="canonical" href="http://y.net/fr/x">'), (7, "http://q.org/f", '<link rel="canonical-x" href="http://y.net/fr/x">')]
    out = {r.page_id: r.verdict for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "block", 7: "allow"}


def test_language_and_quality(spark, docs, nothing):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    both = language_id.identify(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in both) > 0.97 * len(both)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rated = quality.rate(d, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rated) > 0.93 * len(rated)
    assert all(r.lang_pred == "und" and r.score == 0 for r in language_id.identify(docs).where("doc_id < 3").collect())
    assert quality.rate(docs, labels.where("false")).count() == docs.count() and quality.rate(nothing, labels).count() == 0
    assert language_id.identify(nothing).count() == 0


def test_licences(spark, nothing):
    rows = [(0, "Released under the MIT License.", "s"), (1, "text\nLicensed under CC BY-NC 4.0.\nmore", "s"), (2, None, "s"), (3, "nothing", None), (3, "nothing", None)]
    out = license_scan.scan_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted((r.doc_id, r.licence) for r in out if r.licence) == [(0, "MIT"), (1, "CC-BY-NC-4.0"), (2, "MIT")] and len(out) == 5
    assert license_scan.scan_documents(nothing).count() == 0


def test_wrapped_licences(spark):
    gpl = ["This program is free software: you can redistribute it and/or modify", "it under the terms of the GNU General Public License as published by", "the Free Software Foundation, either version 3 of the License, or", "(at your option) any later version."]
    apache = "\n" + " " * 33 + "Apache License\n" + " " * 27 + "Version 2.0, January 2004\n" + " " * 24 + "http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n"
    lesser = "                   GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007\n"
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:\n"
    early = "\n".join(["# ab"] * 62 + ["# " + x for x in gpl])  # over the border of two blocks
    texts = ["\n".join("# " + x for x in gpl), apache, lesser, "Copyright (c) 2020 A. Person\n" + bsd, early, "free software\nand a licence of another kind\nin any version", gpl[0] + "x " * 600 + gpl[1]]
    rows = [(100 * i + 1, t, "s") for i, t in enumerate(texts)]
    out = {r.doc_id // 100: r.licence for r in license_scan.scan_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert [out[i] for i in range(len(texts))] == ["GPL-3.0", "Apache-2.0", "LGPL-3.0", "BSD-3-Clause", "GPL-3.0", None, None]
