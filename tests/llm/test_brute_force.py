"""Operators without SQL against plain re-implementations that share no code with them."""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from rooflight.llm import language_id, lm_scoring, mixing, packing, piece_lattice, quality, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def remainder(doc_id, m):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % m


# --- mixing -------------------------------------------------------------------------------------


def cheapest(capacity, quota, epochs=3):
    """The largest amount that can be taken and the least cost of taking it, by trying everything."""
    patterns = list(capacity)
    best = (0, 0)
    splits = [[x for x in itertools.product(range(epochs * capacity[p] + 1), repeat=len(p)) if sum(x) <= epochs * capacity[p]] for p in patterns]
    for choice in itertools.product(*splits):
        used = Counter()
        for p, x in zip(patterns, choice, strict=True):
            for s, n in zip(p, x, strict=True):
                used[s] += n
        if any(used[s] > quota[s] for s in used):
            continue
        cost = 0
        for p, x in zip(patterns, choice, strict=True):
            n = sum(x)
            for k in range(1, epochs + 1):
                now = min(n, capacity[p])
                cost, n = cost + k * k * now, n - now
        best = max(best, (sum(map(sum, choice)), -cost))
    return best


def cost_of(taken, capacity, epochs=3):
    out = 0
    for p, n in taken.items():
        for k in range(1, epochs + 1):
            now = min(n, capacity[p])
            out, n = out + k * k * now, n - now
        assert n == 0
    return out


def test_flow_is_cheapest():
    rng = np.random.default_rng(11)
    shapes = [("a",), ("b",), ("a", "b"), ("b", "c")]
    for _ in range(12):
        chosen = [shapes[i] for i in sorted(rng.choice(4, rng.integers(1, 4), replace=False))]
        capacity = {p: int(rng.integers(0, 3)) for p in chosen}
        quota = {s: int(rng.integers(0, 6)) for s in "abc"}
        taken = mixing.route(capacity, quota)
        assert (sum(taken.values()), -cost_of(taken, capacity)) == cheapest(capacity, quota)


def test_every_source_comes_near_its_target_and_the_seeded_order_decides(spark):
    rng = np.random.default_rng(12)
    rows = [(i, "w " * int(rng.integers(1, 60)), "abc"[min(2, int(rng.integers(0, 6)))]) for i in range(400)]
    rows += [(400, None, "a"), (401, "x y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r for r in mixing.mix_report(docs).collect()}
    size, source = {i: len(words(t)) for i, t, _ in rows}, {i: s for i, _, s in rows}
    total, by = Counter(), Counter()
    for i in size:
        total[source[i]] += size[i]
        by[source[i]] += out[i].taken
    targets, left, todo = {}, float(sum(total.values())), sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(todo)}
    while todo:
        share = left / sum(weight[s] for s in todo)
        over = [s for s in todo if share * weight[s] > 3 * total[s]]
        for s in over or todo:
            targets[s] = 3.0 * total[s] if over else share * weight[s]
        left -= sum(targets[s] for s in over)
        todo = [s for s in todo if s not in targets]
    for s in total:
        assert abs(by[s] - targets[s]) <= 1
        mine = [i for i in size if source[i] == s and size[i]]
        assert all(abs(out[i].target - targets[s]) < 1e-6 and out[i].source_size == total[s] for i in mine)
        # whole times for all, once more for those that come first in the order, part of one at the cut
        times = by[s] // total[s] if total[s] else 0
        extra = {i: out[i].taken - times * size[i] for i in mine}
        assert sum(0 < extra[i] < size[i] for i in mine) <= 1 and all(0 <= e <= size[i] for i, e in extra.items())
        order = sorted(mine, key=lambda i: spark_hash(spark, i))
        flags = [extra[i] > 0 for i in order]
        assert flags == sorted(flags, reverse=True)
    again = mixing.mix_documents(docs).groupBy("doc_id").count().collect()
    for r in again:
        assert abs(r["count"] * size[r.doc_id] - out[r.doc_id].taken) <= size[r.doc_id] / 2 + 1


def spark_hash(spark, i, known={}):  # noqa: B006
    if not known:
        known.update((r.id, r.h) for r in spark.sql(f"SELECT id, xxhash64({mixing.SEED}, id) AS h FROM range(500)").collect())
    return known[i]


def test_overlapping_patterns(spark):
    """A document in two sources fills the source that is short; whole tables of overlapping patterns."""
    rows = [(i, "w " * 10, ["a"]) for i in range(50)] + [(100 + i, "w " * 10, ["a", "b"]) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    from pyspark.sql import functions as F

    mixed = mixing.mix_documents(docs, F.col("sources"), {"a": 1, "b": 1}).groupBy("doc_id").count().collect()
    got = {r.doc_id: r["count"] for r in mixed}
    # sizes 1000 and 500, 1500 words in all, targets 750 and 750: 1000 words once, 500 a second time
    assert sum(got.values()) == 150 and max(got.values()) <= 2 and len(got) == 100
    assert mixed and set(got) == {r[0] for r in rows}


# --- language identification ----------------------------------------------------------------------


def plain_vector(text, dim):
    letters = [c.lower() if len(c.lower()) == 1 else c for c in text] if text else []
    line = [0]
    for c in letters:
        x = ord(c) if c.isalpha() else 0
        if x or line[-1]:
            line.append(x)
    if line[-1]:
        line.append(0)
    known = {}

    def vector(c):
        if c not in known:
            known[c] = np.random.Generator(np.random.PCG64([language_id.SEED, c])).integers(0, 2, dim, np.int8).astype(float) * 2 - 1
        return known[c]

    out = np.zeros(dim)
    for a, b, c in zip(line, line[1:], line[2:], strict=False):
        out += np.roll(vector(a), 2) * np.roll(vector(b), 1) * vector(c)
    return out


def test_language_profiles(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "the dog sat on the mat", "en"), (3, "der hund und die katze", "de"), (4, "die katze auf der matte", "de"), (5, "le chat et le chien", "fr"), (6, "straße über ÄÖ", None), (7, "the", None), (8, None, "en"), (9, "12 34", "de"), (10, "", None), (11, "the " * 80_000, None), (12, "日本語" * 3000 + "".join(map(chr, range(0x4E00, 0x9000))), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    sums, dim = {}, language_id.DIMENSIONS
    for i, t, lang in rows:
        if lang and t and remainder(i, 5):
            line = Counter(zip(*[plain_line(t)[k:] for k in range(3)], strict=False))
            if line:
                sums[lang] = sums.get(lang, 0) + plain_vector(t, dim) / math.sqrt(sum(n * n for n in line.values()))
    names = sorted(sums)
    unit = np.stack([sums[n] / np.linalg.norm(sums[n]) for n in names])
    common = unit.mean(axis=0) / np.linalg.norm(unit.mean(axis=0))
    rest = unit - np.outer(unit @ common, common)
    rest /= np.linalg.norm(rest, axis=1, keepdims=True)
    for i, t, _ in rows:
        if not any(c.isalpha() for c in t or ""):
            assert got[i].lang_pred == "und" and got[i].score == 0
            continue
        x = plain_vector(t, dim)
        x -= (x @ common) * common
        cos = rest @ x / np.linalg.norm(x)
        assert got[i].lang_pred == names[int(cos.argmax())] and abs(got[i].score - max(0.0, cos.max())) < 1e-3
        assert got[i].held_out == (remainder(i, 5) == 0)


def plain_line(text):
    line = [0]
    for c in text:
        x = ord(c.lower()) if c.isalpha() else 0
        if x or line[-1]:
            line.append(x)
    return line + [0] if line[-1] else line


# --- quality --------------------------------------------------------------------------------------


def test_features_of_long_texts_do_not_depend_on_pieces(monkeypatch):
    rng = np.random.default_rng(13)
    text = "".join(rng.choice(list("ab Z9.,\né"), 5000)) + "-" * 700 + "x1 x1 x1"
    whole = quality.features(text)
    for piece in (1, 2, 3, 7, 64, 1000):
        monkeypatch.setattr(quality, "_PIECE", piece)
        assert quality.features(text).tolist() == whole.tolist()


def test_ratios_and_the_hinge_optimum():
    """The log-count ratios by hand; the dual solution meets the primal one's value."""
    rng = np.random.default_rng(14)
    rows = [np.sort(rng.choice(40, rng.integers(3, 12), replace=False)).astype(np.int32) for _ in range(60)]
    y = np.array([int(r[0] < 4) ^ int(rng.random() < 0.1) for r in rows])
    ratio = quality._log_count_ratio(rows, y)
    count = {c: Counter(i for r, k in zip(rows, y, strict=True) if k == c for i in r.tolist()) for c in (0, 1)}
    total = {c: sum(count[c].values()) + quality.BUCKETS for c in (0, 1)}
    for i in range(45):
        assert abs(ratio[i] - (math.log((count[1][i] + 1) / total[1]) - math.log((count[0][i] + 1) / total[0]))) < 1e-9
    values = [ratio[r] / np.linalg.norm(ratio[r]) for r in rows]
    weight, bias = quality._descend(rows, values, y)
    cost = np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == 0).sum()))
    sign = 2 * y - 1

    def value(w, b):
        slack = [max(0.0, 1 - s * (v @ w[r] + b)) for r, v, s in zip(rows, values, sign, strict=True)]
        return 0.5 * (w @ w + b * b) + float(cost @ np.array(slack))

    # plain subgradient steps end no lower than the dual solution
    w, b, low = np.zeros(quality.BUCKETS), 0.0, math.inf
    for t in range(1, 4000):
        gw, gb = w.copy(), b
        for r, v, s, c in zip(rows, values, sign, cost, strict=True):
            if s * (v @ w[r] + b) < 1:
                gw[r] -= c * s * v
                gb -= c * s
        w, b = w - gw / t, b - gb / t
        low = min(low, value(w, b))
    assert value(weight, bias) <= low * 1.01


# --- language model -------------------------------------------------------------------------------


def plain_model(texts, kinds):
    """score of every text: exact ratios, exact expectation-maximisation, dictionaries only."""
    end = None

    def grams(w):
        out = []
        for i, x in enumerate(w):
            h = w[i - 1] if i else end
            g = (w[i - 2] if i > 1 else end) if i else "two ends"
            out.append((x, (h, x), (g, h, x)))
        return out

    def count(which):
        c = [Counter(), Counter(), Counter(), Counter(), Counter()]
        for w, k in zip(texts, kinds, strict=True):
            if k in which:
                for one, two, three in grams(w):
                    c[0][one] += 1
                    c[1][two] += 1
                    c[2][three] += 1
                    c[3][two[0]] += 1
                    c[4][three[:2]] += 1
        return c

    core, every = count({0}), count({0, 1})
    n, v = sum(core[0].values()), len(every[0])
    tables = []

    def p(c, total, gram, orders):
        x = 1 / (v + 1)
        for o in range(orders):
            context = [total, c[3][gram[1][0]], c[4][gram[2][:2]]][o]
            b = int(math.log2(context)) + 1 if context else 0
            w = tables[o].get(b, 0.0) if context else 0.0
            x = w * (c[o][gram[o]] / context if context else 0) + (1 - w) * x
        return x

    for order in range(3):
        by: dict = {}
        for w, k in zip(texts, kinds, strict=True):
            if k == 1:
                for g in grams(w):
                    context = [n, core[3][g[1][0]], core[4][g[2][:2]]][order]
                    if context:
                        by.setdefault(int(math.log2(context)) + 1, []).append((core[order][g[order]] / context, p(core, n, g, order)))
        learned = {}
        for b, rows in by.items():
            x = 0.5
            for _ in range(3000):
                x = (sum(x * hi / (x * hi + (1 - x) * lo) for hi, lo in rows) + 0.5) / (len(rows) + 1)
            learned[b] = x
        table, last = {}, 0.5
        for b in range(1, 65):
            table[b] = last = learned.get(b, last)
        tables.append(table)
    total = sum(every[0].values())
    return [sum(math.log10(p(every, total, g, 3)) for g in grams(w)) for w in texts], every, total, v, lambda g: p(every, total, g, 3)


@pytest.mark.parametrize("small", [False, True])
def test_scores(spark, monkeypatch, small):
    if small:  # many chunks and ranges
        monkeypatch.setattr(lm_scoring, "RANGE_TOKENS", 50)
    rng = np.random.default_rng(15)
    vocabulary = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 25), p=np.arange(30, 0, -1) / 465)), 0) for i in range(300)]
    rows += [(300, None, 0), (301, "", 0), (302, "never Seen words", 0), (None, "w1 w2", 0), (5, rows[5][1], 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")
    aside = {r.doc_id for r in docs.where("pmod(xxhash64(3, doc_id), 10) = 0").collect()}
    kinds = [2 if remainder(i, 7) == 2 else 1 if i in aside else 0 for i, _, _ in rows]
    texts = [[*words(t), None] for _, t, _ in rows]
    scores, every, total, v, p = plain_model(texts, kinds)
    want = sorted((str(i), len(w), round(s, 2)) for (i, _, _), w, s in zip(rows, texts, scores, strict=True))
    got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in lm_scoring.score_documents(docs).collect())
    assert len(got) == len(want)
    for (i, n, s), (j, m, t) in zip(got, want, strict=True):
        assert (i, n) == (j, m) and abs(s - t) < 0.006 + 2e-3 * abs(t)
    # the probabilities of all known tokens and one unknown sum to 1 after any context
    for h, g in [(None, "two ends"), ("w1", None), ("w2", "w1"), ("unseen", "w1")]:
        assert abs(sum(p((x, (h, x), (g, h, x))) for x in [*every[0], "unknown"]) - 1) < 1e-9


# --- SimHash and pieces -----------------------------------------------------------------------------


def test_fingerprints(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60).collect()
    texts = [r.text for r in docs] + [None, "", "a b", "A  B", "x " * 70_000]
    for t in texts:
        w = words(t)
        grams = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        bits = [0] * 64
        for g in grams:
            h = xxhash.xxh64_intdigest(g.encode(), 42)
            for k in range(64):
                bits[k] += h >> k & 1
        want = sum(1 << k for k in range(64) if 2 * bits[k] > len(grams))
        assert simhash.fingerprint(t) & (1 << 64) - 1 == want


def test_near_copies_in_large_families(spark):
    """Families above FEW rows a key, with outsiders within the bits: no component is lost."""
    rng = np.random.default_rng(16)
    words_ = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(3):
        base = list(rng.choice(words_, 150))
        for n in (0, 0, 0, 1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 5, 5, 6, 6, 8, 8):
            c = list(base)
            for at in rng.choice(150, n, replace=False):
                c[at] = rng.choice(words_)
            texts.append(" ".join(c))
        texts.append(" ".join(sorted(base)))  # the same words, no shingle in common
    sets = [{tuple(t.split()[i : i + 5]) for i in range(146)} for t in texts]
    head = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = head[i], head[j]
                head = [min(a, b) if h in (a, b) else h for h in head]
    out = simhash.keep_one_each(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(head))


def test_near_copies_among_many_texts_of_the_same_words(spark):
    """Two hundred orders of the same words share all keys; only each one's own near copy is alike, whatever a tree or a first row meets."""
    rng = np.random.default_rng(17)
    words_ = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(100):
        order = list(rng.permutation(words_))
        texts += [" ".join(order), " ".join([*order[:-2], order[-1], order[-2]])]
    out = simhash.keep_one_each(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(r.doc_id for r in out.collect()) == list(range(0, 200, 2))


def test_alike_sets_meet_by_their_prefixes():
    """All pairs of alike sets are found, whatever the order of shingles, over few labels in one key too."""
    rng = np.random.default_rng(18)
    base = [rng.integers(1 << 62, size=n).astype(np.uint64) for n in (1, 2, 5, 9, 40, 200)]
    sets = [np.unique(np.where(rng.random(len(b)) < share, rng.integers(1 << 62, size=len(b)).astype(np.uint64), b)) for b in base for share in (0, 0.02, 0.05, 0.08, 0.11, 0.2) for _ in range(12)]
    want = {(i, j) for j in range(len(sets)) for i in range(j) if simhash.alike(sets[i], sets[j]) and i % 3 != j % 3}
    for counts in (np.zeros(simhash._SLOTS), rng.random(simhash._SLOTS)):
        rows = [(int(t), i % 3, i, len(s), k) for i, s in enumerate(sets) for k, t in enumerate(simhash._prefix(s, counts))]
        src, dst, least, n = simhash._meeting(*np.array(sorted(rows)).T, False).T
        assert want <= set(zip(src[n >= least].tolist(), dst[n >= least].tolist(), strict=True))
        assert len(want) > 500


@pytest.mark.parametrize("block", (256, 32))
def test_rows_do_not_grow_with_the_square_of_a_family(spark, monkeypatch, block):
    """Mutated copies around the least similarity: the components of all pairs, while no table has many rows a text."""
    rng = np.random.default_rng(19)
    base, texts = [f"w{i}" for i in range(150)], []
    for _ in range(400):
        c = list(base)
        for at in rng.choice(150, rng.integers(2, 4), replace=False):
            c[at] = f"new{rng.integers(1 << 30)}"
        texts.append(" ".join(c))
    grams = [set(simhash.shingles(t).tolist()) for t in texts]
    head = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if head[i] != head[j] and 9 * len(grams[i] & grams[j]) >= 4 * (len(grams[i]) + len(grams[j])):
                a, b = head[i], head[j]
                head = [min(a, b) if h in (a, b) else h for h in head]
    assert 10 < len(set(head)) < 300
    rows, written = {}, simhash.written

    def counted(df, name):
        out = written(df, name)
        rows[name] = max(rows.get(name, 0), out.count())
        return out

    monkeypatch.setattr(simhash, "written", counted)
    monkeypatch.setattr(simhash, "BLOCK", block, raising=False)
    monkeypatch.setattr(simhash, "_compared", lambda first, *_: first.selectExpr("fp src", "fp dst").where("false"))  # the exact way has all to do
    out = simhash.keep_one_each(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(head))
    assert max(rows.values()) <= 20 * len(texts), rows
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("rooflight")]


def test_sets_of_two_blocks_are_compared_exactly(monkeypatch):
    monkeypatch.setattr(simhash, "_COLUMNS", 7)
    rng = np.random.default_rng(20)
    base = [rng.integers(1 << 62, size=n).astype(np.uint64) for n in (1, 2, 5, 40)]
    sets = [np.unique(np.where(rng.random(len(b)) < share, rng.integers(1 << 62, size=len(b)).astype(np.uint64), b))[k:] for b in base for share in (0, 0.05, 0.1, 0.2) for k in (0, 1, 4)]
    sets = [x for x in sets if len(x)]
    want = [[simhash.alike(x, y) for y in sets[5:]] for x in sets]
    assert (simhash._alike_pairs(sets, sets[5:]) == np.array(want)).all() and 20 < np.sum(want) < len(sets) ** 2 / 2


def test_uses_of_cells_have_room():
    last = packing.chunk_id((1 << 25) - 1, (1 << packing.NUMBER_BITS) - 1)
    assert 0 < piece_lattice.use_of(last, (1 << piece_lattice.CELL_BITS) - 1) < 1 << 63
    for bad in ((1 << 37, 0), (0, 1 << piece_lattice.CELL_BITS)):
        with pytest.raises(OverflowError):
            piece_lattice.use_of(*bad)
    with pytest.raises(OverflowError):
        packing.chunk_id(0, 1 << packing.NUMBER_BITS)


def test_long_texts_take_the_same_way_as_short_ones(spark):
    """A text beyond every internal piece: the pieces of its repeated sentence repeat."""
    line = "Some words, 12 numbers\tand  spaces; "
    docs = spark.createDataFrame([(1, line * 200_000), (2, line * 2)], "doc_id long, text string")
    out = {r.doc_id: r for r in piece_lattice.encode_documents(docs).collect()}
    assert out[1].round_trip and out[2].round_trip
    tail = out[2].ids[out[2].n_pieces // 2 :]
    assert out[1].ids[-len(tail) :] == tail
    assert language_id.trigrams(line * 20_000)[1].sum() > 20_000 * 20
    assert simhash.fingerprint(line * 30_000) == simhash.fingerprint(line * 30_001)
