"""Whitening, ranked search and online packing against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltplane.llm import lexical_search, online_packing, whitening
from voltplane.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


# whitening


def brute_whitening(rows, k, scale=256):
    """id -> (deviation, whitened with signs as found), explained, n."""
    sound = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) and abs(c) * scale < 2**62 for c in v)]
    xs = [(i, tuple(math.floor(scale * c) for c in v)) for i, v in sound]
    sizes = Counter(len(x) for x in {x for _, x in xs})
    d = max(sizes, key=lambda s: (sizes[s], s))
    xs = [(i, x) for i, x in xs if len(x) == d]
    fit = sorted({x for _, x in xs})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    exact = np.array([[n * a - s for a, s in zip(x, sums)] for x in fit], object)
    centred = exact.astype(float) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    out = [(i, sum((n * a - s) ** 2 for a, s in zip(x, sums)), (np.array([n * a - s for a, s in zip(x, sums)], float) / n) @ v / np.sqrt(e)) for i, x in xs]
    return n, e / (centred**2).sum(axis=1).mean(), out


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "a", 1.0) for i, v in rows], "vec_id long, embedding array<float>, x string, component double").repartition(5)


@pytest.mark.parametrize("offset", [0.0, 3.0e4])
def test_whitening(spark, offset):
    rnd = np.random.default_rng(3)
    base = rnd.normal(size=(60, 6)) * [5, 3, 2, 1, 0.5, 0.1] + offset
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    # copies, also of a third of all rows, a repeated and a missing id, unsound and shorter vectors
    rows += [(100 + i, rows[7][1]) for i in range(40)] + [(5, rows[9][1]), (None, rows[3][1])]
    odd = [(900, None), (901, []), (902, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (903, [float("nan")] * 6), (904, [float("inf")] + [0.0] * 5), (905, [3e38] * 6), (906, [1.0, 2.0]), (907, [0.0] * 7)]
    n, explained, want = brute_whitening(rows + odd, 4)
    got = whitening.whitened(vectors(spark, rows + odd)).collect()
    assert len(got) == 4 * len(rows) == 4 * len(want)
    by_id = defaultdict(list)
    for r in got:
        by_id[r.vec_id].append(r)
        assert r.n == n and r.identity_error < 1e-9 and abs(r.explained / explained[r.component - 1] - 1) < 1e-6
    signs = np.array([np.sign(r.whitened) for r in sorted(by_id[0], key=lambda r: r.component)]) * np.sign(want[0][2])
    for i in {i for i, _, _ in want}:
        mine = sorted((r.deviation, r.component, round(r.whitened * signs[r.component - 1], 5)) for r in by_id[i])
        assert mine == sorted((dev, c + 1, round(float(w[c]), 5)) for j, dev, w in want if j == i for c in range(4)), i


def test_whitening_of_low_rank_and_nothing(spark):
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(5)]
    got = whitening.whitened(vectors(spark, line)).collect()
    assert len(got) == 5 and {r.component for r in got} == {1} and all(abs(r.explained - 1) < 1e-9 and r.identity_error < 1e-9 for r in got)
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        empty = whitening.whitened(vectors(spark, rows))
        assert empty.count() == 0 and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviations_beyond_64_bits():
    x = np.array([[1 << 40, -(1 << 41)], [3, 5]])
    q, r = np.array([7, -9]), np.array([3, 1])
    want = [sum((1000 * (int(a) - int(b)) - int(c)) ** 2 for a, b, c in zip(row, q, r)) for row in x]
    assert whitening.deviations(x, 1000, q, r) == want and want[0] > 1 << 63
    assert whitening.deviations(x[1:], 1000, q, r) == want[1:]


# search


def brute_ranks(docs, items, k):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    held = [x for x in held if x[2]]
    nd, nt = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        asked, scores = Counter(terms(text)), []
        for i, c, n in held:
            m = 100 - 25 + (25 * n * nd) // nt
            s = sum(q * math.floor(1000 * math.log((2 * nd + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, q in asked.items() if t in c)
            if s:
                scores.append((-s, i is None, i or 0))
        out += [(item, r, None if missing else i, -s) for r, (s, missing, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize(("k", "block_docs", "pass_bytes"), [(3, 7, 1 << 20), (20, 64, 40), (1, 1000, 1 << 20)])
def test_ranked(spark, k, block_docs, pass_bytes):
    rnd = random.Random(k)
    vocab = ["the", "Quick", "fox", "née", "x1", "2", *(f"w{i}" for i in range(30))]
    text = lambda most: ", ".join(vocab[min(int(rnd.expovariate(0.15)), len(vocab) - 1)] for _ in range(rnd.randint(0, most)))
    docs = [(i, text(60)) for i in range(200)] + [(300 + i, "fox x1 the w3") for i in range(90)]
    docs += [(None, "fox w5 w5"), (None, "fox w5 w5"), (7, "x1 x1 x1"), (7, "x1 x1 x1"), (500, None), (501, ""), (502, "!! --"), (503, "the " * 5000 + "w9")]
    items = [(i, text(25)) for i in range(12)] + [(20, None), (21, "??"), (3, "fox x1 fox"), (3, "fox x1 fox"), (22, "unheard"), (None, "quick w7")]
    frame = spark.createDataFrame([(i, t, 1, "s") for i, t in docs], "doc_id long, text string, score int, rank string").repartition(4)
    got = lexical_search.ranked(frame, spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, df int"), k=k, block_docs=block_docs, pass_bytes=pass_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_ranks(docs, items, k)


def test_nothing_to_rank(spark):
    docs, items = "doc_id long, text string", "item_id long, text string"
    for d, i in (([], [(1, "a b")]), ([(1, "a b")], []), ([(1, "")], [(1, "a")]), ([(1, "a")], [(1, None)])):
        assert lexical_search.ranked(spark.createDataFrame(d, docs), spark.createDataFrame(i, items)).count() == 0


def test_search_stops_early_and_stays_exact(monkeypatch):
    rnd = np.random.default_rng(1)
    n, v, k = 4000, 300, 10
    lengths = rnd.integers(0, 40, n)
    each = [np.sort(rnd.choice(v, m, replace=False, p=(p := 1 / np.arange(1, v + 1)) / p.sum())) for m in lengths]
    t, tf = np.concatenate(each), rnd.integers(1, 4, lengths.sum())
    df = np.bincount(t, minlength=v)
    w = lexical_search.weights(df, n)
    block = lexical_search.ImpactBlock(lengths, t, tf, 75 + rnd.integers(1, 90, n), w)
    completed = []
    complete = block.complete
    monkeypatch.setattr(block, "complete", lambda *a: completed.append(len(a[0])) or complete(*a))
    searches = 0
    for _ in range(40):
        asked = np.unique(rnd.choice(v, 12))
        times = rnd.integers(1, 3, len(asked))
        all_docs = complete(np.arange(n), asked, times)
        for least in (1, int(np.sort(all_docs)[-k])):
            found, scores = block.search(asked, times, least, k)
            searches += 1
            assert (scores == all_docs[found]).all()
            best = np.lexsort((np.arange(n), -all_docs))[:k]
            assert set(best[all_docs[best] >= least]) <= set(found)
    # some of the searches end early, and complete a few documents
    assert len(completed) > searches / 10 and max(completed) < n / 4, completed


# packing


def packed_back(spark, texts, ids=None, **how):
    """doc place -> its ids as packed, after checks of sequences and pieces."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    window = how.get("window", 1024)
    ids = ids or list(range(len(texts)))
    frame = spark.createDataFrame([(i, x, 1) for i, x in zip(ids, texts)], "doc_id long, text string, length int").repartition(3)
    rows = online_packing.pack_online(frame, tokenizer_path(), **how).collect()
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at == window or (at < window and at & (at - 1) == 0)
    want = defaultdict(list)
    for i, x in zip(ids, texts):
        want[i].append([*t.encode(x or "", add_special_tokens=False).ids, 0])
    assert set(want) == set(docs)
    for i, lists in want.items():
        assert sorted({p[3] for p in docs[i]}) == sorted({len(x) for x in lists})
        assert sum(p[1] for p in docs[i]) == sum(map(len, lists))
        for start, length, crc, n in docs[i]:
            assert any(len(x) == n and zlib.crc32(np.array(x[start : start + length], "<u4").tobytes()) == crc for x in lists)
        if len(lists) == 1:
            at = 0
            for start, length, _, _ in sorted(docs[i]):
                assert start == at
                at += length
    return rows, sequences


@pytest.mark.parametrize(("window", "open_windows"), [(1024, 512), (32, 4), (8, 1), (1, 3)])
def test_packing_online(spark, window, open_windows):
    rnd = random.Random(window)
    pieces = ["<|endoftext|>", " ", "\n", "'s", "don't", "é", "1", "漢字", "😀", "AB", "!", " the", " quick", "\x85", "\x1c", "Ђ", "՘'s"]
    texts = [None, "", " the" * 5000, *("".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 60))) for _ in range(120)), *[" quick" * 20] * 100]
    packed_back(spark, texts, window=window, open_windows=open_windows)
    # ids that repeat or are missing
    packed_back(spark, ["a b", "a b", " the quick", None, "x"], [1, 1, 2, None, None], window=window, open_windows=open_windows)
    empty = online_packing.pack_online(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path())
    assert empty.count() == 0


def test_sizes_that_never_meet_stay_bounded():
    packer = online_packing.SquaresPacker(1024, 16)
    for i in range(3000):
        packer.add(online_packing.Piece(i, 0, bytes(4 * 600), 600))
        assert packer.n_open == packer.counts.sum() <= 16
    packer.close()
    lengths = [sum(len(p.ids) for p in s) // 4 for s in packer.done]
    assert sum(lengths) == 3000 * 600 and sum(x != 1024 for x in lengths) <= 10


def test_level_has_the_least_sum_of_squares():
    rnd = random.Random(9)
    packer = online_packing.SquaresPacker(64, 40)
    for i in range(2000):
        size = rnd.choice([*range(1, 64), 20, 20, 44])
        squares = lambda counts: int((counts[1:64] ** 2).sum())
        options = {}
        for level in range(0, 65 - size):
            if (level == 0 and packer.n_open < 40) or packer.counts[level] > 0:
                after = packer.counts.copy()
                after[level] -= level > 0
                after[level + size] += level + size < 64
                options[level] = squares(after)
        chosen = packer.level_for(size)
        if chosen is None:
            assert not options
        else:
            assert options[chosen] == min(options.values())
            if chosen:
                assert chosen == max(h for h, s in options.items() if s == options[chosen])
        packer.add(online_packing.Piece(i, 0, bytes(4 * size), size))
        assert packer.counts[0] == packer.counts[64] == 0


def test_ids_by_the_librarys_classes():
    """Every code point to U+3FFFF, with letters, numbers, blanks and others beside it."""
    from tokenizers import Tokenizer

    from voltplane.llm.token_counts import Counter2Tier, TokenIds

    t, ids, counter = Tokenizer.from_file(tokenizer_path()), TokenIds(tokenizer_path()), Counter2Tier(tokenizer_path())
    texts = []
    for lo in range(0x80, 0x40000, 64):
        some = [chr(c) for c in range(lo, lo + 64) if not 0xD800 <= c < 0xE000]
        texts += ["".join(form.format(c) for c in some) for form in ("b{0}{0}'s ", "1{0}1 {0}", "{0} {0}\n", "!{0}!{0}a")]
    for text, encoded in zip(texts, t.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids.packed(text), "<u4").tolist() == encoded.ids
        assert counter.count(text) == len(encoded.ids)
