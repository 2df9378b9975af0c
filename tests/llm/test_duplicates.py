"""Line deduplication, repeated passages and the Jaccard join against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from voltplane.llm import common, decontaminate, line_dedup, ngram_join, quality, shingles, suffix_dedup
from voltplane.llm.components import components
from voltplane.llm.perfect_hash import PerfectHash


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_perfect_hash():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 20_000, dtype=np.uint64)
    keys = np.unique(keys)
    h = PerfectHash(keys)
    assert sorted(h.slots(keys)) == list(range(len(keys)))
    assert len(PerfectHash(keys[:0]).slots(keys[:5])) == 5 and PerfectHash(keys[:1]).slots(keys[:1]).tolist() == [0]
    assert h.slots(keys + np.uint64(1)).max() < len(keys)


def test_shard_index_keeps_colliding_hashes_apart():
    index = line_dedup.ShardIndex(np.array([5, 5, 9, 5], np.uint64), np.array([1, 2, 1, 1], np.uint32), np.array([1, 1, 1, 1], np.uint8), np.array([40, 50, 60, 30]))
    count, owner = index.probe(np.array([5, 5, 9, 5, 7], np.uint64), np.array([1, 2, 1, 3, 1], np.uint32))
    assert count.tolist() == [2, 1, 1, 0, 0] and owner[:3].tolist() == [30, 50, 60]


def brute_lines(rows, least=10):
    strip = " \t\n\x0b\x0c\r"
    key = lambda line: lower(line.strip(strip))
    docs = defaultdict(set)
    big = 1 << 62
    for i, t in rows:
        for line in (t or "").split("\n"):
            docs[key(line)].add(big if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= least and len(docs[key(x)]) >= 2 and min(docs[key(x)]) != (big if i is None else i))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block, shard", [(2 << 20, 16 << 20), (300, 500)])
def test_line_dedup(spark, monkeypatch, block, shard):
    monkeypatch.setattr(line_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(line_dedup, "SHARD_BYTES", shard)
    rnd = random.Random(7)
    lines = [f"{'A common LINE of many words'[: rnd.randint(8, 27)]} {i % 9}" for i in range(60)] + ["", " ", "short", "été été été", "\x85padded line é", "10 letters", "\t10 LETTERS \x0b", "9 letters"]
    rows = [(i, "\n".join(rnd.choice(lines) for _ in range(rnd.randint(1, 12)))) for i in range(80)] + [(None, lines[0]), (None, lines[0]), (5, lines[1]), (90, None), (91, ""), (92, "\n".join([lines[2]] * 500))]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, block string, n_lines string").repartition(5)
    kept = line_dedup.dedup_lines(docs)
    assert kept.columns == ["doc_id", "text", "block", "n_lines", "n_dropped"]
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in kept.collect()), key=str)
    assert got == brute_lines(rows)
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_components(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(160)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_jaccard(rows, k=5, percent=75):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets.append(frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) > 0:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        least[r] = doc if least.get(r) is None else least[r] if doc is None else min(least[r], doc)
    return sorted(((doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows)), key=str)


def near_copies(rnd, n, vocab, length):
    base = [rnd.choice(vocab) for _ in range(length)]
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.choice([0, 1, 2, 3, 4, 6])):
            p, q = rnd.randrange(len(w)), rnd.random()
            if q < 0.4:
                w[p] = rnd.choice(vocab)
            elif q < 0.7:
                del w[p : p + rnd.randint(1, 9)]
            else:
                w[p:p] = [rnd.choice(vocab) for _ in range(rnd.randint(1, 8))]
        yield " ".join(w)


@pytest.mark.parametrize("most_tokens", [2_000_000, 600])
def test_jaccard_components(spark, monkeypatch, most_tokens):
    monkeypatch.setattr(ngram_join, "BATCH_DOCS", 40)
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(300)]
    texts = [*near_copies(rnd, 110, vocab, 80), *near_copies(rnd, 30, vocab[:40], 12), *(" ".join(rnd.choice(vocab[:5]) for _ in range(rnd.randint(0, 9))) for _ in range(40))]
    rows = list(enumerate(texts)) + [(500, None), (501, ""), (None, texts[3]), (None, "all alone here"), (7, texts[7]), (502, texts[0].upper())]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, name string").repartition(5)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs, most_tokens=most_tokens).collect()), key=str)
    want = brute_jaccard(rows)
    assert got == want
    assert ngram_join.jaccard_components(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_tree_join_finds_every_component(seed):
    """The trees alone, in any order of sets, against all pairs."""
    rnd = random.Random(seed)
    sets = [sorted(rnd.sample(range(40), rnd.randint(4, 30))) for _ in range(60)]
    sets += [sorted(set(s) ^ {rnd.randrange(40)}) for s in sets]
    joined = ngram_join.UnionFind(len(sets))
    every = list(range(len(sets)))
    ngram_join.TreeJoin([len(s) for s in sets], [np.array(s, np.uint64) for s in sets], 75, joined).run(every, every)
    plain = ngram_join.UnionFind(len(sets))
    for a in range(len(sets)):
        for b in range(a):
            if 100 * len({*sets[a]} & {*sets[b]}) >= 75 * len({*sets[a]} | {*sets[b]}):
                plain.union(a, b)
    assert [joined.find(i) for i in range(len(sets))] == [plain.find(i) for i in range(len(sets))]


@pytest.mark.parametrize("batch", [1024, 3])
def test_repeated_spans(spark, monkeypatch, batch):
    monkeypatch.setattr(suffix_dedup, "BATCH_DOCS", batch)
    rnd = random.Random(2)
    n, gram = 12, 8
    words = [f"w{i}" for i in range(500)]
    prose = lambda k: [rnd.choice(words) for _ in range(k)]
    shared = [prose(k) for k in (11, 12, 13, 40)]
    texts = []
    for i in range(40):
        w = prose(rnd.randint(0, 60))
        for s in rnd.sample(shared, rnd.randint(0, 2)):
            w += s + prose(rnd.randint(0, 5))
        texts.append(" ".join(w).upper() if i % 3 else ", ".join(w))
    own = prose(30)
    rows = list(enumerate(texts)) + [(60, None), (61, ""), (62, " ".join(own + own)), (63, texts[8]), (63, texts[8]), (None, texts[8])]
    seen = defaultdict(set)
    split = {(i, t): lower(t or "").replace(",", "").split() for i, t in rows if i is not None}
    for (i, _), w in split.items():
        for p in range(len(w) - n + 1):
            seen[tuple(w[p : p + n])].add(i)
    want = {(i, q) for (i, _), w in split.items() for p in range(len(w) - n + 1) if len(seen[tuple(w[p : p + n])]) > 1 for q in range(p, p + n)}
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, spans string").repartition(4)
    found = suffix_dedup.repeated_spans(docs, n, gram).collect()
    assert {(r.doc_id, q) for r in found for q in range(r.first_word, r.first_word + r.n_words)} == want
    assert all(r.other_doc_id != r.doc_id for r in found)
    left = suffix_dedup.without_repeats(docs, n, gram)
    assert left.columns == docs.columns and left.count() == len(rows)
    kept = {i: lower(t or "").replace(",", " ").split() for i, t in left.select("doc_id", "text").collect() if i is not None}
    for s in shared[1:]:
        assert any(" ".join(s) in " ".join(w) for w in kept.values()) == any(" ".join(s) in " ".join(w) for w in split.values())
    assert suffix_dedup.repeated_spans(docs.limit(0), n, gram).count() == 0


def brute_repeats(rows, n):
    """(document, word) of each word in n words in a row that another document holds too; and of those that a smaller one holds."""
    held = defaultdict(set)
    for i, t in rows:
        w = t.split()
        for p in range(len(w) - n + 1):
            held[tuple(w[p : p + n])].add(i)
    found, smaller = set(), set()
    for i, t in rows:
        w = t.split()
        for p in range(len(w) - n + 1):
            have = held[tuple(w[p : p + n])]
            found |= {(i, q) for q in range(p, p + n) if len(have) > 1}
            smaller |= {(i, q) for q in range(p, p + n) if min(have) < i}
    return found, smaller


def spanned(found):
    return {(r.doc_id, q) for r in found for q in range(r.first_word, r.first_word + r.n_words)}


@pytest.mark.parametrize("batch", [1024, 1])
def test_repeats_within_a_document_and_across_batches(spark, monkeypatch, batch):
    monkeypatch.setattr(suffix_dedup, "BATCH_DOCS", batch)
    rnd = random.Random(7)
    prose = lambda k: [f"v{rnd.randrange(10**6)}" for _ in range(k)]
    passage, period = prose(60), prose(7)
    texts = [(1, prose(5) + passage + prose(9) + passage + prose(4)), (2, prose(30) + passage), (3, period * 40), (4, period * 40), (5, prose(25) * 2)]
    rows = [(i, " ".join(w)) for i, w in texts]
    found = suffix_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 12, 8).collect()
    assert spanned(found) == brute_repeats(rows, 12)[0]


def test_repeats_between_edited_copies(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BATCH_DOCS", 1)
    rnd = random.Random(11)
    prose = lambda k: [f"v{rnd.randrange(10**6)}" for _ in range(k)]
    base = prose(120)
    rows = []
    for i in range(60):
        w = list(base)
        for at in rnd.sample(range(len(w)), rnd.randint(2, 12)):
            w[at] = prose(1)[0]
        rows.append((i, " ".join(w)))
    found = suffix_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 24, 12).collect()
    assert spanned(found) == brute_repeats(rows, 24)[0]


@pytest.mark.parametrize("batch", [1024, 1])
def test_without_repeats_leaves_each_window_in_its_smallest_document(spark, monkeypatch, batch):
    monkeypatch.setattr(suffix_dedup, "BATCH_DOCS", batch)
    rnd = random.Random(13)
    prose = lambda k: [f"v{rnd.randrange(10**6)}" for _ in range(k)]
    n, one, two, short = 12, prose(30), prose(30), prose(14)
    texts = [(3, prose(5) + one), (5, one + two), (9, two + prose(4)), *((i, prose(6) + short + prose(6)) for i in range(20, 40))]
    rows = [(i, " ".join(w)) for i, w in texts]
    left = dict(suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), n, 8).collect())
    smaller = brute_repeats(rows, n)[1]
    assert {i: (t or "").split() for i, t in left.items()} == {i: [x for q, x in enumerate(w) if (i, q) not in smaller] for i, w in texts}
    windows = lambda w: {tuple(w[p : p + n]) for p in range(len(w) - n + 1)}
    for passage, smallest in ((one, 3), (two, 5), (short, 20)):
        for window in windows(passage):
            assert [i for i, t in left.items() if window in windows((t or "").split())] == [smallest]


def test_batches_of_the_same_documents_in_another_order(spark, monkeypatch):
    rnd = random.Random(17)
    texts = [" ".join(f"v{rnd.randrange(10**6)}" for _ in range(30)) for _ in range(12)]
    rows = list(enumerate([*texts, texts[0] + " more", texts[5] + " more"]))
    monkeypatch.setattr(ngram_join, "BATCH_DOCS", len(rows))
    docs = spark.createDataFrame(rows + rows[::-1], "doc_id long, text string").coalesce(1)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs).collect()), key=str)
    assert got == brute_jaccard(rows + rows)


def spans_of(rows, n, gram, batch):
    """repeated_spans() without a session: the same functions, shard by shard."""
    parts = [pa.RecordBatch.from_pylist([{"doc_id": i, "text": t} for i, t in rows[at : at + batch]]) for at in range(0, len(rows), batch)]
    sent = pa.Table.from_batches(suffix_dedup._encode(n, gram, 3)(iter(parts)))
    found = [suffix_dedup._match(n, gram)(sent.filter(pc.equal(sent.column("shard"), s))) for s in range(3)]
    return {(r["doc"], q) for t in found for r in t.to_pylist() for q in range(r["first"], r["end"])}


@pytest.mark.parametrize("batch", [1000, 1])
def test_a_common_core_in_many_contexts_hides_no_passage(batch):
    """A passage of 50 words in two documents, whose 32 middle words stand in 37 others with fewer than 18 equal words around them."""
    for seed in range(40):
        rnd = random.Random(seed)
        prose = lambda k: [f"v{rnd.randrange(10**6)}" for _ in range(k)]
        left = rnd.randint(0, 18)
        before, core, after = prose(left), prose(32), prose(18 - left)
        texts = [prose(20) + before + core + after + prose(20) for _ in range(2)]
        for _ in range(37):
            a = rnd.randint(0, left)
            b = rnd.randint(0, min(17 - a, 18 - left)) if a < 18 else 0
            if a + b < 18:
                texts.append(prose(20) + (before[left - a :] if a else []) + core + after[:b] + prose(20))
        rows = [(i, " ".join(w)) for i, w in enumerate(rnd.sample(texts, len(texts)))]
        assert spans_of(rows, 50, 32, batch) == brute_repeats(rows, 50)[0]


@pytest.mark.parametrize("chunk", [3, 40])
def test_long_texts_are_cut_into_words_in_parts(monkeypatch, chunk):
    rnd = random.Random(chunk)
    text = "".join(rnd.choice(["a", "B", "été", "x1", "7", "漢字"]) + rnd.choice([" ", "\n", "\t", "\x0b", ", ", "  "]) for _ in range(300))
    index = decontaminate.WindowIndex([(1, "a B x1"), (2, text[40:90])], 4)

    def everything():
        at, value, stats = quality.features(text, quality.WordPlaces())
        hash_, places, sides = suffix_dedup._suffixes(text, 12, 8, shingles.WordHashes())
        return shingles.shingle_set(text, 5, shingles.WordHashes()).tolist(), hash_.tolist(), places.tolist(), sides.tolist(), index.scan(text), at.tolist(), value.tolist(), stats

    whole = everything()
    monkeypatch.setattr(shingles.word_hashes, "__defaults__", (chunk,))
    monkeypatch.setattr(common.cut_at_blanks, "__defaults__", (chunk,))
    assert everything() == whole


def test_parts_of_a_batch():
    texts = ["abcd", None, "", "x" * 50, "ab", "é" * 3, "y"]
    batch = pa.RecordBatch.from_pylist([{"text": t, "i": i} for i, t in enumerate(texts)])
    parts = [p.column("i").to_pylist() for p in common.slices(batch, "text", rows=3, size=8)]
    assert parts == [[0, 1, 2], [3], [4, 5], [6]] and not list(common.slices(batch[:0], "text"))


def test_line_dedup_of_rows_that_share_an_id(spark, monkeypatch):
    """An id that holds a third of all rows, and none at all, spread over blocks and still count as one document."""
    monkeypatch.setattr(line_dedup, "BLOCK_BYTES", 200)
    rnd = random.Random(19)
    lines = [f"a line of words {i}" for i in range(40)]
    rows = [(rnd.choice([None, 7, rnd.randint(0, 50)]), "\n".join(rnd.choice(lines) for _ in range(3))) for _ in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in line_dedup.dedup_lines(docs).collect()), key=str)
    assert got == brute_lines(rows)
