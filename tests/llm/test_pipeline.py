"""The pipeline's stages, each on what its predecessor wrote, against brute force."""

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from test_duplicates import brute_jaccard, brute_lines, near_copies  # noqa: E402
from test_texts import WORD, brute_hits, lower  # noqa: E402

import corpus_pipeline  # noqa: E402
from voltplane.llm import decontaminate  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(13)
    vocab = [f"word{i}" for i in range(400)]
    prose = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    item = prose(30)
    texts = [prose(rnd.randint(20, 60)) + ".\n" + prose(rnd.randint(5, 30)) for _ in range(60)]
    texts += [t + "\nA line that many documents share with others" for t in texts[:9]]
    texts += list(near_copies(rnd, 12, vocab, 60)) + [texts[3], texts[4]]
    texts += [f"{prose(15)}\n{item}\n{prose(10)}" for _ in range(4)] + [item]
    texts += [prose(30).upper().replace(" ", "!! ") for _ in range(25)] + [None, ""]
    path = tmp_path_factory.mktemp("data")
    spark.createDataFrame([(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 0 if t and "!!" in t else 1, 0) for i, t in enumerate(texts)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, out = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = corpus_pipeline.written(stage(spark, docs, folder))
        out[name] = before, docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns

    before, after = out["quality"]
    kept = {r.doc_id for r in after}
    assert {i for i, r in before.items() if r.text and "!!" in r.text}.isdisjoint(kept) and {i for i, r in before.items() if r.text and "!!" not in r.text} <= kept
    assert all(before[r.doc_id] == r for r in after)

    before, after = out["lines"]
    want = {i: (dropped, text) for i, _, dropped, text in brute_lines([(i, r.text) for i, r in before.items()])}
    assert {r.doc_id: r.text or "" for r in after} == {i: t for i, (dropped, t) in want.items() if not dropped or t.strip()}
    assert all(r.n_chars == (len(r.text) if want[r.doc_id][0] else before[r.doc_id].n_chars) for r in after)

    before, after = out["near_duplicates"]
    assert {r.doc_id for r in after} == {c for _, _, c in brute_jaccard([(i, r.text) for i, r in before.items()])} and all(before[r.doc_id] == r for r in after)

    before, after = out["decontamination"]
    now = {r.doc_id: r for r in after}
    item = spark.read.parquet(f"{folder}/benchmark.parquet").first().text
    n_hit = 0
    for i, r in before.items():
        words, hit, _ = brute_hits(r.text, [(0, item)], 10)
        left = [w for q, w in enumerate(WORD.findall(lower(r.text))) if q not in hit]
        n_hit += bool(hit)
        if not hit:
            assert now[i] == r
        elif left:
            assert WORD.findall(lower(now[i].text)) == left and now[i].n_chars == len(now[i].text)
        else:
            assert i not in now
    assert n_hit >= 1

    before, after = out["packing"]
    assert {r.doc_id for r in after} == set(before)
    ran = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, ran.collect())) == sorted(map(str, after))


def test_cut_of_nothing():
    assert decontaminate.without_spans(None, [[0, 1]]) is None and decontaminate.without_spans("a", []) == "a"


def test_stages_take_empty_tables(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, str(tmp_path)))
        assert docs.count() == 0


def test_stages_take_rows_without_or_with_one_id_and_extra_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("text IS NULL OR text NOT LIKE '%!!%'")
    for extra in ("score", "n_lines", "hit_spans", "component_id", "block"):
        docs = docs.withColumn(extra, F.lit(1))
    hot = docs.where("doc_id < 12").withColumn("doc_id", F.lit(None).cast("long"))
    docs = corpus_pipeline.written(docs.unionByName(hot).unionByName(docs.where("doc_id IN (3, 4)")).withColumn("n_chars", F.lit(-1).cast("long")))
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.written(stage(spark, docs, folder))
        if name == "quality":
            assert docs.count() == n
        if name != "packing":
            assert docs.columns == before.columns
        if name == "near_duplicates":
            gone = before.select("doc_id").subtract(docs.select("doc_id")).collect()
            assert docs.where("doc_id IS NULL").count() == before.where("doc_id IS NULL").count() and gone
    assert docs.count() == before.count()
