"""The pipeline against plain versions of its stages, on a small table."""

import random
from collections import Counter

import corpus_pipeline
from daybook.llm import mix, toxicity

from .test_decontaminate import plain as plain_matches
from .test_simhash import plain_groups
from .test_toxicity import corpus


def write(spark, tmp_path):
    r = random.Random(8)
    docs, labels = corpus(240, 4)
    items = [(i, " ".join(f"item{i}word{k}" for k in range(20 + i))) for i in range(5)]
    rows = [(i, t, "en", r.choice(["a", "b", "b", "b", None]), len(t)) for i, t in docs]
    rows += [(1000 + i, t + " tail", "en", "a", len(t)) for i, t in docs[:40]]
    rows += [(2000 + i, docs[i][1][:300] + ". " + items[i % 5][1].title() + " end of it", "en", "c", 1) for i in range(60, 75)]
    rows += [(3000, None, None, None, None), (3001, "", "en", "a", 0), rows[7], rows[7]]
    d = str(tmp_path / "tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(
        f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, rows, items


def test_pipeline(spark, tmp_path):
    d, rows, items = write(spark, tmp_path)
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    bad = {r.doc_id for r in toxicity.scored(docs, toxicity.trained(docs, labels)).collect() if r.predicted}
    assert 10 < len(bad) < 100
    left = [(i, t) for i, t, *_ in rows if i not in bad]
    kept = {c for _, _, c in plain_groups(left)}
    texts = dict(left)
    hits = {i for i, _ in plain_matches([(i, texts[i]) for i in kept], items)}
    assert len(hits) >= 8
    clean = kept - hits
    source = {i: s for i, _, _, s, _ in rows}
    small = spark.createDataFrame([(i, texts[i], source[i]) for i in clean], "doc_id long, text string, source string")
    want = Counter({r.doc_id: r.copies for r in mix.mixed(small).collect() if r.copies})
    out = corpus_pipeline.run(spark, d)
    assert out.columns == [*docs.columns, "shard", "slot"]
    got = out.collect()
    assert Counter(r.doc_id for r in got) == want
    assert all(r.text == texts[r.doc_id] and r.source == source[r.doc_id] for r in got)
    per = Counter(r.shard for r in got)
    assert max(per.values()) - min(per.values()) <= 1
    for s, n in per.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))


def test_stages_keep_columns_and_stand_empty_tables(spark, tmp_path):
    d, _, _ = write(spark, tmp_path)
    docs = spark.read.parquet(f"{d}/documents.parquet").limit(0).selectExpr("*", "1 AS shard", "'x' AS fp", "2 AS copies")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, d)
        assert out.count() == 0
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
