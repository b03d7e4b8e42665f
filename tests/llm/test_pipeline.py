"""The pipeline's stages against brute force on a small fixture and on the smallest tables."""

import re
from collections import defaultdict

import numpy as np

import corpus_pipeline as P
from topicgrove.llm.near_dedup import one_of_each
from topicgrove.llm.registry import op4_quality_classifier

SF_DIR = "/root/testdata/sf0.001"


def test_stages_on_the_smallest_tables(spark, tmp_path):
    from test_decontamination import brute as hits
    from test_near_dedup import brute as components

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    good = {r.doc_id for r in op4_quality_classifier(spark, SF_DIR).where("predicted = 1").collect()}
    kept = {i for i, (_, root) in components([(i, rows[i].text) for i in sorted(good)], 5, 80).items() if i == root}
    clean = {i for i in kept if not hits(rows[i].text, items)[1]}
    expected = {"quality_classifier": good, "near_dedup": kept, "decontamination": clean}
    assert len(rows) > len(good) > len(kept) > len(clean) > 20
    for name, stage in P.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name in expected:
            assert sorted(r.doc_id for r in out.collect()) == sorted(expected[name])
        if name != "token_packing":
            assert out.columns == list(rows[0].asDict())
            assert all(rows[r.doc_id].asDict() == r.asDict() for r in out.collect())
        if name == "mixing":
            copies = [r.doc_id for r in out.collect()]
            size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", rows[i].text)) for i in clean}
            taken = sum(size[i] for i in copies)
            assert set(copies) <= clean and max(map(copies.count, set(copies))) <= 2
            assert abs(taken - 1.5 * sum(size.values())) < 0.3 * taken
        docs = out
    ids = defaultdict(int)
    for r in docs.collect():
        for i, piece in zip(r.doc_ids, r.pieces):
            ids[i] += piece == 0
        assert len(np.frombuffer(r.ids, np.uint16)) == 2048
    assert dict(ids) == {i: copies.count(i) for i in set(copies)}


def test_one_of_each_keeps_odd_rows(documents):
    docs = documents([(5, "a b c d e f"), (None, "A b c d e f"), (None, "x y z"), (None, None), (7, "q r s t u v"), (7, "q r s t u v"), (7, "other words here now"), (9, "q r s t u v"), (10, None), (11, "")])
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    found = {(r.doc_id, r.text) for r in kept.collect() if r.doc_id != 7}
    assert found == {(5, "a b c d e f"), (None, "x y z"), (None, None), (10, None), (11, "")}
    assert [r.doc_id for r in kept.collect()].count(7) == 1


def test_empty_documents(spark, documents):
    docs = documents([]).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in P.STAGES:
        docs_out = stage(spark, docs, SF_DIR)
        assert docs_out.count() == 0


def test_packed_shards_follow_the_training_order(spark, documents, tmp_path):
    lengths = [7, 300, 20, 900, 60]  # later files are larger: a read by falling size turns them round
    rows = [(i, f"w{i} " * (lengths[i % 5] + i)) for i in range(240)]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    documents(rows).select(columns).repartitionByRange(12, "doc_id").sortWithinPartitions("doc_id").write.parquet(str(tmp_path / "mixed"))
    packed = P.pack_tokens(spark, spark.read.parquet(str(tmp_path / "mixed")), SF_DIR).collect()
    places = defaultdict(list)
    for r in packed:
        places[r.shard] += r.doc_ids
    shards = [places[s] for s in sorted(places)]
    assert len(shards) > 1 and all(max(a) < min(b) for a, b in zip(shards, shards[1:]))
    assert {i for s in shards for i in s} == set(range(240))
    for s in places:
        means = [np.mean(r.doc_ids) for r in sorted(packed, key=lambda r: r.row) if r.shard == s]
        assert means == sorted(means)


def test_clashing_column_names(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = "positions planned_id planned_source planned_size training_position kept_id kept_hash score predicted _row _number _name doc c0 c1 file_name number name place hit_id text_hash words start window".split()
    wide = docs.selectExpr("*", *[f"{i} AS `{n}`" for i, n in enumerate(names)], "1 AS `a.b`")
    for name, stage in P.STAGES[:-1]:
        plain, found = stage(spark, docs, SF_DIR), stage(spark, wide, SF_DIR)
        assert found.columns == wide.columns and plain.columns == docs.columns
        found.write.parquet(str(tmp_path / name))
        rows = spark.read.parquet(str(tmp_path / name)).collect()
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in plain.collect()) and len(rows) > 20
        assert all(r["score"] == names.index("score") and r["a.b"] == 1 and r["_row"] == names.index("_row") for r in rows)
    wide.write.parquet(str(tmp_path / "wide"))
    packed = P.pack_tokens(spark, spark.read.parquet(str(tmp_path / "wide")), SF_DIR)
    assert sorted(i for r in packed.collect() for i, k in zip(r.doc_ids, r.pieces) if k == 0) == sorted(r.doc_id for r in docs.collect())
