import pyarrow as pa
import pyarrow.compute as pc

from topicgrove.llm.common import slabs, split_words, texts_of


def test_slabs_hold_all_rows_in_order():
    texts = ["A" * n for n in (0, 5, 30, 1, 1, 1, 12, 0)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    parts = list(slabs(iter([batch, batch.slice(0, 0)]), limit=10))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts and len(parts) > 3


def test_texts_of_slices_can_be_lowered():
    whole = pa.array([f"Text {i} É" for i in range(100)])
    assert whole.buffers()[0] is None
    batch = pa.RecordBatch.from_arrays([whole], ["text"]).slice(37, 20)
    assert pc.ascii_lower(texts_of(batch)).to_pylist() == [f"text {i} É" for i in range(37, 57)]


def test_words():
    words, starts = split_words(pa.array(["a  b", "", " \n", "c\x0bd\x1ce "], pa.large_string()))
    assert words.to_pylist() == ["a", "b", "c", "d\x1ce"] and starts.tolist() == [0, 2, 2, 2, 4]


def test_sample_fills_each_class_and_tells_repeats_apart(spark):
    from pyspark.sql import functions as F

    from topicgrove.llm.common import labelled_sample

    rows = [(i, ("long " * 50 if i < 300 else "short ") + str(i)) for i in range(360)] + [(359, "another"), (359, "another"), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 9 > 0)) for i in range(400)] + [(350, 0), (350, 1), (None, 1)], "doc_id long, quality int")
    texts, y = labelled_sample(docs, labels, "quality", F.lit(True), 30, 40)
    again, _ = labelled_sample(docs.repartition(5), labels, "quality", F.lit(True), 30, 40)
    assert texts == again and len(set(texts)) == len(texts) and all(t.startswith((b"short", b"another")) for t in texts)
    assert (y == 1).sum() == 30 and (y == 0).sum() == sum(i % 9 == 0 for i in range(300, 360))
    assert labelled_sample(docs, labels.limit(0), "quality", F.lit(True), 30, 40)[0] == []
