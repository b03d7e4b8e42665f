import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from topicgrove.llm import bpe
from topicgrove.llm.bpe import Encoder, decode, digests, encode
from topicgrove.llm.registry import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY, ENCODER = Tokenizer.from_file(PATH), Encoder(PATH)
ODD = ["Σ", "ς", "á", "<|endoftext|>", "<|startoftext|>", "<|end", "'s", "'LL", "\u0085", "​", "\xa0", "\x1c", "  ", "\n", "İ", "ſ", "한", "🙂", "1234", "aaaa", "...", "̈́", "!!!"]
TEXT = st.lists(st.one_of(st.text(max_size=8), st.sampled_from(ODD), st.sampled_from(["hello", "World", "the", "ing"])), max_size=14).map("".join)


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5))
def test_ids_equal_the_library(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, starts = ENCODER.of_texts(pa.array(texts, pa.large_string()))
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == library_ids(text), text


def test_every_merge_needs_only_lower_ranks():
    merges = ENCODER.merges
    made = dict(zip(merges.results.tolist(), merges.ranks.tolist()))
    assert len(made) == len(merges.results)
    for code, rank in zip(merges.codes.tolist(), merges.ranks.tolist()):
        assert all(made.get(part, -1) < rank for part in divmod(code, merges.width))


def test_long_runs():
    for text in ["a" * 5001, "ab" * 3000, "é" * 4001, "!" * 3000, "x" * 70000, "the" * 2001]:
        ids, _ = ENCODER.of_texts(pa.array([text], pa.large_string()))
        assert ids.tolist() == library_ids(text)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_PIECES", 3)
    encoder = Encoder(PATH)
    for text in ["one two three four five", "two six", "one <|endoftext|>seven"]:
        assert encoder.of_texts(pa.array([text], pa.large_string()))[0].tolist() == library_ids(text)
        assert len(encoder.place) <= 8


def test_round_trip_and_odd_rows(documents):
    texts = [None, "", "Hello, World's  end!", "é<|endoftext|>x", "a\nb", "no 123"]
    docs = documents([*enumerate(texts), (None, "a b"), (2, "Hello, World's  end!")])
    rows = decode(encode(docs, PATH), PATH).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        text = "a b" if r.doc_id is None else texts[r.doc_id] or ""
        assert ids == library_ids(text) and r.n_tokens == len(ids) and r.decoded == LIBRARY.decode(ids, skip_special_tokens=False)
    at_once = encode(docs, PATH, decoded="text again").collect()
    assert sorted((str(r[0]), r[1], bytes(r[2]), r[3]) for r in at_once) == sorted((str(r.doc_id), r.n_tokens, bytes(r.ids), r.decoded) for r in rows)
    plain = {r.doc_id: r.decoded for r in decode(encode(docs, PATH), PATH, plain=True).collect()}
    assert plain[2] == "hello , world 's end !" and plain[3] == "é <|endoftext|> x" and plain[5] == "no 1 2 3" and plain[0] == plain[1] == ""
    assert encode(documents([]), PATH).count() == 0


def test_decode_keeps_clashing_columns(spark):
    rows = spark.createDataFrame([(1, None, "old", "t"), (2, bytearray(np.array([49407, 60000], "<u4").tobytes()), "x", "u")], "`decoded x` int, ids binary, decoded string, text string")
    found = {r["decoded x"]: (r.decoded, r.text) for r in decode(rows, PATH).collect()}
    assert found == {1: (None, "t"), 2: ("<|endoftext|>", "u")}


def test_query_over_the_given_table(spark):
    found = {r.doc_id: r for r in QUERIES["op13_bpe"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(found) == len(docs)
    for r in docs:
        ids = library_ids(r.text or "")
        assert found[r.doc_id].n_tokens == len(ids)
        assert found[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[r.doc_id].decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_digests_of_nothing(documents):
    assert digests(documents([]), PATH).count() == 0
