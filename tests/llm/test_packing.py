import base64
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from topicgrove.llm.packing import PATTERN, Encoder, best_fit, pack

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ENCODER = Encoder(PATH)


def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


LIBRARY = library()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("ab's \n\t\xa0\x1c  .!9é")), max_size=30), min_size=1, max_size=6))
def test_ids_equal_the_library(texts):
    ids, starts = ENCODER.documents(pa.array(texts, pa.large_string()))
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == LIBRARY.encode_ordinary(text) + [ENCODER.end]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.integers(50, 60))
def test_best_fit_equals_a_plain_search(sizes, capacity):
    rooms, expected = [], []
    for piece in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [r for r in rooms if r >= sizes[piece]]
        if fits:
            k = max(i for i, r in enumerate(rooms) if r == min(fits))
            rooms[k] -= sizes[piece]
        else:
            rooms.append(capacity - sizes[piece])
        expected = sorted(rooms)
    rows = best_fit(np.array(sizes, np.int64), capacity)
    assert sorted(i for r in rows for i in r) == list(range(len(sizes)))
    assert sorted(capacity - sum(sizes[i] for i in r) for r in rows) == expected


@pytest.mark.parametrize("pool", [1, 1 << 20])
def test_round_trip(documents, pool):
    texts = [None, "", "Hello world, this is it.", "  double  spaces \n\n and\ttabs ", "word " * 1000, "é" * 333, "a\nb"] + [f"text number {i} " * (i % 9) for i in range(60)]
    docs = documents([(i, t) for i, t in enumerate(texts)]).repartition(2)
    ids = defaultdict(dict)
    packed = pack(docs, PATH, capacity=64, pool_tokens=pool).collect()
    for r in packed:
        line, place = np.frombuffer(r.ids, np.uint16), np.frombuffer(r.position_ids, np.uint16)
        assert len(line) == len(place) == 64 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 64
        assert (line[r.n_tokens :] == ENCODER.end).all()
        for k, (a, b) in enumerate(zip(r.cu_seqlens, r.cu_seqlens[1:])):
            assert place[a:b].tolist() == list(range(b - a)) and b > a
            assert r.pieces[k] not in ids[r.doc_ids[k]]
            ids[r.doc_ids[k]][r.pieces[k]] = line[a:b].tolist()
    for i, text in enumerate(texts):
        whole = [t for k in sorted(ids[i]) for t in ids[i][k]]
        assert whole[-1] == ENCODER.end and LIBRARY.decode(whole[:-1]) == (text or "")
    assert len({(r.shard, r.row) for r in packed}) == len(packed)


def test_nulls_repeats_and_no_rows(documents):
    found = pack(documents([(None, "a b"), (1, "a b"), (1, "a b")]).coalesce(1), PATH).collect()
    assert sorted(found[0].doc_ids, key=str) == [1, 1, None]
    assert pack(documents([]), PATH).count() == 0
