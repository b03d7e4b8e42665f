import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from topicgrove.llm.token_counts import Counter, count_tokens, load_merges

PATH = public_tokenizers.path("word_bpe_49k.json")
COUNTER = Counter(load_merges(PATH))
LIBRARY = Tokenizer.from_file(PATH)

TEXTS = ["", " ", "hello world", "Hello, WORLD!!!  it's we'll I'd", "aaaaaaaaaa", "Été été ΣΣ İx", "a\x0bb\x1cc\x85d\xa0e f", "<|endoftext|>",
         "x<|startoftext|>y <|endoftext|><|endoftext|> <|pad|> < |", "42 2024 ½", "中文 नमस्ते \U0001f600\U0001f600", "the " * 5000, "$$$%%%&&& ***", "'s't 'RE", "ﬁ ǅ", "z" * 3000, "a\u1680b\u2003c\u2028d\u3000!\u200b?\ufeff"]


def library(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_equals_library():
    assert COUNTER.of_texts(pa.array(TEXTS, pa.large_string())).tolist() == [library(t) for t in TEXTS]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("\u2003\u3000\u0301aAeEtThH'sS \n\t<|>0.!́é")), max_size=40), max_size=5))
def test_equals_library_on_any_text(texts):
    assert COUNTER.of_texts(pa.array(texts, pa.large_string())).tolist() == [library(t) for t in texts]


def test_rows_are_kept(documents):
    docs = documents([(1, None), (None, "hello world"), (2, "a b c"), (2, "a b c")])
    found = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs, PATH, limit=2).collect())
    assert found == [(0, 11, 2, False), (1, 0, 0, False), (2, 5, 3, True), (2, 5, 3, True)]
    assert count_tokens(documents([]), PATH).count() == 0
