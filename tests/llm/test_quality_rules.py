import re
from collections import Counter

from topicgrove.llm.quality_rules import judge


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen, covered = Counter(runs), set()
    for i, run in enumerate(runs):
        if seen[run] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force(documents):
    texts = [None, "", " \n\t", "one", "é" * 40, "a b c d e f g h a b c d e f g h", "x " * 9, "x " * 8 + "y",
             "l1 a\nl1 a\n\n\nl2 $\n", "a b c d " * 700 + "tail", " ".join(map(str, range(3000))), "a\x0bb\x0cc\rd\x1ce",
             "p q r s t u v w 1 p q r s t u v w 2 q r s t u v w 2 z"]
    docs = documents([(i, t) for i, t in enumerate(texts)] + [(None, "null id"), (3, "one")])
    found = judge(docs).collect()
    assert len(found) == len(texts) + 2
    for r in found:
        if r.doc_id is not None:
            expected = brute(texts[r.doc_id])
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
            assert r.base_failed == (expected[0] < 20 or 100 * expected[4] > 30 * expected[0])
            assert not (r.base_failed and r.kept)


def test_prose_stays_and_junk_goes(documents):
    prose = "The house by the river was sold in the spring, and it is said that a new owner came with the first boat of may."
    junk = " ".join(w + "###" for w in prose.split())
    kept = {r.doc_id: (r.kept, r.broken) for r in judge(documents([(1, prose), (2, junk), (3, prose.replace(" ", "!! "))])).collect()}
    assert kept[1] == (True, [])
    assert kept[2][1] == ["symbols", "stop_words"]
    assert "shouting" in kept[3][1]


def test_ratios_of_stop_words_and_lines(documents):
    prose = "The house by the river was sold in the spring, and it is said that a new owner came with the first boat of may."
    texts = [prose.upper(), "the of " + "word " * 400, "\n".join([prose, "it is the end of that...", "and the \u2026 "]), "\n".join(f" - {w} the {w}x of" for w in prose.split()), "\n".join([f"* {prose}", prose + "\u2026 x"])]
    found = {r.doc_id: r.broken for r in judge(documents(enumerate(texts))).collect()}
    assert found == {0: [], 1: ["stop_words"], 2: ["open_lines"], 3: ["bullet_lines"], 4: []}


def test_no_rows(documents):
    assert judge(documents([])).count() == 0
