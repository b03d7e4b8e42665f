"""Tag text: words of titles and tags, tag formats, prompts and replies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from topicgrove.functions.text import WS_BODY, let, squeeze, strip_ws, word_runs

# Words that never name a cluster in keyword tags.
KEYWORD_STOP_WORDS = ["the", "and", "with", "for", "easy", "simple", "best", "how", "recipe", "make"]

# Words with little meaning in titles.
INSIGNIFICANT_WORDS = [
    "know", "need", "new", "com", "thing", "best", "do", "I", "is", "cause", "effect", "vs", "way",
    "come", "report", "say", "amp",
]

# English stop words without an apostrophe (Spark's own English list).
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom this "
    "that these those am is are was were be been being have has had having do does did doing a an "
    "the and but if or because as until while of at by for with about against between into through "
    "during before after above below to from up down in out on off over under again further then "
    "once here there when where why how all any both each few more most other some such no nor not "
    "only own same so than too very s t can will just don should now d ll m o re ve y ain aren "
    "couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan shouldn wasn weren won wouldn"
).split()

NO_KEYWORD_TAG = "unknown_topic"
NO_PARENT_TAG = "general_topic"
NO_SEED_TAG = "unnamed"


def _without(words: Column, stop: Sequence[str]) -> Column:
    return F.filter(words, lambda w: ~w.isin(*stop))


def keyword_words(title: Column) -> Column:
    """Plain a-z words of three letters or more, repeats kept."""
    plain = F.filter(word_runs(F.lower(title)), lambda w: w.rlike("^[a-z]{3,}$"))
    return _without(plain, KEYWORD_STOP_WORDS)


def tag_words(tag: Column) -> Column:
    """Parts of a tag longer than two characters."""
    return F.filter(F.split(F.lower(tag), f"[_{WS_BODY}-]"), lambda w: F.length(w) > 2)


def seed_tokens(document: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Terms for seed scoring: underscores split, two characters or more, no stop words."""
    words = word_runs(F.lower(F.translate(document, "_", " ")))
    return _without(F.filter(words, lambda w: F.length(w) > 1), stop_words)


def name_tokens(text: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Word tokens of a name; unlike ``seed_tokens`` an underscore is part of a word."""
    words = _without(word_runs(F.lower(text)), stop_words)
    return F.filter(words, lambda w: F.length(w) > 1)


def join_name(words: Column, n: int) -> Column:
    """First ``n`` different tokens as a tag."""
    tokens = F.slice(F.array_distinct(name_tokens(F.array_join(words, " "))), 1, n)
    joined = F.replace(F.array_join(tokens, "_"), F.lit("__"), F.lit("_"))
    return F.trim(F.replace(joined, F.lit("--"), F.lit("")), F.lit("_"))


def drop_insignificant_words(words: Column) -> Column:
    return _without(words, INSIGNIFICANT_WORDS)


def drop_words_with_digits(words: Column) -> Column:
    return F.filter(words, lambda w: ~w.rlike(r"\p{Nd}"))


def tag_format(text: Column) -> Column:
    """Lower case, spaces as underscores, none at the ends."""
    return F.trim(F.lower(F.translate(text, " ", "_")), F.lit("_"))


def summary_input(text: Column) -> Column:
    """Underscores as spaces, white space squeezed."""
    return squeeze(F.translate(text, "_", " "))


def first_n_title_words(title: Column, n: int) -> Column:
    return F.substring_index(squeeze(title), " ", n)


def candidate_title(title: Column, cleaner) -> Column:
    """A knowledge-base title without its disambiguation mark."""
    return strip_ws(F.replace(cleaner(F.lower(title)), F.lit("disambiguation"), F.lit("")))


def reply_topic(reply: Column) -> Column:
    """The first line of a reply up to its first full stop and comma."""
    line = F.substring_index(strip_ws(reply), "\n", 1)
    return strip_ws(F.substring_index(F.substring_index(line, ".", 1), ",", 1))


def reply_tag(topic: Column) -> Column:
    """At most three words of a reply topic as a tag."""
    plain = squeeze(F.regexp_replace(topic, r"[^\p{L}\p{N}_" + WS_BODY + "-]", ""))
    words = F.translate(F.substring_index(F.lower(plain), " ", 3), " ", "_")
    tag = let(words, lambda t: F.when(t == "", F.lit(NO_PARENT_TAG)).otherwise(t))
    return F.when(topic.isNull() | (topic == ""), F.lit(NO_KEYWORD_TAG)).otherwise(tag)


def _prompt(request: str, heading: str, items: Column, excluded: Column | None) -> Column:
    parts = [F.lit(f"{request}\n\n{heading}\n"), items]
    if excluded is not None:
        note = F.concat(F.lit("\n\nDo not answer with: "), excluded, F.lit("."))
        parts.append(F.coalesce(note, F.lit("")))
    return F.concat(*parts, F.lit("\nTopic:"))


def leaf_prompt(titles: Column, excluded: Column | None = None) -> Column:
    """Question for the topic of some titles; ``titles`` is an array."""
    request = "Name the common topic of these article titles in two to four words."
    return _prompt(request, "Titles:", F.array_join(titles, ". \n"), excluded)


def parent_prompt(child_tags: Column, excluded: Column | None = None) -> Column:
    """Question for the broader topic of some child tags; ``child_tags`` is an array."""
    request = "Name the broader topic that covers all of these tags in two to four words."
    return _prompt(request, "Tags:", F.array_join(child_tags, ", \n"), excluded)
