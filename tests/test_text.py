import html
from html.parser import HTMLParser

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from topicgrove.functions import tags as T
from topicgrove.functions import text as X
from topicgrove.functions import urls as U


def test_clean_html_golden(column):
    cases = {
        '<p>A&amp;B</p><script>x</script><div data-hed="<b>Hi</b>"></div>': "A&B Hi",
        "<p>one\ntwo</p>": "onetwo",
        None: "None",
        "a<!-- b > c -->d<style>p{}</style><template>t</template>": "a d",
        '<a title="x>y" href=\'q\'>L</a>tail<br/>z': "L tail z",
        "&#8217;&#x27;&amp;lt;&bogus;&nbsp;x": "’'&lt;&bogus;\xa0x",
        "back\\slash": "backslash",
        '<div data-description="Some <i>deep</i> text">in</div> out': "in out Some deep text",
        "<script>never closed": "",
        "3 < 4 <b>yes</b>": "3  < 4 yes",
    }
    assert column(list(cases), X.clean_html) == list(cases.values())


def test_clean_html_without_glue(column):
    assert column(["<p>one\ntwo</p>"], lambda t: X.clean_html(t, glue_newlines=False)) == ["one two"]


def test_clean_html_bytes(spark):
    rows = spark.createDataFrame([(b"<p>ok\xff\xfe</p>",)], "t binary")
    assert rows.select(X.clean_html_bytes(F.col("t"))).first()[0] == "ok"


class _Reader(HTMLParser):
    hidden = ("script", "style", "template")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes, self.inside = [], 0

    def handle_starttag(self, tag, attrs):
        self.inside += tag in self.hidden

    def handle_endtag(self, tag):
        self.inside -= tag in self.hidden

    def handle_data(self, data):
        if not self.inside and data.strip():
            self.nodes.append(data.strip())


def test_pages_read_as_an_html_parser_reads_them(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for row in pages.select("html", X.clean_html(F.col("html")).alias("text")).collect():
        reader = _Reader()
        reader.feed(row.html)
        assert row.text.split() == " ".join(reader.nodes).replace("\n", "").split()


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \t\n\x0b\x1c\x85\xa0 　é_9", max_size=12), min_size=1, max_size=20))
def test_words_follow_python_split(column, texts):
    assert column(texts, X.num_words) == [len(t.split()) for t in texts]
    assert column(texts, lambda t: X.first_n_words(t, 2)) == [" ".join(t.split()[:2]) for t in texts]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="x&;#l1t3ampgo4 ", max_size=14), min_size=1, max_size=20))
def test_closed_references_are_decoded_once(column, texts):
    import re

    def decode(match):
        known = match.group(1) in X.ENTITIES or re.fullmatch(r"#[0-9]{1,7}", match.group(1))
        code = match.group(1)[1:]
        if known and code.isdigit() and not (0 < int(code) <= 0xD7FF or 0xE000 <= int(code) <= 0x10FFFF):
            return match.group(0)
        if known and code.isdigit():
            return chr(int(code))
        return html.unescape(match.group(0)) if known else match.group(0)

    assert column(texts, X.decode_entities) == [re.sub("&([^&;]*);", decode, t) for t in texts]


def test_word_limits(column):
    texts = ["w " * 20, "w " * 21]
    assert column(texts, lambda t: X.is_min_text(X.num_words(t))) == [False, True]


@pytest.mark.parametrize(
    "site, dropped, strict",
    [
        ("panasonic.com", True, True),
        ("latestnews.com", True, False),
        ("localhost:8000", True, True),
        ("my.staging.site", True, True),
        ("example.com", False, False),
    ],
)
def test_dev_sites(column, site, dropped, strict):
    assert column([site], U.is_dev_site) == [dropped]
    assert column([site], lambda s: U.is_dev_site(s, strict=True)) == [strict]


def test_site_keeps_port_and_user(column):
    urls = ["http://u:p@a.com:80/x?y", "//b.org#q", "no url", "https://x.y", None]
    assert column(urls, U.site_of) == ["u:p@a.com:80", "b.org", "", "x.y", ""]


def test_recent_posts(column):
    def recent(title):
        return U.is_recent_post(F.lit(2021), title)

    assert column(["Best of 2015", "Best of 2010", "Style of 1987", "x\n2015"], recent) == [False, True, False, True]
    assert column(["2019-12-31T00"], lambda d: U.is_recent_post(U.year_of(d), F.lit("t"))) == [False]
    assert column(["bad"], U.year_of) == [None]


def test_reply_tags(column):
    replies = {
        "Machine learning, AI.\nsecond": "machine_learning",
        "Pet Care & Food Tips!": "pet_care_food",
        "U.S. history": "u",
        "": "unknown_topic",
        "!!!": "general_topic",
        "über große-Städte": "über_große-städte",
    }
    assert column(list(replies), lambda t: T.reply_tag(T.reply_topic(t))) == list(replies.values())


def test_tag_words_and_formats(column):
    assert column(["vegan_chili-7 ab"], T.tag_words) == [["vegan", "chili"]]
    assert column([" Big Cats "], T.tag_format) == ["big_cats"]
    assert column(["The crème Naïvely best Soup soup"], T.keyword_words) == [["soup", "soup"]]
    assert column(["Cat A 4th cat__x of"], lambda t: T.join_name(T.name_tokens(t), 4)) == ["cat_4th_cat_x"]
    assert column(["a_b  c" + "x" * 2000], T.summary_input) == ["a b c" + "x" * 2000]
    assert column(["Mercury (Disambiguation)"], lambda t: T.candidate_title(t, X.clean_html)) == ["mercury ()"]


def test_prompts_name_the_excluded_tag(column):
    def prompt(t):
        return T.leaf_prompt(F.array(t, F.lit("b")), F.when(t == "x", F.lit("old_tag")))

    with_note, without = column(["x", "y"], prompt)
    assert "x. \nb" in with_note and "old_tag" in with_note and with_note.endswith("Topic:")
    assert "old_tag" not in without


def test_text_without_markup_is_cleaned_without_a_search_for_it(column):
    assert "CASE WHEN" in str(X._hide(F.col("t")))
    assert column(["a > b \x01 c\\d\n", "x &amp; y", "", None], X.clean_html) == ["a >  b cd", "x & y", "", "None"]
