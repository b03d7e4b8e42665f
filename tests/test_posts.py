import json

import pytest
from pyspark.sql import functions as F

from topicgrove.operators.cleaning import clean_posts, drop_dev_sites, keep_first
from topicgrove.plans.tables import page_posts
from topicgrove.schema import require_columns, require_levels, validate_distances
from topicgrove.session import shared_dir, written
from topicgrove.sources import posts as S
from topicgrove.sources.sinks import write_csv, write_table

WORDS = " ".join(f"w{i}" for i in range(25))


def _raw(i, title="T", text=WORDS, link=None, date="2022-01-01T00:00:00"):
    return {
        "id": i,
        "date": date,
        "link": link or f"https://s.org/{i}",
        "title": {"rendered": title},
        "content": {"rendered": text},
        "extra": [1],
    }


def test_read_posts_from_landed_pages(spark, tmp_path):
    for site, posts in {"a": [_raw(1), _raw(2)], "b": [_raw(1, "U")], "empty": []}.items():
        folder = tmp_path / site
        folder.mkdir()
        (folder / "page1.json").write_text(json.dumps(posts))
    read = S.read_posts(spark, [str(tmp_path / s) for s in ("a", "b", "empty")])
    assert read.columns == ["text", "title", "url", "date", "id"]
    assert sorted((r.id, r.title) for r in read.collect()) == [(1, "T"), (1, "U"), (2, "T")]


def test_tables_survive_csv_and_parquet(spark, tmp_path):
    rows = spark.createDataFrame(
        [('say "hi",\nthere', "t", "u", "2020", 7)], "text string, title string, url string, date string, id long"
    )
    for _ in range(2):
        write_csv(rows, str(tmp_path / "c"))
        write_table(rows.withColumn("v", F.array(F.lit(1.5))), str(tmp_path / "p"))
    assert S.read_csv(spark, str(tmp_path / "c")).collect() == rows.collect()
    assert S.read_table(spark, str(tmp_path / "p")).first().v == [1.5]
    write_csv(rows.select(F.array("id").alias("v")), str(tmp_path / "v"))
    assert spark.read.csv(str(tmp_path / "v"), header=True).first().v == "[7]"


def test_seq_union_and_caps(spark):
    left = spark.range(50).select((F.col("id") * 7 % 50).alias("k"), F.lit("a").alias("site"))
    seen = S.with_seq(left, "k").orderBy("k").collect()
    assert [r.seq for r in seen] == list(range(50))
    both = S.union_sources([left, spark.range(2).select(F.col("id").alias("k"), F.lit(1).alias("more"))])
    assert both.count() == 52 and both.filter("more IS NULL").count() == 50
    capped = S.cap_per_site(S.with_seq(left, "k"), cap=3)
    assert sorted(r.k for r in capped.collect()) == [0, 1, 2]
    assert [r.seq for r in S.first_rows(S.with_seq(left, "k"), 2).collect()] == [0, 1]
    with pytest.raises(ValueError):
        S.union_sources([])


def test_keep_first_keeps_the_lowest_seq_of_a_dominant_key(spark):
    rows = spark.range(999, -1, -1).select(F.col("id").alias("seq"), F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(-1).alias("k"))
    kept = {r.k: r.seq for r in keep_first(rows, "k").collect()}
    assert kept[-1] == 0 and len(kept) == 667


def _clean(spark, posts):
    rows = [(i, p["content"]["rendered"], p["title"]["rendered"], p["link"], p["date"], p["id"]) for i, p in enumerate(posts)]
    table = spark.createDataFrame(rows, "seq long, text string, title string, url string, date string, id long")
    return clean_posts(table)


def test_clean_posts_in_order(spark):
    posts = [
        _raw(0, "Old", date="2019-05-05"),
        _raw(1, "Of 2015"),
        _raw(2, "Same", text=WORDS + " two"),
        _raw(3, "<b>Same</b>", text=WORDS + " three"),
        _raw(4, "Url", link="https://s.org/2", text=WORDS + " four"),
        _raw(5, "Short", text="too short"),
        _raw(6, "Copy", text="<p>" + WORDS + " two</p>"),
        _raw(7, "Dev", link="https://x.staging.org/7"),
        _raw(8, "Null", text=None),
        _raw(9, "Last", text=WORDS + " nine"),
        _raw(10, None, text=WORDS + " ten"),
    ]
    cleaned = _clean(spark, posts).orderBy("seq").collect()
    assert [(r.seq, r.title) for r in cleaned] == [(2, "Same"), (9, "Last"), (10, "None")]
    assert cleaned[0].site == "s.org" and cleaned[0].year_published == 2022 and cleaned[0].text_length == 26


def test_short_text_is_dropped_after_the_title_pass(spark):
    """A short first post still hides a long one with the same title."""
    assert _clean(spark, [_raw(0, "A", text="short"), _raw(1, "A")]).count() == 0


def test_text_is_cleaned_once(spark):
    """One plan gives the rows: the title and the text are cleaned once in it."""
    cleaned = clean_posts(page_posts(spark, "/root/testdata/sf0.001"), cleaner=lambda t: F.concat(t, F.lit("#mark")))
    plan = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("#mark") == 2


def test_long_texts_that_differ_late_both_stay(spark):
    same = "word " * 1500
    cleaned = _clean(spark, [_raw(0, "A", text=same + "one"), _raw(1, "B", text=same + "two"), _raw(2, "C", text=same + "two")])
    assert sorted(r.title for r in cleaned.collect()) == ["A", "B"]
    assert cleaned.agg(F.min("text_length")).first()[0] == 1501


def test_an_unreadable_page_ends_the_job(spark, tmp_path):
    (tmp_path / "good.json").write_text('[{"id": 1, "date": "2022", "link": "u", "title": {"rendered": "t"}, "content": {"rendered": "x"}}]')
    assert S.read_posts(spark, str(tmp_path)).count() == 1
    (tmp_path / "bad.json").write_text('[{"id": 2, "date": "2022", "li')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        S.read_posts(spark, str(tmp_path)).collect()


def test_dev_filter_needs_a_site(spark):
    assert drop_dev_sites(spark.range(3)).count() == 3


def test_guards(spark):
    with pytest.raises(ValueError, match="lacks title"):
        require_columns(spark.range(1), ["id", "title"])
    with pytest.raises(ValueError, match="topic_level_1_cluster_id"):
        require_levels(spark.range(1).select(F.lit("").alias("text"), F.lit("").alias("title"), F.lit("").alias("url")), 1)
    for bad in ([], [0.0], [-1], [1.26, 3.0], [2.0, 2.0], [float("nan")], [float("inf"), 1.0]):
        with pytest.raises(ValueError):
            validate_distances(bad)
    assert validate_distances((40, 1.26)) == [40.0, 1.26]


def test_written_tables_lie_in_the_shared_folder(spark):
    table = written(spark.range(4), "numbers")
    assert table.count() == 4 and shared_dir(spark) in table.inputFiles()[0]
