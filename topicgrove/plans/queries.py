"""The registered queries: ``name -> function(spark, sf_dir)``."""

from __future__ import annotations

import uuid

from pyspark.ml.classification import NaiveBayes
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicgrove.functions import tags as T
from topicgrove.functions import text as X
from topicgrove.functions import urls as U
from topicgrove.operators import classify, cleaning, cut, embedding, nearest, projection, quality, review, silhouette, similar, single, ward
from topicgrove.operators.naming import base, centrality, extractive, gazetteer, generative, hypernym, keyword, search, tfidf
from topicgrove.plans import tables, taxonomy
from topicgrove.schema import cluster_column
from topicgrove.session import written, written_dir
from topicgrove.sources import posts as sources
from topicgrove.streaming import scoring

LEVELS = 2
CUTS = [2.5, 2.0]
CAP = 7


# Sources, predicates and text


def site_of_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.table(spark, sf_dir, "pages").select("page_id", U.site_of(F.col("url")).alias("site"))


def drop_dev_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = site_of_url(spark, sf_dir)
    return cleaning.drop_dev_sites(sites)


def year_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    year, title = U.year_of(F.col("date")), F.col("title")
    return tables.document_posts(spark, sf_dir).select(
        "seq",
        year.alias("year_published"),
        U.has_2010s_year(title).alias("is_2010s"),
        U.has_1900s_year(title).alias("is_1900s"),
        U.is_recent_post(year, title).alias("is_recent"),
    )


def recent_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.recent_posts(tables.page_posts(spark, sf_dir)).select(
        "seq", "url", "site", "title", "year_published"
    )


def clean_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.texts(spark, sf_dir, "pages", "page_id").select("page_id", X.clean_html(F.col("html")).alias("text"))


def first_n_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.texts(spark, sf_dir, "documents", "doc_id").select("doc_id", X.first_n_words(F.col("text"), 1000).alias("text"))


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.texts(spark, sf_dir, "documents", "doc_id").select("doc_id", X.num_words(F.col("text")).alias("text_length"))


def article_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.embedding_text(tables.document_posts(spark, sf_dir)).select("seq", "embedding_text")


def dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = tables.document_posts(spark, sf_dir).select("seq", "title", "url", "text")
    survivors = written(cleaning.first_of_each(posts.drop("text"), "title", "url").select("seq"), "survivors")
    long = posts.join(survivors, "seq", "left_semi").filter(X.is_min_text(X.num_words(F.col("text"))))
    return cleaning.first_texts(long).select("seq", "title", "url")


def clean_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = cleaning.clean_posts(tables.page_posts(spark, sf_dir))
    return cleaned.select("seq", "url", "site", "title", "text", "year_published", "text_length")


def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables.page_posts(spark, sf_dir).select("id", "url", "date", U.site_of(F.col("url")).alias("site"))
    documents = tables.document_posts(spark, sf_dir).select("id", "url", "date", "title")
    return sources.union_sources([pages, documents])


def cap_per_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = tables.document_posts(spark, sf_dir).select("seq", "site", "url")
    return sources.cap_per_site(posts, CAP)


def numbered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables.table(spark, sf_dir, "pages").select("url", "page_id")
    return sources.with_seq(pages, "url", "page_id")


# Tags: words, formats, prompts


def _documents(spark: SparkSession, sf_dir: str, level: int = LEVELS) -> DataFrame:
    return base.titles_of_level(tables.document_posts(spark, sf_dir), level)


def title_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.col("title")
    tokens = T.name_tokens(title)
    lists = {
        "keywords": T.keyword_words(title),
        "tokens": tokens,
        "significant": T.drop_insignificant_words(tokens),
        "without_digits": T.drop_words_with_digits(tokens),
    }
    return tables.document_posts(spark, sf_dir).select(
        "seq", *[F.array_join(words, " ").alias(name) for name, words in lists.items()]
    )


def clean_title_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    lemmas = tables.lexicon(spark, sf_dir).filter("sense_rank = 1").select("word", "lemma")
    return tfidf.clean_title_terms(tables.document_posts(spark, sf_dir), "title", "seq", lemmas)


def tag_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.col("title")
    return tables.document_posts(spark, sf_dir).select(
        "seq",
        T.tag_format(title).alias("tag"),
        F.array_join(T.tag_words(T.tag_format(title)), " ").alias("parts"),
        T.summary_input(F.col("text")).alias("summary_input"),
        T.candidate_title(title, X.clean_html).alias("candidate"),
    )


def parse_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = T.reply_topic(F.col("text"))
    return tables.texts(spark, sf_dir, "documents", "doc_id").select(
        "doc_id", topic.alias("topic"), T.reply_tag(topic).alias("tag")
    )


def leaf_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    slices = generative.title_slices(_documents(spark, sf_dir))
    return slices.select("cluster_id", "slice", T.leaf_prompt(F.col("items")).alias("prompt"))


def parent_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = tables.document_posts(spark, sf_dir)
    tags = tfidf.names_from_seeds(tfidf.seed_words(_documents(spark, sf_dir), "title", tfidf.NAME_WORDS))
    children = base.child_tags(base.cluster_tree(posts, LEVELS), tags, 1)
    slices = generative.tag_slices(children)
    return slices.select("cluster_id", "slice", T.parent_prompt(F.col("items")).alias("prompt"))


# Naming


def keyword_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = keyword.word_counts(_documents(spark, sf_dir), T.keyword_words(F.col("title")))
    return counts.select("cluster_id", "word", "count", F.col("first_place.seq").alias("first_seq"), F.col("first_place.pos").alias("first_pos"))


def keyword_tags_leaf(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = keyword.leaf_candidates(_documents(spark, sf_dir))
    return candidates.select("cluster_id", F.array_join("candidates", " ").alias("candidates"))


def parent_keyword_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = tables.document_posts(spark, sf_dir)
    leaf = keyword.leaf_candidates(_documents(spark, sf_dir)).filter("candidates IS NOT NULL")
    first = leaf.select("cluster_id", F.get("candidates", F.lit(0)).alias("tag"))
    children = base.child_tags(base.cluster_tree(posts, LEVELS), first, 1)
    candidates = keyword.parent_candidates(children)
    return candidates.select("cluster_id", F.array_join("candidates", " ").alias("candidates"))


def unique_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = base.tags_by_level(tables.document_posts(spark, sf_dir), LEVELS, keyword.KEYWORD_NAMER)
    leveled = [t.select(F.lit(level).alias("level"), "cluster_id", "tag") for level, t in tags.items()]
    return sources.union_sources(leveled)


def tfidf_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = written(tfidf.term_counts(_documents(spark, sf_dir), "title"), "terms")
    return tfidf.seeds_from_counts(counts, 5).withColumn("score", F.round("score", 6))


def _tfidf_leaf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.tfidf_namer().leaf(_documents(spark, sf_dir))


def tfidf_tags_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = tables.document_posts(spark, sf_dir)
    children = base.child_tags(base.cluster_tree(posts, LEVELS), _tfidf_leaf(spark, sf_dir), 1)
    return tfidf.tfidf_namer().parent(None, children, None)


def gazetteer_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gazetteer.gazetteer_namer(tables.concepts(spark, sf_dir)).leaf(_documents(spark, sf_dir))


def gazetteer_tags_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gazetteer.gazetteer_namer(tables.concepts(spark, sf_dir)).parent(_documents(spark, sf_dir, 1), None, None)


def gazetteer_tags_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    concepts = tables.concepts(spark, sf_dir)
    return gazetteer.gazetteer_namer(concepts, search.ranked_titles).leaf(_documents(spark, sf_dir))


def ranked_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best concept title for each different word of the documents' titles."""
    titles = tables.document_posts(spark, sf_dir)
    words = titles.select(F.explode(X.word_runs(F.lower("title"))).alias("word")).distinct()
    return search.ranked_titles(words, tables.concepts(spark, sf_dir)).withColumn("score", F.round("score", 6))


def title_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best concept title for each document's title, asked with all its words."""
    titles = tables.document_posts(spark, sf_dir)
    queries = titles.select(F.col("seq").alias("query_id"), X.word_runs(F.lower("title")).alias("words"))
    return search.best_title_of_words(queries, tables.concepts(spark, sf_dir)).withColumn("score", F.round("score", 6))


def hypernym_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = tfidf.seed_words(_documents(spark, sf_dir), "title", 5)
    return hypernym.rank_hypernyms(seeds, tables.lexicon(spark, sf_dir)).withColumn("score", F.round("score", 6))


def central_title_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    central = extractive.central_titles(base.titles_of_level(tables.embedded_posts(spark, sf_dir), LEVELS))
    tagged = central.join(extractive.title_tags(central), "cluster_id")
    return tagged.select("cluster_id", "title", "tag", F.round("distance", 6).alias("distance"))


def _centrality_leaf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centrality.centrality_namer().leaf(_documents(spark, sf_dir))


def centrality_tags_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = base.cluster_tree(tables.document_posts(spark, sf_dir), LEVELS)
    children = base.child_tags(tree, written(_centrality_leaf(spark, sf_dir), "leaf-tags"), 1)
    return centrality.centrality_namer().parent(None, children, None)


def generated_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    def last_title(prompts, temperatures):
        return prompts.str.split("\n").str[-2]

    return generative.generative_namer(last_title).leaf(_documents(spark, sf_dir))


# Review


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.name_clusters(tables.document_posts(spark, sf_dir), LEVELS, keyword.KEYWORD_NAMER)


def review_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.review(_tagged(spark, sf_dir), LEVELS)


def review_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.review(_tagged(spark, sf_dir), LEVELS, rollup=True)


def review_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.review_subset(_tagged(spark, sf_dir), LEVELS, level=1, cluster_ids=[1, 3])


def titles_in_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.titles_in_cluster(_tagged(spark, sf_dir), level=2, cluster_id=3)


def rename_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = base.rename_cluster(_tagged(spark, sf_dir), 2, 3, "chosen_name")
    return renamed.select("seq", "topic_level_2_cluster_id", "topic_level_2")


def rename_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = _tagged(spark, sf_dir)
    names = tagged.filter("topic_level_2_cluster_id % 2 = 0").groupBy(
        F.col("topic_level_2_cluster_id").alias("cluster_id")
    ).agg(F.max(F.concat(F.lit("new_"), "site")).alias("tag"))
    return base.rename_clusters(tagged, 2, names).select("seq", "topic_level_2_cluster_id", "topic_level_2")


def topic_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = _tagged(spark, sf_dir)
    leaves = tables.table(spark, sf_dir, "embeddings").select("vec_id", (F.col("label") + 1).alias(cluster_column(2)))
    paths = review.topic_paths(leaves, review.topic_tree(tagged, LEVELS), LEVELS)
    return paths.select("vec_id", cluster_column(2), cluster_column(1), "topic_path")


def parents_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaves = tables.table(spark, sf_dir, "embeddings").select("vec_id", (F.col("label") + 1).alias(cluster_column(2)))
    found = review.parents_of(tables.document_posts(spark, sf_dir), leaves, 2)
    return found.select("vec_id", F.array_join(F.transform("parents", lambda p: p.cast("string")), ",").alias("parents"))


def tag_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.tag_overlap(_tagged(spark, sf_dir), LEVELS)


def similar_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(similar.similar_tags(_tagged(spark, sf_dir), LEVELS, 20), "similarity")


def similar_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of each source that share six tenths of their words."""
    posts = tables.document_posts(spark, sf_dir)
    sets = posts.select(F.col("seq").alias("id"), "site", X.word_runs(F.lower("title")).alias("words"))
    classes = written(similar.word_set_classes(sets, "site"), "title-sets")
    return similar.similar_classes(classes, "site", 60).select("site", "first", "other", "shared", "total")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def size_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = quality.size_distribution(_tagged_by_language(spark, sf_dir), LEVELS)
    return _rounded(posts, "mean_urls", "stddev_urls", "skewness", "kurtosis")


def _tagged_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents clustered by language and, below it, by the number of digits of their length."""
    language = F.ascii("lang") * 256 + F.ascii(F.substring("lang", 2, 1))
    length = F.length(F.col("n_chars").cast("string"))
    return tables.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("https://"), "source", F.lit(".example.org/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("source").alias("site"),
        language.alias("topic_level_1_cluster_id"),
        F.col("lang").alias("topic_level_1"),
        (language * 10 + length).alias("topic_level_2_cluster_id"),
        F.concat_ws("_", "lang", length.cast("string")).alias("topic_level_2"),
    )


def site_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(quality.site_coverage(_tagged_by_language(spark, sf_dir), LEVELS), "mean_sites")


# Vectors


def nearest_neighbour(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = tables.vectors(spark, sf_dir).select(
        "id", F.lit(1).cast("long").alias("size"), F.col("text_embedding").cast("array<double>").alias("centroid")
    )
    found = ward.nearest_neighbours(points, points, points.count())
    return found.select("id", "neighbour", F.round("height", 6).alias("distance"))


def silhouette_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(silhouette.silhouette(tables.vectors(spark, sf_dir), "label"), "silhouette")


def silhouette_squared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(silhouette.silhouette(tables.vectors(spark, sf_dir), "label", squared=True), "silhouette")


def _tree(spark: SparkSession, sf_dir: str) -> taxonomy.MergeTree:
    points = tables.vectors(spark, sf_dir).withColumnRenamed("id", "seq")
    return taxonomy.grow_tree(points)


def ward_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_tree(spark, sf_dir).merges, "height")


def dendrogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(cut.dendrogram(_tree(spark, sf_dir).merges), "height")


def leaf_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = _tree(spark, sf_dir)
    return cut.leaf_order(tree.merges, tree.leaves).select("id", "place")


def cut_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tree(spark, sf_dir).cut(CUTS).select("seq", "topic_level_1_cluster_id", "topic_level_2_cluster_id")


def cluster_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = _tree(spark, sf_dir)
    return cut.cluster_counts(tree.merges, tree.leaves, CUTS)


def sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_tree(spark, sf_dir).sweep(), "distance")


def sweep_squared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_tree(spark, sf_dir).sweep(squared=True), "distance")


def single_linkage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single.single_linkage(tables.vectors(spark, sf_dir), [1.15, 1.0], "text_embedding")


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = extractive.centroids(tables.vectors(spark, sf_dir), "label")
    return means.select("label", F.posexplode("centroid").alias("dimension", "value")).withColumn(
        "value", F.round("value", 6)
    )


def nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = tables.vectors(spark, sf_dir)
    middles = written(extractive.centroids(points, "label"), "centroids")
    found = nearest.nearest_centroid(points, middles)
    return found.select("id", "label", "nearest", F.round("distance", 6).alias("distance"))


def embed_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.embed(tables.document_posts(spark, sf_dir)).select("seq", "text_embedding")


def projected_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projected tf-idf vectors of all documents, a row per dimension, to four decimals."""
    texts = embedding.embedding_text(tables.document_posts(spark, sf_dir)).select("seq", "embedding_text")
    vectors = projection.project(texts)
    return vectors.select("seq", F.posexplode("text_embedding").alias("dimension", "value")).withColumn(
        "value", F.round(F.col("value").cast("double"), 4)
    )


def split_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = tables.document_posts(spark, sf_dir).select("seq", "url", cluster_column(2))
    return classify.split_stratified(posts, cluster_column(2))


def classifier_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = tables.vectors(spark, sf_dir).withColumn("url", F.col("id").cast("string"))
    split = classify.split_stratified(posts, "label")
    model = classify.fit_model(split.filter("NOT is_test"), "label")
    test = split.filter("is_test")
    scored = model.predict(test.withColumnRenamed("label", "truth"))
    return scored.agg(F.count("*").alias("rows"), F.avg((F.col("truth") == F.col("label")).cast("double")).alias("accuracy"))


# Whole jobs


def taxonomy_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages cleaned, embedded, merged, cut twice, named by keywords and reviewed."""
    posts = cleaning.clean_posts(tables.page_posts(spark, sf_dir))
    return review.review(taxonomy.build_taxonomy(posts, [1.6, 1.3]), LEVELS)


def _folder(spark: SparkSession) -> str:
    return f"{written_dir(spark)}/{uuid.uuid4().hex}"


def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents landed as JSON pages of at most 100 posts, one array each, read back."""
    posts = tables.document_posts(spark, sf_dir)
    raw = F.struct(
        "id",
        "date",
        F.col("url").alias("link"),
        F.struct(F.col("title").alias("rendered")).alias("title"),
        F.struct(F.col("text").alias("rendered")).alias("content"),
    )
    pages = posts.groupBy(F.floor(F.col("id") / 100).alias("page")).agg(F.to_json(F.collect_list(raw)).alias("value"))
    path = _folder(spark)
    pages.write.partitionBy("page").text(path)
    return sources.read_posts(spark, path)


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents saved as CSV with line breaks and quotes inside, read back."""
    path = _folder(spark)
    tables.document_posts(spark, sf_dir).select("text", "title", "url", "date", "id").write.csv(path, header=True, escape='"', quoteAll=True)
    return sources.read_csv(spark, path)


def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.first_rows(tables.document_posts(spark, sf_dir).select("seq", "url"), 20)


# Streaming


def _page_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = tables.table(spark, sf_dir, "pages").schema
    pages = spark.readStream.schema(schema).parquet(f"{sf_dir}/pages.parque[t]")
    return pages.select(
        F.col("page_id").alias("seq"),
        "url",
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.col("html").alias("text"),
        F.concat((F.lit(2017) + F.col("page_id") % 8).cast("string"), F.lit("-06-01T08:00:00")).alias("date"),
    )


def _streamed(rows: DataFrame) -> DataFrame:
    """What a stream has written when all its input has been read."""
    base_path = _folder(rows.sparkSession)
    scoring.write_stream(rows, f"{base_path}/posts", f"{base_path}/progress").awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{base_path}/posts")


def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages read as a stream, cleaned and written; the written rows come back."""
    columns = ["seq", "site", "title", "text", "year_published", "text_length"]
    return _streamed(scoring.clean_stream(_page_stream(spark, sf_dir)).select(*columns))


def stream_republished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites of streamed posts, each once: posts are told apart by their site instead of their whole URL."""
    posts = _page_stream(spark, sf_dir).select(U.site_of(F.col("url")).alias("url"), F.lit("2022-06-01T08:00:00").alias("date"))
    return _streamed(scoring.drop_republished(posts).select("url"))


def stream_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New pages filed under the topics of a classifier fitted on the documents, with full topic paths."""
    documents = tables.document_posts(spark, sf_dir).filter(F.col(cluster_column(2)).isNotNull())
    encoder, embedded = embedding.fit_and_embed(documents.select("seq", "title", "text", cluster_column(2)))
    model = classify.fit_model(embedded, cluster_column(2), model=NaiveBayes(modelType="gaussian"))
    tree = written(review.topic_tree(_tagged(spark, sf_dir), LEVELS), "tree")
    pages = scoring.clean_stream(_page_stream(spark, sf_dir))
    return _streamed(scoring.score_stream(pages, encoder, model, tree, LEVELS).select("seq", cluster_column(2), "topic_path"))


QUERIES = {
    "site_of_url": site_of_url,
    "drop_dev_sites": drop_dev_sites,
    "year_predicates": year_predicates,
    "recent_posts": recent_posts,
    "clean_pages": clean_pages,
    "first_n_words": first_n_words,
    "word_count": word_count,
    "article_text": article_text,
    "dedupe_keep_first": dedupe_keep_first,
    "clean_posts": clean_posts,
    "union_sources": union_sources,
    "cap_per_site": cap_per_site,
    "numbered_rows": numbered_rows,
    "title_words": title_words,
    "clean_title_terms": clean_title_terms,
    "tag_formats": tag_formats,
    "parse_reply": parse_reply,
    "leaf_prompts": leaf_prompts,
    "parent_prompts": parent_prompts,
    "keyword_counts": keyword_counts,
    "keyword_tags_leaf": keyword_tags_leaf,
    "parent_keyword_tags": parent_keyword_tags,
    "unique_tags": unique_tags,
    "tfidf_seeds": tfidf_seeds,
    "tfidf_tags_leaf": _tfidf_leaf,
    "tfidf_tags_parent": tfidf_tags_parent,
    "gazetteer_tags": gazetteer_tags,
    "gazetteer_tags_parent": gazetteer_tags_parent,
    "gazetteer_tags_ranked": gazetteer_tags_ranked,
    "ranked_titles": ranked_titles,
    "title_search": title_search,
    "hypernym_tags": hypernym_tags,
    "central_title_tags": central_title_tags,
    "centrality_tags_leaf": _centrality_leaf,
    "centrality_tags_parent": centrality_tags_parent,
    "generated_tags": generated_tags,
    "review": review_table,
    "review_rollup": review_rollup,
    "review_subset": review_subset,
    "titles_in_cluster": titles_in_cluster,
    "rename_cluster": rename_cluster,
    "rename_clusters": rename_clusters,
    "topic_paths": topic_paths,
    "parents_of": parents_of,
    "tag_overlap": tag_overlap,
    "similar_tags": similar_tags,
    "similar_titles": similar_titles,
    "size_distribution": size_distribution,
    "site_coverage": site_coverage,
    "nearest_neighbour": nearest_neighbour,
    "silhouette": silhouette_score,
    "silhouette_squared": silhouette_squared,
    "ward_merges": ward_merges,
    "dendrogram": dendrogram,
    "leaf_order": leaf_order,
    "cut_levels": cut_levels,
    "cluster_counts": cluster_counts,
    "sweep": sweep,
    "sweep_squared": sweep_squared,
    "single_linkage": single_linkage,
    "centroids": centroids,
    "nearest_centroid": nearest_centroid,
    "embed_posts": embed_posts,
    "projected_posts": projected_posts,
    "split_stratified": split_stratified,
    "classifier_scores": classifier_scores,
    "taxonomy_review": taxonomy_review,
    "json_round_trip": json_round_trip,
    "csv_round_trip": csv_round_trip,
    "first_rows": first_rows,
    "stream_clean": stream_clean,
    "stream_republished": stream_republished,
    "stream_scored": stream_scored,
}
