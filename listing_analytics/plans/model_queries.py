"""Queries over challenge detection (D) and category classification."""

from __future__ import annotations

from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listing_analytics.functions import text as tx
from listing_analytics.operators import challenge, classify
from listing_analytics.operators.shred import shred
from listing_analytics.plans.mart_queries import EVERYDAY_WORDS, _WORDS_SQL
from listing_analytics.plans.page_queries import NORMAL_SQL, PAGE_TEXT_SQL
from listing_analytics.plans import roles
from listing_analytics.plans.registry import query
from listing_analytics.plans.roles import LISTING_SQL, table
from listing_analytics.session import store

_PHRASES = ["token", "Password", "Stat"]
_TOKENS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]{{2,}}')"


@query("D1_match_phrases", """select doc_id, lower(text) like '%token%' or lower(text) like '%password%' or lower(text) like '%stat%' as hit
  from documents""")
def d1(spark, sf):
    return challenge.match_phrases(table(spark, sf, "documents"), "text", _PHRASES).select("doc_id", "hit")


@query("D2_word_counts", f"""select doc_id, token, count(*) as tf from (select doc_id, unnest({_TOKENS.format('text')}) as token from documents)
  group by 1, 2""")
def d2(spark, sf):
    return challenge.word_counts(table(spark, sf, "documents"), "doc_id")


_DOC_TEXT = NORMAL_SQL.format("text")
_WEIGHTS_SQL = f"""tok as (select toxic, unnest({_TOKENS.format(_DOC_TEXT)}) as token from documents join labels using (doc_id)),
  cnt as (select token, count(*) filter (toxic = 1) as nc, count(*) filter (toxic = 0) as nn from tok group by 1),
  tot as (select cast(sum(nc) + count(*) as double) as tc, cast(sum(nn) + count(*) as double) as tn from cnt),
  wt as (select token, -ln((nn + 1.0::double) / tn) as w_challenge, -ln((nc + 1.0::double) / tc) as w_content from cnt, tot)"""


def _corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a known label; toxic ones play the challenge pages."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return docs.select(tx.normalise_text(F.col("text")).alias("text"),
                       F.when(F.col("toxic") == 1, challenge.CHALLENGE).otherwise("non-captcha").alias("label"))


@query("D3_term_weights", f"with {_WEIGHTS_SQL} select token, round(w_challenge, 9) as w_challenge, round(w_content, 9) as w_content from wt")
def d3(spark, sf):
    weights = challenge.term_weights(_corpus(spark, sf))
    return weights.select(F.col("term").alias("token"), F.round("w_challenge", 9).alias("w_challenge"), F.round("w_content", 9).alias("w_content"))


def _scored_sql(source: str, key: str, text: str) -> str:
    return f"""{_WEIGHTS_SQL}, ptok as (select {key}, unnest({_TOKENS.format(text)}) as token from {source}),
    sc as (select {key}, sum(w_challenge) as c, sum(w_content) as n from ptok join wt using (token) group by 1),
    scored as (select {key}, coalesce(c, 0) >= coalesce(n, 0) as is_challenge from {source} left join sc using ({key}))"""


@query("D4_score_challenge", f"with {_scored_sql('documents', 'doc_id', _DOC_TEXT)} select * from scored")
def d4(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", tx.normalise_text(F.col("text")).alias("text"))
    return challenge.detect(docs, _corpus(spark, sf)).select("doc_id", "is_challenge")


@query("D4_score_by_weights", f"with {_scored_sql('documents', 'doc_id', _DOC_TEXT)} select * from scored")
def d4_join(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", tx.normalise_text(F.col("text")).alias("text"))
    weights = store(challenge.term_weights(_corpus(spark, sf)), "weights")
    return challenge.score_by_weights(docs, weights).select("doc_id", "is_challenge")


_PAGE_SCORES = _scored_sql("pt", "page_id", NORMAL_SQL.format("ptext")).replace(
    "tok as (", f"pt as (select page_id, {PAGE_TEXT_SQL} as ptext from pages), tok as (", 1)


@query("D5_split_challenges", f"with {_PAGE_SCORES} select page_id, case when is_challenge then 'challenge' else 'content' end as store from scored")
def d5(spark, sf):
    pages = shred(table(spark, sf, "pages"), nodes="none").select("page_id", tx.normalise_text(F.col("text")).alias("text"))
    pages = store(pages, "page-texts")  # shredded once
    scored = store(challenge.detect(pages, _corpus(spark, sf)).drop("text"), "scored-pages")
    content, rejected = challenge.split_challenges(scored)
    return content.select("page_id", F.lit("content").alias("store")).unionByName(
        rejected.select("page_id", F.lit("challenge").alias("store")))


_QUALITY_SQL = "case quality when 1 then 'keep' when 0 then 'drop' end"


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    """All documents; the quality label, where known, plays the broad category."""
    quality = F.when(F.col("quality") == 1, "keep").when(F.col("quality") == 0, "drop")
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").select(
        "doc_id", "text", quality.alias("broad_category"))


@query("F5_label_index", f"""select doc_id, {_QUALITY_SQL} as broad_category, cast(quality as double) as label,
  {_QUALITY_SQL} as decoded from labels""")
def f5(spark, sf):
    labelled = _labelled(spark, sf).filter("broad_category is not null").select("doc_id", "broad_category")
    index = StringIndexer(inputCol="broad_category", outputCol="label", stringOrderType="alphabetAsc").fit(labelled)
    decode = IndexToString(inputCol="label", outputCol="decoded", labels=index.labels)
    return decode.transform(index.transform(labelled)).select("doc_id", "broad_category", "label", "decoded")


@query("F6_tfidf_weights", f"""with t as (select doc_id, unnest({_TOKENS.format('text')}) as term from documents join labels using (doc_id)),
  tf as (select doc_id, term, count(*) as tf from t where term not in ({_WORDS_SQL}) group by 1, 2),
  idf as (select term, ln(((select count(*) from labels) + 1.0::double) / (count(*) + 1)) + 1 as idf from tf group by 1),
  w as (select doc_id, term, tf * idf as raw from tf join idf using (term))
  select doc_id, term, round(raw / sqrt(sum(raw * raw) over (partition by doc_id)), 9) as weight from w""")
def f6(spark, sf):
    labelled = _labelled(spark, sf).filter("broad_category is not null")
    return classify.tfidf_weights(labelled, "doc_id", "text", EVERYDAY_WORDS).withColumn("weight", F.round("weight", 9))


# Where the fit is at its optimum, the predicted probabilities of a class sum to its number of rows, as the intercept is
# not regularised.
@query("F7_fit_category_model", f"""select {_QUALITY_SQL} as broad_category, count(*) as n, round(count(*)::double, 6) as expected
  from labels join documents using (doc_id) group by 1""")
def f7(spark, sf):
    labelled = store(_labelled(spark, sf).filter("broad_category is not null"), "labelled")
    model = classify.fit_category_model(labelled, EVERYDAY_WORDS, tol=1e-11)
    scored = classify.category_scores(labelled, model)
    # The probabilities of the labels, in their order.
    exps = F.transform("scores", lambda s: F.exp(s - F.array_max("scores")))
    chances = scored.withColumn("e", exps).select("broad_category", F.posexplode("e").alias("at", "e1"), F.aggregate(
        "e", F.lit(0.0), lambda a, b: a + b).alias("whole"))
    name = F.element_at(F.array(*[F.lit(x) for x in model.labels]), F.col("at") + 1)
    return chances.withColumn("_class", name).groupBy(F.col("_class").alias("broad_category")).agg(
        F.count_if(F.col("broad_category") == F.col("_class")).alias("n"),
        F.round(F.sum(F.col("e1") / F.col("whole")), 6).alias("expected"))


# Listings whose text holds words that only listings of one business have: their prediction can be stated. Of every five
# lines one has no category of the dictionary.
_SHOP_SQL = f"""{LISTING_SQL.replace("as main_business", "as main_business, cast(l_orderkey * 8 + l_linenumber as bigint) as line")},
  shop as (select line, name, main_business, line % 5 = 0 as unknown from listing)"""


def _shop(spark: SparkSession, sf: str) -> DataFrame:
    rows = roles.listing(spark, sf, F.expr("cast(l_orderkey * 8 + l_linenumber as bigint) as line"))
    return rows.select(
        "line", "name", F.concat_ws(" ", F.lit("The best offer of"), "marketplace", "category", F.lit("type")).alias("description"),
        F.when(F.col("line") % 5 != 0, F.concat(F.lit(" "), F.upper("main_business"))).alias("category"))


def _dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """Written forms of the businesses that the listings have, with the name that all of them stand for."""
    return roles.listing(spark, sf).select(F.concat(F.lower("main_business"), F.lit(" ")).alias("key"), F.col("main_business").alias("value")).distinct()


@query("F8_predict_category", f"with {_SHOP_SQL} select line, main_business as predicted_broad_category from shop where unknown")
def f8(spark, sf):
    mapped = classify.map_category(_shop(spark, sf), _dictionary(spark, sf)).withColumn(
        "text", tx.listing_text(F.col("name"), F.col("description")))
    mapped = store(mapped.select("line", "text", "broad_category"), "shop")
    known, unknown = classify.split_labelled(mapped)
    return classify.predict_category(unknown, classify.fit_category_model(known, EVERYDAY_WORDS)).select("line", "predicted_broad_category")


@query("F9_classify", f"with {_SHOP_SQL} select line, name, main_business as broad_category, unknown as is_predicted from shop")
def f9(spark, sf):
    shop = store(_shop(spark, sf), "shop")
    return classify.classify(shop, _dictionary(spark, sf), EVERYDAY_WORDS).select("line", "name", "broad_category", "is_predicted")


@query("F9_classify_documents", f"""select doc_id, {_QUALITY_SQL} as known, quality is null as is_predicted, true as has_category
  from documents left join labels using (doc_id)""")
def f9_documents(spark, sf):
    docs = _labelled(spark, sf).select("doc_id", F.lit("").alias("name"), F.col("text").alias("description"),
                                       F.coalesce("broad_category", F.lit("no idea")).alias("category"))
    dictionary = docs.filter("category <> 'no idea'").select(
        F.col("category").alias("key"), F.col("category").alias("value")).distinct()
    result = classify.classify(docs, dictionary, EVERYDAY_WORDS)
    return result.select("doc_id", F.when(~F.col("is_predicted"), F.col("broad_category")).alias("known"),
                         "is_predicted", F.col("broad_category").isNotNull().alias("has_category"))
