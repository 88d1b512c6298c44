import numpy as np
import pytest
from pyspark.sql import functions as F

from listing_analytics.operators import challenge, classify, term_scores
from listing_analytics.operators.regression import chances, fit_by_rows, fit_by_terms, idf_of

CORPUS = [("solve the captcha image now", "captcha"), ("captcha code wrong try again", "captcha"), ("enter code captcha", "captcha"),
          ("welcome to the market rules", "non-captcha"), ("vendor rules and market info pages", "non-captcha"),
          ("listing price vendor", "non-captcha"), ("the market forum", "non-captcha")]
CASES = [("please solve captcha code", True), ("wrong image", True), ("xyzzy qwerty", True), ("", True), ("market vendor rules", False), ("forum listing", False), ("info pages", False)]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(CORPUS, "text string, label string")


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame([(i, t, e) for i, (t, e) in enumerate(CASES)], "id int, text string, expected boolean")


def brute_weights():
    vocab = sorted({t for text, _ in CORPUS for t in text.split()})
    count = lambda label: np.array([sum(text.split().count(t) for text, lab in CORPUS if (lab == "captcha") == label) for t in vocab], float)
    share = lambda c: -np.log((c + 1) / (c + 1).sum())
    return vocab, share(count(False)), share(count(True))


def test_weights(corpus):
    vocab, w_challenge, w_content = brute_weights()
    got = {r.term: (r.w_challenge, r.w_content) for r in challenge.term_weights(corpus).collect()}
    assert sorted(got) == vocab
    assert np.allclose([got[t] for t in vocab], np.stack([w_challenge, w_content], 1))


def test_scoring(corpus, cases):
    scored = challenge.detect(cases, corpus)
    assert scored.columns == ["id", "text", "expected", "is_challenge"]
    assert {r.id: r.is_challenge for r in scored.collect()} == {i: e for i, (_, e) in enumerate(CASES)}
    content, diverted = challenge.split_challenges(scored)
    assert (content.count(), diverted.count()) == (3, 4)


@pytest.mark.parametrize("heavy", [1, 7, 1 << 40])
def test_every_row_is_scored_once(spark, monkeypatch, corpus, cases, heavy):
    """Whatever words are heavy, and with repeated rows, null keys and null texts."""
    monkeypatch.setattr(term_scores, "HEAVY", heavy)
    rows = cases.unionByName(cases).withColumn("id", F.when(F.col("id") > 1, F.col("id"))).unionByName(
        spark.createDataFrame([(99, None, True)], "id int, text string, expected boolean"))
    scored = challenge.detect(rows, corpus)
    assert scored.count() == 2 * len(CASES) + 1 and scored.filter("is_challenge <> expected").count() == 0


def test_heavy_words_are_few_and_no_vocabulary_meets_the_driver(spark, monkeypatch):
    monkeypatch.setattr(term_scores, "HEAVY", 5)
    texts = spark.range(300).select(F.concat(F.lit("the same word"), F.col("id")).alias("text"))
    weights = spark.range(300).select(F.concat(F.lit("word"), F.col("id")).alias("term"), F.lit(1.0).alias("w")).unionByName(
        spark.createDataFrame([("the", 2.0), ("same", 3.0)], "term string, w double"))
    scored = term_scores.score_texts(texts, weights, {"s": F.sum(F.col("tf") * F.col("w"))})
    assert {r.s for r in scored.collect()} == {6.0}
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "CountVectorizer" not in plan and "vector" not in plan and plan.count("broadcast") == 2


def test_weights_survive_storage(spark, corpus, cases, tmp_path):
    challenge.term_weights(corpus).write.parquet(str(tmp_path / "weights"))
    scored = challenge.score_by_weights(cases, spark.read.parquet(str(tmp_path / "weights")))
    assert scored.filter("is_challenge = expected").count() == len(CASES)


def test_phrases(spark):
    df = spark.createDataFrame([("Too many STRIKES",), ("ok",), (None,)], "html string")
    assert [r.hit for r in challenge.match_phrases(df, "html").collect()] == [True, False, False]


LISTINGS = [("red chair", "soft wood chair", "Home "), ("blue chair", "hard wood", "home"), ("lamp", "bright light bulb", "HOME"),
            ("novel", "paper story of wood", "books"), ("poems", "paper verse story", "Books"), ("essay", "story on paper", "books"),
            ("stool", "wood chair without back", "misc"), ("tale", "story verse", None), ("x", None, None), ("train", "toy engine", "toys"), ("kite", "toy wind", "toys")]


@pytest.fixture(scope="module")
def listings(spark):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(LISTINGS)], "id int, name string, description string, category string")


@pytest.fixture(scope="module")
def mapping(spark):
    return spark.createDataFrame([("home", "House"), ("books", "Paper"), ("TOYS ", "Fun")], "key string, value string")


def brute_tfidf(texts, stop):
    docs = [[t for t in text.split() if len(t) > 1 and t not in stop] for text in texts]
    vocab = sorted({t for d in docs for t in d})
    tf = np.array([[d.count(t) for t in vocab] for d in docs], float)
    idf = np.log((1 + len(docs)) / (1 + (tf > 0).sum(0))) + 1
    x = tf * idf
    return vocab, x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-300)


def test_tfidf(spark):
    texts = ["wood chair chair", "the wood lamp", "lamp light of lamp"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    stop = ["the", "of"]
    vocab, x = brute_tfidf(texts, stop)
    joined = {(r.id, r.term): r.weight for r in classify.tfidf_weights(df, "id", "text", stop).collect()}
    assert np.allclose([[joined.get((i, t), 0.0) for t in vocab] for i in range(3)], x)


def test_bounded_fit(spark):
    df = spark.createDataFrame([(f"a{i}", "x" if i % 2 else "y") for i in range(300)], "text string, broad_category string").repartition(5)
    assert classify.bounded(df, 300).count() == 300
    hashes = sorted(r.h for r in df.select(F.xxhash64("text", "broad_category").alias("h")).collect())
    for n in (1, 7, 299):
        kept = classify.bounded(df, n)
        assert sorted(r.h for r in kept.select(F.xxhash64("text", "broad_category").alias("h")).collect()) == hashes[:n]
        assert "TakeOrdered" not in kept._jdf.queryExecution().executedPlan().toString()


def test_bounded_fit_of_copies(spark):
    copies = spark.range(400).select(F.lit("same").alias("text"), F.lit("x").alias("broad_category"))
    few = spark.createDataFrame([(f"b{i}", "y") for i in range(20)], "text string, broad_category string")
    assert classify.bounded(copies, 30).count() == 30
    assert 30 >= classify.bounded(copies.unionByName(few), 30).filter("text = 'same'").count() >= 10


def test_classify(listings, mapping):
    rows = {r.id: r for r in classify.classify(listings, mapping, []).collect()}
    assert [rows[i].broad_category for i in range(6)] == ["House"] * 3 + ["Paper"] * 3
    assert [rows[i].is_predicted for i in range(11)] == [False] * 6 + [True] * 3 + [False] * 2
    assert (rows[6].broad_category, rows[7].broad_category) == ("House", "Paper")
    assert rows[8].broad_category in ("House", "Paper", "Fun")


def fitted(model, vocab):
    rows = {r.term: r.coefficients for r in model.terms.collect()}
    assert sorted(rows) == sorted(vocab)
    return np.array([rows[t] for t in vocab]).T, np.array(model.intercepts)


def test_regression_is_at_the_optimum(listings, mapping):
    """The gradient of the C = 1 objective vanishes at the fitted coefficients."""
    mapped = classify.map_category(listings, mapping).withColumn("text", F.concat_ws(" ", "name", "description"))
    known = classify.split_labelled(mapped)[0]
    model = classify.fit_category_model(known, [], tol=1e-9)
    rows = known.select("text", "broad_category").collect()
    vocab, x = brute_tfidf([r.text for r in rows], [])
    y = np.array([[r.broad_category == c for c in ("Fun", "House", "Paper")] for r in rows], float)
    w, b = fitted(model, vocab)
    z = x @ w.T + b
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    assert model.labels == ["Fun", "House", "Paper"]
    assert np.abs((p - y).T @ x + w).max() < 1e-6 and np.abs((p - y).sum(0)).max() < 1e-6
    scores = {r.text: r.scores for r in classify.category_scores(known, model).collect()}
    assert np.allclose([scores[r.text] for r in rows], z)


def test_regression_equals_the_library(spark):
    """Two labels, against Spark's solver on the same features."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choice(words[:20] if i % 3 else words[10:], 6)) for i in range(90)]
    labelled = spark.createDataFrame([(t, "yes" if i % 3 else "no") for i, t in enumerate(texts)], "text string, broad_category string")
    model = classify.fit_category_model(labelled, [], tol=1e-10)
    vocab, x = brute_tfidf(texts, [])
    w, b = fitted(model, vocab)
    frame = spark.createDataFrame([(Vectors.dense(row), float(i % 3 > 0)) for i, row in enumerate(x)], ["features", "label"])
    theirs = LogisticRegression(regParam=1 / 90, standardization=False, tol=1e-12, maxIter=1000).fit(frame)
    assert np.allclose(w[0], theirs.coefficients.toArray(), atol=1e-4) and np.allclose(b[0], theirs.intercept, atol=1e-4)


def test_one_label_or_none(spark):
    one = spark.createDataFrame([("a word", "only"), ("other word", "only")], "text string, broad_category string")
    model = classify.fit_category_model(one, [])
    assert {r.predicted_broad_category for r in classify.predict_category(one, model).collect()} == {"only"}
    with pytest.raises(ValueError):
        classify.fit_category_model(one.filter("text = ''"), [])


def test_search_ends_in_few_passes():
    """Against the coefficients themselves: a dense matrix as the product, both forms of the objective."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 40)) * (rng.random((200, 40)) < 0.2)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    for y in ((rng.random((200, 1)) < 0.2).astype(float), np.eye(4)[rng.integers(0, 4, 200)]):
        passes = []
        alpha, free = fit_by_rows(lambda v: passes.append(1) or x @ (x.T @ v), y, 1e-10, 1000)
        error = chances(x @ (x.T @ alpha) + free) - y
        assert len(passes) < 120
        assert np.abs(x.T @ error + x.T @ alpha).max() < 1e-6 and np.abs(error.sum(0)).max() < 1e-6


def test_terms_are_counted_where_a_text_is_read(spark):
    rows = spark.createDataFrame([(1, "wood wood the chair"), (1, "the lamp"), (2, None), (None, "")], "id int, text string").coalesce(1)
    lists = term_scores.term_lists(rows, ["id"], "text", ["the"])
    assert "Exchange" not in lists._jdf.queryExecution().executedPlan().toString()
    found = [(r.id, {(t.term, t.tf) for t in r.terms}) for r in lists.collect()]
    assert found == [(1, {("wood", 2), ("chair", 1)}), (1, {("lamp", 1)}), (2, set()), (None, set())]


def test_matrix_of_terms_in_blocks(spark, monkeypatch):
    """Products with all rows, whatever the size of the blocks."""
    from listing_analytics.operators import regression
    texts = ["wood chair chair", "the wood lamp", "lamp light of lamp", "", "chair"]
    vocab, x = brute_tfidf(texts, [])
    rows = spark.createDataFrame(list(enumerate(texts)), "row int, text string")
    entries = term_scores.term_lists(rows, ["row"], "text").select("row", F.inline("terms"))
    vector = np.arange(10.0).reshape(5, 2)
    for block, chunk in ((1 << 18, 1 << 14), (1, 2)):
        monkeypatch.setattr(regression, "_BLOCK", block)
        monkeypatch.setattr(regression, "_CHUNK", chunk)
        with regression.TermMatrix(entries, len(texts)) as matrix:
            assert np.allclose(matrix.product(vector), x @ (x.T @ vector))
            found = {r.term: r.coefficients for r in matrix.transposed(vector).collect()}
        assert np.allclose([found[t] for t in vocab], x.T @ vector)


def test_pairs_are_moved_without_names(spark, monkeypatch):
    """What is joined with the weights holds a number per row, not the name of its text; equal and null texts keep their sums."""
    moved, join = [], term_scores.join_weights
    monkeypatch.setattr(term_scores, "join_weights", lambda terms, weights: moved.append(terms.columns) or join(terms, weights))
    texts = spark.createDataFrame([(1, "red red blue"), (1, "red red blue"), (2, None), (3, "unknown")], "id int, text string")
    weights = spark.createDataFrame([("red", 1.0), ("blue", 10.0)], "term string, w double")
    scored = term_scores.score_texts(texts, weights, {"s": F.sum(F.col("tf") * F.col("w"))})
    assert sorted((r.id, r.s) for r in scored.collect()) == [(1, 12.0), (1, 12.0), (2, None), (3, None)]
    assert moved == [["row", "term", "tf"]]


def test_every_labelled_row_is_fitted(spark):
    """More rows than any bound that a fit once had (200,000): all weigh in the frequencies of the terms and in the optimum."""
    n = 200_300
    rows = spark.range(n).select(
        F.concat(F.lit("thing w"), F.col("id") % 50, F.when(F.col("id") == 7, " rare").otherwise("")).alias("text"),
        F.when(F.col("id") % 50 < 20 + F.col("id") % 3 * 8, "no").otherwise("yes").alias("broad_category"))
    model = classify.fit_category_model(rows, [], tol=1e-9)
    found = {r.term: r.idf for r in model.terms.collect()}
    assert len(found) == 52 and np.isclose(found["thing"], 1.0)
    assert np.isclose(found["w3"], idf_of(np.array([n // 50]), n)[0]) and np.isclose(found["rare"], idf_of(np.array([1]), n)[0])
    score = classify.category_scores(rows, model).select((1 / (1 + F.exp(-F.col("scores")[1]))).alias("p"))
    assert np.isclose(score.agg(F.sum("p")).first()[0], rows.filter("broad_category = 'yes'").count(), atol=0.01)


@pytest.mark.parametrize("labels", [2, 3])
def test_both_spaces_give_one_model(spark, monkeypatch, labels):
    """Fewer terms than rows or not; texts without terms, null texts, null labels and copies; blocks of any size."""
    from listing_analytics.operators import regression
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 25, rng.integers(0, 7))) for _ in range(120)]
    rows = [(t, f"c{rng.integers(0, labels)}") for t in texts] + [(None, "c0"), ("w1 w1 w2", None), *[("w3 " * 300, "c1")] * 3]
    df = spark.createDataFrame(rows, "text string, broad_category string").repartition(3).withColumn("n", F.lit(1))
    rows = classify.term_lists(df.filter("broad_category is not null").withColumn(
        "row_id", F.monotonically_increasing_id()).withColumn("label", F.substring("broad_category", 2, 1).cast("int")), ["row_id", "label"], "text")
    rows = classify.store(rows, "test-rows")
    counts = rows.groupBy("label", F.shiftright("row_id", 33).alias("part")).count().withColumnRenamed("count", "n").collect()
    scores = labels if labels > 2 else 1
    by_rows, free = classify._fit_by_rows(rows, counts, scores, 1e-8, 1000)
    expected = {r.term: (r.idf, *r.coefficients) for r in by_rows.collect()}
    for block in (1 << 18, 1):
        monkeypatch.setattr(regression, "_BLOCK", block)
        found, intercepts = classify._fit_by_terms(rows, 124, scores, 1e-8, 1000)
        found = {r.term: (r.idf, *r.coefficients) for r in found.collect()}
        assert sorted(found) == sorted(expected) and np.allclose([found[t] for t in expected], [*expected.values()], atol=1e-5)
        assert np.allclose(intercepts, free, atol=1e-5)


def test_search_by_terms_ends_in_few_passes():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 40)) * (rng.random((400, 40)) < 0.2)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    for y in ((rng.random((400, 1)) < 0.2).astype(float), np.eye(4)[rng.integers(0, 4, 400)]):
        passes = []

        def slopes(w, b):
            passes.append(1)
            error = chances(x @ w + b) - y
            return x.T @ error, error.sum(axis=0)

        w, b = fit_by_terms(slopes, 40, y.shape[1], 400, 1e-10, 1000)
        error = chances(x @ w + b) - y
        assert len(passes) < 80
        assert np.abs(x.T @ error + w).max() < 1e-6 and np.abs(error.sum(0)).max() < 1e-6


def test_a_pass_has_no_more_tasks_than_run_at_once(spark):
    """Each task hands on a number per row, however many partitions a shuffle has."""
    from listing_analytics.operators import regression
    rows = spark.createDataFrame([(0, "red"), (1, "blue chair")], "row int, text string")
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        with regression.TermMatrix(term_scores.term_lists(rows, ["row"], "text").select("row", F.inline("terms")), 2) as matrix:
            assert matrix.blocks.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_fewer_terms_than_rows_without_a_score_or_a_term(spark):
    one = spark.createDataFrame([("word", "only")] * 5, "text string, broad_category string")
    model = classify.fit_category_model(one, [])
    assert (model.labels, model.intercepts, model.terms.count()) == (["only"], [], 1)
    assert {r.predicted_broad_category for r in classify.predict_category(one, model).collect()} == {"only"}
    bare = spark.createDataFrame([(None, "a"), ("", "b"), ("", "b"), ("x", "b")], "text string, broad_category string")
    model = classify.fit_category_model(bare, [])
    assert model.terms.count() == 0 and np.isclose(model.intercepts[0], np.log(3), atol=1e-5)
