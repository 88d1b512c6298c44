import csv
import json
import random
from collections import defaultdict

import pytest

from pyspark.sql import functions as F

from listing_analytics import schemas
from listing_analytics.operators.clean import dedup_keep_first
from listing_analytics.sources import linkmap, pages, records, sinks


def test_page_files(spark, tmp_path):
    (tmp_path / "abc.html").write_text("<p>é</p>", encoding="utf-8")
    (tmp_path / "bad.html").write_bytes(b"<p>\xff\xfe</p>")
    (tmp_path / "map.json").write_text("{}")
    rows = {r.url_hash: r.html for r in pages.read_page_files(spark, str(tmp_path)).collect()}
    assert rows == {"abc": "<p>é</p>", "bad": None}
    latin = {r.url_hash: r.html for r in pages.read_page_files(spark, str(tmp_path), "ISO-8859-1").collect()}
    assert latin["bad"] == "<p>ÿþ</p>"


def test_labelled_files(spark, tmp_path):
    for label in ("captcha", "non_captcha"):
        (tmp_path / label).mkdir()
        (tmp_path / label / "one page.html").write_text(f"<p>{label}</p>")
    rows = {r.label: r.text for r in pages.read_labelled(spark, str(tmp_path)).collect()}
    assert rows == {"captcha": "<p>captcha</p>", "non_captcha": "<p>non_captcha</p>"}


def test_csv_dialect_and_order(spark, tmp_path):
    rows = [["a", 'say "hi", ok', "1"], ["b", "two\nlines", "2"], ["a", "", "3"]]
    with open(tmp_path / "x.csv", "w", newline="") as f:
        csv.writer(f).writerows([["name", "text", "n"], *rows])
    df = records.read_records(spark, str(tmp_path / "x.csv"), schemas._strings("name", "text", "n"))
    assert [tuple(r) for r in df.orderBy("source_file", "row_ord").select("name", "text", "n").collect()] == [
        ("a", 'say "hi", ok', "1"), ("b", "two\nlines", "2"), ("a", None, "3")]
    assert df.first().source_file.endswith("x.csv")
    assert {r.n for r in dedup_keep_first(df, ["name"], ["source_file", "row_ord"]).collect()} == {"1", "2"}


def builtin_rows(spark, path, schema):
    return (spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path))


@pytest.fixture(params=["17", "64", "1000000"])
def block_bytes(spark, request):
    """Files in so small blocks that rows, cells and entries lie across several."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
    old = {n: spark.conf.get(n, None) for n in names}
    for n, v in zip(names, (request.param, "1", "1")):
        spark.conf.set(n, v)
    yield int(request.param)
    for n, v in old.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


CELLS = ["a", "", "two\nlines", 'say "hi"', 'x,y', '"', '""', "\n\n", "é日\n", "a\r\nb", ",\n\"", "plain text", "1.5", " lead", "tail ", "n\n,\n"]


def test_csv_is_read_by_many_tasks_as_the_builtin_reader_reads_it(spark, tmp_path, block_bytes):
    rng = random.Random(3)
    schema = schemas._strings("name", "text", "n")
    for i, ending in enumerate(("\n", "\r\n")):
        for k in range(3):
            with open(tmp_path / f"{i}{k}.csv", "w", newline="", encoding="utf-8") as f:
                writer = csv.writer(f, lineterminator=ending, quoting=csv.QUOTE_ALL if k == 1 else csv.QUOTE_MINIMAL)
                writer.writerow(["name", "text" if i else "te\nxt", "n"])  # the built-in reader takes its line end from the first one
                for row in range(14):
                    # In files with carriage returns the built-in reader takes them out of cells, too.
                    cells = [c for c in CELLS if not (i and "\r" in c)]
                    writer.writerow([rng.choice(cells) for _ in range(3 if k != 2 else rng.randint(1, 4))])
    got = records.read_records(spark, str(tmp_path), schema)
    rows = lambda df: sorted((r.source_file.rsplit("/")[-1], r.row_ord, r.name, r.text, r.n) for r in df.collect())
    mine = defaultdict(list)
    for name, _, *cells in sorted(rows(got), key=lambda r: r[:2]):
        mine[name].append(tuple(cells))
    for file in sorted(tmp_path.iterdir()):
        assert mine[file.name] == [tuple(r) for r in builtin_rows(spark, str(file), schema).collect()], file.name


@pytest.mark.parametrize("text", [
    'n,t,x\na,"never closed\nb,c,d', 'n,t,x\na,b"c,d\ne"f,g,h\n', '\n\nn,t,x\n\na,b,c\n\n\nd,e,f', 'n,t,x\n"a"b"c,d,e\nf,g,h\n', "n,t,x",
    'n,t,x\n"a\nb""",""",\n""",c\nx,,\n,,\n', ""])
def test_csv_with_odd_quotes_and_ends(spark, tmp_path, text):
    (tmp_path / "x.csv").write_text(text)
    schema = schemas._strings("n", "t", "x")
    want = [tuple(r) for r in builtin_rows(spark, str(tmp_path / "x.csv"), schema).collect()]
    for size in ("5", "1000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = records.read_records(spark, str(tmp_path / "x.csv"), schema).orderBy("row_ord").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert [tuple(r)[:3] for r in got] == want


def test_large_csv_is_split(spark, tmp_path, block_bytes):
    (tmp_path / "x.csv").write_text("n\n" + '"a\nb"\n' * 60)
    rows = records.read_records(spark, str(tmp_path / "x.csv"), schemas._strings("n"))
    assert rows.count() == 60 and {r.n for r in rows.collect()} == {"a\nb"}
    tasks = spark.read.text(str(tmp_path / "x.csv")).rdd.getNumPartitions()
    assert tasks >= 360 // block_bytes


def test_linkmap_in_blocks(spark, tmp_path, block_bytes):
    """URLs with brackets, quotes and backslashes, in all written forms."""
    rng = random.Random(9)
    odd = ["u", "http://h/{x}", 'q"uote', "back\\slash", "}}{{", '\\"}', "é日", "a,b:c", "", "tab\t"]
    url = lambda: rng.choice(odd) + str(rng.randrange(100))
    whole = {f"h{i}": {"original": url(), "children": {f"c{j}": url() for j in range(rng.randint(0, 4))}} for i in range(16)}
    want = {(h, p["original"], c, u) for h, p in whole.items() for c, u in (p["children"] or {None: None}).items()}
    for name, text in {"one": json.dumps(whole), "indent": json.dumps(whole, indent=3), "raw": json.dumps(whole, ensure_ascii=False) + "\n",
                       "lines": "\n".join(json.dumps({k: v}) for k, v in whole.items()),
                       "pairs": "\n".join(json.dumps(dict(list(whole.items())[i:i + 2])) for i in range(0, 16, 2)) + "\n\n"}.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
        edges = linkmap.read_linkmap(spark, str(tmp_path / name)).collect()
        assert {tuple(r) for r in edges} == want and len(edges) == len(want), name
    (tmp_path / "empty").write_text("{}\n")
    assert linkmap.read_linkmap(spark, str(tmp_path / "empty")).collect() == []
    (tmp_path / "cut").write_text(json.dumps(whole)[:-60])
    cut = linkmap.read_linkmap(spark, str(tmp_path / "cut"), str(tmp_path / "rejects"))
    assert {tuple(r) for r in cut.collect()} < want and spark.read.parquet(str(tmp_path / "rejects")).count() == 1


def test_mapping_and_linkmap(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"x": "1", "y": "2"}, indent=2))
    assert {tuple(r) for r in records.read_mapping(spark, str(tmp_path / "m.json")).collect()} == {("x", "1"), ("y", "2")}
    whole = {"h1": {"original": "u1", "children": {"h2": "u2", "h3": "u3"}}, "h4": {"original": "u4", "children": {}}}
    (tmp_path / "net.json").write_text(json.dumps(whole))
    edges = linkmap.read_linkmap(spark, str(tmp_path / "net.json"))
    assert {tuple(r) for r in edges.collect()} == {
        ("h1", "u1", "h2", "u2"), ("h1", "u1", "h3", "u3"), ("h4", "u4", None, None)}
    linkmap.write_linkmap(edges, str(tmp_path / "out"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert {k: v for line in lines for k, v in line.items()} == whole
    assert {tuple(r) for r in linkmap.original_urls(edges).collect()} == {("h1", "u1"), ("h4", "u4")}


def test_whole_documents_and_rejects(spark, tmp_path):
    whole = {"h1": {"original": "u1", "children": {"h2": "u2"}}, "h4": {"original": "u4", "children": {}}}
    folder = tmp_path / "maps"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps(whole, indent=4))
    (folder / "b.json").write_text(json.dumps({"h9": {"original": "u9", "children": {}}}) + "\n\n")
    want = {("h1", "u1", "h2", "u2"), ("h4", "u4", None, None), ("h9", "u9", None, None)}
    assert {tuple(r) for r in linkmap.read_linkmap(spark, str(folder)).collect()} == want
    (folder / "c.json").write_text("no map\nat all")
    with pytest.raises(ValueError):
        linkmap.read_linkmap(spark, str(folder))
    assert {tuple(r) for r in linkmap.read_linkmap(spark, str(folder), str(tmp_path / "rejects")).collect()} == want
    assert [r.value for r in spark.read.parquet(str(tmp_path / "rejects")).collect()] == ["no map\nat all"]
    (tmp_path / "bad.json").write_text("[1")
    with pytest.raises(ValueError):
        records.read_mapping(spark, str(tmp_path / "bad.json"))
    assert records.read_mapping(spark, str(tmp_path / "bad.json"), str(tmp_path / "r2")).count() == 0
    assert spark.read.parquet(str(tmp_path / "r2")).count() == 1


def test_append_and_overwrite(spark, tmp_path):
    df = spark.createDataFrame([("a", "W"), ("b", "N")], "name string, marketplace string")
    path = str(tmp_path / "t")
    sinks.append_records(df, path)
    sinks.append_records(df.filter("marketplace = 'N'"), path)
    assert spark.read.parquet(path).filter("marketplace = 'N'").count() == 2
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir()) == ["marketplace=N", "marketplace=W"]
    sinks.overwrite(df, str(tmp_path / "o"))
    sinks.overwrite(df.limit(1), str(tmp_path / "o"))
    assert spark.read.parquet(str(tmp_path / "o")).count() == 1


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "store")
    save = lambda rows: sinks.upsert_latest(spark.createDataFrame(rows, "k string, v string, at int"), ["k"], "at", path, 4)
    save([("a", "1", 1), ("b", "1", 1), ("a", "0", 0)])
    save([("b", "2", 2), ("c", "2", 2), ("a", "old", 0)])
    assert {r.k: r.v for r in spark.read.parquet(path).collect()} == {"a": "1", "b": "2", "c": "2"}


def test_upsert_that_is_lost_leaves_the_old_rows(spark, tmp_path):
    path, schema = str(tmp_path / "store"), "k string, v string, at int"
    rows = [(f"k{i}", "old", 1) for i in range(40)]
    sinks.upsert_latest(spark.createDataFrame(rows, schema), ["k"], "at", path, 4)
    fresh = spark.createDataFrame([(f"k{i}", "new", 2) for i in range(40)], schema).repartition(4)
    dying = fresh.withColumn("v", F.when(F.col("k") == "k7", F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        sinks.upsert_latest(dying, ["k"], "at", path, 4)
    assert {tuple(r) for r in spark.read.parquet(path).select("k", "v", "at").collect()} == set(rows)
    sinks.upsert_latest(fresh, ["k"], "at", path, 4)
    assert {r.v for r in spark.read.parquet(path).collect()} == {"new"} and spark.read.parquet(path).count() == 40


def test_upsert_reads_touched_splits_only(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = lambda ks: spark.createDataFrame([(k, "1", 1) for k in ks], "k string, v string, at int")
    sinks.upsert_latest(rows("abcdefgh"), ["k"], "at", path, 8)
    fresh = rows("a").withColumn("split", F.pmod(F.xxhash64("k"), F.lit(8)).cast("int"))
    plan = sinks.stored_splits(fresh, path)._jdf.queryExecution().executedPlan().toString()
    number = fresh.first().split
    assert f"(split#" in plan.split("PartitionFilters: [")[1].split("]")[0] and f"= {number})" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_upsert_ties(spark, tmp_path):
    rows = [("a", str(i), 1) for i in range(5)]
    kept = {sinks.latest(spark.createDataFrame(some, "k string, v string, at int"), ["k"], "at").first().v for some in (rows, rows[::-1])}
    assert len(kept) == 1


def test_accept_reject(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "n int")
    accepted, rejected = sinks.split_accept_reject(df, F.col("n") > 2, "small")
    assert [r.n for r in accepted.collect()] == [5] and {(r.n, r.reason) for r in rejected.collect()} == {(1, "small"), (None, "small")}
    scored = spark.createDataFrame([(1, True), (2, False)], "n int, is_challenge boolean")
    content, diverted = sinks.divert_challenges(scored)
    assert content.first().n == 2 and diverted.first().detected_at is not None


def test_records_are_joined_inside_their_blocks(spark, tmp_path, monkeypatch):
    """Stored are a row per block or file and the parts of rows that lie across blocks, no whole rows; those are not shuffled."""
    from listing_analytics.sources import pieces
    stored = {}

    def store(df, name, keep=pieces.store):
        stored[name] = kept = keep(df, name)
        return kept

    monkeypatch.setattr(pieces, "store", store)
    (tmp_path / "x.csv").write_text("n,t\n" + '"a\nb",c\n' * 300)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = records.read_records(spark, str(tmp_path / "x.csv"), schemas._strings("n", "t"))
        assert {tuple(r) for r in got.select("n", "t").collect()} == {("a\nb", "c")} and got.count() == 300
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    blocks = stored["blocks"].count()
    assert blocks > 1 and set(stored) == {"blocks", "parts"} and stored["parts"].count() <= 2 * blocks
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange hashpartitioning(source_file") and "SortMergeJoin" not in plan.split("MapInArrow")[0]
