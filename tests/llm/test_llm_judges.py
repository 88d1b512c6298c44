"""URL equivalence, nearest neighbours, license rules, the quality discriminant and the pipeline."""

import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from check_oracle import compare
from listing_analytics.llm import inverted_multi_index as imi
from listing_analytics.llm import license_rules, quality_qda, simhash_bk, url_equivalence
from listing_analytics.llm.common import store
from listing_analytics.session import shared_dir

PAGES = [
    (1, "http://a.com/de/x", "<link rel=canonical href='https://b.net/y'>", None), (2, "https://b.net/y/", None, "v"),
    (3, "http://c.net/z", "<meta http-equiv=refresh content='0; url=//b.net/y?utm_x=1#q'>", None), (4, None, "", None),
    (5, "nope", "<link>", None), (6, "http://k.com/fr/", "<LINK href=http://m.net/ rel='canonical'>", None),
    (7, "http://m.net", "<link rel=canonical href=http://a.com/de/x2>", None), (8, "HTTP://Sub.ORG?x", "", None),
    (2, "https://b.net/y/", None, "v"), (None, "http://example.org/es/1", "x" * 100000, None), (9, "http://example.org/en/12?q", "", None),
    (10, "http://notexample.org/en/12", "<a href=/x>", None), (11, "", "", None), (12, "http://com/de/", None, None),
    (13, "http://x.example.org/en/2", None, None), (14, "http://r.net/1", "<link rel='canonical' href='/2'>", None)]
PAGE_SCHEMA = "page_id long, url string, html string, verdict string"


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for v, h, p in url_equivalence.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, default=None)


def test_url_rules_and_aliases(spark):
    got = url_equivalence.judge(spark.createDataFrame(PAGES, PAGE_SCHEMA)).collect()
    assert len(got) == len(PAGES)
    rows = Counter((r.page_id, r.host, r.path, r.rule) for r in got)
    want = [(i, *brute_rule(u)) for i, u, *_ in PAGES]
    assert rows == Counter((i, h, p, r and r[1]) for i, h, p, r in want)
    verdict = {r.page_id: r.verdict for r in got}
    assert all(verdict[i] == r[2] for i, _, _, r in want if r)
    # Aliases of a blocked page are blocked; where an alias is allowed by a rule, those without a rule are allowed.
    assert {i: verdict[i] for i in (2, 3, 7, 4, 5, 11, 14)} == {2: "block", 3: "block", 7: "allow", 4: "allow", 5: "allow", 11: "allow", 14: "allow"}
    assert url_equivalence.judge(spark.createDataFrame([], PAGE_SCHEMA)).count() == 0


@pytest.mark.parametrize("reference, want", [
    ("g", "http://a/b/c/g"), ("./g/", "http://a/b/c/g/"), ("/g", "http://a/g"), ("//g", "http://g"), ("?y", "http://a/b/c/d;p?y"), ("g?y/./x", "http://a/b/c/g?y/./x"),
    ("#s", "http://a/b/c/d;p?q#s"), ("..", "http://a/b/"), ("../../../g", "http://a/g"), ("g;x=1/../y", "http://a/b/c/y"), ("/./g", "http://a/g"), (".", "http://a/b/c/"),
    ("HTTP:g", "http://a/b/c/g"), ("mailto:x@y", None), ("login?next=http://z/", "http://a/b/c/login?next=http://z/"), ("https://z/x/../y", "https://z/y")])
def test_references(reference, want):
    assert url_equivalence.resolve("http://a/b/c/d;p?q", reference) == want


RELATIVE = [
    (1, "http://p.com/de/a/b.html", "<link rel=canonical href=../../plain/x>", "block"), (2, "http://p.com/plain/x", "", "block"),
    (3, "http://q.net/s/t?id=1", "<link rel='canonical' href='?id=2'>", "block"), (4, "http://q.net/s/t?id=2", "<meta content='0; url=next.html' http-equiv=Refresh>", "block"),
    (5, "http://q.net/s/next.html", "<base href=http://o.com/de/><link href='c' rel='x CANONICAL'>", "block"),
    (6, "http://u.net/", "<link rel=canonical href=/a?x=1&amp;y=2>", "block"), (7, "http://u.net/a?x=1&y=2", "<meta http-equiv=refresh content=\"1;URL='http://v.com/de/'\">", "block"),
    (8, "http://w.net/d", "<link rel=canonical href='go?to=http://v.com/de/'>", "allow"), (9, "http://w.net/go?to=http://v.com/de/", None, "allow"),
    (10, "http://example.org/en/1/x/", "<link rel=canonical href=../../../home/>", "block"), (11, "http://example.org/home", "", "allow"),
    (12, "http://w.net/e", "<link rel=alternate href=http://v.com/de/ title=canonical><meta http-equiv=refresh content=5><link rel=canonical href=''>", "allow")]


def test_relative_links(spark):
    got = {r.page_id: r for r in url_equivalence.judge(spark.createDataFrame(RELATIVE, PAGE_SCHEMA)).collect()}
    assert {i: r.verdict for i, r in got.items()} == {i: v for i, _, _, v in RELATIVE}
    for some in ((1, 2), (3, 4, 5), (6, 7), (8, 9), (10, 11)):
        assert len({got[i].alias_of for i in some}) == 1
    assert url_equivalence.declared_links(spark.createDataFrame(RELATIVE[11:], PAGE_SCHEMA)).count() == 0


def test_sql_of_awkward_pages(spark):
    db = duckdb.connect()
    db.execute("create table pages (page_id bigint, url varchar, html varchar)")
    db.executemany("insert into pages values (?, ?, ?)", [p[:3] for p in PAGES])
    got = url_equivalence.judge(spark.createDataFrame(PAGES, PAGE_SCHEMA))
    assert compare(got, db.execute(url_equivalence.SQL)).startswith("ok")


def test_redirect_chains(spark):
    n = 60
    pages = spark.createDataFrame([(i, f"http://h{i}.net/", "", None) for i in range(n)] + [(n, "http://z.com/de/", "", None)], PAGE_SCHEMA)
    chain = [(f"http://h{i}.net", f"http://h{i + 1}.net/") for i in range(40)] + [("http://h40.net", "http://z.com/de"), (None, "http://h50.net")]
    got = url_equivalence.judge(pages, spark.createDataFrame(chain, "source string, target string")).collect()
    assert {r.page_id for r in got if r.verdict == "block"} == {*range(41), n}
    assert len({r.alias_of for r in got}) == n + 1 - 41


def brute_nearest(rows, k, kind=np.float32):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == 8 and not any(x is None for x in v) and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.setdefault(i, []).append(np.array(v, kind).astype(float))
    out = {}
    for i, vs in good.items():
        if i % 5 == 0:
            scored = sorted((-float((vs[0] * w).sum()), j) for j, ws in good.items() if j != i for w in ws)
            out[i] = scored[:k]
    return out


def vectors(rng, n):
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(n)]
    same = rows[3][1]
    rows += [(n + i, same) for i in range(60)]  # ties
    rows += [(500, None), (505, [0.0] * 8), (510, [float("nan")] + [1.0] * 7), (515, [None] + [1.0] * 7), (520, [1.0] * 7), (525, [float("inf")] * 8), (None, same), rows[0]]
    return rows


def assert_nearest(spark, rows, kind, block, **how):
    frame, _ = store(imi.usable(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")), "vectors")
    got = defaultdict(list)
    for r in imi.search(frame, frame.filter("vec_id % 5 = 0"), 5, 1.0, 4, block, **how).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = brute_nearest(rows, 5, np.float32 if kind == "float" else np.float64)
    assert set(got) == set(want)
    for i, best in want.items():
        assert [v for v, _ in got[i]] == [j for _, j in best]
        assert [x for _, x in got[i]] == pytest.approx([-x for x, _ in best], rel=1e-14, abs=1e-12)


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("block", [imi.BLOCK, 16])
def test_nearest_with_everything_probed(spark, block, kind):
    assert_nearest(spark, vectors(np.random.default_rng(1), 150), kind, block)


def test_doubles_keep_their_digits(spark):
    """Numbers that floats cannot tell apart or hold, and lengths from 1e-3 to 1e60."""
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.normal(size=8) * 10.0 ** rng.integers(-3, 4)]) for i in range(120)]
    rows += [(200 + i, [x + i * 1e-12 for x in rows[4][1]]) for i in range(12)] + [(300 + i, rows[5][1]) for i in range(8)]
    assert_nearest(spark, rows, "double", 16)
    long_rows = rows + [(400 + i, [float(x) for x in rng.normal(size=8) * 1e60]) for i in range(9)] + [(500 + i, [1e60] * 8) for i in range(7)]
    frame, _ = store(imi.usable(spark.createDataFrame(long_rows, "vec_id long, embedding array<double>")), "vectors")
    assert frame.count() == len(long_rows)
    best = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in imi.search(frame, frame.filter("vec_id = 500"), 5, 1.0, 4).collect()}
    # Equal candidates by their ids, though their products are of the size 1e121.
    assert [best[500, rank][0] for rank in range(1, 6)] == [501, 502, 503, 504, 505]


def test_every_block_has_a_task_of_its_own(spark):
    for n in (1, 5, 37):
        dealt = imi._keys(spark, n).repartition(n, "key").select("block", F.spark_partition_id().alias("p")).collect()
        assert len({r.p for r in dealt}) == n and {r.block for r in dealt} == set(range(n))


def test_nearest_recall_and_small_tables(spark, sf_dir):
    got = imi.op8_nearest(spark, sf_dir).collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    x, ids = np.array([v for _, v in rows], dtype=float), np.array([i for i, _ in rows])
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = np.where(ids == ids[q], -np.inf, x @ x[q])
        best = set(ids[np.argsort(-score, kind="stable")[:20]].tolist())
        hits, total = hits + len(best & {r.vec_id for r in got if r.query_id == ids[q]}), total + 20
    assert hits / total >= 0.9
    schema = "vec_id long, embedding array<float>"
    for few in ([], [(0, None)], [(0, [1.0, 2.0])], [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (20, [1.0, 0.0])]):
        frame, _ = store(imi.usable(spark.createDataFrame(few, schema)), "vectors")
        n = sum(v is not None for _, v in few)
        assert imi.search(frame, frame.filter("vec_id % 20 = 0")).count() == sum(i % 20 == 0 and v is not None for i, v in few) * max(0, n - 1)


def test_best_first_is_in_order():
    rng = np.random.default_rng(2)
    for _ in range(20):
        a, b, counts = rng.normal(size=7), rng.normal(size=5), rng.integers(0, 4, 35)
        cells = imi.best_first(a, b, counts, counts.sum())
        sums = [a[c // 5] + b[c % 5] for c in cells]
        assert sorted(cells) == np.flatnonzero(counts).tolist() and sums == sorted(sums, reverse=True)
        enough = imi.best_first(a, b, counts, 5)
        assert cells[:len(enough)] == enough and counts[enough].sum() >= min(5, counts.sum())


def brute_places(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    found = [(i, label) for phrase, label in license_rules.PHRASES for i in range(len(words))
             if words[i:i + len(phrase.split())] == phrase.split()]
    return len(words), sorted(found)


LICENSE_TEXTS = [
    None, "", "cc by", "CC-BY cc/by ccby acc by ccç by", "MIT\n\n license, mit--license.mit license", "the GNU General   Public\tLicense v3 and gnu general public licenses",
    "Licensed under the Apache License, Version 2.0 (the \"License\")", "apache\x00license éapache license", "word " * 20000 + "mit license", "cc by cc by-sa 4.0"]


def test_license_base_places(spark):
    rng = random.Random(4)
    parts = ["gnu ", "General ", "public ", "LICENSE", " ", "-", "cc", " by ", "apache ", "mit ", "é", "0", "\n"]
    some = LICENSE_TEXTS + ["".join(rng.choice(parts) for _ in range(40)) for _ in range(300)]
    frame = spark.createDataFrame([(i, t, 1) for i, t in enumerate(some)] + [(None, "mit license", 2), (2, "cc by", 3)], "doc_id long, text string, score int")
    rows = license_rules.scan(frame).collect()
    assert len(rows) == len(some) + 2
    for r in rows:
        if r.doc_id is not None:
            n, found = brute_places(some[r.doc_id])
            where = [i for i, _ in found]
            assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(found), min(where, default=None), max(where, default=None))
            assert r.base_labels == ",".join(sorted({label for _, label in found}))
            assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    assert license_rules.scan(frame.limit(0)).count() == 0


@pytest.mark.parametrize("text, labels", [
    ("SPDX-License-Identifier: MIT", {"mit"}), ("GNU Lesser General Public License v2.1", {"lgpl-2.1"}), ("under the New BSD License", {"bsd-3-clause"}),
    ("released under the terms of the Mozilla Public License, version 2.0", {"mpl-2.0"}), ("CC BY-NC-SA 4.0", {"cc-by-nc-sa", "cc-by"}),
    ("gpl-3.0 or agpl-3.0", {"gpl-3.0", "agpl-3.0"}), ("nothing of the kind, mit freundlichen", set())])
def test_license_rules(text, labels):
    found = license_rules.detections(text.lower())
    assert {rule.label for _, _, rule in found} == labels - ({"cc-by"} if "NC" in text else set())
    spans = [(s, e) for s, e, _ in found]
    assert not any(a != b and a[0] <= b[0] and b[1] <= a[1] for i, a in enumerate(spans) for b in spans[i + 1:])
    assert len(license_rules.rules()[0]) == len(license_rules.LICENSES) * len(license_rules.CONTEXTS) + len(license_rules.BODIES)


def written(pattern, rng):
    """A text that the parsed pattern matches, at least without its look-arounds."""
    out = ""
    for op, arg in pattern:
        name = str(op)
        if name == "LITERAL":
            out += chr(arg)
        elif name == "IN":
            out += rng.choice([" ", "\n  ", "\r\n", "  ", "-"] if any(str(v) == "CATEGORY_SPACE" for _, v in arg) and len(arg) > 1
                              else [" ", " \n ", "\xa0"] if any(str(v) == "CATEGORY_SPACE" for _, v in arg)
                              else ["fun"] if any(str(v) == "CATEGORY_WORD" for _, v in arg)
                              else [chr(c) for k, v in arg for c in ([v] if str(k) == "LITERAL" else range(v[0], v[1] + 1))])
        elif name == "MAX_REPEAT":
            low, high, body = arg
            out += "".join(written(body, rng) for _ in range(rng.randint(low, min(high, low + 1))))
        elif name == "SUBPATTERN":
            out += written(arg[3], rng)
        elif name == "BRANCH":
            out += written(rng.choice(arg[1]), rng)
        elif name == "ASSERT" and arg[0] < 0:
            out += written(arg[1], rng)
        else:
            assert name in ("ASSERT_NOT",), name
    return out


def ungated(text):
    """Detections of all rules on the text with single blanks, placed character by character."""
    place = [i for i, c in enumerate(text) if not c.isspace() or i and not text[i - 1].isspace()]
    while place and text[place[-1]].isspace():
        place.pop()
    plain = "".join(" " if text[i].isspace() else text[i] for i in place)
    kept = []
    for rule in license_rules.rules()[0]:
        for hit in rule.pattern.finditer(plain):
            if not any(s <= hit.start() and hit.end() <= e for s, e, _ in kept):
                kept.append((*hit.span(), rule))
    return [(place[s], place[e - 1] + 1, rule) for s, e, rule in kept]


def test_keywords_drop_no_detection():
    rng, matched = random.Random(8), Counter()
    for rule in license_rules.rules()[0]:
        parsed = re._parser.parse(rule.pattern.pattern)
        for _ in range(12):
            text = rng.choice(["", "\n  ", "see  the\t"]) + written(parsed, rng) + rng.choice(["", " \n", ".  end"])
            found = license_rules.detections(text)
            assert found == ungated(text), text
            matched[rule.priority] += bool(found)
    assert len(matched) == len(license_rules.rules()[0]) and min(matched.values()) > 0


@pytest.mark.parametrize("text, spans", [
    ("  see mozilla\n public license.", ["mpl-2.0:6-29"]), ("GNU Lesser\r\n General Public License", ["lgpl-2.1:0-35"]),
    ("a BSD style license", ["bsd:2-19"]), ("MPLv2", ["mpl-2.0:0-5"]), ("creative commons-zero", ["cc0-1.0:0-21"]), ("x\n\ncc - 0", ["cc0-1.0:3-9"])])
def test_wrapped_and_spelled_licenses(text, spans):
    assert license_rules.scan_text(text.encode())[-1] == spans


@pytest.mark.parametrize("text, label", [
    ("Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification", "bsd"),
    ("Neither the name of the Example Group may be used to endorse or promote products", "bsd-3-clause"),
    ("This program is free software: you can redistribute it and/or modify it", "gpl"),
    ("the GNU General Public License as published by the Free Software Foundation; either version 2", "gpl-2.0"),
    ("This file is provided \"as is\" with no support", "no-warranty"), ("see https://creativecommons.org/licenses/by/4.0/", "cc-by"),
    ("http://www.apache.org/licenses/LICENSE-2.0", "apache-2.0"), ("the MIT licence", "mit"), ("Licensed under MIT.", "mit"), ("licenced under the MIT", "mit"),
    ("Apache Licence, Version 2.0", "apache-2.0"), ("BSD-style licence", "bsd"), ("https://www.gnu.org/licenses/gpl-3.0.html", "gpl-3.0"),
    ("This is free and unencumbered software released into the public domain.", "unlicense")])
def test_license_texts_notices_and_addresses(text, label):
    assert label in {rule.label for _, _, rule in license_rules.detections(text.lower())}


@pytest.mark.parametrize("text", [
    "permission is granted to any person", "use in source and binary form", "the name of the group may be used", "this program is not free software",
    "as is usual", "creativecommons.org/about", "apache.org/foundation", "understood mit anderen", "the licence of a driver", "gnu.org", "publication may be copied"])
def test_other_texts_name_no_license(text):
    assert license_rules.detections(text) == []


@pytest.mark.parametrize("phrase", ["mit license ", "cc by ", "gpl ", "apache license, version 2.0 "])
def test_time_grows_with_the_text(phrase):
    import time
    spent = []
    for size in (1 << 18, 1 << 20):
        text = (phrase * (size // len(phrase))).encode()
        start = time.process_time()
        row = license_rules.scan_text(text)
        spent.append(time.process_time() - start)
        assert row[7] == size // len(phrase)
    assert spent[1] < 12 * spent[0]


def test_discriminant_against_plain_formulas():
    rng = np.random.default_rng(3)
    x = [rng.normal(size=(400, quality_qda.D)), rng.normal(size=(900, quality_qda.D)) * 1.5 + 0.4]
    model = quality_qda.from_moments([400, 900], [v.sum(0) for v in x], [v.T @ v for v in x], 0.1)
    both = np.vstack(x)
    target, odds = np.diag(both.var(axis=0)), np.log(901 / 401)
    density = []
    for v in x:
        cov = 0.9 * np.cov(v.T, bias=True) + 0.1 * target
        d = both - v.mean(0)
        density.append(-0.5 * ((d @ np.linalg.inv(cov)) * d).sum(1) - 0.5 * np.linalg.slogdet(cov)[1])
    assert np.allclose(model.score(both), 1 / (1 + np.exp(-(odds + density[1] - density[0]))))


def test_quality_query(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in quality_qda.op10_quality(spark, folder).collect()}
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7) for i, r in got.items())
    unseen = [i for i in marks if got[i].held_out]
    assert sum(got[i].predicted == marks[i] for i in unseen) / len(unseen) >= 0.95


def test_quality_of_awkward_rows(spark):
    rows = [(1, None, 9.0), (2, "", 9.0), (None, "abc", None), (3, "x " * 50000, 1.0), (1, "one more of the id", 2.0)] + [
        (10 + i, f"fine words number {i} stand here" if i % 2 else "### !!! ### " * i, None) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _score double")
    marks = spark.createDataFrame([(10 + i, i % 2, 5) for i in range(20)] + [(11, 0, 5), (None, 1, 5), (12, None, 5)], "doc_id long, quality int, stats int")
    model, stats = quality_qda.train(docs, marks)
    scores = quality_qda.score_statistics(stats, model).collect()
    assert len(scores) == len(rows) and all(0 <= r.score <= 1 for r in scores)
    kept = quality_qda.keep_good(docs, marks)
    assert kept.columns == docs.columns and 0 < kept.count() <= len(rows)
    for few in (marks.limit(0), marks.filter("quality = 1")):
        model, stats = quality_qda.train(docs, few)
        assert len({r.score for r in quality_qda.score_statistics(stats, model).collect()}) == 1
    assert quality_qda.score_statistics(quality_qda.train(docs.limit(0), marks)[1], model).count() == 0


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    current = [docs]
    for name, stage in corpus_pipeline.STAGES:
        current.append(store(stage(spark, current[-1], sf_dir), f"test-{name}")[0])
    for out in current[1:-1]:
        assert out.dtypes == docs.dtypes
    good, lines, single, pieces = current[1:]
    model, stats = quality_qda.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    wanted = {r.doc_id for r in quality_qda.score_statistics(stats, model).collect() if r.score >= 0.7}
    assert {r.doc_id for r in good.collect()} == wanted
    assert {r.doc_id for r in lines.collect()} == wanted and lines.filter(F.length("text") != F.col("n_chars")).count() == 0
    classes = simhash_bk.near_components(lines).collect()
    assert {r.doc_id for r in single.collect()} == {r.component_id for r in classes}
    assert {r.doc_id for r in pieces.collect()} == {r.component_id for r in classes}
    before = set(os.listdir(shared_dir(spark)))
    assert contract.queries()["pipeline"](spark, sf_dir).count() == pieces.count()
    # Of all that the stages made only the last result is left.
    left = [name for name in set(os.listdir(shared_dir(spark))) - before if not name.startswith(("rdd", "."))]
    assert len([n for n in left if n.startswith("pipeline-")]) == 1 and len(left) <= 2


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def stages(spark, rows, labels, path):
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs, _ = store(stage(spark, docs, str(path)), "test-stage")
        out.append(docs.collect())
    return out


def test_pipeline_of_an_empty_table(spark, tmp_path):
    assert stages(spark, [], [], tmp_path) == [[], [], [], []]


def test_pipeline_without_labels_and_with_awkward_rows(spark, tmp_path):
    """Nothing tells good from bad, so all documents stay; nulls, repeated rows and rows without an id have a defined end."""
    rows = [(1, "one line of its own\na line that two share", "en", "s", 5), (2, "A line that two share  \nanother one of two", None, None, None),
            (2, "A line that two share  \nanother one of two", None, None, None), (3, None, "en", "s", 0), (4, "", None, None, None),
            (None, "a line that two share\nrow without an id", None, None, None), (None, None, None, None, None)]
    good, lines, single, pieces = stages(spark, rows, [(1, 1, 0), (2, None, None), (None, 0, 0)], tmp_path)
    assert Counter(tuple(r) for r in good) == Counter(rows)
    assert Counter((r.doc_id, r.text, r.n_chars) for r in lines) == Counter(
        [(1, rows[0][1], len(rows[0][1])), *[(2, "another one of two", 18)] * 2, (3, "", 0), (4, "", 0), (None, rows[5][1], len(rows[5][1])), (None, "", 0)])
    assert sorted((r.doc_id or 0) for r in single) == [0, 1, 2, 3]
    assert {r.doc_id for r in pieces} == {None, 1, 2, 3}


def test_thirteen_queries_are_registered():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
