"""Line dedup, sharding, fingerprints and SimHash against brute force, with rows that are awkward."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from listing_analytics.llm import components as cc
from listing_analytics.llm import line_dedup, sharding, simhash_bk, spotsigs
from listing_analytics.llm.common import store

SCHEMA = "doc_id long, text string, lang string, kept string, bucket int, mark long, Owner string"
LONG = " ".join(f"w{i % 997} the" for i in range(30000)) + "\nshared line here"
ROWS = [
    (7, "Shared line here\nown line of seven\nshort", None, "x", 1, 5, "o"), (3, "  shared LINE here\t\nshort\n\n", "en", None, None, None, None),
    (3, "  shared LINE here\t\nshort\n\n", "en", None, None, None, None), (5, None, None, None, 2, 2, ""), (6, "", None, None, None, None, None),
    (9, "own line of nine\nown line of nine", None, "a", 0, 0, "b"), (11, LONG, None, None, None, None, None),
    (None, "shared line here\nlonely row", None, None, None, None, None), (12, "Ünïcode éàü ß line\nshort", "de", None, None, None, None),
    (13, "ünïcode éàü ß line\nÜnïcode éàü ß line", "de", None, None, None, None), (14, "a\r\nshared line here\x0b\x0c", "", "", 1, 1, "")]


def docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def brute_lines(rows):
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\v\f\r"))
    holders = defaultdict(set)
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= 10:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc_id is None or len(holders[key(x)]) < 2 or min(holders[key(x)]) == doc_id]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return Counter(out)


@pytest.mark.parametrize("batches, fanout", [(1, 2), (4, 2), (6, 3)])
def test_line_dedup(spark, batches, fanout):
    got = line_dedup.dedup_lines(docs(spark), batches=batches, fanout=fanout, carry=["lang", "kept"])
    assert Counter((r.doc_id, r.kept, r.n_lines, r.n_dropped) for r in got.collect()) == brute_lines(ROWS)
    assert {r.carried.lang for r in got.collect()} == {None, "en", "de", ""}


def test_line_dedup_without_rows(spark):
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0


def test_runs_are_levelled_and_disjoint(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    keys = lambda a, b: spark.range(a, b).selectExpr("id as h1", "id * 3 as h2", "id as owner")
    for start in range(0, 50, 10):
        asked = runs.owners(keys(start - 5, start + 5).drop("owner"))
        assert asked.filter("owner is not null").count() == (5 if start else 0)
        runs.add(keys(start, start + 10) if not start else keys(start, start + 10))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert sorted(r.h1 for run in runs.runs() for r in run.collect()) == list(range(50))
    plan = runs.owners(keys(0, 9).drop("owner"))._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "SortMergeJoin" in plan
    runs.close()


@pytest.mark.parametrize("n", [1, 2, 3, 23, 24, 25, 1000, 1009])
def test_permutation(spark, n):
    walks = sharding.passes(spark, n, 7)
    got = spark.range(n).select("id", sharding.permute(F.col("id"), n, 7, walks).alias("p")).select(
        "id", "p", sharding.permute(F.col("p"), n, 7, walks, inverse=True).alias("back")).collect()
    assert sorted(r.p for r in got) == list(range(n)) and all(r.back == r.id for r in got)


def test_sharding(spark):
    got = sharding.shard(docs(spark), shards=4).collect()
    assert sorted(r.row_number for r in got) == list(range(len(ROWS)))
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for shard, size in sizes.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(size))
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in ROWS)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    again = sharding.shard(docs(spark, ROWS[::-1]).repartition(3), shards=4).collect()
    place = lambda rows: Counter((r.doc_id, r.text_crc32, r.shard, r.slot) for r in rows)
    assert place(got) == place(again)
    assert sharding.shard(docs(spark, []), 4).count() == 0


def test_sharding_is_native(spark):
    plan = sharding.shard(docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def brute_signatures(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    anchors, glued, i = set(spotsigs.ANCHORS), [], 0
    while i < len(words):
        j = i
        while j < len(words) and words[j] in anchors:
            j += 1
        if j < len(words):
            glued.append((words[j - 1] if j > i else None, words[j]))
        else:
            glued += [(None, w) for w in words[i:j]]
        i = j + 1
    spots = {f"{a}:" + " ".join(w for _, w in glued[k:k + 3]) + " " for k, (a, _) in enumerate(glued) if a}
    return spots or None


def test_signatures(spark):
    texts = ["The house of the big green man is here", "no spots whatever", "", None, "der Hund und die Katze, the END of", "é le Çà la ñ"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r.i: r.s for r in rows.select("i", spotsigs.signatures(F.coalesce("text", F.lit(""))).alias("s")).collect()}
    for i, text in enumerate(texts):
        want = brute_signatures(text)
        assert len(got[i]) == (len(want) if want else 1) and got[i] == sorted(got[i])
        if want:
            hashes = {xxhash.xxh64_intdigest(s.encode(), 42) for s in want}
            assert {h % (1 << 64) for h in got[i]} == hashes


def test_signatures_of_long_anchor_runs(spark):
    texts = ["of dog " + "the " * n + end for n in (1, 2, 20, 21, 22, 50, 100_000) for end in ("cat", "cat of the", "")] + ["the " * 50, "the " * 50 + "cat"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: r.s for r in rows.select("i", spotsigs.signatures(F.col("text")).alias("s")).collect()}
    for i, text in enumerate(texts):
        want = brute_signatures(text)
        assert len(got[i]) == (len(want) if want else 1)
        if want:
            assert {h % (1 << 64) for h in got[i]} == {xxhash.xxh64_intdigest(s.encode(), 42) for s in want}


@pytest.mark.parametrize("per_partition", [1, 4, 50])
def test_fingerprints_and_edits(spark, monkeypatch, per_partition):
    monkeypatch.setattr(spotsigs, "BUCKETS_PER_PARTITION", per_partition)
    rows = [r for r in ROWS if r[1] != LONG] + [(20 + i, f"the word{i} and of thing{i % 3} x", *[None] * 5) for i in range(12)]
    got = spotsigs.fingerprints_and_edits(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    ordered = sorted(((i if i is not None else -(1 << 63), t or "") for i, t, *_ in rows), reverse=True)
    for at, (doc_id, text) in enumerate(ordered):
        if [i for i, _ in ordered].count(doc_id) > 1:
            continue
        following = {t for i, t in ordered if i == ordered[(at + 1) % len(ordered)][0]}
        half = len(text) // 2
        row, = [r for r in got if (r.doc_id if r.doc_id is not None else -(1 << 63)) == doc_id]
        assert row.edited in {text[:len(text) - half] + t[:half] for t in following} and row.n_chars == len(text)
    assert spotsigs.fingerprints_and_edits(docs(spark, [])).count() == 0
    one = spotsigs.fingerprints_and_edits(docs(spark, [(1, "abcdef", *[None] * 5)])).first()
    assert one.edited == "abcabc"


def test_one_id_may_have_any_number_of_rows(spark):
    """Null ids with many texts lie in many ranges, and each row's next is the next text by hash."""
    rows = [(None, f"the text{i} of a{i % 7} kind" * 3, *[None] * 5) for i in range(400)] + [(5, "the first of all", *[None] * 5)]
    placed = spotsigs._starts(docs(spark, rows).select(F.lit(1).alias("a"), F.xxhash64("text").alias("b")))
    assert len(placed) > 8
    got = spotsigs.fingerprints_and_edits(docs(spark, rows)).collect()
    assert len(got) == 401
    hashes = {r.text: r.h for r in docs(spark, rows).select("text", F.xxhash64("text").alias("h")).collect()}
    ordered = ["the first of all", *sorted((t for t in hashes if t != "the first of all"), key=hashes.get)]
    want = Counter(t[:len(t) - len(t) // 2] + ordered[(i + 1) % 401][:len(t) // 2] for i, t in enumerate(ordered))
    assert Counter(r.edited for r in got) == want


def test_near_pairs(spark):
    rng = random.Random(3)
    base = [[rng.getrandbits(40) for _ in range(rng.randint(1, 60))] for _ in range(12)]
    sets = [sorted({x for x in b if rng.random() > 0.05} or {1}) for b in base for _ in range(4)] + [[5], [5], [5, 6]]
    pairs, members = spotsigs.near_pairs(spark.createDataFrame(list(enumerate(sets)), "doc_id long, signatures array<long>"), 0.8)
    name = {r["class"]: frozenset(sets[r.doc_id]) for r in members.collect()}
    got = {frozenset((name[r.a], name[r.b])): r.likeness for r in pairs.collect()}
    distinct = sorted({tuple(s) for s in sets})
    like = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b))
    want = {frozenset((frozenset(a), frozenset(b))): like(a, b) for k, a in enumerate(distinct) for b in distinct[:k] if like(a, b) >= 0.8}
    assert got == pytest.approx(want) and len(name) == len(distinct)


def brute_simhash(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(marks, radius):
    root = {m: m for m in marks}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    marks = sorted(root)
    for k, a in enumerate(marks):
        for b in marks[:k]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    groups = defaultdict(set)
    for m in marks:
        groups[find(m)].add(m)
    return {frozenset(g) for g in groups.values()}


def test_simhash_components(spark):
    more = [(30 + i, f"word{i // 3} alpha beta gamma delta " * 30 + ("" if i % 3 else "tail"), *[None] * 5) for i in range(12)]
    rows = ROWS + more
    got = simhash_bk.near_components(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by_mark = defaultdict(list)
    for doc_id, text, *_ in rows:
        by_mark[brute_simhash(text)].append(doc_id)
    name = {}
    for group in brute_components(by_mark, 4):
        ids = [i for m in group for i in by_mark[m] if i is not None]
        name |= {m: min(ids, default=None) for m in group}
    assert Counter((r.doc_id, r.mark % (1 << 64), r.component_id) for r in got) == Counter(
        (i, m, name[m]) for m, ids in by_mark.items() for i in ids)
    assert simhash_bk.near_components(docs(spark, [])).count() == 0


def test_keep_one(spark):
    rows = ROWS + [(40, ROWS[0][1], *[None] * 5), (None, "lonely words of nobody at all", *[None] * 5), (None, "lonely words of nobody at all", *[None] * 5)]
    got = simhash_bk.keep_one(docs(spark, rows))
    assert got.columns == docs(spark).columns
    ids = Counter(r.doc_id for r in got.collect())
    want = {r.component_id for r in simhash_bk.near_components(docs(spark, rows)).collect() if r.component_id is not None}
    assert {i for i in ids if i is not None} == want and all(n == 1 for i, n in ids.items() if i is not None)
    assert sum(r.text == "lonely words of nobody at all" for r in got.collect()) == 1


@pytest.mark.parametrize("capacity, blocks", [(2048, None), (50, None), (50, 7), (2048, 8)])
def test_links_of_dense_groups(spark, capacity, blocks):
    rng, marks = random.Random(1), set()
    for _ in range(5):
        centre = rng.getrandbits(64)
        for _ in range(150):
            x = centre
            for _ in range(rng.randint(1, 6)):
                x ^= 1 << rng.randrange(64)
            marks.add(x)
    signed = [m - (1 << 64) if m >> 63 else m for m in sorted(marks)]
    table, _ = store(spark.createDataFrame([(m,) for m in signed], "mark long"), "marks")
    links = simhash_bk.near_links(table, 4, blocks, capacity)
    groups = defaultdict(set)
    for r in cc.components(links).collect():
        groups[r.root].add(r.node % (1 << 64))
    assert set(map(frozenset, groups.values())) == {g for g in brute_components(marks, 4) if len(g) > 1}


def test_bk_tree():
    rng = np.random.default_rng(0)
    marks = rng.integers(0, 1 << 63, 600, dtype=np.uint64) & np.uint64(0xFFFF)
    tree = simhash_bk.BKTree(3)
    for m in marks:
        tree.insert(m)
    for m in marks[:50]:
        assert sorted(tree.search(m)) == np.flatnonzero(np.bitwise_count(marks ^ m) <= 3).tolist()


def test_components_of_a_chain(spark):
    chain = [(i, i + 1) for i in range(200)] + [(500, 500), (700, 600), (600, 700), (None, 3)]
    got = {r.node: r.root for r in cc.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 600: 600, 700: 600}
    assert cc.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edited_hash_is_of_utf8(spark, sf_dir):
    row = spotsigs.op5_fingerprints(spark, sf_dir).orderBy(F.desc("doc_id")).first()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ids = sorted(texts, reverse=True)
    text, following, half = texts[ids[0]], texts[ids[1]], len(texts[ids[0]]) // 2
    assert row.edited_sha256 == hashlib.sha256((text[:len(text) - half] + following[:half]).encode()).hexdigest()
