"""Exact dedup, fill-in-middle and conversation repair against brute force, with rows that are awkward."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import groupby

import pytest
import zstandard
from pyspark.sql import functions as F

from listing_analytics.llm import exact_dedup, fill_in_middle, turn_repair
from listing_analytics.llm.common import store

SCHEMA = "doc_id long, text string, hash string, n int, frames string, variant string, Row int"
LONG = "".join(random.Random(3).choice(["word ", "é", "日本", "x" * 50, "\n", "1.5 "]) for _ in range(40000))
ROWS = [(i, text, "h", 1, "f", None, None) for i, text in [
    (4, "same text"), (2, "same text"), (9, "same text"), (9, "same text"), (None, "same text"), (None, "alone without id"),
    (None, "alone without id"), (5, None), (6, ""), (7, "Same text"), (8, "same text "), (11, LONG), (12, LONG), (13, LONG + "."),
    (-3, "<P> marked"), (20, "ends in <"), (21, "M>"), (22, "日"), (23, "a" * 500)]]


def docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def brute_groups(rows, keep):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (max if keep == "largest" else min)(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        stays = True
        for i in ids:
            out.append((i, best, len(ids), stays and i == best, digest))
            stays = stays and i != best
    return Counter(out)


# 128 bits, and hashes so short that many different texts share one.
HASHES = {"md5": exact_dedup.content_hash, "length": lambda t: F.length(t).cast("string"), "one": lambda t: F.lit("x")}


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("hashed", HASHES)
def test_exact_groups(spark, keep, hashed):
    rows = ROWS + [(100 + i, f"text {i % 7}", None, None, None, None, None) for i in range(200)]
    got = exact_dedup.exact_groups(docs(spark, rows), keep, hashed=HASHES[hashed])
    assert Counter(tuple(r) for r in got.collect()) == brute_groups(rows, keep)


@pytest.mark.parametrize("hot", [1, 3, 1 << 40])
def test_hot_groups_are_dealt_alike(spark, monkeypatch, hot):
    monkeypatch.setattr(exact_dedup, "HOT_GROUPS", hot)
    rows = [(i, "a third" if i % 3 else f"t{i % 11}", None, None, None, None, None) for i in range(300)]
    assert Counter(tuple(r) for r in exact_dedup.exact_groups(docs(spark, rows)).collect()) == brute_groups(rows, "smallest")


def test_exact_groups_of_normalised_texts(spark):
    got = exact_dedup.exact_groups(docs(spark), normalise=lambda t: F.lower(F.trim(t)))
    sizes = {r.doc_id: r.group_size for r in got.collect() if r.doc_id is not None}
    assert sizes[4] == sizes[7] == sizes[8] == 7 and sizes[23] == 1


def test_exact_groups_without_rows(spark):
    assert exact_dedup.exact_groups(docs(spark, [])).collect() == []
    with pytest.raises(ValueError):
        exact_dedup.exact_groups(docs(spark), keep="first")


def test_exact_dedup_stays_in_the_jvm(spark, sf_dir):
    plan = exact_dedup.op13_exact_dedup(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan) and "CartesianProduct" not in plan and "NestedLoop" not in plan


# --- fill in middle -----------------------------------------------------------------------------------------------


def brute_middle(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    form = "spm" if h[3] % 100 < 20 else "psm"
    return doc_id, len(units), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def many_texts():
    rng = random.Random(11)
    alphabet = ["a", "Bc", "<", ">", "P", "é", "日", "😀", "\n", " ", "<S", "M>", "[", "@", "`", "{"]
    return ROWS + [(1000 + i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))), None, None, None, None, None)
                   for i in range(300)]


@pytest.mark.parametrize("frame_bytes", [1, 5, 64, fill_in_middle.FRAME_BYTES])
def test_fill_in_middle(spark, frame_bytes):
    rows = many_texts()
    framed, _ = store(fill_in_middle.frame_texts(docs(spark, [r for r in rows if frame_bytes > 5 or len(r[1] or "") < 1000]), frame_bytes), "f")
    new = fill_in_middle.transform(framed)
    texts = {r.doc_id for r in framed.collect()}
    wanted = Counter(brute_middle(i, t) for i, t, *_ in rows if frame_bytes > 5 or len(t or "") < 1000)
    assert Counter(tuple(r) for r in fill_in_middle.as_texts(new).collect()) == wanted and len(texts) > 300
    got = Counter((r.doc_id, r.form, r.output_sha256, r.restored_sha256) for r in fill_in_middle.digests(new).collect())
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert got == Counter((i, brute_middle(i, t)[2], sha(brute_middle(i, t)[5]), sha(t)) for i, t, *_ in rows
                          if frame_bytes > 5 or len(t or "") < 1000)


def test_outputs_are_one_stream_and_keep_whole_frames(spark):
    framed, _ = store(fill_in_middle.frame_texts(docs(spark), 4096), "f")
    before = {r.doc_id: [bytes(f["data"]) for f in r.frames] for r in framed.collect() if r.doc_id in (11, 12, 13)}
    for r in fill_in_middle.transform(framed).filter("doc_id in (11, 12, 13)").collect():
        joined = b"".join(map(bytes, r.output))
        whole = zstandard.ZstdDecompressor().stream_reader(joined, read_across_frames=True).read()
        text = LONG + "." * (r.doc_id == 13)
        assert whole.decode() == brute_middle(r.doc_id, text)[5]
        assert len(set(before[r.doc_id]) - {bytes(f) for f in r.output}) <= 2  # only frames that hold a cut are new


def test_only_cut_frames_are_read():
    rows = list(fill_in_middle.split_frames(LONG.encode(), 1024))
    assert b"".join(rows) == LONG.encode() and all(len(r) <= 1024 and r.decode() is not None for r in rows)
    frames, units, chars, inside = [], 0, 0, False
    import numpy as np
    for raw in rows:
        start, char = fill_in_middle.unit_starts(np.frombuffer(raw, dtype=np.uint8), inside)
        frames.append({"unit": units, "char": chars, "inside": inside, "data": zstandard.compress(raw)})
        units, chars, inside = units + int(start.sum()), chars + int(char.sum()), raw[-1:].isalpha()
    text = fill_in_middle._Text(frames, units, chars, 3)
    read = []
    text.raw = lambda number, raw=text.raw: read.append(number) or raw(number)
    words = re.findall(r"[A-Za-z]+|[^A-Za-z]", LONG)
    for unit in (0, 1, len(words) // 2, len(words) - 1, len(words)):
        del read[:]
        assert text.cut(unit)[2] == len("".join(words[:unit])) and len(set(read)) <= 1


def test_restored_without_frames_that_match_the_markers():
    for form, order in fill_in_middle.FORMS.items():
        parts = {b"<P>": b"ab<", b"<S>": b"<P", b"<M>": b"S>x"}
        stream = b"".join(m + parts[m] for m in order)
        for size in range(1, len(stream) + 1):
            frames = [zstandard.compress(stream[i:i + size]) for i in range(0, len(stream), size)]
            assert b"".join(fill_in_middle.restored(form, frames)) == b"ab<S>x<P"


def test_fill_in_middle_without_rows(spark):
    assert fill_in_middle.digests(fill_in_middle.transform(fill_in_middle.frame_texts(docs(spark, [])))).collect() == []


# --- conversation repair -----------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, codes string, idx int"
SHORT = {"user": "u", "assistant": "a", "system": "s"}


def best_edits(turns):
    """(cost, audit, lines): the least of all, by the states' least (cost, audit) from the front."""
    follows = {"0": "u", "s": "u", "u": "a", "a": "u"}
    role = {"u": "user", "a": "assistant"}
    states = {"0": (0, "", ())}

    def put(into, state, value):
        if state not in into or value[:2] < into[state][:2]:
            into[state] = value

    def inserted(states):
        out = dict(states)
        for _ in range(3):
            for state, (cost, audit, lines) in list(out.items()):
                put(out, follows[state], (cost + 5, audit + "I", lines + (role[follows[state]] + ":",)))
        return out

    for who, text, forced, cut in turns:
        after = {}
        for state, (cost, audit, lines) in inserted(states).items():
            put(after, state, (cost + 2, audit + "D", lines))
            if not forced:
                initial = who[:1]
                if (initial == "s" and state == "0") or initial == follows[state]:
                    put(after, initial, (cost + 5 * cut, audit + "K", lines + (f"{who}:{text}",)))
                to = follows[state]
                put(after, to, (cost + 1 + 5 * cut, audit + "R", lines + (f"{role[to]}:{text}",)))
        states = after
    final = inserted(states)
    return min((final[s] for s in ("0", "a") if s in final), key=lambda v: v[:2])


def brute_damage(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        space = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def brute_repair(rows):
    key = lambda r: (r[0] is not None, r[0] or 0)
    out = {}
    for _, group in groupby(sorted(rows, key=key), key=key):
        group = list(group)
        order = sorted(group, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
        seen, turns, counts = set(), [], Counter()
        for _, _, role, text in order:
            core = text.strip(" \t\n\v\f\r")
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            turns.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        initials = [t[0][:1] for t in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        known = [r[1] for r in group if r[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        cost, audit, lines = best_edits(turns)
        out[group[0][0]] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
                            hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines)
    return out


def odd_conversations(seed, conversations=60, most=14):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "user", "assistant", "tool", "unknown", "", None]
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t", None, "a. ", "ends.\n\n", "mid.dle", "a ", "é.", " "]
    return [(None if conv == 0 else conv, rng.choice([None, turn, turn, turn, turn + 3]), rng.choice(roles),
             rng.choice(texts) if rng.random() < 0.6 else f"text {turn}.", "c", 1)
            for conv in range(conversations) for turn in range(rng.randint(1, most))]


def compare(spark, rows, chunk_rows):
    damaged = turn_repair.damage(spark.createDataFrame(rows, TURNS))
    report, turns = turn_repair.repair(damaged, chunk_rows)
    hashes = {r.conv_id: r.repaired_sha256 for r in turn_repair.digests(turns).collect()}
    empty = hashlib.sha256().hexdigest()
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, hashes.get(r.conv_id, empty))
           for r in report.collect()}
    wanted = brute_repair(brute_damage(rows))
    assert got == {k: v[:8] for k, v in wanted.items()}
    lines = defaultdict(list)
    for r in sorted(turns.collect(), key=lambda r: (r.part, r.idx, r.pos)):
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    assert {k: tuple(v) for k, v in lines.items()} == {k: v[8] for k, v in wanted.items() if v[8]}


@pytest.mark.parametrize("seed, chunk_rows", [(1, 1), (2, 2), (3, 5), (4, turn_repair.CHUNK)])
def test_repair(spark, seed, chunk_rows):
    compare(spark, odd_conversations(seed), chunk_rows)


def test_one_large_conversation_over_many_chunks(spark):
    rng = random.Random(8)
    rows = [(7, t, rng.choice(["user", "assistant", "assistant", "system", "tool"]), f"turn {t}" + rng.choice([".", "", "."]), "", 0)
            for t in range(2500)]
    compare(spark, rows + odd_conversations(9, 5), 16)


@pytest.mark.parametrize("text", ["the same.", "cut {}", "", "Fine {}."])
def test_hot_conversations_of_one_kind(spark, text):
    rows = [(1, t, "user" if t % 2 else "assistant", text.format(t), "", 0) for t in range(300)]
    compare(spark, rows + [(2, 0, "user", "Hello.", "", 0), (2, 1, "assistant", "Hello.", "", 0)], 7)


def test_equal_turns_are_counted_not_kept(spark):
    damaged = spark.createDataFrame([(1, None, "user", "Hi.", "", 0)] * 500 + [(1, 3, "assistant", "Yes.", "", 0)], TURNS)
    report, turns = turn_repair.repair(damaged)
    row = report.first()
    assert (row.duplicate, row.illegal, row.gaps, row.audit) == (499, 499, 0, "K" + "D" * 499 + "K")
    assert [r.role for r in sorted(turns.collect(), key=lambda r: r.pos)] == ["user", "assistant"]


def test_passes_rerun_only_what_differs(spark):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant"]), f"Turn {t}.", "", 0) for c in range(20) for t in range(40)]
    cut, _ = store(turn_repair.chunks(turn_repair._placed(spark.createDataFrame(rows, TURNS)), 8), "c")
    steady, passes = turn_repair.converged(cut)
    assert cut.count() >= 100 and 1 <= passes <= 4
    by_conv = defaultdict(dict)
    for r in cut.select("conv", "part", "idx", "codes").collect():
        by_conv[r.conv][(r.part, r.idx)] = bytes(r.codes)
    wanted = {(r.conv, r.part, r.idx): tuple(r.wanted) for r in steady.collect()}
    for conv, found in by_conv.items():
        vector = turn_repair.END
        for at in sorted(found, reverse=True):
            assert wanted[(conv, *at)] == vector
            vector = turn_repair.vectors(found[at], vector)[0]


def test_vectors_stop_where_old_and_new_meet():
    rng = random.Random(4)
    for _ in range(200):
        codes = bytes(rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 8]) for _ in range(rng.randint(0, 30)))
        old, new = [turn_repair.vectors(bytes(rng.choice([1, 2, 5, 6]) for _ in range(3)), turn_repair.END)[0] for _ in range(2)]
        assert turn_repair.rerun(codes, old, new, turn_repair.vectors(codes, old)[0]) == turn_repair.vectors(codes, new)[0]


def test_edits_against_all_edits():
    """Every way to edit up to four turns with up to three insertions."""
    def ways(turns, state, inserts):
        if not turns:
            if state in "0a":
                yield 0, ""
        else:
            who, _, forced, cut = turns[0]
            options = [("D", state, 2)]
            if not forced:
                options += [("K", who, 5 * cut)] if who == {"0": "u", "s": "u", "u": "a", "a": "u"}[state] or (who == "s" and state == "0") else []
                options += [("R", {"0": "u", "s": "u", "u": "a", "a": "u"}[state], 1 + 5 * cut)]
            for letter, to, cost in options:
                for c, rest in ways(turns[1:], to, inserts):
                    yield cost + c, letter + rest
        if inserts:
            for c, rest in ways(turns, {"0": "u", "s": "u", "u": "a", "a": "u"}[state], inserts - 1):
                yield 5 + c, "I" + rest

    rng = random.Random(6)
    for _ in range(150):
        turns = [(rng.choice("suat"), "", rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randint(0, 4))]
        codes = bytes(turn_repair.FORCED if forced else (turn_repair.LETTERS + "t").index(who) + 4 * cut for who, _, forced, cut in turns)
        state, audit, cost = turn_repair.START, "", 0
        for code, vector in zip(codes, turn_repair.vectors(codes, turn_repair.END)[1:]):
            done, state, paid = turn_repair.edits_of(code, vector, state)
            audit, cost = audit + done, cost + paid
        audit, cost = audit + turn_repair.END_EDITS[state], cost + turn_repair.END[state]
        assert (cost, audit) == min(ways(turns, "0", 3)) == best_edits(turns)[:2]


def test_repair_without_rows(spark):
    report, turns = turn_repair.repair(spark.createDataFrame([], TURNS))
    assert report.collect() == [] and turns.collect() == []


def test_conversations_that_lose_all_turns(spark, tmp_path):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet"))
    row = turn_repair.op12_turn_repair(spark, str(tmp_path)).first()
    assert (row.conv_id, row.cost, row.audit, row.repaired_sha256) == (gone, 0, "", hashlib.sha256().hexdigest())
