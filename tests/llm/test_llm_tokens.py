"""Sentence pieces and packing: round trips, the library's own encoder, brute-force packing."""

import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from listing_analytics.llm import packing, sentence_pieces

ALPHABET = list("  \n\nabcthe▁ éüß.,!?'0129漢字🙂\x01\t") + ["tion", "ing", " the", "\n\n", "   ", "don't ", "'s", "ÀÉ", "İ", "<|endoftext|>", "é"]


def random_text(rng, n):
    return "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, n)))


@pytest.fixture(scope="module")
def model_path():
    return public_tokenizers.path("piece_bpe_32k.model")


def test_same_as_the_library_in_lattice_mode(model_path, tmp_path):
    """The library sums scores in 32 bits, so its unknown penalty must stay small and texts short."""
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(model_path, "rb").read())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        piece.score = max(piece.score, -40000)
    (tmp_path / "lattice.model").write_bytes(proto.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    ours, rng = sentence_pieces.Pieces(str(tmp_path / "lattice.model")), random.Random(5)
    for _ in range(400):
        text = random_text(rng, 12)[:24]
        assert ours.encode(text).tolist() == library.encode(text)


def test_round_trip_and_stream(model_path):
    model, rng = sentence_pieces.Pieces(model_path), random.Random(6)
    for size in [0, 1, 2, *[40] * 200, 4000]:
        text = random_text(rng, size)
        ids = model.encode(text)
        assert model.decode(ids).decode() == text.replace("▁", " ")
        if text:
            assert list(model.stream("▁" + text.replace(" ", "▁"))) == ids.tolist()


def brute_path(model, text):
    best = [(0.0, [])] + [None] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            piece = text[start:end]
            score = model.pieces[piece][1] if piece in model.pieces else model.unknown if end - start == 1 else None
            if score is not None and (best[end] is None or best[start][0] + score > best[end][0]):
                best[end] = (best[start][0] + score, [*best[start][1], piece])
    return best[-1][0]


def test_stream_is_the_best_path(model_path):
    model, rng = sentence_pieces.Pieces(model_path), random.Random(7)
    for _ in range(60):
        text = "▁" + random_text(rng, 60).replace(" ", "▁").replace("\n", "a")
        score = {i: s for i, s in model.pieces.values()}
        ids = list(model.stream(text))
        plain = sum(score[i] for i in ids if i in score)
        unknown = sum(c not in model.pieces for c in text)
        assert plain + unknown * model.unknown == pytest.approx(brute_path(model, text), rel=1e-12)


def test_window_commits_early(model_path):
    """A long stretch without blanks is given out long before its end."""
    model, read = sentence_pieces.Pieces(model_path), []

    class Watched(str):
        def __getitem__(self, key):
            if isinstance(key, slice):
                read.append(key.stop)
            return str.__getitem__(self, key)

    first = next(model.stream(Watched("internationalization" * 400)))
    assert first == next(model.stream("internationalization" * 400)) and max(read) < 500


@pytest.mark.parametrize("alphabet", ["0123456789", "漢字日本語中文国的是", "0a1b漢", "🙂🙃é"])
def test_long_runs_without_blanks(model_path, alphabet):
    model, rng = sentence_pieces.Pieces(model_path), random.Random(9)
    text = "".join(rng.choices(alphabet, k=100_000))
    for whole in (text, "see " + text + "th of\n" + text[:5000] + " x", "\n" + text):
        ids = model.encode(whole)
        assert model.decode(ids).decode() == whole
        assert ids.tolist() == list(model.stream("▁" + whole.replace(" ", "▁")))
    assert max(map(len, [*model.known, *model.former])) <= sentence_pieces.LONGEST_REMEMBERED


def test_encode_frames(spark):
    rows = [(1, "Hello  world\n x", "n"), (2, None, "n"), (3, "", None), (None, "tail ", "n"), (1, "Hello  world\n x", "n"), (4, "a b " * 50000, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = sentence_pieces.encode(frame)
    assert all(r.round_trip and r.n_ids == len(r.ids) for r in encoded.collect())
    decoded = sentence_pieces.decode(encoded).collect()
    key = lambda pairs: sorted(pairs, key=lambda p: (p[0] is None, p))
    assert key([(r.doc_id, r.text) for r in decoded]) == key([(i, t or "") for i, t, _ in rows])
    assert sentence_pieces.encode(frame.limit(0)).count() == 0


@pytest.fixture(scope="module")
def word_path():
    return public_tokenizers.path("word_bpe_49k.json")


def test_word_ids_are_the_tokenizers(word_path, monkeypatch):
    whole, rng = Tokenizer.from_file(word_path), random.Random(8)
    some = [random_text(rng, 60) for _ in range(300)] + ["Straße ŒUVRE ÇA!!! x*** don't. 'tis, naïve&&& Ǆ ﬁ   á"]
    want = [whole.encode(t, add_special_tokens=False).ids for t in some]
    for remembered in (packing.REMEMBERED, 50):
        monkeypatch.setattr(packing, "REMEMBERED", remembered)
        ours = packing.WordTokenizer(word_path)
        for start in range(0, len(some), 40):
            assert [ids.tolist() for ids in ours.encode(some[start:start + 40])] == want[start:start + 40]


def brute_cost(places, penalties, capacity):
    best = [0.0] + [float("inf")] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            length = places[j] - places[i]
            if length <= capacity:
                padding = 0 if length in (capacity // 2, capacity // 4) else capacity - length
                best[j] = min(best[j], best[i] + padding + penalties[j])
    return best[-1]


def test_cuts_are_the_cheapest():
    rng = random.Random(9)
    for _ in range(60):
        places = np.cumsum([0] + [rng.randint(1, 9) for _ in range(rng.randint(1, 60))])
        penalties = np.array([rng.choice([0.0, 2.0, 5.0]) for _ in places])
        found = [0, *packing.cuts(places, penalties, 16)]
        assert found[-1] == places[-1] and set(found) <= set(places.tolist())
        penalty, cost = dict(zip(places.tolist(), penalties)), 0.0
        for a, b in zip(found, found[1:]):
            assert b - a <= 16
            cost += (0 if b - a in (8, 4) else 16 - (b - a)) + penalty[b]
        assert cost == brute_cost(places.tolist(), penalties.tolist(), 16)


def test_tail():
    for length in range(1, 4097):
        parts = packing.tail(length, 4096)
        assert sum(parts) == length and all(p > 0 for p in parts)


@pytest.mark.parametrize("capacity, stretch", [(4096, 1 << 20), (64, 1 << 20), (64, 500)])
def test_pack(spark, word_path, monkeypatch, capacity, stretch):
    monkeypatch.setattr(packing, "STRETCH", stretch)
    rng = random.Random(10)
    rows = [(i, random_text(rng, 300), "x") for i in range(60)] + [(100, None, None), (101, "", None), (102, "word " * 9000, "s"), (5, "again.", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, length string").coalesce(2)
    pieces = packing.pack(frame, capacity=capacity, with_ids=True).collect()
    whole = Tokenizer.from_file(word_path)
    want = defaultdict(list)
    for doc_id, text, _ in rows:
        want[doc_id].append(whole.encode(text or "", add_special_tokens=False).ids + [2])
    for doc_id, token_lists in want.items():
        own = sorted((p for p in pieces if p.doc_id == doc_id), key=lambda p: (p.start, p.sequence_id))
        assert sum(p.length for p in own) == sum(map(len, token_lists))
        if len(token_lists) == 1:
            assert [i for p in own for i in p.ids] == token_lists[0]
            assert [p.start for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
            assert {p.doc_tokens for p in own} == {len(token_lists[0])}
    sequences = defaultdict(list)
    for p in pieces:
        assert p.ids_crc32 == crc32(np.array(p.ids, "<u4").tobytes()) and p.length == len(p.ids) > 0
        sequences[p.sequence_id].append(p)
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
        assert sum(p.length for p in own) <= capacity
    padding = sum(0 if n & (n - 1) == 0 else capacity - n for n in (sum(p.length for p in own) for own in sequences.values()))
    assert padding < 0.15 * sum(p.length for p in pieces)
    assert packing.pack(frame.limit(0)).count() == 0


def test_short_and_streamed_texts_agree():
    model = sentence_pieces.pieces(sentence_pieces._default(None))
    rng = random.Random(21)
    signs = ["the", "ing", "▁", "a", "é", "日", "0", "1", "\n", "zz", "Q", "tion", "▁of"]
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(1, 9)))[:2 * model.longest]
        assert model.short(text) == list(model.stream(text)), text
