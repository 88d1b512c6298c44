"""Packing token sequences: order-preserving dynamic programming over cut points.

The tokens of a partition stand in the order of its rows. A window of at most ``capacity`` tokens may end at the end of
a document, at the end of a sentence or, inside very long sentences, at regular places; the last two cost a penalty, as
they truncate a document. The cuts minimise padding plus penalties. Since padding falls linearly with the length, the
best start of a window that ends at a cut is a minimum over a sliding range of cuts: a monotone queue holds it, so the
work is linear in the number of cuts. Windows of a power of two need no padding and are tried as well.

Nothing is shuffled: each partition of the input packs its own rows in one pass, keeping a bounded stretch of tokens and
carrying the unfinished end of one stretch into the next. Only the end of a partition can leave a short window.
"""

from __future__ import annotations

import os
import re
from collections import deque
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from listing_analytics.llm.common import as_bytes, prepare, table, texts
from listing_analytics.llm.registry import query

CAPACITY = 4096
END_ID = 2
SENTENCE_PENALTY = 16  # in tokens of padding
INNER_PENALTY = 64
INNER_STEP = 256  # places for cuts in a sentence longer than this
STRETCH = 1 << 20  # tokens in memory before windows are given out
TEXT_AT_ONCE = 1 << 21  # bytes
REMEMBERED = 600_000  # words whose ids are kept
_REMEMBER_EVERY = 8
_MARKS = ".,!?#$%&*|"  # without the apostrophe, which may begin a token such as 's
_BETWEEN, _TOGETHER = "\x01", 200

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _byte_letters() -> dict[int, str]:
    """The printable characters that stand for bytes in a byte-level vocabulary; blanks stay, as they part words."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(256 + i) for i, b in enumerate(others)} | {b: chr(b) for b in [*plain, 32]}


class WordTokenizer:
    """Ids of whole texts from a lower-casing byte-level BPE tokenizer that never joins tokens across blanks.

    A text is cut at blanks and line ends. The ids of frequent words are remembered; the other words of many texts go to
    the tokenizer together. Words of Latin letters, with or without marks after them, need none of its normalisation
    and patterns and go to the same BPE model directly.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task per core
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole, self.letters = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.letters.normalizer, self.letters.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
        self.byte_letters = _byte_letters()
        vocabulary = self.whole.get_vocab(with_added_tokens=True)
        self.kind = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.sentence_end, self.word_end = np.zeros((2, max(vocabulary.values()) + 1), bool)
        self.sentence_end[[i for word, i in vocabulary.items() if re.search(r"[.!?](</w>)?$", word)]] = True
        self.word_end[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.marks: dict[str, bytes] = {}
        self.between, = self.whole.encode(_BETWEEN, add_special_tokens=False).ids
        self.known: dict[str, bytes] = {"": b""}
        self.former: dict[str, bytes] = {}
        self.calls = 0

    def _one(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=self.kind).tobytes()

    def _calls(self, tokenizer, groups: list[str], parts) -> Iterator[bytes]:
        """Ids of the words of joined groups; ``parts`` gives the starts and ends of the words in a group's ids."""
        width = self.kind.itemsize
        for found in tokenizer.encode_batch_fast(groups, add_special_tokens=False):
            ids = np.array(found.ids, dtype=self.kind)
            starts, ends = parts(ids)
            ids = ids.tobytes()
            yield from [ids[s * width:e * width] for s, e in zip(starts, ends)]

    def _of_letters(self, words: list[str]) -> Iterator[bytes]:
        """Lower-cased words of letters, as byte letters: the last token of each has the word-end mark."""
        def parts(ids: np.ndarray) -> tuple[list[int], list[int]]:
            ends = (np.flatnonzero(self.word_end[ids]) + 1).tolist()
            return [0, *ends[:-1]], ends

        groups = [" ".join(words[i:i + _TOGETHER]) for i in range(0, len(words), _TOGETHER)]
        groups = [g if g.isascii() else g.encode().decode("latin-1").translate(self.byte_letters) for g in groups]
        return self._calls(self.letters, groups, parts)

    def _of_others(self, words: list[str]) -> Iterator[bytes]:
        """Any words: between them stands a mark that is one token; a word that holds it is asked for by itself."""
        def parts(ids: np.ndarray) -> tuple[list[int], list[int]]:
            marks = np.flatnonzero(ids == self.between)
            return [0, *(marks + 1).tolist()], [*marks.tolist(), len(ids)]

        clear = [word for word in words if _BETWEEN not in word]
        groups = [f" {_BETWEEN} ".join(clear[i:i + _TOGETHER]) for i in range(0, len(clear), _TOGETHER)]
        found = self._calls(self.whole, groups, parts)
        return iter([self._one(word) if _BETWEEN in word else next(found) for word in words])

    def _ids(self, words: list[str]) -> list[bytes]:
        cores = [word.rstrip(_MARKS) for word in words]
        marks = [word[len(core):] for word, core in zip(words, cores)]
        cores = [core.lower() for core in cores]
        easy = [core.isalpha() and (core.isascii() or max(core) < "\u0250") for core in cores]
        latin = self._of_letters([core for core, is_easy in zip(cores, easy) if is_easy])
        others = self._of_others([word for word, is_easy in zip(words, easy) if not is_easy])
        self.marks = {mark: self.marks.get(mark) or self._one(mark) for mark in set(marks)}
        return [next(latin) + self.marks[mark] if is_easy else next(others) for is_easy, mark in zip(easy, marks)]

    def _remember(self, fresh: dict[str, bytes]) -> None:
        """Frequent words soon turn up in one of the batches that are remembered; rare ones leave with their generation."""
        if len(self.known) > REMEMBERED // 2:
            self.former, self.known = self.known, {"": b""}
        self.known.update(fresh)

    def encode(self, some: list[str]) -> list[np.ndarray]:
        split = [text.replace("\n", " ").split(" ") for text in some]
        words = list(chain.from_iterable(split))
        found = list(map(self.known.get, words))
        holes = [at for at, ids in enumerate(found) if ids is None]
        fresh = dict.fromkeys([words[at] for at in holes])
        fresh.update([(word, self.former[word]) for word in fresh if word in self.former])
        asked = [word for word, ids in fresh.items() if ids is None]
        fresh.update(zip(asked, self._ids(asked)))
        if self.calls % _REMEMBER_EVERY == 0 or len(self.known) < REMEMBERED // 8:
            self._remember(fresh)
        self.calls += 1
        for at in holes:
            found[at] = fresh[words[at]]
        ends = np.cumsum([len(line) for line in split]).tolist()
        return [np.frombuffer(b"".join(found[s:e]), dtype=self.kind) for s, e in zip([0, *ends], ends)]


def cuts(places: np.ndarray, penalties: np.ndarray, capacity: int) -> list[int]:
    """The places (ascending, first 0, gaps within ``capacity``) at which the cheapest packing begins or ends windows."""
    n = len(places)
    exact = []
    for length in (capacity // 2, capacity // 4):
        at = np.searchsorted(places, places - length)
        exact.append(np.where((places >= length) & (places[np.minimum(at, n - 1)] == places - length), at, -1).tolist())
    half, quarter = exact
    where, extra = places.tolist(), penalties.tolist()
    cost, came, key = [0.0] * n, [0] * n, [0.0] * n
    queue = deque([0])
    for j in range(1, n):
        here = where[j]
        while here - where[queue[0]] > capacity:
            queue.popleft()
        best = queue[0]
        least = key[best] + capacity - here
        for i in (half[j], quarter[j]):
            if i >= 0 and cost[i] < least:
                least, best = cost[i], i
        least += extra[j]
        cost[j], came[j] = least, best
        k = key[j] = least + here
        while queue and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j)
    path, j = [], n - 1
    while j:
        path.append(where[j])
        j = came[j]
    return path[::-1]


def tail(length: int, capacity: int) -> list[int]:
    """Lengths for the last window of a partition: powers of two from its front while that saves padding."""
    best, chosen, taken, rest = None, [length], [], length
    while True:
        padding = 0 if rest & (rest - 1) == 0 else capacity - rest
        if best is None or padding + INNER_PENALTY * len(taken) < best:
            best, chosen = padding + INNER_PENALTY * len(taken), [*taken, rest]
        if not padding:
            return chosen
        taken.append(1 << (rest.bit_length() - 1))
        rest -= taken[-1]


class Packer:
    """Documents in, pieces out; tokens that aren't given out yet are ``self.parts``."""

    def __init__(self, tokenizer: WordTokenizer, capacity: int, partition: int):
        self.tokenizer, self.capacity, self.sequence = tokenizer, capacity, partition << 32
        self.parts: list[tuple[object, int, int, np.ndarray]] = []  # id, start in the document, its length, tokens
        self.size = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.parts.append((doc_id, 0, len(ids) + 1, np.append(ids, self.tokenizer.kind.type(END_ID))))
        self.size += len(ids) + 1

    def _places(self) -> tuple[np.ndarray, np.ndarray]:
        tokens = np.concatenate([p[3] for p in self.parts])
        ends = np.cumsum([len(p[3]) for p in self.parts])
        sentences = np.flatnonzero(self.tokenizer.sentence_end[tokens]) + 1
        places = np.union1d(np.union1d(sentences, ends), [0])
        gaps = np.flatnonzero(np.diff(places) > min(INNER_STEP, self.capacity))
        step = min(INNER_STEP, self.capacity)
        inner = [np.arange(places[g] + step, places[g + 1], step) for g in gaps]
        penalties = np.full(len(places), float(SENTENCE_PENALTY))
        if inner:
            more = np.concatenate(inner)
            at = np.searchsorted(places, more)
            places, penalties = np.insert(places, at, more), np.insert(penalties, at, float(INNER_PENALTY))
        penalties[np.searchsorted(places, ends)] = 0.0
        return places, penalties

    def pieces(self, last: bool) -> Iterator[tuple]:
        """Windows of the stretch; without ``last`` its final two stay, as more tokens may change them."""
        if not self.parts:
            return
        found = cuts(*self._places(), self.capacity)
        if last:
            start = found[-2] if len(found) > 1 else 0
            found = found[:-1] + (start + np.cumsum(tail(found[-1] - start, self.capacity))).tolist()
        else:
            found = found[:-2]
        begin, number, used = 0, 0, 0  # used: tokens of parts[number] given out
        for end in found:
            offset = 0
            while begin < end:
                doc_id, start, total, tokens = self.parts[number]
                length = min(end - begin, len(tokens) - used)
                ids = tokens[used:used + length]
                yield (doc_id, start + used, length, ids, total, self.sequence, offset)
                begin, used, offset = begin + length, used + length, offset + length
                if used == len(tokens):
                    number, used = number + 1, 0
            self.sequence += 1
        self.size -= begin
        self.parts = self.parts[number:]
        if used:
            doc_id, start, total, tokens = self.parts[0]
            self.parts[0] = (doc_id, start + used, total, tokens[used:])


_TOKENIZERS: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def _pack(path: str, capacity: int, with_ids: bool):
    kinds = [pa.int64()] * 7
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def rows(pieces: list[tuple]) -> pa.RecordBatch:
        columns = [[p[0] for p in pieces], [p[1] for p in pieces], [p[2] for p in pieces],
                   [crc32(p[3].astype("<u4").tobytes()) for p in pieces], [p[4] for p in pieces],
                   [p[5] for p in pieces], [p[6] for p in pieces]]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        if not with_ids:
            return pa.RecordBatch.from_arrays(arrays, names)
        offsets = np.concatenate(([0], np.cumsum(columns[2]))).astype(np.int32)
        flat = np.concatenate([p[3] for p in pieces]) if pieces else np.empty(0)
        return pa.RecordBatch.from_arrays([*arrays, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))],
                                          [*names, "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(word_tokenizer(path), capacity, TaskContext.get().partitionId())
        for batch in batches:
            some, ids, size = [], [], 0
            for doc_id, text in chain(zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))), [(None, None)]):
                if text is not None:
                    some.append(text.decode("utf-8"))
                    ids.append(doc_id)
                    size += len(text)
                if some and (text is None or size >= TEXT_AT_ONCE):
                    for known, tokens in zip(ids, packer.tokenizer.encode(some)):
                        packer.add(known, tokens)
                    some, ids, size = [], [], 0
                    if packer.size >= STRETCH:
                        yield rows(list(packer.pieces(last=False)))
        yield rows(list(packer.pieces(last=True)))
    return run


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents in sequences of at most ``capacity`` tokens.

    Returns doc_id, start, length (of the piece, in the document's tokens), ids_crc32 (little-endian unsigned 32-bit
    ids), doc_tokens, sequence_id (partition number in the upper half), offset, and the ids with ``with_ids``. A
    document is its token ids and then ``END_ID``; a null or empty text is that id alone. Repeated rows are packed each
    for itself, null ids pass through, an empty table gives no pieces. The order is that of the rows in their files.
    """
    prepare(docs.sparkSession)
    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    path = path or public_tokenizers.path("word_bpe_49k.json")
    return texts(docs, id_col, text_col).mapInArrow(_pack(path, capacity, with_ids), schema)


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens."""
    return pack(table(spark, sf_dir, "documents"))
