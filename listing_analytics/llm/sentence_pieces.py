"""SentencePiece encoding and decoding by streaming Viterbi.

A text is a lattice of the model's pieces; the ids of the best path (largest sum of scores) are its encoding. The search
reads character by character. Scores are needed for as many positions as the longest piece has characters; back pointers
are kept only since the last committed boundary. Whenever the paths to all positions from which a piece may still begin
run through one common boundary, the ids before it are final and leave the window.

Some boundaries are common for every text, because no piece crosses them (in front of a blank that follows another
character, and around a line end). There a text is cut first, and the ids of frequent stretches are remembered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from listing_analytics.llm.common import as_bytes, prepare, table, texts
from listing_analytics.llm.registry import query

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
_NONE = float("-inf")
REMEMBERED = 700_000
LONGEST_REMEMBERED = 48  # characters; longer stretches are encoded each time, so what is remembered is bounded in bytes


class Pieces:
    """A model file's pieces and scores, as a lattice encoder and a decoder.

    The file must neither rewrite characters nor collapse blanks; both would need its compiled tables.
    """

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            spec.ParseFromString(file.read())
        form = spec.normalizer_spec
        if form.precompiled_charsmap or form.remove_extra_whitespaces or not form.escape_whitespaces:
            raise ValueError("the model rewrites its input; only models that keep every character are supported")
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.prefix = form.add_dummy_prefix
        self.pieces = {model.id_to_piece(i): (i, model.get_score(i)) for i in plain}
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.unknown_id = model.unk_id()
        self.longest = max(map(len, self.pieces), default=1)
        self.begins = {piece[:i] for piece in self.pieces for i in range(1, len(piece))}  # what a longer piece begins with
        self.unknown = min((score for _, score in self.pieces.values()), default=0.0) - UNKNOWN_PENALTY
        self.kind = np.dtype("<u2" if n <= 1 << 16 else "<i4")
        self.packed = [i.tobytes() for i in np.arange(n, dtype=self.kind)]
        self.spelled = [b""] * n
        for piece, (i, _) in self.pieces.items():
            self.spelled[i] = piece.replace(SPACE, " ").encode()
        for value, i in self.bytes.items():
            self.spelled[i] = bytes([value])
        self.spelled[self.unknown_id] = " ⁇ ".encode()
        # No piece has a blank after another character, none a line end: then texts may be cut there.
        self.joined = {piece[i:i + 2] for piece in self.pieces for i in range(len(piece) - 1)}
        self.cuttable = not any(SPACE in piece.lstrip(SPACE) or "\n" in piece for piece in self.pieces)
        self.line_end = len(self._char_ids("\n")) * self.kind.itemsize
        self.known: dict[str, bytes] = {}
        self.former: dict[str, bytes] = {}

    def _char_ids(self, char: str) -> list[int]:
        return [self.bytes.get(b, self.unknown_id) for b in char.encode()] if self.bytes else [self.unknown_id]

    def short(self, text: str) -> list[int]:
        """What :meth:`stream` gives for a text that fits into its window, so that nothing is committed before the end."""
        get, begins, size, unknown = self.pieces.get, self.begins, len(text), self.unknown
        score, back, ids = [_NONE] * (size + 1), [0] * (size + 1), [-1] * (size + 1)
        score[0] = 0.0
        for start in range(size):
            here, end = score[start], start + 1
            part = text[start:end]
            found = get(part)
            value = here + (unknown if found is None else found[1])
            if value > score[end]:
                score[end], back[end], ids[end] = value, start, -1 if found is None else found[0]
            while part in begins and end < size:
                end += 1
                part = text[start:end]
                found = get(part)
                if found is not None and here + found[1] > score[end]:
                    score[end], back[end], ids[end] = here + found[1], start, found[0]
        return self._path(text, back, ids, 0, size)

    def stream(self, text: str) -> Iterator[int]:
        """Ids of the best path of an escaped text; of equal paths the one with the earlier last boundary."""
        get, begins, longest, base, size = self.pieces.get, self.begins, self.longest, 0, len(text)
        # By position, from the committed boundary on; those ahead hold the best of the pieces that have begun so far.
        score, back, ids = [0.0], [0], [0]
        for start in range(size):
            here, at = score[start - base], start - base + 1
            for end in range(start + 1, min(start + longest, size) + 1):
                part = text[start:end]
                found = get(part)
                if found is None:
                    if end == start + 1:  # the character alone is no piece
                        found = -1, self.unknown
                    elif part not in begins:
                        break
                    else:
                        if at == len(score):
                            score.append(_NONE)
                            back.append(start)
                            ids.append(-1)
                        at += 1
                        continue
                value = here + found[1]
                if at == len(score):
                    score.append(value)
                    back.append(start)
                    ids.append(found[0])
                elif value > score[at]:
                    score[at], back[at], ids[at] = value, start, found[0]
                if part not in begins:
                    break
                at += 1
            done = start + 1
            if done - base >= 2 * longest and done < size:
                shared = self._shared(back, base, done - longest + 1, done)
                if shared > base:
                    yield from self._path(text, back, ids, base, shared)
                    gone = shared - base
                    score, back, ids, base = score[gone:], back[gone:], ids[gone:], shared
        yield from self._path(text, back, ids, base, size)

    @staticmethod
    def _shared(back: list[int], base: int, first: int, last: int) -> int:
        """The last boundary on the paths to all positions from ``first`` to ``last``."""
        open_paths = set(range(first, last + 1))
        while len(open_paths) > 1:
            furthest = max(open_paths)
            open_paths.remove(furthest)
            open_paths.add(back[furthest - base])
        return open_paths.pop()

    def _path(self, text: str, back: list[int], ids: list[int], base: int, end: int) -> list[int]:
        out = []
        while end > base:
            number, start = ids[end - base], back[end - base]
            out.extend(reversed(self._char_ids(text[start:end])) if number < 0 else (number,))
            end = start
        return out[::-1]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        if not text:
            return np.empty(0, dtype=self.kind)
        if not (self.cuttable and self.prefix):
            escaped = (" " if self.prefix else "") + text
            return np.fromiter(self.stream(escaped.replace(" ", SPACE)), dtype=self.kind)
        # After the split every part lacks the blank before it; a part that begins with a line end had none.
        parts = text.replace(SPACE, " ").replace("\n", " \n").split(" ")
        if "" in parts:
            parts = self._with_runs(parts)
        if parts[0][:1] == "\n":
            parts = ["", *parts]  # the blank that the encoding begins with
        known = self.known
        found = list(map(known.get, parts))
        if None in found:
            found = [self._learn(part) if ids is None else ids for part, ids in zip(parts, found)]
        return np.frombuffer(b"".join(found), dtype=self.kind)

    def _with_runs(self, parts: list[str]) -> list[str]:
        """Empty parts are further blanks: they go to the front of the part after them, or stand alone."""
        out, blanks = [], 0
        for number, part in enumerate(parts):
            if part == "" and number < len(parts) - 1:
                blanks += 1
            elif part[:1] == "\n" and blanks:
                out += [" " * (blanks - 1), part]
                blanks = 0
            else:
                out.append(" " * blanks + part)
                blanks = 0
        return out

    def _learn(self, part: str) -> bytes:
        ids = self.known.get(part) or self.former.get(part)
        if ids is None:
            # No piece holds two characters that are not joined in any: what follows such a place is cut off one by one.
            end = len(part)
            while end > 1 and part[0] != "\n" and " " not in part[end - 2:end] and part[end - 2:end] not in self.joined:
                end -= 1
            if end < len(part):
                ids = self._learn(part[:end]) + b"".join([self._learn("\n" + char)[self.line_end:] for char in part[end:]])
            else:
                escaped = part if part[:1] == "\n" else SPACE + part.replace(" ", SPACE)
                ids = b"".join(map(self.packed.__getitem__, self.short(escaped) if len(escaped) < 2 * self.longest else self.stream(escaped)))
        if len(part) <= LONGEST_REMEMBERED:
            if len(self.known) > REMEMBERED // 2:
                self.former, self.known = self.known, {}
            self.known[part] = ids
        return ids

    def decode(self, ids: np.ndarray) -> bytes:
        """The text's bytes, without the blank that encoding puts in front."""
        text = b"".join(map(self.spelled.__getitem__, ids.tolist()))
        return text[1:] if self.prefix and text[:1] == b" " else text


_MODELS: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]


def _default(path: str | None) -> str:
    return path or public_tokenizers.path("piece_bpe_32k.model")


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values).astype(np.int32) if values else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            ids, same = [], []
            for text in as_bytes(batch.column(1)):
                ids.append(model.encode(text.decode("utf-8")))
                same.append(model.decode(ids[-1]) == text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(i) for i in ids], pa.int64()), _lists(ids), pa.array(same, pa.bool_())],
                ["doc_id", "n_ids", "ids", "round_trip"])
    return run


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text, in one pass without a shuffle.

    Returns doc_id, n_ids, ids, round_trip (whether decoding gives the text back; false only where a text holds the
    model's own sign for a blank). Null and empty texts have no ids; null ids of rows pass through; rows are encoded one
    by one, so repeated rows need no rule. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    return texts(docs, id_col, text_col).mapInArrow(
        _encode(_default(path)), "doc_id long, n_ids long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of every row of ids; null ids are an empty text, bytes that are no UTF-8 become U+FFFD."""
    prepare(encoded.sparkSession)
    path = _default(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            found = [model.decode(np.array(ids or [], dtype=np.int64)).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["doc_id", "text"])

    return encoded.selectExpr(f"cast({id_col} as long) as doc_id", f"{ids_col} as ids").mapInArrow(run, "doc_id long, text string")


@query("op3_sentence_pieces")
def op3_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents."""
    return encode(table(spark, sf_dir, "documents"))
