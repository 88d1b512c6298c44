"""Fill-in-middle transformation over seekable compressed frames.

A text is stored as independent zstandard frames, each with the units, code points and bytes before it. A unit is a run
of ASCII letters or any other single code point; a frame that begins inside a run knows it, so a run of any length may
cross frames. To cut a text at a unit only the frame that holds the cut is decompressed. The transformed text is again
a list of frames: whole frames are taken over as they are, only the cut ones are compressed anew. Digests read the
frames in order, one in memory at a time.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listing_analytics.llm.common import as_bytes, prepare, store, table, texts
from listing_analytics.llm.registry import query

FRAME_BYTES = 1 << 16
LEVEL = 3
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Markers in the order of each form; a plain text has none.
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
PLAIN_SHARE, SPM_SHARE = 10, 20  # percent of texts left plain, and of the others put suffix first

_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1] = True

_FRAME = pa.struct([("unit", pa.int64()), ("char", pa.int64()), ("inside", pa.bool_()), ("data", pa.binary())])
FRAMED = "doc_id long, n long, n_chars long, marked boolean, frames array<struct<unit long, char long, inside boolean, data binary>>"


def unit_starts(view: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of a UTF-8 piece: does a unit start here, does a code point. ``inside``: the piece follows a letter."""
    letter, char = _LETTER[view], (view & 0xC0) != 0x80
    after = np.empty_like(letter)
    after[:1] = inside
    after[1:] = letter[:-1]
    return char & ~(letter & after), char


def split_frames(text: bytes, frame_bytes: int) -> Iterator[bytes]:
    """Pieces of at most ``frame_bytes`` bytes (four at least) that end between code points."""
    at, size = 0, max(4, frame_bytes)
    while at < len(text):
        end = min(at + size, len(text))
        while end < len(text) and text[end] & 0xC0 == 0x80:
            end -= 1
        yield text[at:end]
        at = end


def _framed(frame_bytes: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=level, write_content_size=True).compress
        for batch in batches:
            units, chars, inner, data, ends, totals, sizes, marked = [], [], [], [], [0], [], [], []
            for text in as_bytes(batch.column(1)):
                unit, char, inside = 0, 0, False
                for piece in split_frames(text, frame_bytes):
                    start, first = unit_starts(np.frombuffer(piece, dtype=np.uint8), inside)
                    units.append(unit)
                    chars.append(char)
                    inner.append(inside)
                    data.append(pack(piece))
                    unit += int(np.count_nonzero(start))
                    char += int(np.count_nonzero(first))
                    inside = bool(_LETTER[piece[-1]])
                ends.append(len(units))
                totals.append(unit)
                sizes.append(char)
                marked.append(PREFIX in text or SUFFIX in text or MIDDLE in text)
            frames = pa.StructArray.from_arrays(
                [pa.array(units, pa.int64()), pa.array(chars, pa.int64()), pa.array(inner, pa.bool_()), pa.array(data, pa.binary())],
                fields=list(_FRAME))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(totals, pa.int64()), pa.array(sizes, pa.int64()), pa.array(marked, pa.bool_()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), frames)], ["doc_id", "n", "n_chars", "marked", "frames"])
    return run


def frame_texts(docs: DataFrame, frame_bytes: int = FRAME_BYTES, level: int = LEVEL,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text as frames: doc_id, n (units), n_chars, marked (does it contain a marker), frames.

    A null or empty text has no frames. Only id and text are read, so other columns cannot clash. Repeated rows stay as
    they are, an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    return texts(docs, id_col, text_col).mapInArrow(_framed(frame_bytes, level), FRAMED)


def read_frames(frames: list[bytes]) -> Iterator[bytes]:
    """The decompressed frames, one at a time."""
    unpack = zstandard.ZstdDecompressor().decompress
    return (unpack(frame) for frame in frames)


def drawn(doc_id: Column, n: Column, marked: Column, seed: int = 1) -> list[Column]:
    """low and high (units before the cuts) and form of a document, by the SHA-256 of ``seed:doc_id``.

    A null id is drawn as the empty text.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    a, b = h[0] % (n + 1), h[1] % (n + 1)
    form = (F.when((n == 0) | marked | (h[2] % 100 >= 100 - PLAIN_SHARE), "plain")
            .when(h[3] % 100 < SPM_SHARE, "spm").otherwise("psm"))
    return [F.least(a, b).alias("low"), F.greatest(a, b).alias("high"), form.alias("form")]


class _Text:
    """The frames of one text; frames that hold a cut are decompressed, the last one is remembered."""

    def __init__(self, frames: list[dict], n: int, n_chars: int, level: int):
        self.frames, self.n, self.n_chars = frames, n, n_chars
        self.units = [f["unit"] for f in frames]
        self.known: tuple[int, bytes] = (-1, b"")
        self.pack = zstandard.ZstdCompressor(level=level, write_content_size=True).compress

    def raw(self, number: int) -> bytes:
        if self.known[0] != number:
            self.known = number, zstandard.ZstdDecompressor().decompress(self.frames[number]["data"])
        return self.known[1]

    def cut(self, unit: int) -> tuple[int, int, int]:
        """(frame, byte in it, code points before) where unit number ``unit`` starts; the end for the number of units."""
        if unit >= self.n:
            return len(self.frames), 0, self.n_chars
        number = bisect_right(self.units, unit) - 1
        frame = self.frames[number]
        start, char = unit_starts(np.frombuffer(self.raw(number), dtype=np.uint8), frame["inside"])
        at = int(np.flatnonzero(start)[unit - frame["unit"]])
        return number, at, frame["char"] + int(np.count_nonzero(char[:at]))

    def between(self, low: tuple[int, int, int], high: tuple[int, int, int]) -> list[bytes]:
        """Frames of the text between two cuts; those between the cut frames are the stored ones."""
        out = []
        for number in range(low[0], min(high[0] + 1, len(self.frames))):
            start, end = low[1] if number == low[0] else 0, high[1] if number == high[0] else None
            if start == 0 and end is None:
                out.append(self.frames[number]["data"])
            elif end is None or end > start:
                out.append(self.pack(self.raw(number)[start:end]))
        return out


def _transformed(level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=level, write_content_size=True).compress
        marker = {m: pack(m) for m in (PREFIX, SUFFIX, MIDDLE)}
        for batch in batches:
            prefix_chars, middle_chars, outputs = [], [], []
            for n, n_chars, low, high, form, frames in zip(*[batch.column(i).to_pylist() for i in range(1, 7)]):
                if form == "plain":
                    prefix_chars.append(None)
                    middle_chars.append(None)
                    outputs.append([f["data"] for f in frames])
                    continue
                text = _Text(frames, n, n_chars, level)
                a, b = text.cut(low), text.cut(high)
                prefix_chars.append(a[2])
                middle_chars.append(b[2] - a[2])
                ends = {PREFIX: ((0, 0, 0), a), MIDDLE: (a, b), SUFFIX: (b, (len(frames), 0, n_chars))}
                outputs.append([piece for part in FORMS[form] for piece in [marker[part], *text.between(*ends[part])]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(5), pa.array(prefix_chars, pa.int64()),
                 pa.array(middle_chars, pa.int64()), pa.array(outputs, pa.list_(pa.binary()))],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def transform(framed: DataFrame, seed: int = 1, level: int = LEVEL) -> DataFrame:
    """Framed texts (:func:`frame_texts`) rearranged around two cuts drawn per document.

    Returns doc_id, n, form (plain, psm, spm), prefix_chars, middle_chars (null if plain) and output, the frames of the
    new text; together they are one valid zstandard stream. A text that is empty or contains a marker stays plain, so
    every output can be read back. Rows with equal id and text get equal results. Map only.
    """
    prepare(framed.sparkSession)
    cuts = framed.select("doc_id", "n", "n_chars", *drawn(F.col("doc_id"), F.col("n"), F.col("marked"), seed), "frames")
    return cuts.mapInArrow(_transformed(level), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output array<binary>")


def restored(form: str, output: list[bytes]) -> Iterator[bytes]:
    """The original text of a form and its output frames, in pieces.

    The first pass finds the markers, which the text itself cannot contain (they may lie across frames); the second reads
    what is between them in the order of the text.
    """
    if form == "plain":
        yield from read_frames(output)
        return
    order = FORMS[form]
    found, before, tail = [0], 0, b""
    for raw in read_frames(output):
        look, at = tail + raw, 0
        while len(found) < len(order) and (hit := look.find(order[len(found)], at)) >= 0:
            found.append(before - len(tail) + hit)
            at = hit + len(order[0])
        before += len(raw)
        tail = look[max(at, len(look) - len(order[0]) + 1):]
    spans = {m: (start + len(m), end) for m, start, end in zip(order, found, [*found[1:], before])}
    for marker in (PREFIX, MIDDLE, SUFFIX):
        low, high = spans[marker]
        at = 0
        for frame in output:
            size = zstandard.frame_content_size(frame)
            if at < high and at + size > low:
                yield zstandard.ZstdDecompressor().decompress(frame)[max(0, low - at):high - at]
            at += size


def _sha256(pieces: Iterator[bytes]) -> str:
    digest = hashlib.sha256()
    for piece in pieces:
        digest.update(piece)
    return digest.hexdigest()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        forms, outputs = batch.column(2).to_pylist(), batch.column(5).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:5], pa.array([_sha256(read_frames(o)) for o in outputs], pa.string()),
             pa.array([_sha256(restored(f, o)) for f, o in zip(forms, outputs)], pa.string())],
            [*batch.schema.names[:5], "output_sha256", "restored_sha256"])


def digests(transformed: DataFrame) -> DataFrame:
    """Transformed texts with the SHA-256 of the output and of the text restored from output and form, without the frames."""
    prepare(transformed.sparkSession)
    return transformed.mapInArrow(_digests, "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
                                            "output_sha256 string, restored_sha256 string")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        whole = [b"".join(read_frames(frames)) for frames in batch.column(5).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array([w.decode() for w in whole], pa.string())],
                                         [*batch.schema.names[:5], "output"])


def as_texts(transformed: DataFrame) -> DataFrame:
    """Transformed texts with the output as a plain string, for readers that don't stream frames."""
    prepare(transformed.sparkSession)
    return transformed.mapInArrow(_joined, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


_SQL = """
  with d as (select doc_id, coalesce(text, '') as text, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
  u as (select *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') as units,
      ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
      ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4 from d),
  n as (select *, len(units)::bigint as n from u),
  c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as low, greatest(h1 % (n + 1), h2 % (n + 1)) as high,
      case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
           when h4 % 100 < 20 then 'spm' else 'psm' end as form from n),
  s as (select *, array_to_string(units[1:low], '') as p, array_to_string(units[low + 1:high], '') as m,
      array_to_string(units[high + 1:n], '') as s from c)
  select doc_id, n, form, case when form <> 'plain' then length(p)::bigint end as prefix_chars,
         case when form <> 'plain' then length(m)::bigint end as middle_chars,
         sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256, sha256(text) as restored_sha256
  from s"""


@query("op11_fill_in_middle", _SQL)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, stored as frames, rearranged and read back."""
    framed, _ = store(frame_texts(table(spark, sf_dir, "documents")), "text-frames")
    return digests(transform(framed))
