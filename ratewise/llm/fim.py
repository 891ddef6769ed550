"""Fill-in-middle examples by a piece table (operator 13).

A document is a list of descriptors (buffer, start, end) over buffers that never change: its text and the sentinels. Cutting
splits descriptors, an arrangement permutes the three parts between sentinels, the inverse permutation takes them out of
an output again, and digests read the descriptors one after the other. A text is copied once, when its output is asked for.

Cuts fall between units: a run of A-Z or a-z is one unit, every other code point is one of its own. Where they fall and
which order comes out is decided by the id's SHA-256 alone, so reruns and other layouts of the table agree. A text that
holds a sentinel stays plain, as its output could not be taken apart.

Defined cases: null text counts as empty and an empty text is plain; a null id is hashed as no digits; repeated rows and ids
each give one row; an empty table gives an empty result; extra columns are ignored; a text of any length is cut whole, in
memory in proportion to this one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The sentinels.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Of 100 documents so many get the middle moved, and of 100 of these so many have the suffix first.
MOVED_OF_100, SPM_OF_100 = 90, 20
#: (sentinel, part) in the order of the output; parts are numbered prefix 0, middle 1, suffix 2.
ORDERS = {PSM: ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), SPM: ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}
#: Code points that a digest encodes at a time.
STEP = 1 << 20

Piece = tuple[int, int, int]


class PieceTable:
    """A text as descriptors (buffer, start, end) over immutable buffers."""

    def __init__(self, buffers: tuple[str, ...], pieces: list[Piece]):
        self.buffers, self.pieces = buffers, pieces

    @classmethod
    def of(cls, text: str) -> PieceTable:
        return cls((text, PREFIX + SUFFIX + MIDDLE), [(0, 0, len(text))])

    def __len__(self) -> int:
        return sum(end - start for _, start, end in self.pieces)

    def cut(self, *offsets: int) -> list[PieceTable]:
        """The parts between ascending ``offsets``; a descriptor that an offset falls into is split."""
        parts, left, at = [], list(self.pieces), 0
        for offset in offsets:
            taken: list[Piece] = []
            while left and at < offset:
                buffer, start, end = left.pop(0)
                here = min(end - start, offset - at)
                taken.append((buffer, start, start + here))
                if start + here < end:
                    left.insert(0, (buffer, start + here, end))
                at += here
            parts.append(PieceTable(self.buffers, taken))
        return [*parts, PieceTable(self.buffers, left)]

    def joined(self, parts: list[PieceTable]) -> PieceTable:
        """The descriptors of ``parts``, which share this table's buffers, one after the other."""
        return PieceTable(self.buffers, [p for part in parts for p in part.pieces])

    def sentinel(self, mark: str) -> PieceTable:
        start = self.buffers[1].index(mark)
        return PieceTable(self.buffers, [(1, start, start + len(mark))])

    def text(self) -> str:
        return "".join(self.buffers[b][start:end] for b, start, end in self.pieces)

    def sha256(self) -> str:
        """Digest of the UTF-8 text, which is never put together."""
        digest = hashlib.sha256()
        for b, start, end in self.pieces:
            for at in range(start, end, STEP):
                digest.update(self.buffers[b][at:min(end, at + STEP)].encode("utf-8", "surrogatepass"))
        return digest.hexdigest()


def unit_starts(text: str) -> np.ndarray:
    """Code-point offsets at which the units of ``text`` begin."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = ((c | 32) >= ord("a")) & ((c | 32) <= ord("z"))
    start = np.ones(len(c), bool)
    start[1:] = ~(letter[1:] & letter[:-1])
    return np.flatnonzero(start)


def draws(doc_id) -> list[int]:
    """h1 to h4 of a document."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]


def arrangement(doc_id, text: str) -> tuple[int, str, list[int]]:
    """Number of units, form, and the two code-point offsets at which the text is cut."""
    h1, h2, h3, h4 = draws(doc_id)
    starts = unit_starts(text)
    n = len(starts)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= MOVED_OF_100:
        return n, PLAIN, []
    cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, SPM if h4 % 100 < SPM_OF_100 else PSM, [int(starts[k]) if k < n else len(text) for k in cuts]


def arrange(table: PieceTable, form: str, offsets: list[int]) -> PieceTable:
    """The output of ``form``: the three parts, permuted, each behind its sentinel."""
    if form == PLAIN:
        return table
    parts = table.cut(*offsets)
    return table.joined([p for mark, part in ORDERS[form] for p in (table.sentinel(mark), parts[part])])


def restored(output: str, form: str) -> PieceTable:
    """The text that an output was made of, as descriptors over that output. Only output and form are looked at."""
    table = PieceTable.of(output)
    if form == PLAIN:
        return table
    at = [(output.index(mark), mark, part) for mark, part in ORDERS[form]]
    ends = [begin for begin, _, _ in at[1:]] + [len(output)]
    parts = {part: PieceTable(table.buffers, [(0, begin + len(mark), end)]) for (begin, mark, part), end in zip(at, ends)}
    return table.joined([parts[k] for k in range(3)])


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", outputs: bool = True) -> DataFrame:
    """doc_id, n (units), form, prefix_chars and middle_chars (null if plain), output_sha256, restored_sha256 (of the text
    taken out of the output again) and, with ``outputs``, output; one row per document."""
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"] + ["output"] * outputs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in names[1:]]
            for doc_id, value in zip(batch.column(0), batch.column(1)):
                text = value.as_py() or ""
                n, form, offsets = arrangement(doc_id.as_py(), text)
                made = arrange(PieceTable.of(text), form, offsets)
                output = made.text()
                row = (n, form, *((offsets[0], offsets[1] - offsets[0]) if offsets else (None, None)),
                       made.sha256(), restored(output, form).sha256(), output)
                for column, v in zip(columns, row):
                    column.append(v)
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns, types)], names)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = (f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n bigint, form string, prefix_chars bigint, "
              "middle_chars bigint, output_sha256 string, restored_sha256 string") + ", output string" * outputs
    return rows.mapInArrow(run, schema)


def restore(outputs: DataFrame, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """``outputs`` with the column ``restored``: the exact text, from output and form only. A null output or form gives null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [batch.schema.names.index(c) for c in (output_col, form_col)]
            texts = [None if o is None or f is None else restored(o, f).text()
                     for o, f in zip(*(batch.column(k).to_pylist() for k in at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "restored"])

    return outputs.mapInArrow(run, T.StructType([*outputs.schema.fields, T.StructField("restored", T.StringType())]))


#: DuckDB SQL of the registered query, from the contract.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]', 0, 's') AS units,
             ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3,
             ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
             greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
             array_to_string(units[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
