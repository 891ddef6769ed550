"""Token counts with a linear longest-match automaton (operator 7).

A word is cut greedily into the longest pieces of a vocabulary. The vocabulary's trie gets failure links: from a node,
the link leads to the node of what is left after the longest pieces at its front have been popped, and the number of
popped pieces is stored with the node. So a word is read once, character by character, and its piece count is the sum
of the stored numbers; no piece is built.

Every word is preceded by the word-start mark of the vocabulary. A character outside the vocabulary counts as many
tokens as it has UTF-8 bytes (byte fallback). Vocabulary files are read from a path that the caller gives.

Defined cases: null text has 0 tokens; repeated rows and ids each give one row; an empty table gives an empty result;
extra columns are ignored; a text is read whole and counted word by word, so its length does not matter. The longest piece
always wins, and pieces of one length at one place are the same piece, so there are no ties.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES_PATH = "/opt/tokenizers/piece_bpe_32k.model"
START = "▁"
#: Words whose counts a task remembers; the memory is emptied when full.
MEMORY = 1 << 18


def load_pieces(path: str = PIECES_PATH) -> list[str]:
    """The ordinary pieces (no control, unknown or byte pieces) of a sentencepiece model file."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


class Automaton:
    """next[node][char], link[node], popped[node] (pieces popped on the way to link), rest[node] (pieces at the end)."""

    def __init__(self, pieces: Iterable[str]):
        known = set(pieces)
        weight = {c: 1 if c in known else len(c.encode()) for p in known for c in p}
        self.next: list[dict[str, int]] = [{}]
        piece_at: dict[int, int] = {}
        for piece in [*known, *weight]:  # single characters always end somewhere, so no word gets stuck
            node = 0
            for c in piece:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                node = self.next[node][c]
            piece_at[node] = weight[piece] if len(piece) == 1 else 1
        self.link, self.popped = [0] * len(self.next), [0] * len(self.next)
        queue = deque([0])
        while queue:
            u = queue.popleft()
            for c, v in self.next[u].items():
                if v in piece_at:
                    self.link[v], self.popped[v] = 0, piece_at[v]
                else:
                    z, n = self.link[u], self.popped[u]
                    while c not in self.next[z]:
                        n += self.popped[z]
                        z = self.link[z]
                    self.link[v], self.popped[v] = self.next[z][c], n
                queue.append(v)
        self.rest = [0] * len(self.next)
        for v in range(len(self.next)):
            n, z = 0, v
            while z:
                n += self.popped[z]
                z = self.link[z]
            self.rest[v] = n

    def count(self, word: str) -> int:
        steps, link, popped = self.next, self.link, self.popped
        node = total = 0
        for c in word:
            while (to := steps[node].get(c)) is None:
                if not node:
                    total += len(c.encode())
                    to = 0
                    break
                total += popped[node]
                node = link[node]
            node = to
        return total + self.rest[node]


@lru_cache(maxsize=2)
def automaton(pieces: tuple[str, ...]) -> Automaton:
    return Automaton(pieces)


def count_tokens(docs: DataFrame, pieces: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words and n_tokens, one row per document. ``pieces`` is a vocabulary (its size bounds what is sent)."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(pieces))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, seen = automaton(sent.value), {}
        for batch in batches:
            n_words, n_tokens = [], []
            for text in batch.column(1):
                # bytes.split() parts at exactly the blanks \x20 and \x09-\x0D
                ws = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                total = 0
                for w in ws:
                    n = seen.get(w)
                    if n is None:
                        n = of.count(START + w.decode("utf-8", "surrogatepass"))
                        if len(seen) >= MEMORY:
                            seen.clear()
                        if len(w) < 64:
                            seen[w] = n
                    total += n
                n_words.append(len(ws))
                n_tokens.append(total)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                                             ["doc_id", "n_words", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words bigint, n_tokens bigint")
