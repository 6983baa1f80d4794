"""SentencePiece ids and text through a table of distinct chunks.

A piece never holds a whitespace marker behind another character, and never a
newline. Merges therefore stay inside chunks: a newline, or a run of markers with
the characters up to the next marker or newline. A chunk is segmented once, as long
as the table keeps it, and its ids are put back at each of its positions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain
from sys import getsizeof

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame

from silverair.llm.batches import map_texts, slices

CHUNK = re.compile(r"\n| *[^ \n]+| +")
MARKER = "▁"
# Where a text may be cut: before a newline, or before the first of a run of markers.
BORDER = re.compile(r"\n|(?<! ) ")
# Characters whose chunks are looked up at once, and bytes of the chunk table that a task keeps.
# They bound memory only.
GROUP_CHARS = 200_000
TABLE_BYTES = 32_000_000
SLOT_BYTES = 60  # of a dictionary for one entry, about


def pack(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def parts(text: str) -> Iterator[str]:
    """Consecutive parts of about GROUP_CHARS characters, cut where no chunk is."""
    start = 0
    while border := BORDER.search(text, start + GROUP_CHARS):
        yield text[start : border.start()]
        start = border.start()
    yield text[start:]


class ChunkTable:
    """Packed ids of each distinct chunk, and its decoded text where that is not the chunk itself."""

    def __init__(self, model: bytes) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        for piece in map(self.model.id_to_piece, range(self.model.get_piece_size())):
            if "\n" in piece or MARKER in piece.lstrip(MARKER):
                raise ValueError(f"piece {piece!r} crosses a chunk border")
        self.lead = len(self.model.encode("\n"))
        self.begin, self.end = (pack([i]) for i in (self.model.bos_id(), self.model.eos_id()))
        self.ids: dict[str, bytes] = {}
        self.text: dict[str, str] = {}
        self.size = 0

    def learn(self, chunks: set[str]) -> None:
        """Segment the chunks that are not in the table yet.

        A newline in front keeps the model from adding a marker to the chunk.
        """
        if self.size > TABLE_BYTES:
            self.ids, self.text, self.size = {}, {}, 0
        new = [c for c in chunks if c not in self.ids]
        ids = self.model.encode(["\n" + c for c in new], num_threads=1)
        back = self.model.decode(ids, num_threads=1)
        packed = [pack(i[self.lead :]) for i in ids]
        other = {c: t[1:] for c, t in zip(new, back, strict=True) if t[1:] != c}
        self.ids.update(zip(new, packed, strict=True))
        self.text.update(other)
        self.size += SLOT_BYTES * (len(new) + len(other)) + sum(map(getsizeof, chain(new, packed, other.values())))

    def code(self, marked: list[str]) -> tuple[list[bytes], list[str]]:
        """Ids and text, without begin and end, of texts whose first marker is there."""
        chunked = [CHUNK.findall(t) for t in marked]
        self.learn(set().union(*chunked))
        ids, decoded = self.ids.__getitem__, self.text.get
        return [b"".join(map(ids, c)) for c in chunked], ["".join(map(decoded, c, c)) for c in chunked]

    def __call__(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        packed: list[bytes] = []
        decoded: list[str] = []
        for low, high in slices(texts, GROUP_CHARS):
            # The model puts one marker in front of a text that is not empty.
            marked = [" " + t.replace(MARKER, " ") if t else "" for t in texts[low:high]]
            if high - low > 1:
                ids, back = self.code(marked)
            else:
                coded = [self.code([part]) for part in parts(marked[0])]
                ids, back = [b"".join(i for [i], _ in coded)], ["".join(t for _, [t] in coded)]
            packed += [b"".join([self.begin, i, self.end]) for i in ids]
            decoded += [t[1:] for t in back]
        return packed, decoded


def encode_decode(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``ids`` (packed little-endian unsigned 32-bit, with begin and end id) and ``decoded`` text of every row.

    Ids equal the library's ``encode`` of the whole text, ``decoded`` its
    ``decode`` of those ids. A null text counts as empty: begin and end id, empty
    decoded text. Rows are neither dropped nor merged; a repeated row gives a
    repeated result, an empty table an empty one.
    """
    with open(model_path, "rb") as file:
        model = file.read()
    return map_texts(docs, id_column, text_column, "ids binary, decoded string", lambda: ChunkTable(model))
