"""SentencePiece encoding and decoding through a table of distinct marked words.

Where no piece of the vocabulary continues past a blank mark, merges never cross the
place before a run of marks. So a text falls apart there into marked words that are
segmented alone, each distinct one once; ids and surfaces are joined back by position.
The table lives in the task, is shared by its batches and emptied when full, so nothing
is shuffled and memory is bounded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from areakit.llm.common import map_batches, only

# Fixed value: the mark that stands for a blank.
MARK = "▁"
_CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_CROSSING = re.compile(f"[^{MARK}]{MARK}")

TABLE_CHUNKS = 300_000


class ChunkTable:
    """Ids (little-endian unsigned 32 bit) and surface of each distinct marked word."""

    def __init__(self, model: bytes, limit: int = TABLE_CHUNKS):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.limit = limit
        self.ids: dict[str, bytes] = {}
        self.surface: dict[str, str] = {}

    def learn(self, chunks: set[str]) -> None:
        if len(self.ids) > self.limit:
            self.ids, self.surface = {}, {}
        new = [c for c in chunks if c not in self.ids]
        # The library adds the first mark by itself; a lone mark it would drop.
        found = self.library.encode([c[1:] for c in new], num_threads=1)
        found = [ids if c != MARK else [self.library.piece_to_id(MARK)] for c, ids in zip(new, found)]
        for chunk, ids, text in zip(new, found, self.library.decode(found, num_threads=1) if new else []):
            self.ids[chunk] = np.array(ids, "<u4").tobytes()
            self.surface[chunk] = " " + text  # decoding drops one leading blank

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids with begin and end, and the text that they decode to."""
        begin, end = (np.array([i], "<u4").tobytes() for i in (self.library.bos_id(), self.library.eos_id()))
        if not text:
            return begin + end, ""
        chunks = _CHUNK.findall(MARK + text.replace(" ", MARK))
        self.learn(set(chunks))
        ids = b"".join(map(self.ids.__getitem__, chunks))
        return begin + ids + end, "".join(map(self.surface.__getitem__, chunks))[1:]


def read_model(path: str) -> bytes:
    """A model file whose pieces and normalization allow segmenting marked words alone."""
    import sentencepiece

    with open(path, "rb") as file:
        model = file.read()
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    if any(_CROSSING.search(library.id_to_piece(i)) for i in range(library.get_piece_size())):
        raise ValueError("a piece crosses a blank mark")
    probe = "  a ﬁ  "
    if library.decode(library.encode(probe)) != probe:
        raise ValueError("the model changes texts before it segments them")
    return model


def encode_documents(df: DataFrame, model_path: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (packed, 4 bytes each, little-endian) and ``decoded``.

    One row per row of ``df``, repeated rows and null or repeated doc_ids included. A null
    text counts as empty and gets the begin and end ids only. The model, bounded by its
    vocabulary, is read by the driver and broadcast.
    """
    model = df.sparkSession.sparkContext.broadcast(read_model(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model.value)
        for batch in batches:
            rows = [table.encode(t or "") for t in batch.column("text").to_pylist()]
            ids = [r[0] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array([r[1] for r in rows], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )

    source = only(df, doc_id="long", text="string")
    return map_batches(source, run, "doc_id long, n_tokens long, ids binary, decoded string")
