"""Token counts of whole texts, with huge texts encoded in overlapping chunks.

A byte-level vocabulary merges only within the words its pattern cuts. Between a
character that is no blank and a blank that pattern always cuts, whatever stands before
or after. Such a place is therefore a proven boundary: where two overlapping chunks
both start a token there, their encodings are spliced. If an overlap holds no such
place it is widened, in the end up to the whole rest of the text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areakit.llm.common import map_batches, only

# Fixed value: the published pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

CHUNK = 16_384
OVERLAP = 512
TABLE_WORDS = 500_000

# What lies between proven boundaries: blanks, then no blanks, up to the next blank.
_WORD = re.compile(r"\s*\S+|\s+")


# Separators that Python counts as blank and the pattern does not, and the other way round.
_UNSURE = re.compile("[\x1c-\x1f]")


def _byte_of() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary file.

    Printable bytes stand for themselves, all others for characters from 256 on.
    """
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteTokens:
    """Encodes with a byte-level vocabulary, special strings read as its default does."""

    def __init__(self, definition: str):
        import tiktoken

        parsed = json.loads(definition)
        byte_of = _byte_of()
        special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        ranks = {
            bytes(byte_of[c] for c in piece): number
            for piece, number in parsed["model"]["vocab"].items()
            if piece not in special
        }
        self._encoding = tiktoken.Encoding(
            "byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
        self._counts: dict[str, int] = {}

    def ids(self, text: str) -> list[int]:
        return self._encoding.encode(text, allowed_special="all")

    def count(self, text: str) -> int:
        """The number of tokens, from a table of those of each word between boundaries."""
        if len(self._counts) > TABLE_WORDS:
            self._counts = {}
        counts, total = self._counts, 0
        for word in _cut(text):
            number = counts.get(word)
            if number is None:
                number = counts[word] = len(self.ids(word))
            total += number
        return total

    def starts(self, text: str) -> np.ndarray:
        """The offset at which each token of ``text`` starts."""
        return np.array(self._encoding.decode_with_offsets(self.ids(text))[1], dtype=np.int64)


def _cut(text: str) -> list[str]:
    """``text`` in pieces that meet at proven boundaries only."""
    if _UNSURE.search(text):  # a blank to one library and none to the other: one piece
        return [text]
    return _WORD.findall(text)


def _stable(text: str, places: np.ndarray) -> list[int]:
    return [p for p in places.tolist() if p > 0 and text[p] in " \t\n\r" and not text[p - 1].isspace()]


def count_spliced(tokens: ByteTokens, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """The number of tokens of ``text``, encoded at most ``chunk`` characters at a time.

    Only a stretch without any blank is encoded in one piece, however long it is.
    """
    if len(text) <= chunk:
        return tokens.count(text)
    total, done, end = 0, 0, chunk
    left = tokens.starts(text[:end])
    while end < len(text):
        width, splice = overlap, None
        while splice is None and end - width > done:
            begin = end - width
            stop = min(len(text), end + chunk)
            right = begin + tokens.starts(text[begin:stop])
            common = np.intersect1d(left, right[right > begin])
            stable = _stable(text, common)
            if stable:
                splice = min(stable, key=lambda p: abs(p - (end - width // 2)))
            else:
                width *= 2
        if splice is None:  # no boundary back to the last splice: take both as one chunk
            end = min(len(text), end + chunk)
            left = done + tokens.starts(text[done:end])
        else:
            total += int((left < splice).sum())
            left, done, end = right[right >= splice], splice, stop
    return total + len(left)


def read_tokenizer(path: str) -> str:
    """The definition file, refused unless it is plain byte-level with the known pattern."""
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    parsed = json.loads(definition)
    cut = parsed["pre_tokenizer"]
    plain = cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]
    exact = not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in parsed["added_tokens"])
    if not plain or not exact or parsed["normalizer"] or parsed["model"]["ignore_merges"]:
        raise ValueError("not a plain byte-level vocabulary")
    return definition


def count_tokens(
    df: DataFrame, tokenizer_path: str, limit: int = 1024, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``, one row per row of ``df``.

    A null text counts as empty: no bytes, no tokens. Null and repeated doc_ids and
    repeated rows are kept as they are. The vocabulary is read by the driver and broadcast.
    """
    definition = df.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = ByteTokens(definition.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts = [count_spliced(tokens, t, chunk, overlap) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    source = only(df, doc_id="long", text="string").withColumn(
        "n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    )
    counted = map_batches(source, run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
