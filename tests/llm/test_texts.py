"""Piece encoding and token counts against the libraries themselves."""

import hashlib
import os
import random
import struct

import public_tokenizers
import pytest
import sentencepiece

from areakit.llm import pieces, tokens

os.environ["TOKENIZERS_PARALLELISM"] = "false"
from tokenizers import Tokenizer  # noqa: E402

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "ab cde  \n\t▁éß漢1 2'sT!.,<>|\x1c\x85\xa0　👍\x00" + "  "


def texts(n, longest, seed):
    draw = random.Random(seed)
    for _ in range(n):
        yield "".join(draw.choices(ALPHABET, k=draw.randrange(longest)))
    yield from ("<|endoftext|>", "a<|endoftext|> b <|endoftext", " ", "  ", "don't I'll", "▁", "▁▁ a▁ ", "x\n\n\ny")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(BYTES)


def test_chunk_table_equals_library(library):
    table = pieces.ChunkTable(pieces.read_model(PIECES), limit=50)  # emptied many times
    for text in texts(400, 60, 1):
        ids = library.encode(text, add_bos=True, add_eos=True)
        packed, decoded = table.encode(text)
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == ids, repr(text)
        assert decoded == library.decode(ids), repr(text)


def test_encode_documents(frame, odd_rows, library):
    rows = pieces.encode_documents(frame(odd_rows), PIECES).collect()
    expected = []
    for doc, text, _ in odd_rows:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        expected.append((doc, len(ids), digest, library.decode(ids)))
    found = [(r.doc_id, r.n_tokens, hashlib.sha256(r.ids).hexdigest(), r.decoded) for r in rows]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert pieces.encode_documents(frame([]), PIECES).count() == 0


def test_spliced_counts_equal_library(tokenizer):
    own = tokens.ByteTokens(tokens.read_tokenizer(BYTES))
    for text in texts(300, 400, 2):
        expected = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert own.count(text) == expected, repr(text)
        assert tokens.count_spliced(own, text, chunk=40, overlap=4) == expected, repr(text)


def test_splicing_widens_where_nothing_is_stable(tokenizer):
    own = tokens.ByteTokens(tokens.read_tokenizer(BYTES))
    for text in ("ab" * 300 + " cd" * 50, "\n" * 500 + "x y " * 40, "q" * 700):
        expected = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert tokens.count_spliced(own, text, chunk=64, overlap=8) == expected


def test_count_tokens(frame, odd_rows, tokenizer):
    rows = tokens.count_tokens(frame(odd_rows), BYTES, chunk=2_000, overlap=50).collect()
    expected = []
    for doc, text, _ in odd_rows:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc, len((text or "").encode()), n, n > 1024))
    assert sorted((tuple(r) for r in rows), key=repr) == sorted(expected, key=repr)
    assert tokens.count_tokens(frame([]), BYTES).count() == 0


def test_other_vocabularies_are_refused(tmp_path):
    with pytest.raises(ValueError):
        tokens.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
