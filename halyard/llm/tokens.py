"""Token counts by overlap resynchronisation.

A document up to `chunk` bytes is encoded at once. A huge one is encoded in overlapping chunks with
offsets. Neighbours are spliced at a stable boundary: a position where a space follows a character that
isn't a space, which both encodings have as a token boundary. Such a boundary is proven stable where no
piece of the vocabulary has a space after another character: no merge can cross it, so the tokens on either
side don't depend on the other. Without one in the overlap, the overlap is widened, up to the end of the text.
A vocabulary or normaliser for which this can't be proven gets whole texts.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows each give their own row.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halyard.llm.shared import blocks

CHUNK = 16_384
OVERLAP = 256
LIMIT = 4096
_SPACE_PIECE = "▁"


#: Fixed by the model format: the fields of the model's normaliser and, in it, of its character map and its rules.
_NORMALISER, _MAP, _RULES = 3, 2, 6


def _fields(raw: bytes):
    """Number and value of each field of a message in the protocol-buffer wire format; bytes, or a whole number."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = varint()
        size = {1: 8, 5: 4}.get(tag & 7)
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        if size is None:
            size = varint()
        yield tag >> 3, raw[at : at + size]
        at += size


def maps_characters(model) -> bool:
    """True if the model's normaliser has a map or rules that replace characters, by its specification."""
    spec = [x for k, x in _fields(model.serialized_model_proto()) if k == _NORMALISER]
    return any(k in (_MAP, _RULES) and len(x) > 0 for one in spec for k, x in _fields(one))


def provable(model) -> bool:
    """True if a space after another character is always a boundary for this model.

    Its normaliser may replace no character, and must keep each space and mark it before what follows."""
    if maps_characters(model) or model.normalize("a  b ") != _SPACE_PIECE + "a  b ".replace(" ", _SPACE_PIECE):
        return False
    across = re.compile(f"[^{_SPACE_PIECE}]{_SPACE_PIECE}")
    return not any(across.search(model.id_to_piece(i)) for i in range(model.get_piece_size()))


def _whole(text: bytes, at: int, step: int) -> int:
    """The nearest start of a character from `at` on, in the direction of step."""
    while 0 < at < len(text) and text[at] & 0xC0 == 0x80:
        at += step
    return min(max(at, 0), len(text))


def _starts(model, text: bytes, start: int, stop: int) -> np.ndarray:
    """Byte offset in the text of each token of text[start:stop] that begins at start or later.

    From a splice on, the chunk takes the character before it too, whose tokens don't count."""
    before = _whole(text, start - 1, -1) if start else 0
    pieces = model.encode(text[before:stop].decode(), return_type="proto").pieces
    found = np.fromiter((p.begin for p in pieces), np.int64, len(pieces)) + before
    return found[np.searchsorted(found, start) :]


def spliced_count(model, text: bytes, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a UTF-8 text by overlapping chunks; as many as one call over the whole text gives."""
    total, start, n, wide = 0, 0, len(text), overlap
    stop = _whole(text, chunk + overlap, 1)
    left = _starts(model, text, 0, stop)
    while stop < n:
        begin = _whole(text, max(start + 1, stop - wide), -1)
        end = _whole(text, stop + chunk, 1)
        pieces = model.encode(text[begin:end].decode(), return_type="proto").pieces
        right = np.fromiter((p.begin for p in pieces), np.int64, len(pieces)) + begin
        common = np.intersect1d(left[left > begin], right)
        stable = [p for p in common.tolist() if text[p] == 32 and text[p - 1] != 32]
        if stable:
            total += int(np.searchsorted(left, stable[-1]))
            start, stop, wide = stable[-1], end, overlap
            left = right[np.searchsorted(right, start) :]
        else:
            wide *= 2
            stop = _whole(text, stop + wide, 1)
            left = _starts(model, text, start, stop)
    return total + len(left)


def token_counts(docs: DataFrame, tokenizer: str = "piece_bpe_32k.model", limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of each whole text; a map over rows.

    tokenizer: a file's path, or its name among the public tokenizers that each executor has."""

    def run(batches):
        import os

        import sentencepiece

        at = tokenizer
        if not os.path.isabs(at):
            import public_tokenizers

            at = public_tokenizers.path(at)
        model = sentencepiece.SentencePieceProcessor(model_file=at)
        splice = provable(model)
        for part, data, offsets in blocks(batches, "text"):
            texts = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            small = [i for i, x in enumerate(texts) if len(x) <= chunk or not splice]
            n = np.zeros(len(texts), np.int64)
            for i, ids in zip(small, model.encode([texts[i].decode() for i in small], num_threads=1), strict=True):
                n[i] = len(ids)
            for i, x in enumerate(texts):
                if len(x) > chunk and splice:
                    n[i] = spliced_count(model, x, chunk, overlap)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
