"""Language ID by rank-order profiles: the most frequent letter n-grams of a text against those of each language.

Words are runs of letters (and the marks in them), in lower case, with a boundary before and after; n-grams have one
to three symbols, with boundaries at their ends only. A language's profile is its SIZE most frequent n-grams over all
training texts, a text's profile its own SIZE most frequent; ties go by code point. The out-of-place distance adds up,
over the text's n-grams, how far each one's rank is from its rank in the language's profile, or SIZE where it isn't there.

N-grams are exact: three code points in one 63-bit number. Training counts whole texts, added up in each task before
Spark adds them up by language and n-gram; profiles are chosen in two steps, within hash buckets and then among
the buckets' best, so no task sorts a language's n-grams. Only profiles reach the driver: SIZE rows for each of at most
MOST_LANGUAGES languages (beyond that, an error), and they are what each task holds. Scoring is a map over rows; a long
text goes in pieces, of which only counts are kept.

Defined results: a null or empty text, and one without a letter, is "und" with score 0; so is all if there's nothing to
learn from. The score is how much nearer the nearest language is than the second, as a part of the second's distance
(1 if there is just one language); among equal distances the first by code point wins, with score 0. Null languages aren't learned
from, null ids count as the empty id, repeated rows each give their own row, other columns are not read.
"""

from __future__ import annotations

import unicodedata
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from halyard.llm.shared import blocks, crc_part

SIZE = 300
MOST_LANGUAGES = 4096
UNKNOWN = "und"
BUCKETS = 64
#: Bytes of text in one step; with it, a text's number and three symbols of the step's alphabet fit in 63 bits.
STEP = 1 << 17
_HELD = 1 << 20
_POINTS = 0x110000
_BITS = 21
#: Stands for a boundary; no letter, so free.
_EDGE = 1


@cache
def _symbols() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: its symbol (the simple lower case of letters, marks as they are, _EDGE else), and whether it's a letter."""
    symbol, letter = np.full(_POINTS, _EDGE, np.int32), np.zeros(_POINTS, bool)
    for k in range(0x32400):  # no letters are assigned beyond
        kind = unicodedata.category(chr(k))[0]
        if kind == "L":
            low = chr(k).lower()
            symbol[k], letter[k] = ord(low) if len(low) == 1 else k, True
        elif kind == "M":
            symbol[k] = k
    return symbol, letter


def _pieces(raw: bytes):
    """Parts of a text, cut between characters."""
    at = 0
    while at < len(raw):
        end = min(at + STEP, len(raw))
        while end < len(raw) and end > at + 1 and raw[end] & 0xC0 == 0x80:
            end -= 1
        yield raw[at:end]
        at = end


def _counted(raw: bytes, offsets: np.ndarray, start: np.ndarray | None = None, last: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, n-gram and count of each n-gram of some texts, in that order; which texts have letters; and the last two symbols.

    start: the two symbols before a text's piece, which is the only one then; last: whether the piece ends its text."""
    table, letters = _symbols()
    points = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    n = len(offsets) - 1
    if n == 1:
        of = np.zeros(len(points), np.int64)
    else:
        heads = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
        of = np.searchsorted(offsets, heads, "right") - 1
        if len(of) != len(points):  # not UTF-8: one text after the other
            each = [np.frombuffer(raw[a:b].decode("utf-8", "replace").encode("utf-32-le"), np.uint32) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            points, of = np.concatenate(each), np.repeat(np.arange(n), [len(x) for x in each])
    has = np.zeros(n, bool)
    has[of[letters[points]]] = True
    symbol = table[points]
    # a boundary before and after each text; runs of boundaries are one
    per = np.bincount(of, minlength=n)
    ends = np.cumsum(per + 2)
    line, text = np.full(ends[-1] if n else 0, _EDGE, np.int64), np.repeat(np.arange(n), per + 2)
    line[np.arange(len(points)) + 2 * of + 1] = symbol
    if start is not None:
        line, text = np.append(start, line[1:]), np.append([0, 0], text[1:])
    if not last:
        line, text = line[:-1], text[:-1]
    keep = np.ones(len(line), bool)
    keep[1:] = (line[1:] != _EDGE) | (line[:-1] != _EDGE) | (text[1:] != text[:-1])
    old = 0 if start is None else int(keep[:2].sum())
    line, text = line[keep], text[keep]
    tail = np.append([_EDGE, _EDGE], line)[-2:]
    alphabet, dense = np.unique(line, return_inverse=True)
    dense, width = dense + 1, len(alphabet) + 1
    edge = line == _EDGE
    keys = []
    for order in (1, 2, 3):
        m = len(line) - order + 1
        if m <= 0:
            break
        key = text[:m].copy()
        for k in range(order):
            key = key * width + dense[k : k + m]
        key *= width ** (3 - order)
        inner = edge[:m] if order == 1 else edge[1 : 1 + m] if order == 3 else edge[:m] & edge[1 : 1 + m]
        fresh = np.arange(m) + order > old
        keys.append(key[(text[:m] == text[order - 1 :]) & ~inner & fresh])
    key, count = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.int64),) * 2
    real = np.append(0, alphabet)
    gram = (real[key // (width * width) % width] << (2 * _BITS)) | (real[key // width % width] << _BITS) | real[key % width]
    return key // width**3, gram, count, has, tail


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their summed counts."""
    keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, n-gram and count, by text and n-gram, of whole texts; and which have letters."""
    raw = data.tobytes()
    if len(offsets) == 2 and len(raw) > STEP:
        parts, start, has = [], None, False
        at = 0
        for piece in _pieces(raw):
            at += len(piece)
            _, gram, count, some, start = _counted(piece, np.array([0, len(piece)]), start, at == len(raw))
            parts.append((gram, count))
            has |= bool(some[0])
            if len(parts) > 8:
                parts = [_added(parts)]
        gram, count = _added(parts)
        return np.zeros(len(gram), np.int64), gram, count, np.array([has])
    return _counted(raw, offsets)[:4]


def counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, gram and n over all whole texts with a language."""

    def run(batches):
        names: dict[str, int] = {}
        held: dict[int, list] = {}
        rows = 0

        def emptied():
            for k, name in enumerate(names):
                for gram, n in [_added(held[k])] if held.get(k) else []:
                    yield pa.RecordBatch.from_arrays([pa.DictionaryArray.from_arrays(np.zeros(len(gram), np.int32), [name]).cast(pa.string()), pa.array(gram), pa.array(n)], ["lang", "gram", "n"])
            held.clear()

        for part, data, offsets in blocks(batches, "text", STEP):
            of, gram, n, _ = ngrams(data, offsets)
            tongue = np.array([names.setdefault(x, len(names)) for x in part.column("lang").to_pylist()])[of]
            for k in np.unique(tongue).tolist():
                some = tongue == k
                own = held.setdefault(k, [])
                own.append(_added([(gram[some], n[some])]))
                rows += len(own[-1][0])
                if len(own) > 32:
                    rows -= sum(len(x) for x, _ in own)
                    own[:] = [_added(own)]
                    rows += len(own[0][0])
            if rows > _HELD:
                yield from emptied()
                names.clear()
                rows = 0
        yield from emptied()

    texts = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    return texts.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def ranked(grams: DataFrame, size: int = SIZE) -> DataFrame:
    """lang, gram and place (from 0) of the `size` most frequent n-grams of each language."""
    order = [F.desc("n"), F.asc("gram")]
    bucket = F.pmod(F.xxhash64("gram"), F.lit(BUCKETS))
    best = grams.withColumn("bucket", bucket).withColumn("place", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order))).where(F.col("place") <= size)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order)) - 1
    return best.select("lang", "gram", "n").withColumn("place", place).where(F.col("place") < size).select("lang", "gram", "place")


class Profiles(NamedTuple):
    names: list[str]  # by code point
    gram: np.ndarray  # distinct n-grams, ascending
    first: np.ndarray  # where each one's rows of lang and place begin, and their end
    lang: np.ndarray
    place: np.ndarray
    size: int


def fit(docs: DataFrame, size: int = SIZE, text: str = "text", lang: str = "lang", most: int = MOST_LANGUAGES) -> Profiles:
    """The profiles of docs' languages, of bounded size; without texts, none."""
    few = docs.where(F.col(lang).isNotNull()).select(lang).distinct().limit(most + 1).count()
    if few > most:
        raise ValueError(f"more than {most} languages")
    rows = ranked(counts(docs, text, lang), size).collect()
    names = sorted({r.lang for r in rows})
    number = {name: k for k, name in enumerate(names)}
    table = np.array(sorted((r.gram, number[r.lang], r.place) for r in rows), np.int64).reshape(-1, 3)
    gram, first = np.unique(table[:, 0], return_index=True)
    return Profiles(names, gram, np.append(first, len(table)), table[:, 1].astype(np.int32), table[:, 2].astype(np.int32), size)


def distances(of: np.ndarray, gram: np.ndarray, count: np.ndarray, n: int, model: Profiles) -> np.ndarray:
    """The out-of-place distance of each of n texts to each language; (of, gram, count) by text and n-gram."""
    order = np.lexsort((-count, of))  # stable, so ties stay by n-gram
    of, gram = of[order], gram[order]
    place = np.arange(len(of)) - np.searchsorted(of, of)
    top = place < model.size
    of, gram, place = of[top], gram[top], place[top]
    kinds = len(model.names)
    out = np.repeat(np.bincount(of, minlength=n) * model.size, kinds).reshape(n, kinds)
    if not len(of) or not len(model.gram):
        return out
    at = np.minimum(np.searchsorted(model.gram, gram), len(model.gram) - 1)
    known = model.gram[at] == gram
    at, of, place = at[known], of[known], place[known]
    many = model.first[at + 1] - model.first[at]
    row = np.repeat(model.first[at] - np.cumsum(many) + many, many) + np.arange(many.sum())
    less = model.size - np.abs(model.place[row] - np.repeat(place, many))
    flat = np.bincount(np.repeat(of, many) * kinds + model.lang[row], less, n * kinds)
    return out - flat.astype(np.int64).reshape(n, kinds)


def identify(data: np.ndarray, offsets: np.ndarray, model: Profiles) -> tuple[list[str], np.ndarray]:
    """The language and score of each whole text."""
    n, kinds = len(offsets) - 1, len(model.names)
    names, score = np.full(n, UNKNOWN, object), np.zeros(n)
    of, gram, count, has = ngrams(data, offsets)
    # as many texts at a time as keep the distances small
    step = max(1, (1 << 20) // max(1, kinds))
    for a in range(0, n if kinds else 0, step):
        b = min(a + step, n)
        lo, hi = np.searchsorted(of, [a, b])
        d = distances(of[lo:hi] - a, gram[lo:hi], count[lo:hi], b - a, model)
        best = d.argmin(1)
        some = has[a:b]
        names[a:b][some] = np.array(model.names, object)[best[some]]
        if kinds > 1:
            two = np.partition(d, 1, axis=1)[:, :2].astype(float)
            score[a:b][some] = ((two[:, 1] - two[:, 0]) / np.maximum(two[:, 1], 1))[some]
        else:
            score[a:b][some] = 1.0
    return names.tolist(), score


def predicted(docs: DataFrame, model: Profiles, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document."""

    def run(batches):
        for part, data, offsets in blocks(batches, "text", STEP):
            names, score = identify(data, offsets, model)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), (crc_part(doc_id, 3) == 1).alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def identified(docs: DataFrame, size: int = SIZE, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """predicted() by the profiles of the documents whose crc32 of the id isn't 1 modulo 3."""
    return predicted(docs, fit(docs.where(crc_part(doc_id, 3) != 1), size, text, lang), doc_id, text)
