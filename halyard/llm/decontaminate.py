"""Benchmark decontamination by q-gram lemma filtering.

An item of m characters that occurs in a text with at most e edits shares at least m - q + 1 - q * e character
q-grams with it, all on diagonals (text position less item position) of a span of e. So the shared q-grams are
counted in bands of 2 (e + 1) diagonals that overlap by half; a band with enough of them is a candidate
region, and a banded alignment of the whole item within that band decides. Each item may have a tenth of its
characters as edits; its q is the longest, up to 8, for which at least one shared q-gram is sure, so no item is
too short and no edit is lost. An item under 8 characters is its own q-gram.

Characters are compared as code points, in their simple lower case (one code point for one) and white space as
blanks. Text positions whose q-gram no item has are dropped first; the others are counted in stretches, and bands that
lie behind are done with, so memory beside the text itself doesn't grow with it, however often q-grams repeat.

The items are sent to the tasks in blocks of at most about `block_chars` characters, of which the driver holds
one at a time, and the documents are read once for each block. Documents are mapped row by row, so neither a hot
source nor a popular item gathers in one task; with several blocks, a row's matches meet again by a key that it
has in a written table.

Defined results: null or empty texts match nothing; a null or empty item is no evidence and matches nothing;
repeated items count once, equal items match each under its own id; repeated rows each give their own row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halyard.llm.shared import blocks, discard, packed, written

Q = 8
EDITS = 0.1
BLOCK_CHARS = 4_000_000
_KEYS = tuple(int(x) | 1 for x in np.random.default_rng(7).integers(1, 2**62, 4))
_BITS = 22
#: Positions of a text, and pairs of a position and its place in an item, that are worked on at once.
STRETCH = 1 << 19
PAIRS = 1_000_000
_MATCHES = "array<struct<item_id:bigint,start:int,end:int,edits:int>>"


@cache
def _lower() -> np.ndarray:
    """The simple lower case of the code points of the Basic Multilingual Plane; white space as a blank."""
    low = [chr(c).lower() for c in range(0x10000)]
    out = np.array([ord(x) if len(x) == 1 else c for c, x in enumerate(low)], np.uint32)
    out[9:14] = 32
    return out


def normal(chars: np.ndarray) -> np.ndarray:
    table = _lower()
    if not len(chars) or chars.max() < len(table):
        return table[chars]
    out = chars.copy()
    basic = chars < len(table)
    out[basic] = table[chars[basic]]
    return out


def _chars(raw: bytes) -> np.ndarray:
    return normal(np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32))


def qgrams(chars: np.ndarray, q: int) -> np.ndarray:
    """64-bit hash of the q characters from each position on; doublings as far as they go."""
    h = chars.astype(np.uint64)
    n = max(0, len(chars) - q + 1)
    with np.errstate(over="ignore"):
        if q == Q:
            step = 1
            for key in _KEYS[:3]:
                h = h[:-step] * np.uint64(key) + h[step:] if len(h) > step else h[:0]
                step *= 2
            return h * np.uint64(_KEYS[3])
        out = np.zeros(n, np.uint64)
        for k in range(q):
            out = out * np.uint64(_KEYS[0]) + h[k : k + n]
        return (out + np.uint64(q)) * np.uint64(_KEYS[1]) * np.uint64(_KEYS[3])


def gram_length(m: int, e: int) -> int:
    """The longest q, up to Q, with at least one q-gram in common between an item of m characters and a text with e edits of it."""
    return min(Q, max(1, (m + 1) // (e + 1)), m)


class Items:
    """The q-gram index of those items of a block that have one q."""

    def __init__(self, rows: list[tuple[int, np.ndarray]], q: int, edits: float):
        self.q = q
        self.ids = np.array([i for i, _ in rows], np.int64)
        self.chars = [c for _, c in rows]
        self.length = np.array([len(c) for c in self.chars], np.int64)
        self.budget = (self.length * edits).astype(np.int64)
        self.least = self.length - q + 1 - q * self.budget
        self.width = self.budget + 1
        grams = [qgrams(c, q) for c in self.chars]
        every = np.concatenate(grams)
        order = np.argsort(every, kind="stable")
        self.keys, self.first, self.count = np.unique(every[order], return_index=True, return_counts=True)
        self.item = np.repeat(np.arange(len(rows)), [len(g) for g in grams])[order]
        self.at = np.concatenate([np.arange(len(g)) for g in grams])[order]
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(every >> np.uint64(64 - _BITS)).astype(np.int64)] = True


def indexed(rows: list[tuple[int, str]], edits: float) -> list[Items]:
    """The items of a block, an index for each q that they need."""
    by_q: dict[int, list] = {}
    for i, text in rows:
        c = _chars(text.encode())
        if len(c):
            by_q.setdefault(gram_length(len(c), int(len(c) * edits)), []).append((i, c))
    return [Items(some, q, edits) for q, some in sorted(by_q.items())]


def aligned(texts: list[np.ndarray], item: np.ndarray, low: np.ndarray, diagonals: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edits, start and end of the best occurrence of an item in each text within diagonals low .. low + diagonals.

    A cell holds edits << 32 | start, so that the smallest also has the smallest start."""
    n, m = len(texts), len(item)
    one = np.int64(1) << 32
    span = m + diagonals
    window = np.zeros((n, span), np.uint32)  # the text from diagonal low on; 0 outside
    for k, (t, d) in enumerate(zip(texts, low.tolist(), strict=True)):
        a, b = max(0, d), min(len(t), d + span)
        if b > a:
            window[k, a - d : b - d] = t[a:b]
    lengths = np.array([len(t) for t in texts], np.int64)[:, None]
    across = np.arange(diagonals, dtype=np.int64)
    cell = np.clip(low[:, None] + across, 0, lengths) + np.where((low[:, None] + across < 0) | (low[:, None] + across > lengths), one * (m + 1), 0)
    ramp = across * one
    for p in range(m):
        cost = (window[:, p : p + diagonals] != item[p]) * one
        best = cell + cost
        best[:, :-1] = np.minimum(best[:, :-1], cell[:, 1:] + one)
        cell = np.minimum.accumulate(best - ramp, axis=1) + ramp
    k = cell.argmin(axis=1)
    value = cell[np.arange(n), k]
    return value >> 32, value & 0xFFFFFFFF, np.clip(low + k + m, 0, lengths[:, 0])


def found(chars: np.ndarray, offsets: np.ndarray, indexes: list[Items]) -> list[tuple[int, int, int, int, int]]:
    """(text, item_id, start, end, edits) of the items in a block of texts, given by character offsets."""
    return sorted((d, int(items.ids[k]), a, b, x) for items in indexes for d, k, a, b, x in _found(chars, offsets, items))


def _positions(chars: np.ndarray, offsets: np.ndarray, items: Items) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Positions whose q-gram some item has, each one's slot in the index and text, for some stretches of the texts after another."""
    q = items.q
    for first in range(0, max(0, len(chars) - q + 1), STRETCH):
        grams = qgrams(chars[first : first + STRETCH + q - 1], q)
        at = np.flatnonzero(items.seen[(grams >> np.uint64(64 - _BITS)).astype(np.int64)])
        if not len(at) or not len(items.keys):
            continue
        slot = np.minimum(np.searchsorted(items.keys, grams[at]), len(items.keys) - 1)
        doc = np.searchsorted(offsets, at + first, "right") - 1
        keep = (items.keys[slot] == grams[at]) & (at + first + q <= offsets[doc + 1])
        at, slot, doc = at[keep] + first, slot[keep], doc[keep]
        total = np.cumsum(items.count[slot])
        begin = 0
        while begin < len(at):  # about a million pairs of a position and its place in an item at a time
            end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + PAIRS, "right")))
            yield at[begin:end], slot[begin:end], doc[begin:end]
            begin = end


def _bands(chars: np.ndarray, offsets: np.ndarray, items: Items) -> Iterator[np.ndarray]:
    """Rows (text, item, band) of the bands with enough q-grams in common.

    Positions ascend, so a band that lies more than the longest item behind them is complete; of the others the counts
    are carried on. What is held doesn't grow with a text, however often an item's q-grams repeat in it."""
    longest, n_items = int(items.length.max()), len(items.ids)
    shift = longest + 2
    wide = int(np.diff(offsets).max()) + 2 * shift + 4
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def good(keys, counts):
        both = keys[counts >= items.least[keys // wide % n_items]]
        pair = both // wide
        exact = (items.budget == 0) & (items.length == items.q)  # the whole item is one q-gram: its first place is enough
        both = both[~exact[pair % n_items] | np.append(True, pair[1:] != pair[:-1])[: len(pair)]]
        return np.column_stack([both // wide // n_items, both // wide % n_items, both % wide - shift])

    for at, slot, doc in _positions(chars, offsets, items):
        # all bands that no position from here on can reach
        of, band = keys // wide // n_items, keys % wide - shift
        done = (of < doc[0]) | (band < (at[0] - offsets[doc[0]] - longest) // items.width[keys // wide % n_items] - 1)
        if done.any():
            yield good(keys[done], counts[done])
            keys, counts = keys[~done], counts[~done]
        n = items.count[slot]
        pair = np.repeat(items.first[slot] - np.cumsum(n) + n, n) + np.arange(n.sum())
        item = items.item[pair]
        band = (np.repeat(at - offsets[doc], n) - items.at[pair]) // items.width[item]
        key = (np.repeat(doc, n) * n_items + item) * wide + band + shift
        more, times = np.unique(np.concatenate([key, key - 1]), return_counts=True)
        keys, back = np.unique(np.concatenate([keys, more]), return_inverse=True)
        counts = np.bincount(back, np.concatenate([counts, times]), len(keys)).astype(np.int64)
    yield good(keys, counts)


def _found(chars: np.ndarray, offsets: np.ndarray, items: Items) -> list[tuple[int, int, int, int, int]]:
    if not len(items.ids) or not len(chars):
        return []
    hits = list(_bands(chars, offsets, items))
    cand = np.concatenate(hits)
    out = {}
    for item in np.unique(cand[:, 1]).tolist():
        some = cand[cand[:, 1] == item]
        e, w = int(items.budget[item]), int(items.width[item])
        for k in range(0, len(some), 512):
            part = some[k : k + 512]
            texts = [chars[offsets[d] : offsets[d + 1]] for d in part[:, 0]]
            edits, start, end = aligned(texts, items.chars[item], part[:, 2] * w - e, 2 * w + 2 * e + 1)
            for d, x, a, b in zip(part[:, 0].tolist(), edits.tolist(), start.tolist(), end.tolist(), strict=True):
                if x <= e and (x, a, b) < out.get((d, item), (e + 1, 0, 0)):
                    out[d, item] = (x, a, b)
    return [(d, item, a, b, x) for (d, item), (x, a, b) in out.items()]


def _mapped(docs: DataFrame, items: list[tuple[int, str]], edits: float) -> DataFrame:
    def run(batches):
        indexes = indexed(items, edits)
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32())]))
        for part, data, offsets in blocks(batches, "text"):
            places = np.append(0, np.cumsum((data & 0xC0) != 0x80))[offsets]
            rows: list[list[dict]] = [[] for _ in range(part.num_rows)]
            for d, item, a, b, x in found(_chars(data.tobytes()), places, indexes):
                rows[d].append({"item_id": item, "start": a, "end": b, "edits": x})
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("doc_id"), pa.array(rows, kind)], ["key", "doc_id", "matches"])

    return docs.mapInArrow(run, f"key bigint, doc_id bigint, matches {_MATCHES}")


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> tuple[int, Iterator[list[tuple[int, str]]]]:
    """How many blocks the items make, and the blocks, of about block_chars / 2 characters each, one fetched at a time."""
    known = benchmark.where("item_id is not null and text <> ''").select("item_id", "text").distinct()
    total = known.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first().n
    n = -(-2 * int(total) // block_chars) if total > block_chars else 1

    def fetched():
        for k in range(n):
            yield [(r.item_id, r.text) for r in known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()]

    return n, fetched()


def leaks(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, block_chars: int = BLOCK_CHARS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and matches (item_id, start, end in code points, edits) of each document: the best occurrence of each item."""
    texts = docs.select(F.monotonically_increasing_id().alias("key"), F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    n, every = item_blocks(benchmark, block_chars)
    if n == 1:
        return _mapped(texts, next(every), edits).select("doc_id", F.array_sort("matches").alias("matches"))
    texts = written(texts)  # the keys are the same for all blocks
    out = texts.select("key", "doc_id", F.array().cast(_MATCHES).alias("matches"))
    for items in every:
        out = out.unionAll(written(_mapped(texts, items, edits).where("size(matches) > 0")))
    # the parts of one row meet again; doc_id may repeat or be null
    return out.groupBy("key").agg(F.max("doc_id").alias("doc_id"), F.flatten(F.collect_list("matches")).alias("matches")).select("doc_id", F.array_sort("matches").alias("matches"))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, item_ids and the fewest edits of each document."""
    return leaks(docs, benchmark).select("doc_id", (F.size("matches") > 0).alias("contaminated"), F.array_sort(F.array_distinct(F.col("matches.item_id"))).alias("item_ids"), F.array_min(F.col("matches.edits")).alias("fewest_edits"), "matches")


def clean(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, block_chars: int = BLOCK_CHARS, text: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, in which no item occurs; a map over rows for each block of items."""
    rows = packed(docs, text=text)
    n, every = item_blocks(benchmark, block_chars)
    for k, items in enumerate(every):
        before, rows = rows, rows.mapInArrow(_filter(items, edits), rows.schema)
        if k < n - 1:  # what is left is a table, so that the driver lets go of the block
            rows = written(rows)
            if k:
                discard(before)
    return rows.select("row.*")


def _filter(items: list[tuple[int, str]], edits: float):
    def run(batches):
        indexes = indexed(items, edits)
        for part, data, offsets in blocks(batches, "text"):
            places = np.append(0, np.cumsum((data & 0xC0) != 0x80))[offsets]
            keep = np.ones(part.num_rows, bool)
            keep[[d for d, *_ in found(_chars(data.tobytes()), places, indexes)]] = False
            yield part.filter(pa.array(keep))

    return run
