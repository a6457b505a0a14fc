"""Similarity join of word n-gram sets by Jaccard, with set-relation skipping.

1. Texts become sets of 64-bit shingle hashes. Equal sets are one class; only one of them goes on.
2. Each set is ordered by one global order, rare shingles first, and its prefix goes into an inverted index:
   two sets that reach the threshold meet in a list, at positions that still allow the overlap they need.
   The order comes from two tables of fixed size, counted over all texts: how frequent words are, and which
   shingles are the most frequent.
3. In each list one set of each size band leads: the others are compared with it first, and the sizes of those
   differences are kept. Links give components. Before any two sets are compared, the parities of their
   shingles, about a bit for each, must allow the threshold: only sets that may link are shuffled.
4. What is left are pairs in one list but in different components. Lists lie in blocks by size; a block is
   skipped if its sizes, its first position or its only component rule it out, and parities of the sets rule out
   single pairs: of 256 bits in the first turn, of 1024 in the second. In the first each set meets only the set of another component that looks most
   alike in a list, in the second all that are left in other components. Of two sets with a common leader x, the
   answer is derived from the known differences where they suffice: |x-y| + |x-z| within the bound is a link,
   ||x-y| - |x-z|| beyond it is none. The rest are compared exactly.

A large group of near copies so costs at most two comparisons for each set and list, and pairs only for sets that
no link of those has joined to the others. A set has no more leaders than its prefix has shingles, however many it leads. Only pairs, positions and sets that met in a list are shuffled; components are
tables in the shared folder, and nothing of a document reaches the driver. It plans each query, and what a plan leaves in
its memory adds up over a session: a table that two steps read is written once, not planned into both.

Defined results: a null, empty or white-space text has an empty set and is its own component; rows with
equal texts are one component; a null doc_id never is the smallest, unless all of a component are null; rows
that repeat a doc_id count as documents of their own.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halyard.llm.shared import HEAVY, blocks, discard, heavy_keys, mix, most_frequent, packed, shingles, skewed_join, word_hashes, words, written

SHINGLE = 4
PERCENT = 85
FREQUENT = 1 << 19
#: Shingles are counted in groups of about so many; a group reports those that it has SEEN times.
GROUP = 1_000_000
SEEN = 3
WORD_BUCKETS = 16
PARITY = 256
#: Bits where all pairs of a list are compared.
FINE = 1024
WIDEST = 1 << 17
BLOCK = 128
#: Lists up to this size are searched side by side, longer ones block by block.
SMALL = 64
#: Shingles that occur 2^13 times or more have lists in pieces of about 2^12 sets.
PIECE_BITS = 12
#: The first class of frequent shingles; from there on a class is this plus log2 of the count.
_FREQUENT_CLASS = 201
_BYTES = 7
_BODY = np.uint64((1 << 56) - 1)


class Order(NamedTuple):
    """The global order of shingles by classes: up to 200 by the frequency of the words, beyond for the frequent shingles."""

    words: np.ndarray  # log2 of the counts of word hash buckets
    hot: np.ndarray  # ascending hashes
    level: np.ndarray  # their classes

    def classes(self, h: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
        out = np.minimum(weight * 4 // k, 200)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, h), len(self.hot) - 1)
            out = np.where(self.hot[at] == h, self.level[at], out)
        return out.astype(np.uint64)


def _sets(data: np.ndarray, offsets: np.ndarray, k: int, order: Order | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ascending, and their text numbers. A shingle is 56 bits of its hash below its class."""
    n = len(offsets) - 1
    start, end, doc = words(data, offsets)
    hashes = word_hashes(data, start, end)
    if order is None:
        h, of = shingles(hashes, doc, n, k)
        key = mix(h) >> np.uint64(8)
    else:
        h, of, weight = shingles(hashes, doc, n, k, order.words[_bucket(hashes)])
        key = mix(h) >> np.uint64(8) | order.classes(h, weight, k) << np.uint64(56)
    at = np.searchsorted(of, np.arange(n + 1)).tolist()
    for a, b in zip(at[:-1], at[1:], strict=True):
        key[a:b].sort()
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (of[1:] != of[:-1])
    return key[new], of[new]


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - WORD_BUCKETS)).astype(np.int64)


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _prints(key: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each set that don't depend on its order; equal sets have equal sums."""
    out = []
    for salt in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03):
        with np.errstate(over="ignore"):
            sums = np.append(np.uint64(0), np.cumsum(mix(key & _BODY ^ np.uint64(salt)), dtype=np.uint64))
            at = np.searchsorted(of, np.arange(n + 1))
            out.append(sums[at[1:]] - sums[at[:-1]])
    return out[0], out[1]


def _parities(key: np.ndarray, of: np.ndarray, bits: np.ndarray) -> list[bytes]:
    """For each text, the parity of its shingles in each of `bits` (powers of two) residues; half as many are the xor of the halves."""
    base = np.append(0, np.cumsum(bits))
    at = base[of] + (key & (bits[of] - 1).astype(np.uint64)).astype(np.int64)
    raw = np.packbits((np.bincount(at, minlength=base[-1]) & 1).astype(np.uint8)).tobytes()
    ends = (base // 8).tolist()
    return [raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _apart(x: bytes, y: bytes) -> int:
    """A lower bound of the symmetric difference of two sets by their parities."""
    if len(x) > len(y):
        x, y = y, x
    a, b, size = int.from_bytes(x, "little"), int.from_bytes(y, "little"), len(y)
    while size > len(x):
        size //= 2
        b = (b >> 8 * size) ^ (b & ((1 << 8 * size) - 1))
    return (a ^ b).bit_count()


def needed(a, b, percent: int):
    """The least intersection of sets of sizes a and b that reaches the threshold."""
    return -(-percent * (a + b) // (100 + percent))


def shingle_order(texts: DataFrame, k: int = SHINGLE, most: int = FREQUENT) -> Order:
    """Counts over all texts; only 2^16 word buckets and at most `most` shingles, a fixed 5 MB, reach the driver."""

    def run(batches):
        buckets = np.zeros(1 << WORD_BUCKETS, np.int64)
        held: list[np.ndarray] = []

        def frequent():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            some = n >= SEEN
            return row(h[some], n[some], False)

        def row(h, n, word):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(h), word)), pa.array(_signed(h)), pa.array(n)], ["word", "h", "n"])

        for _, data, offsets in blocks(batches, "text"):
            start, end, doc = words(data, offsets)
            hashes = word_hashes(data, start, end)
            buckets += np.bincount(_bucket(hashes), minlength=len(buckets))
            held.append(shingles(hashes, doc, len(offsets) - 1, k)[0])
            if sum(map(len, held)) > GROUP:
                yield frequent()
        if held:
            yield frequent()
        some = np.flatnonzero(buckets)
        yield row(some.astype(np.uint64), buckets[some], True)

    counts = written(texts.mapInArrow(run, "word boolean, h bigint, n bigint").groupBy("word", "h").agg(F.sum("n").alias("n")))
    by_word = counts.where("word").select("h", "n").toPandas()
    logs = np.zeros(1 << WORD_BUCKETS, np.int64)
    logs[by_word.h] = np.round(np.log2(by_word.n + 1)).astype(np.int64)
    top = most_frequent(counts.where("not word").select("h", "n"), "n", most).toPandas()
    discard(counts)
    hashes = top.h.to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    level = np.minimum(_FREQUENT_CLASS + np.log2(np.maximum(top.n.to_numpy(np.int64), 1)), 255).astype(np.int64)
    return Order(logs, hashes[order], level[order])


def _described(docs: DataFrame, order: Order, k: int, percent: int) -> DataFrame:
    """doc_id, n, two prints, the prefix in the global order and the parities of each text's set (wide: of more than FINE shingles); raw and tie as they are."""

    def run(batches):
        for part, data, offsets in blocks(batches, "text"):
            m = part.num_rows
            key, of = _sets(data, offsets, k, order)
            n = np.bincount(of, minlength=m)
            one, two = _prints(key, of, m)
            position = np.arange(len(key)) - (np.cumsum(n) - n)[of]
            length = np.where(n > 0, n - -(-percent * n // 100) + 1, 0)
            large = n > FINE
            mine = large[of]
            wide = iter(_parities(key[mine], (np.cumsum(large) - 1)[of[mine]], np.minimum(2 ** np.ceil(np.log2(n[large])).astype(np.int64), WIDEST)))
            columns = [
                *(part.column(c) for c in ("doc_id", "raw", "tie")),
                pa.array(n.astype(np.int32)),
                pa.array(_signed(one)),
                pa.array(_signed(two)),
                pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)).astype(np.int32)), pa.array(_signed(key[position < length[of]]))),
                pa.array(_parities(key, of, np.full(m, PARITY)), pa.binary()),
                pa.array(_parities(key, of, np.full(m, FINE)), pa.binary()),
                pa.array([next(wide) if x else None for x in large.tolist()], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "raw", "tie", "n", "one", "two", "prefix", "parity", "fine", "wide"])

    return docs.mapInArrow(run, "doc_id bigint, raw bigint, tie bigint, n int, one bigint, two bigint, prefix array<bigint>, parity binary, fine binary, wide binary")


def _pieces(token: Column) -> Column:
    """In how many pieces a token's list lies, by the frequency that its class tells."""
    return F.pow(F.lit(2.0), F.greatest(F.shiftrightunsigned(token, 56) - (_FREQUENT_CLASS + PIECE_BITS), F.lit(0))).cast("long")


def _piece(token: Column, key: Column) -> Column:
    return F.pmod(F.xxhash64(key), _pieces(token))


def _lists(batches, names: tuple[str, ...]):
    """Columns of whole lists (equal token) from batches sorted by token."""
    held: list[list[np.ndarray]] = []  # the parts of the list that is still open
    for batch in batches:
        now = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
        if not len(now[0]):
            continue
        cut = int(np.searchsorted(now[0], now[0][-1]))
        if held and not cut and held[0][0][0] == now[0][0]:
            held.append(now)
            continue
        if held or cut:
            yield [np.concatenate(x) for x in zip(*held, [x[:cut] for x in now], strict=True)]
        held = [[x[cut:] for x in now]]
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def _postings(sets: DataFrame, percent: int) -> DataFrame:
    """(token, key, n, pos, band, lead) of the sets that have a neighbour of suitable size in the token's list, or are in a piece of one.

    A list (or its piece) passes in the order of sizes, a batch in memory at a time; the first set of a band of sizes leads."""

    frequent = _FREQUENT_CLASS + PIECE_BITS

    def run(batches):
        last = None  # the row that waits for its successor: token, piece, packed, key, lead, whether it has a neighbour
        for batch in batches:
            token, piece, packed, key = (batch.column(c).to_numpy() for c in ("token", "piece", "packed", "key"))
            if not len(token):
                continue
            if last is not None:
                token, piece, packed, key = (np.append(a, x) for a, x in zip(last[:4], (token, piece, packed, key), strict=True))
            n, pos = packed >> 32, packed & 0xFFFFFFFF
            band = (np.log(n) / -np.log(percent / 100)).astype(np.int64)
            same = (token[1:] == token[:-1]) & (piece[1:] == piece[:-1])
            near = same & (100 * n[:-1] >= percent * n[1:])
            new = np.append(True, ~same | (band[1:] != band[:-1]))
            lead = key[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
            keep = np.append(near, False) | np.append(False, near)
            if last is not None:
                second = int(np.argmax(new[1:])) + 1 if new[1:].any() else len(new)
                lead[:second] = last[4]
                keep[0] |= last[5]
            last = (token[-1:], piece[-1:], packed[-1:], key[-1:], lead[-1], keep[-1])
            keep |= (token.view(np.uint64) >> np.uint64(56)) > frequent
            keep[-1] = False
            yield row(token[keep], key[keep], n[keep], pos[keep], band[keep], lead[keep])
        if last is not None and (last[5] or int(last[0].view(np.uint64)[0] >> np.uint64(56)) > frequent):
            n = last[2] >> 32
            yield row(last[0], last[3], n, last[2] & 0xFFFFFFFF, (np.log(n) / -np.log(percent / 100)).astype(np.int64), np.array([last[4]]))

    def row(token, key, n, pos, band, lead):
        return pa.RecordBatch.from_arrays([pa.array(token), pa.array(key), pa.array(n.astype(np.int32)), pa.array(pos.astype(np.int32)), pa.array(band.astype(np.int32)), pa.array(lead)], ["token", "key", "n", "pos", "band", "lead"])

    rows = sets.select(F.posexplode("prefix").alias("pos", "token"), "key", "n").select("token", _piece(F.col("token"), F.col("key")).alias("piece"), "key", (F.shiftleft(F.col("n").cast("long"), 32) + F.col("pos")).alias("packed"))
    return rows.repartition("token", "piece").sortWithinPartitions("token", "piece", "packed", "key").mapInArrow(run, "token bigint, key bigint, n int, pos int, band int, lead bigint")


def _stars(postings: DataFrame) -> DataFrame:
    """(a, b) of each set and its leader, and of the leaders of a list's pieces and the least of them; which of the two leads."""
    pairs = postings.where("key != lead").select("key", "lead")
    leaders = postings.where((_pieces(F.col("token")) > 1) & (F.col("key") == F.col("lead"))).select("token", "band", "key")
    least = leaders.groupBy("token", "band").agg(F.min("key").alias("lead"))
    pairs = pairs.union(leaders.join(least, ["token", "band"]).where("key != lead").select("key", "lead"))
    pairs = pairs.select(F.least("key", "lead").alias("a"), F.greatest("key", "lead").alias("b"), (F.col("lead") < F.col("key")).alias("first"))
    return pairs.groupBy("a", "b").agg(F.max("first").alias("a_leads"), F.max(~F.col("first")).alias("b_leads"))


def _for_search(lists: DataFrame) -> DataFrame:
    """lists (token, key, comp, ...) dealt to the pieces in which their pairs are searched; own tells a piece's own sets.

    A list in pieces whose sets are one component is left out. Else those outside its largest component visit every
    piece, so each pair of different components meets. Only frequent shingles, at most FREQUENT, are broadcast."""
    token, pieces = F.col("token"), _pieces(F.col("token"))
    kinds = lists.where(pieces > 1).groupBy("token", "comp").agg(F.count("*").alias("sets"))
    mixed = kinds.groupBy("token").agg(F.max_by("comp", "sets").alias("largest"), F.count("*").alias("kinds")).where("kinds > 1").select("token", "largest")
    mine = _piece(token, F.col("key"))
    to = F.when(pieces == 1, F.array(F.struct(F.lit(0).cast("long").alias("piece"), F.lit(True).alias("own")))).when(F.col("comp") == F.col("largest"), F.array(F.struct(mine.alias("piece"), F.lit(True).alias("own"))))
    to = to.otherwise(F.transform(F.sequence(F.lit(0).cast("long"), pieces - 1), lambda p: F.struct(p.alias("piece"), (p == mine).alias("own"))))
    dealt = lists.join(F.broadcast(mixed), "token", "left").where((pieces == 1) | F.col("largest").isNotNull()).withColumn("to", F.explode(to))
    # lists that share a hash only share a search
    return dealt.withColumn("token", F.when(pieces == 1, token).otherwise(F.xxhash64("token", "to.piece"))).withColumn("own", F.col("to.own")).drop("to", "largest")


def _pairs_across(postings: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Pairs (a, b, na, nb) of one list (token) and different components (ca, cb) that no filter rules out.

    nearest: of each set in a list, only the pair that looks most alike, so a list gives no more pairs than it has
    sets. A pair may come more than once."""

    def fits(n, p, c, w, own, row, col):
        """The pairs (row, col) that sizes, positions, components and parities allow, and their least difference."""
        ok = (own[row] | own[col]) & (c[row] != c[col]) & (np.minimum(n[row] - p[row], n[col] - p[col]) >= needed(n[row], n[col], percent))
        row, col = row[ok], col[ok]
        apart = np.bitwise_count(w[row] ^ w[col]).sum(1, dtype=np.int64)
        ok = apart <= n[row] + n[col] - 2 * needed(n[row], n[col], percent)
        return row[ok], col[ok], apart[ok]

    def side_by_side(of, n, p, c, w, own):
        """Pairs of many short lists, those at the same distance in the order of sizes at once."""
        alive, far, out = np.arange(len(n)), 0, []
        while len(alive):
            far += 1
            alive = alive[alive + far < len(n)]
            alive = alive[(of[alive] == of[alive + far]) & (100 * n[alive] >= percent * n[alive + far])]
            out.append(fits(n, p, c, w, own, alive, alive + far))
        return out

    def by_block(n, p, c, w, own):
        """Pairs of a long list: sets outside its largest component against blocks that may hold a partner."""
        kinds, counts = np.unique(c, return_counts=True)
        probe = np.flatnonzero(c != kinds[counts.argmax()])
        begin = np.arange(0, len(n), BLOCK)
        low, high = n[begin], np.append(n[begin[1:] - 1], n[-1])
        front = np.minimum.reduceat(p, begin)
        same = np.minimum.reduceat(c, begin) == np.maximum.reduceat(c, begin)
        out = []
        for i in range(0, len(probe), 4096):
            who = probe[i : i + 4096]
            ni, pi = n[who][:, None], p[who][:, None]
            least = needed(np.maximum(low, -(-percent * ni // 100)), ni, percent)
            alive = (100 * high >= percent * ni) & (100 * ni >= percent * low) & (np.minimum(high - front, ni - pi) >= least) & ~(same & (c[begin] == c[who][:, None]))
            x, block = np.nonzero(alive)
            for j in range(0, len(x), 1024):
                row = np.repeat(who[x[j : j + 1024]], BLOCK)
                col = (begin[block[j : j + 1024]][:, None] + np.arange(BLOCK)).ravel()
                inside = col < len(n)
                found = fits(n, p, c, w, own, row[inside], col[inside])
                out.append(closest(*found) if nearest else found)
        return out

    def closest(row, col, apart):
        order = np.lexsort((apart, row))
        row, col, apart = row[order], col[order], apart[order]
        new = np.ones(len(row), bool)
        new[1:] = row[1:] != row[:-1]
        return row[new], col[new], apart[new]

    def run(batches):
        for token, n, p, k, c, w, g in _lists(_unpacked(batches), ("token", "n", "pos", "key", "comp", "row", "own")):
            n, p = n.astype(np.int64), p.astype(np.int64)
            first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            size = np.diff(np.append(first, len(token)))
            mixed = np.minimum.reduceat(c, first) != np.maximum.reduceat(c, first)  # else the whole list is one component
            parts = []
            short = np.flatnonzero(np.repeat(mixed & (size <= SMALL), size))
            if len(short):
                row, col, apart = (np.concatenate(x) for x in zip(*side_by_side(*(x[short] for x in (token, n, p, c, w, g))), strict=True))
                if nearest:
                    row, col, _ = closest(np.append(row, col), np.append(col, row), np.append(apart, apart))
                parts.append((short[row], short[col]))
            for a, m in zip(first[mixed & (size > SMALL)], size[mixed & (size > SMALL)], strict=True):
                own = slice(a, a + m)
                found = by_block(*(x[own] for x in (n, p, c, w, g)))
                if nearest and found:
                    found = [closest(*(np.concatenate(x) for x in zip(*found, strict=True)))]
                parts += [(row + a, col + a) for row, col, _ in found]
            if not parts:
                continue
            row, col = (np.concatenate(x) for x in zip(*parts, strict=True))
            swap = k[row] > k[col]
            row, col = np.where(swap, col, row), np.where(swap, row, col)
            if not nearest:  # else it matters which lists have pairs
                order = np.lexsort((k[col], k[row]))
                row, col = row[order], col[order]
                new = np.ones(len(row), bool)
                new[1:] = (k[row][1:] != k[row][:-1]) | (k[col][1:] != k[col][:-1])
                row, col = row[new], col[new]
            yield pa.RecordBatch.from_arrays([pa.array(token[row]), pa.array(k[row]), pa.array(k[col]), pa.array(n[row].astype(np.int32)), pa.array(n[col].astype(np.int32)), pa.array(c[row]), pa.array(c[col])], ["token", "a", "b", "na", "nb", "ca", "cb"])

    return _for_search(postings).repartition("token").sortWithinPartitions("token", "n").mapInArrow(run, "token bigint, a bigint, b bigint, na int, nb int, ca bigint, cb bigint")


class _Column:
    def __init__(self, values: np.ndarray):
        self.values = values

    def to_numpy(self, zero_copy_only: bool = False) -> np.ndarray:
        return self.values


class _Batch:
    def __init__(self, columns: dict[str, np.ndarray]):
        self.columns = columns

    def column(self, name: str) -> _Column:
        return _Column(self.columns[name])


def _unpacked(batches):
    """Batches with the parities as rows of 64-bit words."""
    for batch in batches:
        columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("token", "n", "pos", "key", "comp", "own")}
        raw = b"".join(batch.column("parity").to_pylist())
        columns["row"] = np.frombuffer(raw, np.uint64).reshape(batch.num_rows, len(raw) // 8 // max(batch.num_rows, 1))
        yield _Batch(columns)


def _packed_sets(texts: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """(key, packed) of the classes: the whole set as ascending 56-bit hashes, made again from the text of each.

    texts and classes meet by (raw, doc_id): the hash of a text's bytes tells rows apart whose id repeats or is null."""

    def run(batches):
        done = set()
        for part, data, offsets in blocks(batches, "text"):
            key, of = _sets(data, offsets, k)
            at = np.searchsorted(of, np.arange(part.num_rows + 1))
            keys, packed = [], []
            for i, own in enumerate(part.column("key").to_pylist()):
                if own not in done:  # rows that repeat share a text
                    done.add(own)
                    keys.append(own)
                    packed.append(np.unique(key[at[i] : at[i + 1]]).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_BYTES].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(packed, pa.binary())], ["key", "packed"])

    some = classes.select(F.col("doc_id").alias("_id"), F.col("raw").alias("_raw"), "key").hint("merge")
    found = texts.join(some, (F.col("raw") == F.col("_raw")) & F.col("doc_id").eqNullSafe(F.col("_id"))).select("key", "text")
    return found.mapInArrow(run, "key bigint, packed binary")


def _plausible(pairs: DataFrame, wide: DataFrame, percent: int) -> DataFrame:
    """The rows of pairs (a, b, na, nb and others) whose parities allow the threshold."""
    names = pairs.columns

    def run(batches):
        for batch in batches:
            na, nb = (batch.column(c).to_numpy().astype(np.int64) for c in ("na", "nb"))
            most = (na + nb - 2 * needed(na, nb, percent)).tolist()
            keep = [_apart(x, y) <= d for x, y, d in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), most, strict=True)]
            yield batch.select(names).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(wide.select(F.col("key").alias("a"), F.col("wide").alias("x")), "a").join(wide.select(F.col("key").alias("b"), F.col("wide").alias("y")), "b")
    return both.select(*pairs.columns, "x", "y").mapInArrow(run, pairs.schema)


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b and others) with delta, the exact size of the symmetric difference."""
    names = pairs.columns

    def unpacked(raw: pa.Buffer) -> np.ndarray:
        out = np.zeros((raw.size // _BYTES, 8), np.uint8)
        out[:, :_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, _BYTES)
        return out.view(np.uint64).ravel()

    def run(batches):
        for batch in batches:
            delta = []
            for x, y in zip(batch.column("left"), batch.column("right"), strict=True):  # views of the batch, no copies
                every = np.concatenate([unpacked(x.as_buffer()), unpacked(y.as_buffer())])
                every.sort()
                delta.append(len(every) - 2 * int((every[1:] == every[:-1]).sum()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(delta, pa.int32())], [*names, "delta"])

    both = pairs.join(sets.select(F.col("key").alias("a"), F.col("packed").alias("left")), "a").join(sets.select(F.col("key").alias("b"), F.col("packed").alias("right")), "b")
    return both.select(*pairs.columns, "left", "right").mapInArrow(run, T.StructType([*pairs.schema.fields, T.StructField("delta", T.IntegerType())]))


def _within(percent: int, delta: str = "delta"):
    """True if a difference of that size allows the threshold: 2 * (least intersection) <= na + nb - delta."""
    both = (F.col("na") + F.col("nb")).cast("long")
    return (both - F.col(delta)) * (100 + percent) >= 2 * percent * both


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(key, comp) of nodes (key) by links (a, b): comp is the smallest key that links reach.

    Each round takes the smallest label among the neighbours and then the label's own label; a chain so
    shortens by half, and every round's table is written to the shared folder. Of a round the driver gets whether
    a label changed and the labels that hold more than 1 in HEAVY keys, so that plans stay short."""
    both = written(links.select("a", "b").union(links.select("b", "a")).where("a != b").distinct().toDF("a", "b"))
    ends, rows = both.count(), nodes.count()
    crowded = heavy_keys(both, "b", ends)
    labels, seen = nodes.select("key", F.col("key").alias("comp")), both.groupBy("a").agg(F.min("b").alias("other"))
    while True:
        step = written(labels.join(seen.withColumnRenamed("a", "key"), "key", "left").select("key", F.least("comp", F.coalesce("other", "comp")).alias("low"), "comp"))
        if hasattr(labels, "halyard_path"):
            discard(labels)
        sizes = step.groupBy("low").agg(F.count("*").alias("n"), F.max(F.col("low") != F.col("comp")).alias("moved"))
        moved, heavy = sizes.agg(F.max("moved"), F.collect_list(F.when(F.col("n") * HEAVY > rows, F.col("low")))).first()
        if not moved:  # no link joins two labels, so a label is the smallest key of its component and its own label
            labels = step.select("key", F.col("low").alias("comp"))
            labels.halyard_path = step.halyard_path
            discard(both)
            return labels
        labels = written(skewed_join(step, step.select(F.col("key").alias("low"), F.col("low").alias("lower")), ["low"], heavy=heavy).select("key", F.col("lower").alias("comp")))
        discard(step)
        seen = skewed_join(both, labels.toDF("b", "other"), ["b"], heavy=crowded).groupBy("a").agg(F.min("other").alias("other"))


def classes_and_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """The described texts of docs (doc_id, text, tie), and one row a class of equal sets: n, one, two, comp, component_id."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), "tie", F.xxhash64(F.col("text").cast("string")).alias("raw"))
    order = shingle_order(texts.select("text"), k)
    described = written(_described(texts, order, k, percent).withColumn("key", F.monotonically_increasing_id()))
    first = described.where("n > 0").groupBy("n", "one", "two").agg(F.min(F.struct("key", "doc_id", "raw")).alias("first"), F.min("doc_id").alias("least"))
    classes = written(first.select("n", "one", "two", "first.*", "least"))
    sets = described.select("key", "n", "prefix").join(classes.select("key"), "key", "left_semi")
    postings = written(_postings(sets, percent))
    met = written(described.select("key", "n", "parity", "fine", "wide").join(postings.select("key").distinct(), "key", "left_semi"))
    sizes, widest = met.select("key", "n"), met.select("key", F.coalesce("wide", "fine").alias("wide"))

    stars = _stars(postings).join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
    stars = stars.where((100 * F.least("na", "nb")) >= percent * F.greatest("na", "nb"))
    stars = written(_plausible(stars.select("a", "b", "na", "nb", "a_leads", "b_leads"), widest, percent))
    packed = written(_packed_sets(texts.select("doc_id", "raw", "text"), classes.join(sizes.select("key"), "key", "left_semi"), k))
    answers = written(_compared(stars, packed))
    discard(stars)
    links = written(answers.where(_within(percent)).select("a", "b"))
    labels = components(sizes, links)
    discard(links)

    leaders = answers.where("a_leads").select("a", "b", "delta").union(answers.where("b_leads").select(F.col("b"), F.col("a"), "delta")).toDF("x", "y", "apart")
    direct, lists, done = answers.select("a", "b", F.col("delta").alias("exact")), postings, [answers]
    for nearest in (True, False):
        mixed = lists.select("token", "key", "n", "pos").join(labels.join(met.select("key", F.col("parity" if nearest else "fine").alias("parity")), "key"), "key")
        found = _pairs_across(mixed, percent, nearest)
        if nearest:  # a list without a pair now never has one: components only grow together
            found = written(found)
            alone = _pieces(F.col("token")) == 1
            lists = written(postings.where(alone).join(found.select("token").distinct(), "token", "left_semi").union(postings.where(~alone)))
        pairs = written(_plausible(found.drop("token").distinct(), widest, percent))
        # answers derived from those of a common leader x
        derived = (
            pairs.join(leaders.select("x", F.col("y").alias("a"), F.col("apart").alias("to_a")), "a")
            .join(leaders.select("x", F.col("y").alias("b"), F.col("apart").alias("to_b")), ["x", "b"])
            .groupBy("a", "b")
            .agg(F.min(F.col("to_a") + F.col("to_b")).alias("most"), F.max(F.abs(F.col("to_a") - F.col("to_b"))).alias("fewest"))
        )
        held = written(pairs.join(derived, ["a", "b"], "left").join(direct, ["a", "b"], "left"))
        sure = held.where(_within(percent, "exact") | _within(percent, "most")).select("ca", "cb")
        unsure = held.where(F.col("exact").isNull() & ~F.coalesce(_within(percent, "most"), F.lit(False)) & F.coalesce(_within(percent, "fewest"), F.lit(True))).select(*pairs.columns)
        now = written(_compared(unsure, packed))
        direct = direct.union(now.select("a", "b", "delta"))
        new = written(sure.union(now.where(_within(percent)).select("ca", "cb")).distinct().toDF("a", "b"))
        if new.limit(1).count():  # links between whole components: their least keys are the nodes now
            joins = components(new.select(F.col("a").alias("key")).union(new.select("b")).distinct(), new)
            heavy = heavy_keys(labels, "comp", labels.count())
            merged = written(skewed_join(labels, joins.toDF("comp", "least"), ["comp"], heavy=heavy).select("key", F.col("least").alias("comp")).union(labels.join(joins.select(F.col("key").alias("comp")), "comp", "left_anti").select("key", "comp")))
            discard(labels, joins)
            labels = merged
        done.append(now)
        discard(pairs, held, new, *([found] if nearest else []))
    discard(postings, lists, met, packed, *done)

    every = written(classes.join(labels, "key", "left").select("n", "one", "two", "least", F.coalesce("comp", "key").alias("comp")))
    discard(labels, classes)
    least = every.groupBy("comp").agg(F.min("least").alias("component_id"))
    found = written(skewed_join(every, least, ["comp"], heavy=heavy_keys(every, "comp", every.count())).select("n", "one", "two", "comp", "component_id"))
    discard(every)
    return described, found


def joined(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of each document (columns doc_id and text)."""
    described, found = classes_and_components(docs.select("doc_id", "text", F.lit(0).cast("long").alias("tie")), k, percent)
    some = skewed_join(described.select("doc_id", "n", "one", "two").where("n > 0"), found, ["n", "one", "two"]).select("doc_id", "n", "component_id")
    rest = described.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return some.unionByName(rest).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that are the smallest doc_id of their component, one of each.

    A null id comes last; rows of one id are ordered by their sets and then by a hash of all their columns, so the
    survivor doesn't depend on partitions. Documents without shingles are alike to nothing and stay."""
    every = packed(docs, doc_id=doc_id, text=text).withColumn("tie", F.xxhash64("row"))
    described, found = classes_and_components(every.select("doc_id", "text", "tie"), k, percent)
    rows = written(skewed_join(described.where("n > 0").select("doc_id", "n", "one", "two", "tie"), found, ["n", "one", "two"]).select("doc_id", "n", "one", "two", "tie", "comp"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n", "one", "two", "tie"))
    kept = written(rows.groupBy("comp").agg(first.alias("b")).select("b.tie", "b.n", "b.one", "b.two").join(rows.groupBy("tie", "n", "one", "two").agg(F.count("*").alias("alike")), ["tie", "n", "one", "two"]))
    discard(rows, found, described)
    prints = _with_prints(every.select("row", "tie", "text"), k)
    own = ["tie", "n", "one", "two"]
    out = prints.join(kept.where("alike = 1").select(*own, F.lit(True).alias("kept")), own, "left").where("n = 0 or kept").select("row")
    again = kept.where("alike > 1").select(*own)
    if again.limit(1).count():  # rows that are alike in all columns: any of them is the one
        out = out.union(prints.join(again, own, "left_semi").groupBy(*own).agg(F.first("row").alias("row")).select("row"))
    return out.select("row.*")


def _with_prints(rows: DataFrame, k: int) -> DataFrame:
    """rows (row, tie, text) with the size and the prints of the text's set in the text's place."""

    def run(batches):
        for part, data, offsets in blocks(batches, "text"):
            h, of = _sets(data, offsets, k)
            one, two = _prints(h, of, part.num_rows)
            n = np.bincount(of, minlength=part.num_rows).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("tie"), pa.array(n), pa.array(_signed(one)), pa.array(_signed(two))], ["row", "tie", "n", "one", "two"])

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], rows.schema["tie"], T.StructField("n", T.IntegerType()), T.StructField("one", T.LongType()), T.StructField("two", T.LongType())]))


#: joined() over documents: rows and classes are numbered, since ids may repeat.
OP3_SQL = r"""WITH RECURSIVE rows AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
words AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i, len(w) AS m FROM (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM rows)),
grams AS (SELECT r, i, m, concat_ws(' ', x, lead(x) OVER v, lead(x, 2) OVER v, lead(x, 3) OVER v) AS x FROM words WINDOW v AS (PARTITION BY r ORDER BY i)),
shingles AS (SELECT DISTINCT r, x FROM grams WHERE i <= greatest(m - 3, 1)),
sets AS (SELECT r, list(x ORDER BY x) AS s FROM shingles GROUP BY r),
classes AS (SELECT min(sets.r) AS c, min(doc_id) AS least, len(s) AS n, list(sets.r) AS members FROM sets JOIN rows ON rows.r = sets.r GROUP BY s),
own AS (SELECT c, n, x FROM classes JOIN shingles ON r = c),
links AS (
  SELECT a.c AS a, b.c AS b FROM own a JOIN own b ON a.x = b.x AND a.c <> b.c AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT c, c AS k FROM classes UNION SELECT reach.c, links.b FROM reach JOIN links ON reach.k = links.a),
found AS (SELECT reach.c, min(classes.least) AS component_id FROM reach JOIN classes ON reach.k = classes.c GROUP BY reach.c),
labels AS (SELECT unnest(members) AS r, n, component_id FROM classes JOIN found ON found.c = classes.c)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id FROM rows LEFT JOIN labels ON labels.r = rows.r"""
