"""Helpers that the corpus operators share: tables read by Spark, written intermediates, whole-text blocks in numpy.

Word and shingle identity is a 64-bit hash of the word's bytes, so tasks work on flat numpy arrays
instead of one Python object for each word. Every kernel takes the texts of one Arrow column as
(bytes, offsets) and never looks beyond a text's own bytes.
"""

from __future__ import annotations

import atexit
import contextlib
import hashlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space: what separates words.
WORD = r"[^\x20\x09-\x0D]+"
BLOCK_BYTES = 1 << 20
SEGMENT = 1 << 19
HEAVY = 2048
_DOCUMENT = (("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where none is set and all run on one machine, as in tests."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="halyard-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at


def written(df: DataFrame, *by: str) -> DataFrame:
    """df as a table in the shared folder: its lineage ends there, so lost executors cost no recomputation of it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/halyard-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    atexit.register(_remove, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out.halyard_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes tables that written() made, once no query that is still to run reads them."""
    for df in tables:
        _remove(df.sparkSession, df.halyard_path)


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def packed(docs: DataFrame, **columns) -> DataFrame:
    """All columns of docs as one, `row`, beside the given ones (names of docs' columns, or expressions).

    Operators that keep whole rows work on this, so no column's name can clash; select("row.*") undoes it."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(k) for k, c in columns.items()])


def crc_part(column: str, parts: int):
    """crc32 of a number's text, modulo parts; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts


def skewed_join(left: DataFrame, right: DataFrame, on: list[str], rows: int | None = None, heavy: list | None = None) -> DataFrame:
    """left joined with right, which has each key once, where a few keys may hold most rows of left (a written table).

    Keys that hold more than 1 in HEAVY rows are fewer than HEAVY, so their rows of right are broadcast and the
    rows of left stay where they are; the other keys meet by a shuffle. rows: how many left has, where that's known.
    heavy: those keys themselves, for a key of one column; a plan for none of them is a plain join."""
    if heavy is not None:
        if not heavy:
            return left.join(right, on)
        among = F.col(on[0]).isin(heavy)
        return left.where(among).join(F.broadcast(right.where(among)), on).unionByName(left.where(~among).join(right, on))
    rows = left.count() if rows is None else rows
    heavy = F.broadcast(left.groupBy(*on).agg(F.count("*").alias("_rows")).where(F.col("_rows") * HEAVY > rows).select(*on))
    some = left.join(F.broadcast(right.join(heavy, on, "left_semi")), on)
    return some.unionByName(left.join(heavy, on, "left_anti").join(right, on))


def heavy_keys(df: DataFrame, key: str, rows: int) -> list:
    """The values of column key that hold more than 1 in HEAVY of df's rows: fewer than HEAVY, whatever df's size."""
    return [r[0] for r in df.groupBy(key).agg(F.count("*").alias("_rows")).where(F.col("_rows") * HEAVY > rows).select(key).collect()]


def most_frequent(counts: DataFrame, n: str, most: int) -> DataFrame:
    """The rows of the largest counts, at most `most`, chosen without a sort.

    Counts fall into bands of about 1 %; rows of the highest bands that together fit are taken, so
    no more than `most` rows exist anywhere and tasks send only a row for each band. Where even the highest
    band doesn't fit, a part of it is taken by a hash of the whole row."""
    band = F.floor(F.log2(F.col(n).cast("double")) * 64)
    total, least = 0, None
    for r in counts.groupBy(band.alias("band")).agg(F.count("*").alias("rows")).orderBy(F.desc("band")).collect():
        if total + r.rows > most and not total:
            first = counts.where(band == r.band)
            part = F.pmod(F.xxhash64(*counts.columns), F.lit(1024))
            held = 0
            for x in first.groupBy(part.alias("part")).agg(F.count("*").alias("rows")).orderBy("part").collect():
                if held + x.rows > most:
                    return first.where(part < x.part)
                held += x.rows
        total += r.rows
        if total > most:
            break
        least = r.band
    return counts.where(F.lit(False) if least is None else band >= least)


# --- numpy kernels -----------------------------------------------------------------------------

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_ODD = int(_RNG.integers(1, 2**62)) * 2 + 1
_MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
_PLACE = _RNG.integers(1, 2**63, 16, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_POWERS: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of a public 64-bit hash."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(_MIX[0])
    h ^= h >> np.uint64(33)
    h = h * np.uint64(_MIX[1])
    return h ^ (h >> np.uint64(33))


def blocks(batches: Iterator[pa.RecordBatch], column: str, most: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches of about `most` text bytes, with the column's bytes and offsets; a null text is empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column).fill_null("").cast(pa.large_binary())
        if texts.offset:
            texts = pa.concat_arrays([texts])
        _, at, data = texts.buffers()
        offsets = np.frombuffer(at, np.int64)[: batch.num_rows + 1]
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
            last = min(last, batch.num_rows)
            part = offsets[first : last + 1]
            yield batch.slice(first, last - first), data[part[0] : part[-1]], part - part[0]
            first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word; no word crosses from one text to the next."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start, end = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1] | edge[1:-1]
    end[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        up, down = np.full(n, _ODD, np.uint64), np.full(n, pow(_ODD, -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        with np.errstate(over="ignore"):
            _POWERS["up"], _POWERS["down"] = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, A-Z as a-z. Long inputs go in segments, so the work space stays small."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    up, down = _powers(SEGMENT + 1)
    with np.errstate(over="ignore"):
        while first < len(starts):
            at = starts[first]
            last = int(np.searchsorted(ends, at + SEGMENT, "right"))
            if last <= first:  # one word longer than a segment
                raw = bytes(data[at : ends[first]]).lower() if ends[first] > at else b""
                out[first] = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
                first += 1
                continue
            n = int(ends[last - 1] - at)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTE[data[at : at + n]] * up[:n], out=sums[1:])
            a, b = starts[first:last] - at, ends[first:last] - at
            out[first:last] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64) * _PLACE[15])
            first = last
    return out


def shingles(hashes: np.ndarray, doc: np.ndarray, n_docs: int, k: int, weight: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Hash and text number of each run of k words; a shorter text with words is one run.

    weight: a whole number for each word; then the sum over each run is the third result (0 for shorter texts)."""
    with np.errstate(over="ignore"):
        run = np.zeros(max(0, len(hashes) - k + 1), np.uint64)
        for i in range(k if len(run) else 0):
            run += hashes[i : len(hashes) - k + 1 + i] * _PLACE[i]
        whole = doc[k - 1 :] == doc[: len(run)] if len(run) else np.zeros(0, bool)
        counts = np.bincount(doc, minlength=n_docs)
        first = np.cumsum(counts) - counts
        short = np.flatnonzero((counts > 0) & (counts < k))
        tail = counts[short].astype(np.uint64) * _PLACE[14]
        for i in range(k - 1):
            has = counts[short] > i
            tail[has] += hashes[first[short[has]] + i] * _PLACE[i]
        every, of = np.concatenate([mix(run[whole]), mix(tail)]), np.concatenate([doc[: len(run)][whole], short])
    order = np.argsort(of, kind="stable")
    if weight is None:
        return every[order], of[order]
    sums = np.append(0, np.cumsum(weight))
    return every[order], of[order], np.append((sums[k:] - sums[:-k])[whole] if len(run) else sums[:0], np.zeros(len(short), np.int64))[order]
