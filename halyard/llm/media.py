"""Media columns: ISO media containers as table columns.

`probe` walks the nested boxes of a container and decodes its sample tables; codec, duration and the
byte ranges of the key frames come from those tables alone, no payload is decoded. `wrap` stores bytes
losslessly as 24 x 24 frames of 8-bit samples in such a container.

Defined results: a null container or one that can't be parsed gives null columns and a message in
`media_error`; a container without a key-frame table has every sample as a key frame; of several tracks the
first video track counts, without one the first. Movie fragments are decoded like sample tables. Texts: null is
stored as the empty text, whose payload is one padded frame. Repeated rows each give their own row.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halyard.llm.shared import blocks

FRAME = 576
SIDE = 24
RATE = 25
KEY_EVERY = 12
CHUNK = 64
#: A container whose boxes are nested deeper is refused; real ones have about eight levels.
DEPTH = 32
#: Fixed by the format: which fields a fragment's run has, and the flag of a sample that is no key frame.
_RUN_FIELDS = {"duration": 0x100, "size": 0x200, "flags": 0x400, "shift": 0x800}
_NO_KEY = 0x10000
_NESTED = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"edts", b"dinf", b"udta", b"mvex", b"moof", b"traf"}


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body


def _full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *parts)


def wrap(payload: bytes) -> bytes:
    """A container with one track of raw frames of FRAME bytes; a payload is a positive multiple of that."""
    n = len(payload) // FRAME
    unity = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    chunks = -(-n // CHUNK)
    runs = [(1, CHUNK, 1)] if n >= CHUNK else []
    if n % CHUNK:
        runs.append((chunks, n % CHUNK, 1))
    keys = np.arange(1, n + 1, KEY_EVERY, dtype=">u4")
    entry = _box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HHIIIH", SIDE, SIDE, 0x480000, 0x480000, 0, 1), bytes(32), struct.pack(">Hh", 8, -1))
    wide = len(payload) > 0xFFFF0000

    def head(first: int) -> bytes:
        at = np.arange(chunks, dtype=np.uint64) * np.uint64(CHUNK * FRAME) + np.uint64(first)
        table = _box(
            b"stbl",
            _full(b"stsd", struct.pack(">I", 1), entry),
            _full(b"stts", struct.pack(">III", 1, n, 1)),
            _full(b"stss", struct.pack(">I", len(keys)), keys.tobytes()),
            _full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", *r) for r in runs)),
            _full(b"stsz", struct.pack(">II", FRAME, n)),
            _full(b"co64" if wide else b"stco", struct.pack(">I", chunks), at.astype(">u8" if wide else ">u4").tobytes()),
        )
        media = _box(
            b"mdia",
            _full(b"mdhd", struct.pack(">IIIIHH", 0, 0, RATE, n, 0x55C4, 0)),
            _full(b"hdlr", bytes(4), b"vide", bytes(12), b"frames\0"),
            _box(b"minf", _full(b"vmhd", bytes(8), flags=1), _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1))), table),
        )
        track = _full(b"tkhd", struct.pack(">IIIII", 0, 0, 1, 0, n), bytes(16), unity, struct.pack(">II", SIDE << 16, SIDE << 16), flags=3)
        movie = _full(b"mvhd", struct.pack(">IIIIIH", 0, 0, RATE, n, 0x10000, 0x100), bytes(10), unity, bytes(24), struct.pack(">I", 2))
        return _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2") + _box(b"moov", movie, _box(b"trak", track, media))

    lead = struct.pack(">I4sQ", 1, b"mdat", 16 + len(payload)) if wide else struct.pack(">I4s", 8 + len(payload), b"mdat")
    return head(len(head(0)) + len(lead)) + lead + payload


def _walk(data: memoryview) -> Iterator[tuple[tuple, int, int]]:
    """Trail (kind and start of each box around it and of itself), body start and body end of each box, in file order."""
    open_ = [(0, len(data), ())]
    while open_:
        at, end, trail = open_.pop()
        if at + 8 > end:
            continue
        size, kind = struct.unpack_from(">I4s", data, at)
        body = at + 8
        if size == 1:
            if at + 16 > end:
                raise ValueError("a box ends in its header")
            size, body = struct.unpack_from(">Q", data, at + 8)[0], at + 16
        stop = end if size == 0 else at + size
        if stop > end or stop < body:
            raise ValueError(f"box {kind!r} at {at} exceeds its parent")
        here = (*trail, (kind, at))
        if len(here) > DEPTH:
            raise ValueError(f"boxes nested deeper than {DEPTH}")
        yield here, body, stop
        open_.append((stop, end, trail))
        if kind in _NESTED:
            open_.append((body, stop, here))


def _table(data: memoryview, at: int, end: int, columns: int, kind: str = ">u4", head: int = 4) -> np.ndarray:
    (n,) = struct.unpack_from(">I", data, at + head)
    wide = np.dtype(kind).itemsize * columns
    if at + head + 4 + n * wide > end:
        raise ValueError("a sample table is cut off")
    return np.frombuffer(data, kind, n * columns, at + head + 4).astype(np.int64).reshape(n, columns)


def _described(data: memoryview, boxes: dict[bytes, tuple[int, int]], room: int) -> dict:
    """A track by its sample tables: id, handler, codec, width, height, scale, ticks, offsets, sizes, keys."""
    if not {b"stsd", b"stts", b"stsc", b"stsz", b"mdhd", b"tkhd"} <= boxes.keys() or not boxes.keys() & {b"stco", b"co64"}:
        raise ValueError("a track lacks its sample tables")
    at, end = boxes[b"stsd"]
    if at + 16 > end:
        raise ValueError("a track lacks its sample entry")
    codec = bytes(data[at + 12 : at + 16]).decode("latin-1")
    handler = bytes(data[boxes[b"hdlr"][0] + 8 : boxes[b"hdlr"][0] + 12]) if b"hdlr" in boxes else b""
    width, height = struct.unpack_from(">HH", data, at + 40) if at + 44 <= end and handler in (b"vide", b"") else (0, 0)
    at, _ = boxes[b"tkhd"]
    number = struct.unpack_from(">I", data, at + (20 if data[at] else 12))[0]
    at, _ = boxes[b"mdhd"]
    scale = struct.unpack_from(">I", data, at + (20 if data[at] else 12))[0]
    times = _table(data, *boxes[b"stts"], 2).astype(float)
    at, end = boxes[b"stsz"]
    fixed, n = struct.unpack_from(">II", data, at + 4)
    if n > room:
        raise ValueError("more samples than bytes")
    sizes = np.full(n, fixed, np.int64) if fixed else _table(data, at, end, 1, head=8)[:, 0]
    starts = (_table(data, *boxes[b"co64"], 1, ">u8") if b"co64" in boxes else _table(data, *boxes[b"stco"], 1))[:, 0]
    runs = _table(data, *boxes[b"stsc"], 3)
    each = np.repeat(runs[:, 1], np.diff(np.append(runs[:, 0] - 1, len(starts)))) if len(runs) else np.zeros(0, np.int64)
    if each.sum() != len(sizes) or len(each) != len(starts):
        raise ValueError("chunks and samples disagree")
    before = np.cumsum(sizes) - sizes
    first = np.cumsum(each) - each
    offsets = np.repeat(starts - before[first], each) + before if len(sizes) else before
    keys = _table(data, *boxes[b"stss"], 1)[:, 0] - 1 if b"stss" in boxes else np.arange(len(sizes))
    if len(keys) and (keys.min() < 0 or keys.max() >= len(sizes)):
        raise ValueError("a key frame outside the samples")
    return {"id": number, "handler": handler, "codec": codec, "width": width, "height": height, "scale": scale, "ticks": float((times[:, 0] * times[:, 1]).sum()), "offsets": [offsets], "sizes": [sizes], "keys": [keys], "samples": n}


def _run(data: memoryview, at: int, end: int, usual: dict, begin: int | None, base: int, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Offsets, sizes, key flags and ticks of a fragment's run. begin: where the run before it ended."""
    flags, n = (x & 0xFFFFFF if i == 0 else x for i, x in enumerate(struct.unpack_from(">II", data, at)))
    if n > room:
        raise ValueError("more samples than bytes")
    at += 8
    if flags & 0x1:
        begin = base + struct.unpack_from(">i", data, at)[0]
        at += 4
    first = None
    if flags & 0x4:
        first = struct.unpack_from(">I", data, at)[0]
        at += 4
    fields = [f for f in ("duration", "size", "flags", "shift") if flags & _RUN_FIELDS[f]]
    if at + 4 * n * len(fields) > end:
        raise ValueError("a fragment's run is cut off")
    told = np.frombuffer(data, ">u4", n * len(fields), at).astype(np.int64).reshape(n, len(fields)) if n and fields else np.zeros((n, 0), np.int64)
    column = {f: told[:, i] for i, f in enumerate(fields)}
    duration, sizes, marks = (column[f] if f in column else np.full(n, usual[f], np.int64) for f in ("duration", "size", "flags"))
    if first is not None and n:
        marks = np.append(first, marks[1:])
    offsets = (base if begin is None else begin) + np.cumsum(sizes) - sizes
    return offsets, sizes, marks & _NO_KEY == 0, float(duration.sum())


def _fragments(data: memoryview, trafs: dict[tuple, list], defaults: dict[int, dict], tracks: list[dict], room: int) -> None:
    """Adds the samples of movie fragments to their tracks. trafs: the boxes in each traf by (moof start, traf start)."""
    by_number = {t["id"]: t for t in tracks}
    ended: dict[int, int] = {}  # where the data of a moof's last traf end
    for (moof, _), boxes in trafs.items():
        heads = [x for x in boxes if x[0] == b"tfhd"]
        if len(heads) != 1:
            raise ValueError("a fragment lacks its header")
        _, at, _ = heads[0]
        flags, number = struct.unpack_from(">II", data, at)
        if number not in by_number:
            raise ValueError(f"a fragment of an unknown track {number}")
        track, usual = by_number[number], dict(defaults.get(number, {"duration": 0, "size": 0, "flags": 0}))
        base = moof if flags & 0x20000 else ended.get(moof, moof)
        at += 8
        if flags & 0x1:
            base = struct.unpack_from(">Q", data, at)[0]
            at += 8
        at += 4 if flags & 0x2 else 0
        for name, bit in (("duration", 0x8), ("size", 0x10), ("flags", 0x20)):
            if flags & bit:
                usual[name] = struct.unpack_from(">I", data, at)[0]
                at += 4
        begin = None
        for kind, body, end in boxes:
            if kind != b"trun":
                continue
            offsets, sizes, key, ticks = _run(data, body, end, usual, begin, base, room)
            room -= len(sizes)
            if len(sizes):
                begin = int(offsets[-1] + sizes[-1])
            track["offsets"].append(offsets)
            track["sizes"].append(sizes)
            track["keys"].append(np.flatnonzero(key) + track["samples"])
            track["samples"] += len(sizes)
            track["ticks"] += ticks
        ended[moof] = base if begin is None else begin


def probe(content: bytes) -> list[dict]:
    """One dict a track: handler, codec, width, height, duration (seconds), samples, offsets, sizes, keys (sample numbers from 0).

    Samples of movie fragments follow those of the track's own tables. No more samples are decoded than the file has bytes."""
    data = memoryview(content)
    found: dict[tuple, dict[bytes, tuple[int, int]]] = {}
    trafs: dict[tuple, list] = {}
    defaults: dict[int, dict] = {}
    for trail, body, end in _walk(data):
        kind = trail[-1][0]
        track = next((x for x in trail[:-1] if x[0] == b"trak"), None)
        traf = next((x for x in trail[:-1] if x[0] == b"traf"), None)
        if track:
            found.setdefault(track, {})[kind] = (body, end)
        elif traf and trail[0][0] == b"moof":
            trafs.setdefault((trail[0][1], traf[1]), []).append((kind, body, end))
        elif kind == b"trex":
            number, _, duration, size, flags = struct.unpack_from(">5I", data, body + 4)
            defaults[number] = {"duration": duration, "size": size, "flags": flags}
    tracks, room = [], len(data)
    for boxes in found.values():
        tracks.append(_described(data, boxes, room))
        room -= tracks[-1]["samples"]
    if not tracks:
        raise ValueError("no track")
    _fragments(data, trafs, defaults, tracks, room)
    for t in tracks:
        t["offsets"], t["sizes"], t["keys"] = (np.concatenate(t[x]) for x in ("offsets", "sizes", "keys"))
        t["duration"] = t.pop("ticks") / max(t.pop("scale"), 1)
        at, size = t["offsets"], t["sizes"]
        if len(at) and (at.min() < 0 or at.max() > len(data) or (at + size).max() > len(data)):
            raise ValueError("a sample outside the file")
    return tracks


def payload(content: bytes, track: dict) -> bytes:
    """The stored bytes of a track, in sample order, by its sample table."""
    data, at, size = memoryview(content), track["offsets"], track["sizes"]
    jump = np.flatnonzero(at[1:] != at[:-1] + size[:-1]) + 1
    first, last = np.append(0, jump), np.append(jump, len(at))
    return b"".join(data[at[a] : at[b - 1] + size[b - 1]] for a, b in zip(first, last, strict=True))


_RANGES = pa.list_(pa.struct([("start", pa.int64()), ("bytes", pa.int64())]))
_COLUMNS = [("codec", pa.string()), ("duration_s", pa.float64()), ("keyframes", _RANGES)]
_DDL = "codec string, duration_s double, keyframes array<struct<start:bigint,bytes:bigint>>"


def _ranges(track: dict) -> list[dict]:
    return [{"start": int(a), "bytes": int(b)} for a, b in zip(track["offsets"][track["keys"]], track["sizes"][track["keys"]], strict=True)]


def media_columns(df: DataFrame, content: str = "content") -> DataFrame:
    """df with codec, duration_s and keyframes of the first video track (else the first) of each container, and media_error.

    Columns of those names in df are replaced, also the one that holds the containers."""
    own = [c for c in df.columns if c.lower() not in ("codec", "duration_s", "keyframes", "media_error")]
    kept = df.select(*[F.col(f"`{c}`") for c in own])
    source = "_" * max(map(len, ["", *own])) + "_media"
    read = df.select(*[F.col(f"`{c}`") for c in own], F.col(f"`{content}`").cast("binary").alias(source))

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                rows = []
                for x in part.column(source).to_pylist():
                    try:
                        if x is None:
                            raise ValueError("null")
                        tracks = probe(x)
                        t = next((t for t in tracks if t["handler"] == b"vide"), tracks[0])
                        rows.append((t["codec"], t["duration"], _ranges(t), None))
                    except (ValueError, OverflowError, struct.error, KeyError, IndexError) as e:
                        rows.append((None, None, None, str(e) or type(e).__name__))
                cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate([t for _, t in _COLUMNS] + [pa.string()])]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *cols], [*part.schema.names[:-1], "codec", "duration_s", "keyframes", "media_error"])

    extra = T._parse_datatype_string(f"{_DDL}, media_error string")
    return read.mapInArrow(run, T.StructType([*kept.schema.fields, *extra.fields]))


_STORED = "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string, " + _DDL


def store_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each whole text stored as frames, read back by the sample tables, with its digests and features.

    One row a document; the work is a map over rows, so nothing is shuffled and one text is in memory at a time."""

    def run(batches):
        names = [x.split(":")[0].split()[0] for x in ("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "codec", "duration_s", "keyframes")]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), _RANGES]
        for part, data, offsets in blocks(batches, "text"):
            out: list[list] = [[] for _ in names]
            for i, one in enumerate(part.column("doc_id").to_pylist()):
                raw = data[offsets[i] : offsets[i + 1]].tobytes()
                media = wrap(raw + b"\xff" * (-len(raw) % FRAME or (0 if raw else FRAME)))
                (track,) = probe(media)
                back = payload(media, track)
                ranges = _ranges(track)
                keys = hashlib.sha256(b"".join(struct.pack(">QQ", r["start"], r["bytes"]) for r in ranges)).hexdigest()[:16]
                feature = f"{track['codec'].strip()};{track['width']}x{track['height']};{track['duration']:.2f}s;{track['samples']} samples;{len(ranges)} keyframes;{ranges[0]['start']}+{ranges[0]['bytes']}..{ranges[-1]['start']}+{ranges[-1]['bytes']};{keys}"
                row = (one, len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature, track["codec"], track["duration"], ranges)
                for column, x in zip(out, row, strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names)

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, _STORED)
