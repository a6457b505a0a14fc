"""Merkle dataset manifest: a postorder append log of one tree for each group of rows, and proofs read from it.

A tree's node over FAN children has the hash of theirs; the log holds a tree's nodes in the order in which they are
completed, which is its postorder. A node's position there follows from its level, its index and the number of leaves
alone (subtree sizes are known), so no pointers are stored: a proof's siblings are addressed by computed positions.

Rows are numbered by a range partitioning and a running count over partitions. Aligned builders then work side by
side: FAN**LEVELS consecutive leaves make one subtree, whose nodes one builder appends in completion order while the leaves
stream by; its root is a leaf of the next stage, whose log interleaves with the first by position. Three levels
a stage, so a handful of stages for any corpus. Proofs go the other way: each block reads its own stretch of the log and
the path above its root, which is stored once a block. Texts are read once, by the leaf hashes; all else works on
digests. A builder holds one block, so a group with a third of all rows is spread like any other.

Defined results: null is hashed as "-" and so differs from the empty value; rows ascend by id, null ids first, ties by leaf
hash (rows alike are interchangeable); a group of one row has its leaf as root; an empty table gives no rows; columns other
than the hashed ones are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halyard.llm.shared import written

FAN = 8
#: Levels a builder completes; its block has FAN**LEVELS leaves.
LEVELS = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_KEPT = "doc_id bigint, claim binary"
_LOG = f"g string, n bigint, blk bigint, level int, idx bigint, pos bigint, hash binary, top boolean, {_KEPT}"


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 of the values, each as its length in UTF-8 bytes, ":" and itself; "-" for null."""
    texts = [c.cast("string") for c in columns]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]).cast("binary"), 256))


def joined_hash(digests: list[bytes]) -> bytes:
    """SHA-256 of digests, each as hex text."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def width(level: int, n: int) -> int:
    """Nodes of a level over n leaves."""
    return -(-n // FAN**level)


def height(n: int) -> int:
    level = 0
    while width(level, n) > 1:
        level += 1
    return level


def position(level: int, index: int, n: int) -> int:
    """Nodes completed before this one: all below it and to its left, and what is complete above those to its left."""
    end = min((index + 1) * FAN**level, n)
    below = sum(width(m, end) for m in range(level))
    above, left = 0, index // FAN
    while left:
        above += left
        left //= FAN
    return below + index + above


def completed(leaves: list[bytes], first: int, n: int, levels: int) -> Iterator[tuple[int, int, bytes]]:
    """(level, index, hash) of the subtree over leaves first, first + 1, ... of n, in completion order."""
    waiting: list[list[bytes]] = [[] for _ in range(levels + 1)]
    for k, digest in enumerate(leaves):
        level, index = 0, first + k
        yield level, index, digest
        while level < levels:
            waiting[level].append(digest)
            if index % FAN != FAN - 1 and index != width(level, n) - 1:
                break
            digest = joined_hash(waiting[level])
            waiting[level].clear()
            level, index = level + 1, index // FAN
            yield level, index, digest


class Numbered(NamedTuple):
    rows: DataFrame  # with g, idx and n
    most: int  # rows of the largest group


def numbered(rows: DataFrame, *order: str) -> Numbered:
    """rows (a written table) with idx, their rank from 0 within g by `order`, and n, their group's size."""
    placed = written(rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)  # that function numbers a partition's rows in its lower bits
    pieces = placed.groupBy("g", part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    up = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("g", "part", "first", F.coalesce(F.sum("rows").over(up), F.lit(0)).alias("before"), F.sum("rows").over(Window.partitionBy("g")).alias("n"))
    pieces = written(pieces)
    most = pieces.agg(F.max("n")).first()[0] or 0
    out = placed.withColumn("part", part).join(pieces, ["g", "part"]).withColumn("idx", F.col("at") - F.col("first") + F.col("before"))
    return Numbered(out.drop("at", "part", "first", "before"), most)


def _by_block(batches, names: list[str]):
    """The rows of one (g, blk) after the other; a partition has them in order."""
    key, held = None, []
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in names]
        for row in zip(*columns, strict=True):
            if row[:2] != key:
                if held:
                    yield key, held
                key, held = row[:2], []
            held.append(row[2:])
    if held:
        yield key, held


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], at_once: int = 8192):
    held = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)

    for row in rows:
        held.append(row)
        if len(held) >= at_once:
            yield batch()
            held.clear()
    if held:
        yield batch()


_TYPES = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}


def _fields(schema: str) -> tuple[list[str], list[pa.DataType]]:
    names, kinds = zip(*[x.split() for x in schema.split(", ")], strict=True)
    return list(names), [_TYPES[k] for k in kinds]


def appended(leaves: Numbered, levels: int = LEVELS) -> list[DataFrame]:
    """The log of all groups' trees, a written table a stage: g, n, blk (builder), level, idx, pos, hash, top (the root).

    leaves: g, idx, n, hash, doc_id and claim, which the log keeps for leaves. A later stage begins with the roots of the stage before."""
    names, kinds = _fields(_LOG)

    def stage(base: int):
        def nodes(batches):
            for (g, blk), rows in _by_block(batches, ["g", "blk", "n", "hash", "doc_id", "claim"]):
                n = rows[0][0]
                top = height(n)
                first = blk * FAN**levels
                here = width(base, n)
                for level, index, digest in completed([r[1] for r in rows], first, here, min(levels, top - base)):
                    kept = rows[index - first][2:] if level == 0 else (None, None)
                    yield g, n, blk, base + level, index, position(base + level, index, n), digest, base + level == top, *kept

        return lambda batches: _batches(nodes(batches), names, kinds)

    out, base = [], 0
    rows = leaves.rows.select("g", "n", "idx", "hash", "doc_id", "claim")
    while True:
        dealt = rows.withColumn("blk", F.floor(F.col("idx") / FAN**levels)).repartition("g", "blk").sortWithinPartitions("g", "blk", "idx")
        out.append(written(dealt.mapInArrow(stage(base), _LOG)))
        base += levels
        if width(base, leaves.most) <= 1:
            return out
        rows = out[-1].where((F.col("level") == base) & ~F.col("top")).select("g", "n", "idx", "hash", "doc_id", "claim")


def log(stages: list[DataFrame], levels: int = LEVELS) -> DataFrame:
    """g, pos, level, idx and hash of every node."""
    own = [s if not k else s.where(F.col("level") > k * levels) for k, s in enumerate(stages)]
    out = own[0]
    for s in own[1:]:
        out = out.unionByName(s)
    return out.select("g", "pos", "level", "idx", "hash")


def tops(stages: list[DataFrame]) -> DataFrame:
    """g, n and the root's hash of each group."""
    out = stages[0].where("top")
    for s in stages[1:]:
        out = out.unionByName(s.where("top"))
    return out.select("g", "n", "hash")


def _step(slot: int, run: list[bytes]) -> bytes:
    """One level of a path: the node's place in its run, the run's size, and the others' digests."""
    return bytes((slot, len(run))) + b"".join(d for k, d in enumerate(run) if k != slot)


def steps(path: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """(place, the others' digests from left to right) of each level of a path."""
    at = 0
    while at < len(path):
        slot, size = path[at], path[at + 1]
        at += 2
        yield slot, [path[at + 32 * k : at + 32 * k + 32] for k in range(size - 1)]
        at += 32 * (size - 1)


def folded(digest: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path lead to."""
    for slot, others in steps(path):
        digest = joined_hash([*others[:slot], digest, *others[slot:]])
    return digest


_ABOVE = "path binary, subroot binary, root binary"
_PROOF = f"g string, idx bigint, hash binary, {_KEPT}, {_ABOVE}"


def paths(stages: list[DataFrame], above: DataFrame, levels: int = LEVELS) -> DataFrame:
    """g, idx, hash, doc_id, claim, path, subroot and root of each leaf; above has g, n, path, subroot and root of each group's root."""
    names, kinds = _fields(_PROOF)

    def stage(base: int):
        def proofs(batches):
            for (g, blk), rows in _by_block(batches, ["g", "blk", "n", "hash", "doc_id", "claim", "path", "subroot", "root"]):
                (_, _, _, _, upper, subroot, root), rows = rows[0], rows[1:]
                n, hashes = rows[0][0], [r[1] for r in rows]
                here = width(base, n)
                up = min(levels, height(n) - base)
                first = blk * FAN**levels
                start = position(0, first, here)
                known: dict[tuple[int, int], bytes] = {}

                def run(level: int, index: int) -> list[bytes]:
                    lo = index - index % FAN
                    return [hashes[position(level, x, here) - start] for x in range(lo, min(lo + FAN, width(level, here)))]  # noqa: B023

                def path(level: int, index: int) -> bytes:
                    if level == up:  # noqa: B023
                        return upper  # noqa: B023
                    over = (level + 1, index // FAN)
                    if over not in known:  # noqa: B023
                        known[over] = path(*over)  # noqa: B023
                    return _step(index % FAN, run(level, index)) + known[over]  # noqa: B023

                for index in range(first, min(first + FAN**levels, here)):
                    row = rows[position(0, index, here) - start]
                    yield g, index, row[1], row[2], row[3], path(0, index), subroot, root

        return lambda batches: _batches(proofs(batches), names, kinds, 2048)

    empty = [F.lit(None).cast(k).alias(c) for c, k in (x.split() for x in _ABOVE.split(", "))]
    nothing = [F.lit(None).cast(k).alias(c) for c, k in (("hash", "binary"), ("doc_id", "bigint"), ("claim", "binary"))]
    lower, found = ["hash", "doc_id", "claim"], None
    for k in reversed(range(len(stages))):
        # groups whose root this stage makes, and blocks whose root the next stage had as a leaf
        ends = (F.col("n") <= FAN ** (levels * (k + 1))) & ((F.col("n") > FAN ** (levels * k)) if k else F.lit(True))
        heads = above.where(ends).select("g", F.lit(0).cast("bigint").alias("blk"), "path", "subroot", "root")
        if found is not None:
            heads = heads.unionByName(found.select("g", F.col("idx").alias("blk"), "path", "subroot", "root"))
        heads = heads.select("g", "blk", F.lit(0).cast("bigint").alias("n"), F.lit(-1).cast("bigint").alias("pos"), *nothing, "path", "subroot", "root")
        nodes = stages[k].select("g", "blk", "n", "pos", *lower, *empty)
        dealt = nodes.unionByName(heads).repartition("g", "blk").sortWithinPartitions("g", "blk", "pos")
        found = dealt.mapInArrow(stage(k * levels), _PROOF)
        found = written(found) if k else found
    return found


def proofs(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """doc_id, claim, hash (the leaf), path, subroot (of its group) and root (of all groups) of each leaf.

    leaves: g, doc_id, hash and claim; groups ascend by g, and their roots are the leaves of one more tree."""
    stages = appended(numbered(written(leaves), "doc_id", "hash", "claim"), levels)
    groups = tops(stages).select(F.lit("").alias("g"), F.col("g").alias("group"), F.col("n").alias("size"), "hash")
    top = numbered(written(groups), "group")
    number = written(top.rows.select("group", "size", "idx"))
    trees = appended(Numbered(top.rows.select("g", "idx", "n", "hash", F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("binary").alias("claim")), top.most), levels)
    whole = tops(trees).select("g", "n", F.lit(b"").alias("path"), F.lit(None).cast("binary").alias("subroot"), F.col("hash").alias("root"))
    above = written(paths(trees, whole, levels).select("idx", "path", F.col("hash").alias("subroot"), "root").join(number, "idx").select(F.col("group").alias("g"), F.col("size").alias("n"), "path", "subroot", "root"))
    return paths(stages, above, levels).select("doc_id", "claim", "hash", "path", "subroot", "root")


def verified(found: DataFrame) -> DataFrame:
    """proofs() with proof_sha256, the hash of all siblings, and folded_root, what claim and siblings lead to; path is dropped."""
    names, kinds = _fields("doc_id bigint, leaf binary, subroot binary, root binary, proof binary, folded binary")

    def run(batches):
        for b in batches:
            columns = [b.column(c) for c in ("doc_id", "hash", "subroot", "root")]
            proof, root = [], []
            for claim, path in zip(b.column("claim").to_pylist(), b.column("path").to_pylist(), strict=True):
                proof.append(joined_hash([d for _, others in steps(path) for d in others]))
                root.append(folded(claim, path))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(proof, pa.binary()), pa.array(root, pa.binary())], names)

    out = found.mapInArrow(run, ", ".join(f"{n} {'bigint' if n == 'doc_id' else 'binary'}" for n in names))
    text = lambda c: F.lower(F.hex(c))
    return out.select("doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"), text("proof").alias("proof_sha256"), text("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def group_key(column: Column) -> Column:
    """A value's text so that null is a value of its own, before all others."""
    return F.coalesce(F.concat(F.lit("v"), column.cast("string")), F.lit("n"))


def digest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, by: str = "lang") -> DataFrame:
    """Proofs of all documents, and what they say of texts in which A-Z was made lower case where 3 divides the crc32 of the id.

    A null id has no decimal text, so its row isn't tampered with."""
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    leaf = leaf_digest(*[F.col(c) for c in columns])
    claim = leaf_digest(*[changed if c == "text" else F.col(c) for c in columns])
    return verified(proofs(docs.select(group_key(F.col(by)).alias("g"), F.col("doc_id").cast("bigint").alias("doc_id"), leaf.alias("hash"), claim.alias("claim"))))


def _sql(levels: int = 8, above: int = 4) -> str:
    """Levels of a group's tree and of the tree over groups: enough for 8^8 rows of a group and 8^4 groups."""
    field = lambda c: f"coalesce(strlen({c})::VARCHAR || ':' || {c}, '-')"
    hashed = lambda text: "sha256(" + " || ".join([field("doc_id::VARCHAR"), field("source"), field("lang"), field("n_chars::VARCHAR"), field(text)]) + ")"
    crc = "xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda c, b: list_reduce(range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), 4294967295), 4294967295)"

    def tree(t: str, most: int) -> list[str]:
        """From t0 (r, g, i, n, h, f: the claim, p: the proof so far) to the last level: every row's f and p."""
        out = []
        for k in range(most):
            here, many = f"{t}{k}", f"(a.n + {FAN**k - 1}) // {FAN**k} > 1"
            out.append(f"{t}n{k} AS (SELECT g, i, n, any_value(h) AS h FROM {here} GROUP BY ALL)")
            out.append(
                f"{t}{k + 1} AS (SELECT a.r, a.g, a.n, CASE WHEN {many} THEN a.i // {FAN} ELSE a.i END AS i, CASE WHEN {many} THEN sha256(string_agg(b.h, '' ORDER BY b.i)) ELSE a.h END AS h, "
                f"CASE WHEN {many} THEN sha256(string_agg(CASE WHEN b.i = a.i THEN a.f ELSE b.h END, '' ORDER BY b.i)) ELSE a.f END AS f, "
                f"a.p || coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER ({many} AND b.i <> a.i), '') AS p FROM {here} a JOIN {t}n{k} b ON a.g = b.g AND a.i // {FAN} = b.i // {FAN} GROUP BY a.r, a.g, a.n, a.i, a.h, a.f, a.p)"
            )
        return out

    parts = [
        f"c AS (SELECT *, CASE WHEN {crc} % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS now FROM documents)",
        f"d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('v' || lang, 'n') AS g, {hashed('text')} AS h, {hashed('now')} AS f FROM c)",
        "t0 AS (SELECT r, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY g) AS n, h, f, '' AS p FROM d)",
        *tree("t", levels),
        f"s AS (SELECT DISTINCT g, h FROM t{levels})",
        f"u0 AS (SELECT t.r, 'all' AS g, s.i, count(DISTINCT t.g) OVER () AS n, t.h, t.f, t.p FROM t{levels} t JOIN (SELECT g, row_number() OVER (ORDER BY g) - 1 AS i FROM s) s ON t.g = s.g)",
        *tree("u", above),
    ]
    return f"WITH {', '.join(parts)} SELECT d.doc_id, d.h AS leaf, t{levels}.h AS subroot, u.h AS root, sha256(u.p) AS proof_sha256, u.f AS folded_root, u.f = u.h AS verified FROM u{above} u JOIN d ON u.r = d.r JOIN t{levels} ON t{levels}.r = d.r"


OP11_SQL = _sql()
