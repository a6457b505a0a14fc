"""Fill-in-middle transformation: a text's prefix, middle and suffix in another order, behind sentinels.

A text is cut into units: code points, words (a run of other characters with the white space after it) or lines. A
Fenwick tree over blocks of BLOCK bytes stores how many units and code points start in each; the two cuts are found by
a binary-lifting descent to the block of a unit and by a look at that block's bytes alone. So a cut costs
log(blocks) steps, whatever the text's length, and work space is the text itself and 16 bytes a block.

Draws come from a hash of seed and id: reruns and retried tasks agree, and no state passes between rows.

Defined results: a null text is empty and a null id is the empty id; an empty text, and one that holds a sentinel,
stays as it is (form "plain"); repeated rows each give their own row, equal ones if their ids are; columns of docs
named as the added ones are replaced; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halyard.llm.shared import blocks

BLOCK = 1024
SENTINELS = ("<P>", "<S>", "<M>")
#: Of 100 texts: those from PLAIN on stay plain; of the others those below SPM have the suffix first.
PLAIN = 90
SPM = 20
ADDED = ("fim_text", "fim_form", "fim_units", "fim_prefix_chars", "fim_middle_chars")
_AT_ONCE = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _characters(data: np.ndarray, before: int | None) -> np.ndarray:
    return (data & 0xC0) != 0x80


def _words(data: np.ndarray, before: int | None) -> np.ndarray:
    space = _SPACE[data]
    after = np.append(before is not None and _SPACE[before], space[:-1])
    out = ~space & after
    if before is None:
        out[:1] = True
    return out


def _lines(data: np.ndarray, before: int | None) -> np.ndarray:
    return np.append(before is None or before == 10, data[:-1] == 10)


#: Where units start among some bytes, given the byte before them (None at the start of a text).
UNITS = {"code_point": _characters, "word": _words, "line": _lines}


class Cuts:
    """A Fenwick tree over a text's blocks: units and code points that start in each."""

    def __init__(self, data: np.ndarray, unit: str = "code_point", block: int = BLOCK):
        self.data, self.starts, self.block = data, UNITS[unit], block
        self.blocks = -(-len(data) // block)
        counts = np.zeros((self.blocks + 1, 2), np.int64)
        step = max(block, _AT_ONCE // block * block)
        for at in range(0, len(data), step):
            part = data[at : at + step]
            edges = np.arange(0, len(part), block)
            first = at // block + 1
            counts[first : first + len(edges), 0] = np.add.reduceat(self.starts(part, self._before(at)), edges, dtype=np.int64)
            counts[first : first + len(edges), 1] = np.add.reduceat(_characters(part, None), edges, dtype=np.int64)
        self.units, self.chars = (int(x) for x in counts.sum(0))
        # each node gets its children's sums: those of a level at once, from the leaves up
        span = 1
        while span * 2 <= self.blocks:
            at = np.arange(span * 2, self.blocks + 1, span * 2)
            counts[at] += counts[at - span]
            span *= 2
        self.tree, self.span = counts.tolist(), span

    def _before(self, at: int) -> int | None:
        return int(self.data[at - 1]) if at else None

    def find(self, k: int) -> tuple[int, int]:
        """Byte offset and code points before the start of unit k; the text's end for k = units."""
        if k >= self.units:
            return len(self.data), self.chars
        if k == 0:
            return 0, 0
        node, rest, chars, step = 0, k, 0, self.span
        while step:
            if node + step <= self.blocks and self.tree[node + step][0] <= rest:
                node += step
                rest -= self.tree[node][0]
                chars += self.tree[node][1]
            step >>= 1
        at = node * self.block
        part = self.data[at : at + self.block]
        here = int(np.flatnonzero(self.starts(part, self._before(at)))[rest])
        return at + here, chars + int(np.count_nonzero(_characters(part[:here], None)))


def draws(seed: str, doc_id: Column) -> Column:
    """Four whole numbers of 32 bits from the hex SHA-256 of "seed:id"."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)])


def _unambiguous(sentinels: tuple[str, ...]) -> None:
    """An error unless an output can be taken apart again: no sentinel's end may be another's (or its own) beginning."""
    ends = [(a, b, k) for a in sentinels for b in sentinels for k in range(1, len(b) + (a is not b))]
    if not all(sentinels) or any(a.endswith(b[:k]) or (a is not b and b in a) for a, b, k in ends):
        raise ValueError(f"sentinels overlap: {', '.join(map(repr, sentinels))}")


def transformed(docs: DataFrame, unit: str = "code_point", seed: str = "1", plain: int = PLAIN, spm: int = SPM, sentinels: tuple[str, str, str] = SENTINELS, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """docs with fim_text, fim_form ("psm", "spm" or "plain"), fim_units, fim_prefix_chars and fim_middle_chars (null if plain)."""
    if unit not in UNITS:
        raise ValueError(f"no unit {unit!r}; there are: {', '.join(UNITS)}")
    _unambiguous(sentinels)
    names = [c for c in docs.columns if c not in ADDED]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), draws(seed, F.col(f"`{doc_id}`")).alias("draws"))
    at = names.index(text)
    added = T.StructType([T.StructField(n, k) for n, k in zip(ADDED, (T.StringType(), T.StringType(), T.LongType(), T.LongType(), T.LongType()), strict=True)])
    p, s, m = (x.encode() for x in sentinels)

    def run(batches):
        whole = (pa.RecordBatch.from_arrays([b.column("row"), b.column("draws"), b.column("row").field(at)], ["row", "draws", "text"]) for b in batches if b.num_rows)
        for part, data, offsets in blocks(whole, "text"):
            four = part.column("draws").flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
            out, form, size, before, middle = [], [], [], [], []
            for k in range(part.num_rows):
                one = data[offsets[k] : offsets[k + 1]]
                raw, h = one.tobytes(), four[k].tolist()
                cuts = Cuts(one, unit, block)
                size.append(cuts.units)
                if not raw or h[2] % 100 >= plain or p in raw or s in raw or m in raw:
                    out.append(raw)
                    form.append("plain")
                    before.append(None)
                    middle.append(None)
                    continue
                low, high = sorted((h[0] % (cuts.units + 1), h[1] % (cuts.units + 1)))
                (a, a_chars), (b, b_chars) = cuts.find(low), cuts.find(high)
                first = h[3] % 100 < spm
                form.append("spm" if first else "psm")
                out.append(b"".join([s, raw[b:], p, raw[:a], m, raw[a:b]] if first else [p, raw[:a], s, raw[b:], m, raw[a:b]]))
                before.append(a_chars)
                middle.append(b_chars - a_chars)
            columns = [pa.array(out, pa.binary()).view(pa.string()), pa.array(form), *[pa.array(x, pa.int64()) for x in (size, before, middle)]]
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.StructArray.from_arrays(columns, list(ADDED))], ["row", "fim"])

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("fim", added)])).select("row.*", "fim.*")


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The exact text from an output and its form.

    No text with a sentinel is transformed, and none can arise where pieces meet, so an output holds each once."""
    piece = F.split(output, "|".join(f"\\Q{s}\\E" for s in sentinels), -1)
    return F.when(form == "psm", F.concat(piece[1], piece[3], piece[2])).when(form == "spm", F.concat(piece[2], piece[3], piece[1])).otherwise(output)


def digest(docs: DataFrame) -> DataFrame:
    """What became of each document, and hashes of its output and of the text rebuilt from it."""
    done = transformed(docs.select("doc_id", "text"))
    return done.select(
        "doc_id",
        F.col("fim_units").alias("n"),
        F.col("fim_form").alias("form"),
        F.col("fim_prefix_chars").alias("prefix_chars"),
        F.col("fim_middle_chars").alias("middle_chars"),
        F.sha2(F.col("fim_text").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("fim_text"), F.col("fim_form")).cast("binary"), 256).alias("restored_sha256"),
    )


OP12_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
c AS (SELECT doc_id, t, length(t) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (length(t) + 1) AS x, ('0x' || substr(h, 9, 8))::BIGINT % (length(t) + 1) AS y,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
                  WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, least(x, y) AS a, greatest(x, y) AS b FROM c),
s AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM p)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s
"""
