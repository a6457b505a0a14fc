"""A hidden Markov language model over words.

A word's probability in a state is that of its class in the state times its share of the class. The COMMON most
frequent words are classes of their own, other words fall into classes by their last three bytes, and the
end of a text is a class too. Shares come from counts over all training texts (c + 0.1), so known words and
one unknown event, whose probability is the same in all states and equals that of the base model, sum to one.

Training is Baum-Welch: each task adds up the expected counts of its own texts, Spark sums them by
(state, class), and only that table, of fixed size, reaches the driver. Each of the ROUNDS counts over all
training texts, however many they are, and over whole texts: a very long one is cut into stretches, whose
transfer matrices carry the messages across. Scores too come from the scaled forward recursion over each whole text.

The vocabulary grows with the data, so it's never sent whole to a task: the MOST_SENT most frequent words are
(16 bytes each), and all others meet their counts in a join.

Defined results: a null or empty text is its end token alone; without training texts every token is unknown
with probability 1, so scores are 0; null ids count as the empty id; repeated rows are learned from and scored each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halyard.llm.shared import _BYTE, blocks, crc_part, mix, most_frequent, word_hashes, words, written

COMMON = 4096
ENDINGS = 2048
END = COMMON + ENDINGS
UNKNOWN = END + 1
MOST_SENT = 1 << 18
STATES = 8
#: Tokens of a stretch; longer texts are cut into several, across which the messages are exact.
STRETCH = 1 << 14
#: Tokens that are worked on at once: the more, the more of them share a step in time. 64 bytes each.
BLOCK = 1 << 20
#: What a ratio between states, or a step, is at least. With both messages scaled at each token no product leaves single precision then.
LEAST = 1e-18
ROUNDS = 10
PSEUDO = 20.0
ADD = 0.1


def _endings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Class of each word by its last three bytes, from COMMON on."""
    key = np.zeros(len(start), np.uint64)
    for k in range(1, 4):
        has = end - k >= start
        part = np.zeros(len(start), np.uint64)
        part[has] = _BYTE[data[end[has] - k]] * np.uint64(2 * k + 1)
        key += part
    return (mix(key) % np.uint64(ENDINGS)).astype(np.int64) + COMMON


def word_counts(texts: DataFrame) -> DataFrame:
    """h, ending and n of the distinct words of a column `text`; each task counts before anything is shuffled."""

    def run(batches):
        held: list[tuple] = []

        def merged():
            h, e, n = (np.concatenate(x) for x in zip(*held, strict=True))
            u, first, back = np.unique(h, return_index=True, return_inverse=True)
            return u, e[first], np.bincount(back, n).astype(np.int64)

        def batch(h, e, n):
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(e.astype(np.int32)), pa.array(n)], ["h", "ending", "n"])

        for _, data, offsets in blocks(batches, "text"):
            start, end, _ = words(data, offsets)
            if not len(start):
                continue
            h, first, n = np.unique(word_hashes(data, start, end), return_index=True, return_counts=True)
            held.append((h, _endings(data, start[first], end[first]), n))
            if sum(len(x[0]) for x in held) > 3_000_000:
                held = [merged()]
                if len(held[0][0]) > 1_500_000:
                    yield batch(*held.pop())
        if held:
            yield batch(*merged())

    return texts.mapInArrow(run, "h bigint, ending int, n bigint").groupBy("h", "ending").agg(F.sum("n").alias("c"))


def _coded(docs: DataFrame, hashes: np.ndarray, counts: np.ndarray, classes: np.ndarray, ends: int) -> DataFrame:
    """A row a text: its class sequence (uint16, with the end), what its frequent words add, and its other words' hashes."""

    def run(batches):
        for part, data, offsets in blocks(batches, "text"):
            n = part.num_rows
            start, end, doc = words(data, offsets)
            h = word_hashes(data, start, end)
            at = np.minimum(np.searchsorted(hashes, h), max(len(hashes) - 1, 0))
            sent = hashes[at] == h if len(hashes) else np.zeros(len(h), bool)
            own = np.where(sent, classes[at] if len(hashes) else -1, -1)
            coded = np.where(own >= 0, own, _endings(data, start, end)) if len(h) else own
            size = np.bincount(doc, minlength=n)
            logs = np.bincount(doc[sent], np.log10(counts[at[sent]] + ADD), n) if len(hashes) else np.zeros(n)
            known = np.bincount(doc[sent], minlength=n)
            if ends:
                logs = logs + np.log10(ends + ADD)
                known = known + 1
            last = np.cumsum(size)
            seq = np.insert(coded, last, END if ends else UNKNOWN).astype(np.uint16)
            bounds = np.append(0, np.cumsum(size + 1)) * 2
            rare = np.flatnonzero(~sent)
            rare_of = np.append(0, np.cumsum(np.bincount(doc[rare], minlength=n)))
            raw = seq.tobytes()
            place = (rare - (last - size)[doc[rare]]).astype(np.int32)
            lists = pa.array(rare_of.astype(np.int32))
            columns = [
                part.column("doc_id"),
                part.column("held_out"),
                pa.array(size + 1),
                pa.array(known),
                pa.array(logs),
                pa.array([raw[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
                pa.ListArray.from_arrays(lists, pa.array(h[rare].view(np.int64))),
                pa.ListArray.from_arrays(lists, pa.array(place)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "known", "logs", "seq", "rare", "rare_at"])

    return docs.mapInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, known bigint, logs double, seq binary, rare array<bigint>, rare_at array<int>")


def _transfers(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, step: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """For each stretch of tokens the product of its steps and emissions, up to a factor: what carries messages across it."""
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    s = len(step)
    out = np.tile(np.eye(s), (len(begin), 1, 1))
    for t in range(int(size[0])):
        m = int(np.searchsorted(-size, -t, "left"))
        out[:m] = (out[:m].reshape(-1, s) @ step).reshape(m, s, s) * emit[flat[begin[:m] + t]][:, None, :]
        out[:m] /= out[:m].sum((1, 2), keepdims=True)
    back = np.empty_like(out)
    back[order] = out
    return back


def _stretches(flat: np.ndarray, n: np.ndarray, start: np.ndarray, step: np.ndarray, emit: np.ndarray, most: int):
    """Begin, size, whether it is a text's first, and the messages into both ends of each stretch of at most `most` tokens.

    A text that is one stretch gets none; across the stretches of a longer text the messages are exact."""
    parts = -(-n // most)
    k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    text = np.repeat(np.arange(len(n)), parts)
    begin = (np.cumsum(n) - n)[text] + k * most
    size = np.minimum(most, n[text] - k * most)
    before, after = np.zeros((len(k), len(step))), np.ones((len(k), len(step)))
    cut = np.flatnonzero(parts[text] > 1)
    if len(cut):
        head = k[cut] == 0
        across = dict(zip(cut.tolist(), _transfers(flat, begin[cut] + head, size[cut] - head, step, emit), strict=True))
        for i in cut[1:].tolist():  # ascending: a text's stretches follow each other
            if k[i]:
                known = before[i - 1] if k[i] > 1 else start * emit[flat[begin[i - 1]]]
                before[i] = known @ across[i - 1]
                before[i] /= before[i].sum()
        for i in cut[-2::-1].tolist():
            if k[i + 1]:
                after[i] = across[i + 1] @ after[i + 1]
                after[i] /= after[i].sum()
    return begin, size, k == 0, before, after


class _Space:
    """Work space that is kept from block to block: fresh memory costs more than the arithmetic."""

    def __init__(self, n: int, states: int):
        # rows an odd number of cache lines apart, else the states of a token share few places of the cache
        self.arrays = [np.empty((states, (n // 16 | 1) * 16 + 32), np.float32) for _ in range(2)]


def _side_by_side(flat, begin, size, first, before, after, start, step, emit, space: _Space, total) -> None:
    """Adds the expected counts of stretches, the longest first, to total (first states, steps, emissions).

    Tokens lie by time, then stretch, in a row for each state. Both messages are scaled to a sum of one at each time, and
    posteriors by what the two have in common there, so nothing depends on how long a text is or how far apart the states are."""
    s, longest = len(step), int(size[0])
    alive = np.searchsorted(-size, -np.arange(longest), "left")
    off = np.cumsum(alive) - alive
    n = int(size.sum())
    at = np.arange(n) - np.repeat(off, alive)
    seen = flat[begin[at] + np.repeat(np.arange(longest), alive)].astype(np.int64)
    e, alpha = (x[:, :n] for x in space.arrays)
    for j in range(s):
        np.take(emit[j], seen, out=e[j], mode="clip")
    into, ones, norms = step.T.copy(), np.ones(s, np.float32), np.empty(n, np.float32)
    alive, off = alive.tolist(), off.tolist()
    lead = np.where(first[:, None], start, before @ step).T.astype(np.float32)
    before, after = before.astype(np.float32), after.T.astype(np.float32)
    np.multiply(lead, e[:, : alive[0]], out=alpha[:, : alive[0]])
    for t in range(longest):
        o, m = off[t], alive[t]
        now, norm = alpha[:, o : o + m], norms[o : o + m]
        if t:
            np.matmul(into, alpha[:, off[t - 1] : off[t - 1] + m], out=now)
            now *= e[:, o : o + m]
        np.matmul(ones, now, out=norm)
        now /= norm
    e /= norms  # what the steps into a time are divided by
    steps, ahead, following = np.zeros((s, s)), None, 0
    for t in range(longest - 1, -1, -1):
        o, m = off[t], alive[t]
        b = after[:, following:m]  # these stretches end here
        if following:
            b = np.concatenate([step @ ahead, b], 1) if following < m else step @ ahead
        now, ahead = alpha[:, o : o + m], e[:, o : o + m]
        ahead *= b
        # alpha * b is the posterior up to its sum, and takes alpha's place; with the sum, the steps into this time get theirs
        now *= b
        shared = ones @ now
        now /= shared
        ahead /= shared
        if t:
            steps += alpha[:, off[t - 1] : off[t - 1] + m] @ ahead.T
            ahead /= ones @ ahead
        following = m
    steps += before.T @ ahead.T
    total[0] += alpha[:, : alive[0]][:, first].sum(1, dtype=np.float64)
    total[1] += step * steps
    for j in range(s):
        total[2][:, j] += np.bincount(seen, alpha[j], emit.shape[1])


def _expected(flat: np.ndarray, n: np.ndarray, start: np.ndarray, step: np.ndarray, emit: np.ndarray, total: list[np.ndarray], stretch: int = STRETCH) -> None:
    """Adds the expected counts of first states, steps and emissions over whole sequences (flat, of lengths n) to total.

    emit has a row for each class; only the ratios within a row matter here, down to LEAST of the largest."""
    if not len(n):
        return
    top = emit.max(1, keepdims=True)
    emit = np.maximum(emit / np.where(top > 0, top, 1.0), LEAST)
    step = np.maximum(step, LEAST)
    begin, size, first, before, after = _stretches(flat, n, start, step, emit, stretch)
    order = np.argsort(-size, kind="stable")
    ends = np.cumsum(size[order])
    space = _Space(max(BLOCK, int(size.max())), len(step))
    emit, step = np.ascontiguousarray(emit.T, np.float32), step.astype(np.float32)
    a = 0
    while a < len(order):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BLOCK, "right")))
        own = order[a:b]
        _side_by_side(flat, begin[own], size[own], first[own], before[own], after[own], start, step, emit, space, total)
        a = b


def log_forward(seqs: list[np.ndarray], start: np.ndarray, step: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """log10 likelihood of each whole sequence by the scaled forward recursion, side by side."""
    n = np.array([len(x) for x in seqs])
    order = np.argsort(-n, kind="stable")
    flat = np.concatenate(seqs).astype(np.int64)
    begin = (np.cumsum(n) - n)[order]
    size = n[order]
    alive = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), "right")
    total = np.zeros(len(seqs))
    alpha = np.tile(start, (len(seqs), 1))
    for t in range(int(size[0])):
        m = alive[t]
        alpha = (alpha if t == 0 else alpha[:m] @ step) * emit[flat[begin[:m] + t]]
        scale = alpha.sum(1)
        alpha = alpha / scale[:, None]
        total[:m] += np.log10(scale)
    out = np.empty(len(seqs))
    out[order] = total
    return out


def _sequences(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The class sequences of a column, one after another, and their lengths; no copies."""
    column = pa.concat_arrays([column.cast(pa.large_binary())])
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[: len(column) + 1]
    return np.frombuffer(data, np.uint16)[offsets[0] // 2 : offsets[-1] // 2] if len(column) else np.zeros(0, np.uint16), np.diff(offsets) // 2


def _round(coded: DataFrame, start, step, emit) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    s, c = len(start), len(emit)

    def run(batches):
        total = [np.zeros(s), np.zeros((s, s)), np.zeros((c, s))]
        for batch in batches:
            _expected(*_sequences(batch.column("seq")), start, step, emit, total)
        # rows of one table: classes, then the previous states, then the start
        every = np.concatenate([total[2], total[1], total[0][None, :]])
        row, state = np.nonzero(every)
        yield pa.RecordBatch.from_arrays([pa.array(row.astype(np.int32)), pa.array(state.astype(np.int32)), pa.array(every[row, state])], ["row", "state", "n"])

    out = np.zeros((c + s + 1, s))
    for r in coded.select("seq").mapInArrow(run, "row int, state int, n double").groupBy("row", "state").agg(F.sum("n").alias("n")).collect():
        out[r.row, r.state] = r.n
    if not np.isfinite(out).all():
        raise ArithmeticError("expected counts aren't finite")
    return out[-1], out[c:-1], out[:c]


def _model(start, step, emit, share: np.ndarray):
    s = len(start)
    start = (start + 1) / (start + 1).sum()
    step = step + np.eye(s) * PSEUDO + 1
    emit = emit + PSEUDO * share[:, None]
    return start, step / step.sum(1, keepdims=True), emit / emit.sum(0)


def scored(docs: DataFrame, states: int = STATES, held_out=None, doc_id: str = "doc_id", text: str = "text", most_sent: int = MOST_SENT, seed: int = 11) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each whole text.

    held_out: a condition on doc_id that keeps rows out of training; crc32 modulo 10 is 0 by default."""
    away = crc_part("doc_id", 10) == 0 if held_out is None else held_out
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("held_out", away)
    train = texts.where("not held_out")
    vocabulary = written(word_counts(train.select("text")))
    ends = train.count()
    # all of these have a fixed size
    n_words, n_distinct = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = most_frequent(vocabulary, "c", most_sent).select("h", "c", "ending").toPandas().sort_values(["c", "h"], ascending=[False, True])
    hashes, counts = top.h.to_numpy(np.int64).view(np.uint64), top.c.to_numpy(np.int64)
    classes = np.where(np.arange(len(top)) < COMMON, np.arange(len(top)), -1)
    mass = np.zeros(END + 1)
    n_common = min(COMMON, len(top))
    mass[:n_common] = counts[:n_common] + ADD
    for r in vocabulary.groupBy("ending").agg(F.sum(F.col("c") + ADD).alias("m")).collect():
        mass[r.ending] = r.m
    np.subtract.at(mass, top.ending.to_numpy(np.int64)[:n_common], mass[:n_common])
    mass[END] = ends + ADD if ends else 0.0
    mass = np.where(mass > 1e-6, mass, 0.0)
    order = np.argsort(hashes)
    n = int(n_words) + ends
    v = int(n_distinct) + (ends > 0)
    log_all = np.log10(n + ADD * (v + 1))
    unknown = ADD / (n + ADD * (v + 1))

    coded = _coded(texts, hashes[order], counts[order], classes[order], ends)
    coded = written(coded.withColumn("key", F.monotonically_increasing_id()))

    share = mass / max(mass.sum(), 1.0)
    rng = np.random.default_rng(seed)
    emit = np.exp(rng.normal(0, 0.5, (END + 1, states))) * (share[:, None] + 1e-12)
    model = _model(np.ones(states), np.eye(states) * 1e3, emit / emit.sum(0) * 1e6, share)
    if ends:
        for _ in range(ROUNDS):
            model = _model(*_round(coded.where(~F.col("held_out")), *model), share)
    start, step, emit = model
    # share of a class within itself; the last row is the unknown event, alike in all states
    emit = np.vstack([emit * (1 - unknown) / np.where(mass > 0, mass, 1.0)[:, None], np.full((1, states), unknown)])

    rare = coded.select("key", F.explode("rare").alias("h")).join(vocabulary.select("h", "c"), "h", "left")
    per = rare.groupBy("key").agg(F.sum(F.log10(F.col("c") + ADD)).alias("rare_logs"), F.count("c").alias("rare_known"), F.collect_set(F.when(F.col("c").isNull(), F.col("h"))).alias("none"))
    both = coded.join(per, "key", "left")

    def run(batches):
        for batch in batches:
            seqs = []
            for raw, none, h, at in zip(*(batch.column(c).to_pylist() for c in ("seq", "none", "rare", "rare_at")), strict=True):
                seq = np.frombuffer(raw, np.uint16)
                if none:
                    seq = seq.copy()
                    seq[np.array(at)[np.isin(np.array(h, np.int64), np.array(none, np.int64))]] = UNKNOWN
                seqs.append(seq)
            if not seqs:
                continue
            forward = log_forward(seqs, start, step, emit)
            n_tokens, known = batch.column("n_tokens").to_numpy(), batch.column("n_known").to_numpy()
            logs = batch.column("all_logs").to_numpy()
            base = logs + (n_tokens - known) * np.log10(ADD) - n_tokens * log_all
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(n_tokens), pa.array(known), pa.array(np.full(len(seqs), n)), pa.array(base), pa.array(forward + logs)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    ready = both.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))).alias("all_logs"),
        "seq",
        "none",
        F.when(F.size("none") > 0, F.col("rare")).alias("rare"),
        F.when(F.size("none") > 0, F.col("rare_at")).alias("rare_at"),
    )
    return ready.mapInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
