"""Secret scans with a trigram inverted index, in DataFrame operations only.

1. Each rule's regular expression gives a Boolean query: an OR of clauses, each an AND of trigrams that every
   match of the clause has (letters as lower case).
2. The index holds, for the trigrams that some query names, the documents that contain them.
3. Postings are intersected clause by clause; a document that meets one clause of a rule is its candidate.
4. Candidates are verified by the regular expression over the whole text. A rule without mandatory trigrams
   is run over every text.

The lists of postings are bounded by documents times the rules' trigrams, and are reduced to one bit mask for
(document, clause) before they are shuffled, so a trigram that all documents hold burdens no task. Texts stay where
they are, but for those that hold the two rarest trigrams of a clause: only they are shuffled to meet their
candidate rules, by a hash of doc_id and text (equal hashes only add rules to verify).

Defined results: a null text counts as empty; an empty one has no span; rows that repeat, or whose doc_id does
or is null, are verified each for itself; offsets count code points, ends are exclusive.
A private key's span goes from BEGIN through the next END line, whatever lies between, unless another BEGIN comes first. Without
END it goes through the lines that follow as long as they are key material: header lines first, then lines of base64 alone, with
marks of comments and quotes around; after a blank line only such as no word can be;
lines of less than 16 characters count without a blank line before them, one of less than 8 is the last; of a line that goes on with something else, what is before that. These are array expressions over lines, not a
pattern, so a key may have any number of lines, headers and dashes. A login's password has any length and all characters but white space, controls and / ? # " < >,
which end a URL's authority or the URL; a scheme of more than 64 characters is cut from there on.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halyard.llm.shared import packed

try:
    from re import _parser as sre
except ImportError:  # before Python 3.11
    import sre_parse as sre


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int  # whose length counts
    least: int
    goes_on: bool = False  # to the end of the key that a match begins


_LABEL = r"[A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
_END = rf"-----END {_LABEL}"
_BASE64, _MARK = "A-Za-z0-9+/=", r"""\x20\t\r\\>#|*"',-"""
#: Kinds of a line: one or more pieces of 16 characters at least (but for the last), a short piece alone, a very short one, a blank, a header.
_PIECES = rf"^[{_BASE64}{_MARK}]*$"
_LONG = rf"[{_BASE64}]{{16}}"
_BROKEN = rf"(^|[{_MARK}])[{_BASE64}]{{1,15}}[{_MARK}]+[{_BASE64}]"
_SHORT = rf"^[{_MARK}]*[{_BASE64}]{{8,15}}[{_MARK}]*$"
_LAST = rf"^[{_MARK}]*[{_BASE64}]{{1,7}}[{_MARK}]*$"
_BLANK = rf"^[{_MARK}]*$"
_HEADER = rf"^[{_MARK}]*[A-Za-z][A-Za-z0-9-]*:"
#: What a long word alone on a line doesn't have.
_MIXED = "[0-9+/=]"
#: Where a line stops being key material: a piece that is too short, or another character.
_STOP = rf"[^{_BASE64}{_MARK}]|(^|[{_MARK}])[{_BASE64}]{{1,15}}([^{_BASE64}]|$)"
#: The short end of a key inside of quotes.
_REST = rf"""^[{_MARK}]*[{_BASE64}]{{1,15}}[\\"']"""

#: Fixed by the contract: the first three, in this order.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
ADDED = (
    Rule("private_key", rf"-----BEGIN {_LABEL}", 0, 1, True),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}", 0, 40),
    Rule("slack", r"xox[abeprs]-[A-Za-z0-9-]{10,}", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 30),
    Rule("url_login", r"""[a-z][a-z0-9+.-]{1,63}://[A-Za-z0-9._%-]+:[^\x00-\x20/?#"<>]{3,}@[A-Za-z0-9.-]{3,}""", 0, 12),
)
RULES = BASE + ADDED
_WIDEST = 64
#: Letters, the most usual first; other characters are rarer.
_USUAL = "etaoinsrhldcumfpgwybvkxjqz"


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The clauses of a pattern: each match holds all trigrams of one clause, letters as lower case. Empty: no mandatory ones."""

    def flush(state):
        run, grams = state
        return "", grams | {run[i : i + 3] for i in range(len(run) - 2)}

    def chars(items) -> list[str] | None:
        out = set()
        for op, x in items:
            if op is sre.LITERAL:
                out.add(chr(x).lower())
            elif op is sre.RANGE and x[1] - x[0] < 8:
                out |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return sorted(out) if len(out) <= 8 else None

    def walk(items, states: set) -> set:
        for op, x in items:
            if op is sre.LITERAL:
                states = {(run + chr(x).lower(), grams) for run, grams in states}
            elif op is sre.IN and (few := chars(x)):
                states = {(run + c, grams) for run, grams in states for c in few}
            elif op is sre.BRANCH:
                states = set().union(*(walk(one, states) for one in x[1]))
            elif op is sre.SUBPATTERN:
                states = walk(x[3], states)
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
                least, most, inner = x
                if least == 0 and most == 1:
                    states = states | walk(inner, states)
                else:
                    for _ in range(min(least, 4)):
                        states = walk(inner, states)
                    if least != most or least > 4:
                        states = {flush(s) for s in states}
            elif op is not sre.AT:
                states = {flush(s) for s in states}
            if len(states) > _WIDEST:
                states = {flush(s) for s in states}
            if len(states) > _WIDEST:  # too many forms: keep what all have in common
                states = {("", frozenset.intersection(*(g for _, g in states)))}
        return states

    ascii_only = {frozenset(g for g in flush(s)[1] if g.isascii()) for s in walk(sre.parse(pattern), {("", frozenset())})}
    least = [c for c in ascii_only if not any(o < c for o in ascii_only)]
    return sorted(least, key=sorted) if all(least) else []


def trigram_index(docs: DataFrame, grams: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings (gram, doc_id) of the given trigrams over every whole text, letters as lower case."""
    every = F.array(*[F.lit(g) for g in grams])
    # the text is made lower case once: the inner function sees it as a bound variable
    found = F.get(F.transform(F.array(F.lower(F.coalesce(F.col(text), F.lit("")))), lambda low: F.filter(every, lambda g: F.contains(low, g))), F.lit(0))
    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(found).alias("gram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, kinds): the rules of which a document's postings meet a clause."""
    rows = []
    for rule in rules:
        for n, clause in enumerate(trigram_query(rule.pattern)):
            for bit, gram in enumerate(sorted(clause)):
                rows.append((rule.kind, n, gram, 1 << bit, (1 << len(clause)) - 1))
    names = ("kind", "clause", "gram", "bit", "every")
    each = F.array(*[F.struct(*[F.lit(x).cast("long" if name in ("bit", "every") else "string" if name in ("kind", "gram") else "int").alias(name) for x, name in zip(row, names, strict=True)]) for row in rows])
    clauses = index.sparkSession.range(1).select(F.inline(each))  # a few rows a rule
    met = index.join(F.broadcast(clauses), "gram").groupBy("doc_id", "kind", "clause", "every").agg(F.bit_or("bit").alias("has")).where("has = every")
    return met.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


_SPAN = "array<struct<start:int,place:int,end:int,kind:string>>"


def _key_lines(rest: Column) -> Column:
    """How much of a text is the rest of a key whose BEGIN is before it and which has no END."""
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("keep"), F.lit(False).alias("body"), F.lit(False).alias("gap"), F.lit(False).alias("stop"))

    def step(acc, x):
        def has(pattern):
            return F.rlike(x, F.lit(pattern))

        long = has(_LONG)
        whole = (has(_PIECES) & long & ~has(_BROKEN) & (~acc["gap"] | has(_MIXED))) | (has(_SHORT) & ~acc["gap"])
        last = has(_LAST) & acc["body"] & ~acc["gap"]
        blank = has(_BLANK)
        passed = blank | (has(_HEADER) & ~acc["body"])
        before = F.length(F.get(F.split(x, _STOP, 2), F.lit(0)))
        # the piece of 16 that ends where a short one begins has its mark before the split
        part = F.when(F.rlike(F.substring(x, F.lit(1), before), F.lit(_LONG)) & (~acc["gap"] | has(_MIXED)), before + F.length(F.regexp_extract(F.substr(x, before + 1), _REST, 0))).otherwise(F.lit(0))
        end = acc["at"] + F.length(x)
        keep = F.when(whole | last, end).when(passed | (part == 0), acc["keep"]).otherwise(acc["at"] + part)
        out = F.struct((end + 1).alias("at"), keep.alias("keep"), (acc["body"] | whole).alias("body"), (acc["body"] & ~whole & (acc["gap"] | blank)).alias("gap"), (~whole & ~passed).alias("stop"))
        return F.when(acc["stop"], acc).otherwise(out)

    return F.aggregate(F.split(rest, "\n", -1), zero, step)["keep"]


def _key_rest(rest: Column) -> Column:
    to_end = F.length(F.get(F.split(rest, _END, 2), F.lit(0))) + F.length(F.regexp_extract(rest, _END, 0))
    return F.when(F.rlike(rest, F.lit(_END)), to_end).otherwise(_key_lines(rest))


def _key_spans(text: Column, rule: Rule, place: int) -> Column:
    """Spans of keys: each reaches from a BEGIN into the text before the next one."""
    gaps = F.split(text, rule.pattern, -1)
    after = F.slice(gaps, F.lit(2), F.size(gaps) - 1)
    parts = F.arrays_zip(F.regexp_extract_all(text, F.lit(rule.pattern), 0).alias("hit"), after.alias("rest"))

    def step(acc, x):
        end = acc["at"] + F.length(x["hit"])
        span = F.array(F.struct(acc["at"].alias("start"), F.lit(place).alias("place"), (end + _key_rest(x["rest"])).alias("end"), F.lit(rule.kind).alias("kind")))
        return F.struct((end + F.length(x["rest"])).alias("at"), F.concat(acc["out"], span).alias("out"))

    return F.aggregate(parts, F.struct(F.length(F.get(gaps, F.lit(0))).alias("at"), F.array().cast(_SPAN).alias("out")), step)["out"]


def _spans(text: Column, rule: Rule, place: int) -> Column:
    """Spans of a rule in a text: what a split leaves between the matches gives their offsets."""
    if rule.goes_on:
        return _key_spans(text, rule, place)
    regex = F.lit(rule.pattern)
    length = F.length
    parts = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), F.regexp_extract_all(text, regex, 0).alias("hit"), F.regexp_extract_all(text, regex, rule.group).alias("part"))

    def step(acc, x):
        start = acc["at"] + length(x["gap"])
        end = start + F.coalesce(length(x["hit"]), F.lit(0))
        span = F.array(F.struct(start.alias("start"), F.lit(place).alias("place"), end.alias("end"), F.lit(rule.kind).alias("kind")))
        return F.struct(end.alias("at"), F.when(length(x["part"]) >= rule.least, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out")), step)["out"]


def _rarest(clause: frozenset[str], n: int = 2) -> list[str]:
    """The n trigrams of a clause that prose is least likely to hold, by the usual order of letters."""
    return sorted(clause, key=lambda g: (-sum(_USUAL.find(c) % (len(_USUAL) + 1) for c in g), g))[:n]


def _found(docs: DataFrame, rules: tuple[Rule, ...], doc_id: str, text: str) -> DataFrame:
    """row (all columns of docs as one, so that no name clashes), text and spans."""
    rows = packed(docs, doc_id=doc_id, text=text).withColumn("key", F.xxhash64("doc_id", "text"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = [r for r in rules if queries[r.kind]]
    grams = sorted({g for r in indexed for c in queries[r.kind] for g in c})
    none = F.array().cast("array<string>")
    if indexed:
        some = candidates(trigram_index(rows, grams, "key"), rules).withColumnRenamed("doc_id", "key")

        def holds(low):
            test = F.lit(False)
            for pair in sorted({tuple(_rarest(c)) for r in indexed for c in queries[r.kind]}):
                both = F.lit(True)
                for g in pair:
                    both &= F.contains(low, F.lit(g))
                test |= both
            return test

        maybe = F.get(F.transform(F.array(F.lower(F.coalesce(F.col("text"), F.lit("")))), holds), F.lit(0))
        rows = rows.where(maybe).join(some, "key", "left").select("row", "text", "kinds").union(rows.where(~maybe).select("row", "text", none.alias("kinds")))
    else:
        rows = rows.withColumn("kinds", none)
    whole = F.coalesce(F.col("text"), F.lit(""))
    each = []
    for place, rule in enumerate(rules):
        go = F.array_contains("kinds", rule.kind) if rule in indexed else F.rlike(whole, F.lit(rule.pattern))
        each.append(F.when(go, _spans(whole, rule, place)).otherwise(F.array().cast(_SPAN)))
    return rows.select("row", "text", F.array_sort(F.concat(*each)).alias("spans"))


def found_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with secret_spans, an array of (start, place, end, kind) by start and the rules' order; a column of that name is replaced."""
    return _found(docs.drop("secret_spans"), rules, doc_id, text).select("row.*", F.col("spans").alias("secret_spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, the hash of their spans, and all spans."""
    spans = F.col("secret_spans")
    base = F.filter(spans, lambda s: s["place"] < len(BASE))

    def count(place: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["place"] == place)).cast("long")

    counts = [count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE)]
    return found_spans(docs.select("doc_id", "text")).select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"))


def redacted(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with every span cut out of the text and its kind in its place; other texts stay as they are."""

    def step(acc, s):
        keep = F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], keep).otherwise(acc["out"]).alias("out"))

    cut = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    rest = F.concat(cut["out"], F.substring(F.col("text"), cut["at"] + 1, F.length("text")))
    new = F.when(F.size("spans") > 0, rest).otherwise(F.col("text"))
    return _found(docs, rules, doc_id, text).select(*[new.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _sql() -> str:
    q = lambda x: "'" + x.replace("'", "''") + "'"
    has = lambda pattern: f"regexp_matches(x, {q(pattern)})"
    each, arrays = [], []
    for k, r in enumerate(RULES):
        if r.goes_on:
            arrays.append("coalesce(keys.spans, [])")
            continue
        p = r.pattern.replace("'", "''")
        each.append(f"regexp_extract_all(t, '{p}', 0) AS h{k}, regexp_extract_all(t, '{p}', {r.group}) AS g{k}, string_split_regex(t, '{p}') AS s{k}")
        start = f"(coalesce(list_sum(list_transform(s{k}[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(h{k}[1:i-1], lambda x: length(x))), 0))::BIGINT"
        arrays.append(f"list_transform(list_filter(range(1, len(h{k}) + 1), lambda i: length(g{k}[i]) >= {r.least}), lambda i: {{'start': {start}, 'place': {k}, 'kind': '{r.kind}', 'stop': {start} + length(h{k}[i])}})")
    place, key = next((k, r) for k, r in enumerate(RULES) if r.goes_on)
    line = "array_to_string(list_transform({}, lambda x: x.kind || ':' || x.start::VARCHAR || ':' || x.stop::VARCHAR), ',')"
    base = f"list_filter(a, lambda x: x.place < {len(BASE)})"
    counts = ", ".join(f"len(list_filter(a, lambda x: x.place = {k}))::BIGINT AS n_{r.kind}" for k, r in enumerate(BASE))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS (SELECT r, doc_id, {", ".join(each)} FROM d),
kh AS (SELECT r, regexp_extract_all(t, {q(key.pattern)}, 0) AS h, string_split_regex(t, {q(key.pattern)}) AS s FROM d WHERE contains(t, 'PRIVATE KEY')),
ks AS (SELECT r, i, (coalesce(list_sum(list_transform(s[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(h[1:i-1], lambda x: length(x))), 0))::BIGINT AS start, length(h[i]) AS size, s[i + 1] AS rest FROM (SELECT *, unnest(range(1, len(h) + 1)) AS i FROM kh)),
kl AS (SELECT r, i, n, x, (sum(length(x) + 1) OVER w - length(x) - 1)::BIGINT AS pos,
  {has(_PIECES)} AND {has(_LONG)} AND NOT {has(_BROKEN)} AS long, {has(_SHORT)} AS short, {has(_LAST)} AS tiny, {has(_BLANK)} AS blank, {has(_HEADER)} AS head,
  length(string_split_regex(x, {q(_STOP)})[1]) AS part FROM (SELECT r, i, generate_subscripts(l, 1) AS n, unnest(l) AS x FROM (SELECT r, i, string_split(rest, chr(10)) AS l FROM ks WHERE NOT regexp_matches(rest, {q(_END)}))) WINDOW w AS (PARTITION BY r, i ORDER BY n)),
kb AS (SELECT *, coalesce(bool_or(long OR short) OVER (PARTITION BY r, i ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS body, max(n) FILTER (long OR short) OVER (PARTITION BY r, i ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM kl),
kg AS (SELECT *, body AND before < n - 1 AS gap FROM kb),
kw AS (SELECT *, (long AND (NOT gap OR {has(_MIXED)})) OR (short AND NOT gap) AS whole FROM kg),
kx AS (SELECT *, coalesce(min(n) FILTER (NOT whole AND NOT blank AND NOT (head AND NOT body)) OVER (PARTITION BY r, i), 2000000000) AS stop FROM kw),
ke AS (SELECT r, i, max(CASE WHEN n < stop AND whole THEN pos + length(x) WHEN n = stop AND tiny AND body AND NOT gap THEN pos + length(x)
  WHEN n = stop AND regexp_matches(substr(x, 1, part), {q(_LONG)}) AND (NOT gap OR {has(_MIXED)}) THEN pos + part + length(regexp_extract(substr(x, part + 1), {q(_REST)}, 0)) ELSE 0 END) AS keep FROM kx WHERE n <= stop GROUP BY r, i),
keys AS (SELECT ks.r, list({{'start': start, 'place': {place}, 'kind': '{key.kind}', 'stop': start + size + coalesce(keep, length(string_split_regex(rest, {q(_END)})[1]) + length(regexp_extract(rest, {q(_END)}, 0)))::BIGINT}}) AS spans FROM ks LEFT JOIN ke ON ke.r = ks.r AND ke.i = ks.i GROUP BY ks.r),
a AS (SELECT doc_id, list_sort({" || ".join(arrays)}) AS a FROM m LEFT JOIN keys ON keys.r = m.r)
SELECT doc_id, {counts}, sha256(coalesce({line.format(base)}, '')) AS base_sha256, coalesce({line.format("a")}, '') AS spans FROM a
"""


OP10_SQL = _sql()
