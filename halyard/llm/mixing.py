"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Every source has a rate r = target words / its words, at most 3. Its documents stand in a fixed order, by
size and then by a hash; the prefix sum of the expected copies at rank k is r * k. With one random offset u
for each source, document k is taken once for each integer boundary that r * k + u crosses there:
floor(r * k + u) - floor(r * (k - 1) + u). Neighbours in that order have about the same size, so the words
taken stay within about one document of the target.

The rank of a document comes from counts of (source, size, slot), where slot is a hash of doc_id: a prefix sum
over those counts, which are few, plus a row number within one (source, size, slot). No task holds a source.

Defined results: a null source is a source of its own, the last; a null or empty text has size 0; repeated
rows are taken each by their own rank (alike rows together as often as they are taken); a source without words, and the only source of an empty table, has
target 0; the same rows give the same result on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halyard.llm.shared import WORD, packed, written

#: Weights of the sources by code point, repeating.
WEIGHTS = (1, 2, 3)
MOST = 3.0
SLOTS = 256
RUN = 1000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """_source, source_size and target from rows (_source, size).

    Shares of all words by weight, at most `most` times a source's words, the excess shared anew: that ends where
    every source has min(cap, lambda * weight) for one lambda, found by prefix sums in the order of cap / weight."""
    per = sizes.groupBy("_source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("_source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    per = per.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    up = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("_source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(up), F.lit(0.0))
    level = rest / (F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(up), F.lit(0.0)))
    per = per.withColumn("_level", level)
    # the last source whose cap is below its share at that point ends the capped ones; the level there on is common
    free = F.col("_cap") > F.col("_level") * F.col("_w")
    common = F.min(F.when(free, F.struct(F.col("_cap") / F.col("_w"), F.col("_source").isNull(), F.col("_source"), F.col("_level").alias("level")))).over(every)["level"]
    return per.select("_source", "source_size", F.when(free, F.coalesce(common, F.lit(0.0)) * F.col("_w")).otherwise(F.col("_cap")).alias("target"))


def copies(docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = WEIGHTS, most: float = MOST, text: str = "text", source: str = "source", doc_id: str = "doc_id", slots: int = SLOTS, tie: Column | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target and copies (0 to `most`) of each document; the keys only are shuffled.

    tie: a number that orders rows which agree in doc_id, source and size; it's kept as a column then."""
    extra = [] if tie is None else [tie.alias("tie")]
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    digest = F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).cast("binary"))
    # the texts are read once; all that follows works on keys and sizes
    keyed = written(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("_source"), size.alias("size"), *extra))
    names = ["tie"] if extra else []
    keyed = keyed.withColumn("_digest", digest).withColumn("_slot", F.conv(F.substring("_digest", 1, 4), 16, 10).cast("int") % slots)
    counted = keyed.groupBy("_source", "size", "_slot").agg(F.count("*").alias("_n"))
    targets = source_targets(counted.select("_source", (F.col("size") * F.col("_n")).alias("size")), weights, most)
    by_size = counted.groupBy("_source", "size").agg(F.sum("_n").alias("_n"))
    below = Window.partitionBy("_source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    by_size = by_size.select(F.col("_source").alias("_s"), F.col("size").alias("_z"), F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_below"))
    within = Window.partitionBy("_source", "size").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slotted = counted.withColumn("_earlier", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_source"), F.lit("-"))).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    groups = (
        slotted.join(by_size, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")))
        .join(targets.withColumnRenamed("_source", "_t"), F.col("_source").eqNullSafe(F.col("_t")))
        .select(F.col("_source").alias("_gs"), F.col("size").alias("_gz"), F.col("_slot").alias("_gk"), (F.col("_below") + F.col("_earlier")).alias("_before"), "source_size", "target", offset.alias("_u"))
    )
    own = Window.partitionBy("_source", "size", "_slot").orderBy("_digest", "doc_id", *names)
    ranked = keyed.withColumn("_k", F.row_number().over(own)).join(groups, F.col("_source").eqNullSafe(F.col("_gs")) & (F.col("size") == F.col("_gz")) & (F.col("_slot") == F.col("_gk")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rank = (F.col("_before") + F.col("_k")).cast("double")
    n = F.floor(rate * rank + F.col("_u")) - F.floor(rate * (rank - 1) + F.col("_u"))
    return ranked.select("doc_id", F.col("_source").alias("source"), "size", "source_size", F.round("target", 6).alias("target"), F.least(n, F.lit(int(most))).cast("long").alias("copies"), *names)


def mixed(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", **how) -> DataFrame:
    """docs with each row as many times as it is taken and its copy number in mix_copy (from 1; a column of that name is replaced).

    Rows meet their copies by doc_id and a hash of all columns. Rows alike in all columns are interchangeable:
    one of them stands for all, as often as they are taken together."""
    docs = docs.drop("mix_copy")
    each = range(1, int(how.get("most", MOST)) + 1)
    rows = packed(docs, doc_id=doc_id, text=text, source=source).withColumn("tie", F.xxhash64("row"))
    id_ = F.coalesce(F.concat(F.lit("v"), F.col("doc_id").cast("string")), F.lit("n"))  # null is a value of its own
    taken = copies(rows, text="text", source="source", doc_id="doc_id", tie=F.col("tie"), **how).groupBy(id_.alias("id"), "tie")
    taken = written(taken.agg(F.count("*").alias("alike"), *[F.count_if(F.col("copies") == n).alias(f"times_{n}") for n in each]))
    whole = rows.select("row", id_.alias("id"), "tie")
    one = sum((F.col(f"times_{n}") * n for n in each), F.lit(0))
    out = whole.join(taken.where((F.col("alike") == 1) & (one > 0)).select("id", "tie", one.alias("n")), ["id", "tie"]).select("row", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("mix_copy"))
    again = taken.where("alike > 1")
    if again.limit(1).count():
        # runs of (first, last) rows that are taken n times each, dealt anew, so that no task emits all of a large group
        runs = F.concat(*[F.when(F.col(f"times_{n}") > 0, F.transform(F.sequence(F.lit(0).cast("long"), (F.col(f"times_{n}") - 1).cast("long"), F.lit(RUN).cast("long")), lambda x: F.struct(x.alias("at"), F.least(F.col(f"times_{n}") - x, F.lit(RUN)).alias("rows"), F.lit(n).alias("n")))).otherwise(F.array().cast("array<struct<at:bigint,rows:bigint,n:int>>")) for n in each])  # noqa: B023
        some = whole.join(again.select("id", "tie"), ["id", "tie"], "left_semi").groupBy("id", "tie").agg(F.first("row").alias("row"))
        some = some.join(again, ["id", "tie"]).select("row", "id", F.explode(runs).alias("run")).repartition("id", "run.at", "run.n")
        some = some.select("row", "run.n", F.explode(F.sequence(F.lit(1).cast("long"), "run.rows"))).select("row", F.explode(F.sequence(F.lit(1), "n")).alias("mix_copy"))
        out = out.unionByName(some.withColumn("mix_copy", F.col("mix_copy").cast("long")))
    return out.select("row.*", F.col("mix_copy").cast("int").alias("mix_copy"))


OP9_SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('mix/' || coalesce(doc_id::VARCHAR, '-')) AS digest
  FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, source_size * 3.0::DOUBLE AS cap,
             ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w FROM p),
lev AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER up, 0::DOUBLE)) / (sum(w) OVER () - coalesce(sum(w) OVER up, 0::DOUBLE)) AS level
        FROM w WINDOW up AS (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT coalesce(first(level ORDER BY cap / w, source ASC NULLS LAST), 0::DOUBLE) AS common FROM lev WHERE cap > level * w),
t AS (SELECT source, source_size, CASE WHEN cap > level * w THEN common * w ELSE cap END AS target,
             (('0x' || substr(md5('mix:' || coalesce(source, '-')), 1, 8))::BIGINT)::DOUBLE / 4294967296.0::DOUBLE AS u FROM lev, f),
r AS (SELECT doc_id, source, size, row_number() OVER (PARTITION BY source ORDER BY size, ('0x' || substr(digest, 1, 4))::BIGINT % 256, digest, doc_id)::DOUBLE AS k FROM d)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       (size * least(CASE WHEN source_size > 0 THEN floor(target / source_size * k + u) - floor(target / source_size * (k - 1) + u) ELSE 0 END, 3))::BIGINT AS taken
FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source
"""
