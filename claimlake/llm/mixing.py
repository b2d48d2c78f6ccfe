"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

A source's documents are all due target / size copies.  The whole part is given; the fractional parts are rounded
in pairs: words move at random from one document to the other until one of them is whole (taken or not), in such
odds that every document keeps its expectation and the sum of words stays.  A source's large documents come first, from
the largest on, each against all that are not rounded yet: it is taken or not, and the words go to or come from the
others' common fraction, so that what is left over at the end is small.  A tree does the rest: buckets of about
``FAN`` documents fold to one unrounded document each, those are bucketed again, until one per source is left, which
a last draw rounds.  So a source misses its target by less than one document that is not large (``LARGE`` of the target), or
by one of those that the others cannot make up for.  Draws are hashes: reruns agree.

Defined cases: null or empty text: size 0, taken 0; null source: a source of its own, last in order; null doc_id: as
any other id; repeated rows: a copy each; empty table: no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
#: Documents folded by one array expression.
FAN = 48
#: Share of its source's target from which on a document is large, and how many of a source go first; the tree takes others.
LARGE, FIRST = 0.002, 1000

# Large documents, one after the other: m words are due of the s words that are not rounded yet.
_LARGE = """
aggregate(items, named_struct('m', mass, 's', whole, 'done', cast(array() as array<struct<k: bigint, up: boolean>>)),
  (s, x) -> if(x.size > least(s.m, s.s - s.m), s,
    named_struct('m', s.m - if(x.draw * s.s < s.m, x.size, 0D), 's', s.s - x.size,
                 'done', concat(s.done, array(named_struct('k', x.k, 'up', x.draw * s.s < s.m))))))
"""

# One step of the fold: a is the unrounded document so far, x the next; d1 words may go to a, d2 to x.
_STEP = """
aggregate(slice(items, 2, greatest(size(items) - 1, 0)),
  named_struct('a', items[0], 'done', cast(array() as array<struct<k: bigint, up: boolean>>)),
  (s, x) -> transform(array(named_struct('a', s.a, 'x', x, 'done', s.done,
      'd1', least(s.a.size - s.a.mass, x.mass), 'd2', least(s.a.mass, x.size - x.mass))), v ->
    transform(array(coalesce(v.d2 / nullif(v.d1 + v.d2, 0D), 0D) > x.draw), to_a ->
      CASE WHEN to_a AND v.d1 >= v.a.size - v.a.mass THEN
             named_struct('a', named_struct('k', x.k, 'size', x.size, 'mass', x.mass - v.d1, 'draw', x.draw),
                          'done', concat(v.done, array(named_struct('k', v.a.k, 'up', true))))
           WHEN to_a THEN
             named_struct('a', named_struct('k', v.a.k, 'size', v.a.size, 'mass', v.a.mass + v.d1, 'draw', v.a.draw),
                          'done', concat(v.done, array(named_struct('k', x.k, 'up', false))))
           WHEN v.d2 >= v.a.mass THEN
             named_struct('a', named_struct('k', x.k, 'size', x.size, 'mass', x.mass + v.d2, 'draw', x.draw),
                          'done', concat(v.done, array(named_struct('k', v.a.k, 'up', false))))
           ELSE
             named_struct('a', named_struct('k', v.a.k, 'size', v.a.size, 'mass', v.a.mass - v.d2, 'draw', v.a.draw),
                          'done', concat(v.done, array(named_struct('k', x.k, 'up', true))))
      END)[0])[0])
"""


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size): ``share`` of all sizes by weight, at most ``most``
    times a source's own size.  The level at which sources stop is found by one pass over the sources in the order
    in which they fill up."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("pos") - 1) % len(weights) + 1).cast("int"))
    s = (sizes.withColumn("pos", F.row_number().over(order)).withColumn("w", w)
         .withColumn("cap", most * F.col("source_size")))
    fill = Window.orderBy(F.col("cap") / F.col("w"), "pos")
    whole = Window.partitionBy()
    s = (s.withColumn("at", F.row_number().over(fill))
         .withColumn("full", F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
         .withColumn("open_w", F.sum("w").over(fill.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("level", (share * F.sum("source_size").over(whole) - F.col("full")) / F.col("open_w")))
    below = F.when(F.col("cap") / F.col("w") > F.col("level"), F.col("at"))
    s = s.withColumn("level", F.min_by("level", below).over(whole))
    return s.select("source", "source_size", F.coalesce(F.least("cap", F.col("w") * F.col("level")), "cap").alias("target"))


def mix_sources(docs: DataFrame, seed: int = 7, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) of every row of ``docs`` (and the names mark, nth, of, by which
    ``take_mix`` finds the row again)."""
    sized = docs.select("doc_id", "source", "text", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    # Repeated rows of one id are told apart by a number; k names a row in the tree.
    same = Window.partitionBy("doc_id", "mark", "source").orderBy("size")
    narrow = (sized.select("doc_id", "source", "size", F.xxhash64("text").alias("mark"))
              .withColumn("nth", F.row_number().over(same))
              .withColumn("k", F.xxhash64(F.lit(seed), "doc_id", "mark", "source", "nth")))
    narrow = staged(narrow, "mix")
    total = targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")).drop("n"),
                    weights, share, most)
    total = staged(total.withColumn("due", F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))),
                   "mix")
    most_rows = narrow.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    few = total.count() < 10_000
    sized = (narrow.filter("size > 0").join(F.broadcast(total) if few else total, narrow.source.eqNullSafe(total.source))
             .select(narrow.source, "k", F.col("size").cast("double").alias("size"), "target", "source_size",
                     (F.col("due") - F.floor("due")).alias("part")).filter("part > 0"))
    largest = Window.partitionBy("source").orderBy(F.col("size").desc(), "k")
    large = (sized.filter(F.col("size") > LARGE * F.col("target")).withColumn("nth", F.row_number().over(largest)).filter(F.col("nth") <= FIRST)
             .groupBy("source", (F.col("source_size") * F.col("part")).alias("mass"), F.col("source_size").cast("double").alias("whole"))
             .agg(F.sort_array(F.collect_list(F.struct("nth", "k", "size", _draw(seed, -1).alias("draw")))).alias("items")))
    large = staged(large.select("source", F.expr(_LARGE).alias("s")).select("source", "s.done", (F.col("s.m") / F.col("s.s")).alias("rest")), "mix")
    first = large.select(F.explode("done").alias("d")).select("d.k", "d.up")
    rest = large.select(F.col("source").alias("of"), "rest")
    level = (sized.join(F.broadcast(rest) if few else rest, F.col("source").eqNullSafe(F.col("of")), "left").join(first.select("k"), "k", "left_anti")
             .select("source", "k", "size", (F.col("size") * F.coalesce("rest", "part")).alias("mass")).filter("mass > 0"))
    done, buckets, depth = [first], most_rows, 0
    while buckets > 1 or not depth:
        buckets = -(-buckets // FAN) if buckets > FAN else 1
        item = F.struct("k", "size", "mass", _draw(seed, depth).alias("draw"))
        folded = staged(level.groupBy("source", F.pmod(F.xxhash64(F.lit(depth), "k"), F.lit(buckets)).alias("b"))
                        .agg(F.sort_array(F.collect_list(item)).alias("items"))
                        .select("source", F.expr(_STEP).alias("s")), "mix")
        done.append(folded.select(F.explode("s.done").alias("d")).select("d.k", "d.up"))
        level = folded.select("source", "s.a.k", "s.a.size", "s.a.mass")
        depth += 1
    done.append(level.select("k", (_draw(seed, depth) * F.col("size") < F.col("mass")).alias("up")))
    up = done[0]
    for d in done[1:]:
        up = up.unionByName(d)
    chosen = up.filter("up").select("k", F.lit(1).alias("extra"))
    due = F.broadcast(total.select("source", "source_size", "target", "due")) if total.count() < 10_000 else total
    out = (narrow.join(chosen, "k", "left").alias("n").join(due.alias("t"), F.col("n.source").eqNullSafe(F.col("t.source")))
           .select("n.doc_id", "n.mark", "n.nth", F.col("n.source").alias("of"), "n.size", "t.source_size", "t.target",
                   F.when(F.col("n.size") > 0, F.floor("t.due") + F.coalesce("extra", F.lit(0))).otherwise(0)
                   .cast("long").alias("copies")))
    return out.withColumn("taken", F.col("copies") * F.col("size"))


def take_mix(docs: DataFrame, **how) -> DataFrame:
    """``docs`` as the mix has it: every row as often as it is taken, columns unchanged."""
    out = mix_sources(docs, **how).filter("copies > 0")
    rows = docs.select(packed(docs, "whole"), "doc_id", "source",
                       F.xxhash64("text").alias("mark"),
                       F.monotonically_increasing_id().alias("place"))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("doc_id", "mark", "source").orderBy("place")))
    on = (F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d.mark") == F.col("m.mark"))
          & F.col("d.source").eqNullSafe(F.col("m.of")) & (F.col("d.nth") == F.col("m.nth")))
    return (rows.alias("d").join(out.alias("m"), on)
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("d.whole.*"))


def _draw(seed: int, depth: int):
    """Uniform in (0, 1) from row and level."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed * 1000 + depth + 1), "k"), 11) + 0.5) / float(1 << 53)
