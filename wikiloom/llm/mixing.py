"""Mixing sources to target weights by balanced sampling with the cube method.

Every document of a source is wanted ``target / source size`` times: the whole
part as copies of all its documents, the fraction by a sample with that
inclusion probability. The flight phase moves the probabilities of three
documents at a time along the null space of the two balancing equations, the
source's expected documents and expected words, until at most two documents of
a group are undecided; both totals stay as they are. Groups hold a bounded
number of documents. What is left of them flies on in groups of its own, level
by level, until a source has one group; the landing then decides its last
documents so that the words come nearest.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wikiloom.llm.copies import collapsed, numbered, row_hash
from wikiloom.shared import stored, unused

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
#: Documents of a group about.
GROUP = 4_000
EPS = 1e-9
#: Sources up to which their table is sent to all tasks.
MANY = 10_000
#: Equal rows that are more than this part of all rows are held apart: so many groups at most.
HOT_PART = 10_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """``source, source_size, target``: words of each source, held and wanted.

    ``weights`` repeat over the sources by code point, null last. The targets
    share the words of all sources by weight and stop at ``max_repeats`` times
    a source's own; the excess goes to the others by weight until none is
    above. Filled in order of the bound per weight: one pass of running sums
    over the table of sources.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    order = Window.orderBy(F.col("bound") / F.col("weight"), F.col("place"))
    before, all_ = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    from_here = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(all_) - F.coalesce(F.sum("bound").over(before), F.lit(0.0))) / F.sum("weight").over(from_here)
    filled = (sources.withColumn("place", F.row_number().over(place) - 1)
              .withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("place") % len(weights) + 1).cast("int")))
              .withColumn("bound", F.col("source_size") * float(max_repeats))
              .withColumn("level", level)
              .withColumn("free", F.col("weight") * F.col("level") < F.col("bound"))
              .withColumn("common", F.min(F.when(F.col("free"), F.struct(F.col("bound") / F.col("weight"), F.col("place"), F.col("level")))).over(all_)["level"]))
    return filled.select("source", "source_size", F.least("bound", F.coalesce(F.col("weight") * F.col("common"), F.col("bound"))).alias("target"))


def flight(prob: np.ndarray, size: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Move ``prob`` until at most two entries are neither 0 nor 1.

    Sums of ``prob`` and of ``prob * size`` stay. Three undecided entries have
    one direction that keeps both sums, (b - c, c - a, a - b) for sizes a, b, c;
    it is followed one way or the other, with odds that keep every entry's mean.
    """
    prob = prob.astype(float)
    held: list[int] = []
    for i in np.nonzero((prob > EPS) & (prob < 1 - EPS))[0].tolist():
        held.append(i)
        if len(held) < 3:
            continue
        a, b, c = (float(size[j]) for j in held)
        way = [b - c, c - a, a - b] if not a == b == c else [1.0, -1.0, 0.0]
        p = [float(prob[j]) for j in held]
        up = min((1 - x) / w if w > 0 else -x / w for x, w in zip(p, way) if w)
        down = min(x / w if w > 0 else (x - 1) / w for x, w in zip(p, way) if w)
        step = up if draws[i] * (up + down) < down else -down
        rest = []
        for j, x, w in zip(held, p, way):
            x += step * w
            x = 0.0 if x < EPS else 1.0 if x > 1 - EPS else x
            prob[j] = x
            if 0.0 < x < 1.0:
                rest.append(j)
        held = rest
    return prob


def land(prob: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Decide what a flight left, at most two entries, so that the words come nearest."""
    prob = prob.copy()
    open_ = np.nonzero((prob > EPS) & (prob < 1 - EPS))[0]
    wanted = float((prob[open_] * size[open_]).sum())
    choices = [[(c >> k) & 1 for k in range(len(open_))] for c in range(1 << len(open_))]
    prob[open_] = min(choices, key=lambda c: (abs(float((np.array(c) * size[open_]).sum()) - wanted), c))
    return np.rint(prob)


def _fly(last: bool):
    def run(group: pa.Table) -> pa.Table:
        size, prob, draw = (group.column(c).to_numpy() for c in ("size", "prob", "draw"))
        order = np.lexsort((draw, -size))  # small documents last, so little is left to land
        moved = flight(prob[order], size[order], (draw[order] + 2.0 ** 63) / 2.0 ** 64)
        out = np.empty(len(order))
        out[order] = land(moved, size[order]) if last else moved
        return group.set_column(group.schema.get_field_index("prob"), "prob", pa.array(out))

    return run


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: float = MAX_REPEATS, group: int = GROUP) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken``, a row per row of ``docs``.

    ``copies`` is how often the mix takes the document, ``taken`` its words in
    the mix. The draws come from the ``doc_id``, so reruns agree; rows that
    agree in id, source and size, as many null ids may, are counted and then
    numbered, so each draws for itself. Null texts have no words; a null source
    is a source, last in order; a source without words has target 0. An empty
    table gives no rows.
    """
    sizes = docs.select("doc_id", "source", n_words(F.col("text").cast("string")).alias("size"))
    return _decided(sizes, ["doc_id"], weights, max_repeats, group)


def _decided(sizes: DataFrame, keys: list[str], weights: Sequence[float], max_repeats: float, group: int) -> DataFrame:
    """The columns of :func:`mix` for rows of ``keys, source, size``, with ``keys`` for the id."""
    counted = stored(sizes.groupBy(*keys, "source", "size").agg(F.count("*").alias("rows")), "sizes")
    targets = source_targets(counted.select("source", (F.col("size") * F.col("rows")).alias("size")), weights, max_repeats)
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    named = targets.withColumnRenamed("source", "_source")
    few = named.limit(MANY + 1).count() <= MANY
    rows = (numbered(counted, "rows", "number")
            .join(F.broadcast(named) if few else named, F.col("source").eqNullSafe(F.col("_source")))
            .select(*keys, "source", "size", "source_size", "target",
                    F.floor(wanted + EPS).alias("whole"), F.greatest(wanted - F.floor(wanted + EPS), F.lit(0.0)).alias("prob"),
                    F.xxhash64(F.lit("cube"), *keys, "size", "number").alias("draw")))
    schema = T.StructType([*(sizes.schema[c] for c in (*keys, "source")), *(T.StructField(c, t) for c, t in (
        ("size", T.LongType()), ("source_size", T.LongType()), ("target", T.DoubleType()), ("whole", T.LongType()),
        ("prob", T.DoubleType()), ("draw", T.LongType()), ("part", T.LongType())))])
    open_ = (F.col("prob") > EPS) & (F.col("prob") < 1 - EPS)
    done, level = rows.where(~open_), rows.where(open_)
    while True:
        counts = level.groupBy("source").agg(F.count("*").alias("n")).select(F.col("source").alias("_s"), F.ceil(F.col("n") / group).alias("parts"))
        last = counts.agg(F.coalesce(F.max("parts"), F.lit(0))).first()[0] <= 1
        dealt = level.join(counts, F.col("source").eqNullSafe(F.col("_s"))).withColumn(
            "part", F.pmod(F.xxhash64(F.lit("part"), "draw"), F.col("parts"))).drop("_s", "parts")
        flown = stored(dealt.groupBy("source", "part").applyInArrow(_fly(last), schema).drop("part"), "flight")
        done, level = done.unionByName(flown.where(~open_)), flown.where(open_)
        if last:
            break
    copies = (F.col("whole") + F.round("prob").cast("long")).alias("copies")
    return done.select(*keys, "source", "size", "source_size", "target", copies).withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: float = MAX_REPEATS, group: int = GROUP) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their columns.

    Rows are known by a 128-bit hash of all their columns, from which the draws
    come. Rows equal in all columns decide each for itself; one of them is then
    given as often as all of them together. A text moves once, to its decision.
    """
    a, b, n, same, h, h2 = (unused(docs, name) for name in ("_hash", "_hash2", "_copies", "_same", "_h", "_h2"))
    keyed = docs.withColumns({a: row_hash(docs), b: row_hash(docs, 1)})
    sizes = keyed.select(F.col(a).alias("hash"), F.col(b).alias("hash2"), "source", n_words(F.col("text").cast("string")).alias("size"))
    decided = stored(_decided(sizes, ["hash", "hash2"], weights, max_repeats, group).groupBy("hash", "hash2")
                     .agg(F.sum("copies").alias(n), F.count("*").alias(same))
                     .select(F.col("hash").alias(h), F.col("hash2").alias(h2), n, same), "mix")
    met = (F.col(a) == F.col(h)) & (F.col(b) == F.col(h2))
    total, most = decided.agg(F.coalesce(F.sum(same), F.lit(0)), F.coalesce(F.max(same), F.lit(0))).first()

    def often(rows: DataFrame, wanted: DataFrame) -> DataFrame:
        return rows.join(wanted.where(F.col(n) > 0), met).drop(a, b, h, h2, same).withColumn(
            n, F.explode(F.sequence(F.lit(1), F.col(n).cast("int")))).drop(n)

    if most <= 1:
        return often(keyed, decided)
    hot = F.broadcast(decided.where((F.col(same) > 1) & (F.col(same) * HOT_PART > total)))  # HOT_PART rows at most
    repeated = decided.where((F.col(same) > 1) & (F.col(same) * HOT_PART <= total))
    light = keyed.join(hot, met, "left_anti")
    equal = collapsed(keyed.join(hot, met, "left_semi"), same).unionByName(
        collapsed(light.join(repeated, met, "left_semi"), same)).drop(same)
    whole = stored(equal.join(decided.where((F.col(same) > 1) & (F.col(n) > 0)), met).drop(a, b, h, h2, same), "repeated")
    return often(light, decided.where(F.col(same) == 1)).unionByName(numbered(whole, n, same).drop(same))
