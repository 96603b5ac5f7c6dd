"""How far the sources of a language differ in vocabulary, over run-length columns.

The kept terms of a language are put in an order that brings equal counts
together and cut into blocks. In a block each source's probabilities form a
column that is stored as runs; a pair of sources is compared by intersecting the
run boundaries of the two columns and multiplying the divergence of a run by its
length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wikiloom.shared import stored

#: Documents of a language that must hold a term, and terms listed per group.
MIN_DOCS, TOP_TERMS = 3, 200
SCALE = 1_000_000_000
#: Terms of a block, about.
BLOCK = 65_536
#: Different words of documents that a task combines at a time.
CHUNK = 2_000_000

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of letters and of characters beyond ASCII, as UTF-8; only A to Z are lowered."""
    return (text or "").encode(errors="replace").translate(_LETTERS).split()


def _combined(pairs: list[tuple[str, str]], owners: list[int], sizes: list[int], terms: list[bytes],
              counts: list[int]) -> pa.RecordBatch:
    coded = pa.array(terms, pa.binary()).dictionary_encode()
    n = len(coded.dictionary)
    keys = np.repeat(np.array(owners, np.int64), sizes) * n + coded.indices.to_numpy()
    found, which, docs = np.unique(keys, return_inverse=True, return_counts=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, which, np.array(counts, np.int64))
    langs, sources = zip(*pairs)
    owner = pa.array(found // n)
    return pa.RecordBatch.from_arrays([
        pa.array(langs, pa.string()).take(owner), pa.array(sources, pa.string()).take(owner),
        pc.cast(coded.dictionary.take(pa.array(found % n)), pa.string()), pa.array(total), pa.array(docs.astype(np.int64)),
    ], ["lang", "source", "term", "n", "docs"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups, owners, sizes, terms, counts = {}, [], [], [], []
    for batch in batches:
        for lang, source, text in zip(*(column.to_pylist() for column in batch.columns)):
            found = Counter(words_of(text))
            owners.append(groups.setdefault((lang, source), len(groups)))
            sizes.append(len(found))
            terms.extend(found)
            counts.extend(found.values())
            if len(terms) >= CHUNK:
                yield _combined(list(groups), owners, sizes, terms, counts)
                groups, owners, sizes, terms, counts = {}, [], [], [], []
    if terms:
        yield _combined(list(groups), owners, sizes, terms, counts)


def _filled(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term``, its occurrences ``n`` and the documents ``docs`` that hold it."""
    found = _filled(docs).mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def ordered_vocabulary(counts: DataFrame, min_docs: int = MIN_DOCS, block: int = BLOCK) -> DataFrame:
    """``lang, term, total, block, place`` of the terms that are kept, in an order with long runs.

    Terms are sorted by their first source and its count, then by a signature
    of all their counts, so that terms with equal counts everywhere are
    neighbours. A block is a range of that order, the same for all sources.
    """
    seen = F.struct("source", "n")
    kept = stored(counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.min(seen).alias("first"),
        F.bit_xor(F.xxhash64("source", "n")).alias("signature")).where(F.col("docs") >= min_docs).drop("docs"), "terms")
    order = ["lang", "first.source", "first.n", "signature", "term"]
    blocks = -(-kept.count() // block) or 1
    row = F.monotonically_increasing_id()  # the partition, and the place in it below 33 bits
    return stored(kept.repartitionByRange(blocks, *order).sortWithinPartitions(*order).select("lang", "term", "total", row.alias("row"))
                  .select("lang", "term", "total", F.shiftright("row", 33).alias("block"),
                          F.col("row").bitwiseAND(F.lit((1 << 33) - 1)).alias("place")), "vocabulary")


def probability(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (count + 1) / (total + terms))``, exact beyond 64 bits; null without terms."""
    scaled = (count + 1).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    rest = scaled % (total + terms)
    return 1 + ((scaled - rest) / (total + terms)).cast("long")


def runs(low: int, size: int, base: int, places: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and value of each run of a column: ``base`` but for the given places."""
    column = np.full(size, base, np.int64)
    column[places - low] = values
    starts = np.flatnonzero(np.r_[True, column[1:] != column[:-1]])
    return starts, column[starts]


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _compare(block: pa.Table) -> pa.Table:
    """The sums of one block for each pair of its columns, both ways."""
    order = np.argsort(pc.fill_null(block["source"], "").dictionary_encode().combine_chunks().indices.to_numpy(), kind="stable")
    block = block.take(pa.array(order))
    names = block["source"].to_pylist()
    place, value, length = (block[c].to_numpy() for c in ("place", "value", "length"))
    edges = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]] + [len(names)]
    columns, size = [], 0
    for start, end in zip(edges, edges[1:]):
        here = slice(start, end)
        whole = start + int(np.argmax(length[here]))  # the run over the block that every column has
        low, size = int(place[whole]), int(length[whole])
        points = np.flatnonzero(length[here] == 0) + start
        columns.append((names[start], *runs(low, size, int(value[whole]), place[points], value[points])))
    out: tuple[list, list, list] = ([], [], [])
    for i, (a, starts_a, values_a) in enumerate(columns):
        for b, starts_b, values_b in columns[:i]:
            cuts = np.union1d(starts_a, starts_b)
            lengths = np.diff(np.r_[cuts, size])
            p = values_a[np.searchsorted(starts_a, cuts, side="right") - 1]
            q = values_b[np.searchsorted(starts_b, cuts, side="right") - 1]
            for pair in ((a, b, p, q), (b, a, q, p)):
                for cell, column in zip((pair[0], pair[1], int((divergence(pair[2], pair[3]) * lengths).sum())), out):
                    column.append(cell)
    lang = block["lang"][0].as_py()
    return pa.table({"lang": pa.array([lang] * len(out[0]), pa.string()), "source": pa.array(out[0], pa.string()),
                     "item": pa.array(out[1], pa.string()), "value": pa.array(out[2], pa.int64())})


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, block: int = BLOCK) -> DataFrame:
    """``lang, source, part, item, value, rank``: divergences between sources, and terms that stand out.

    Part ``pair``: every other source of the language with the sum of
    ``floor((p - q)^2 / q)`` over all kept terms, p the group's probabilities
    and q the other's. Part ``term``: the terms that the group has and uses
    more than its language does, the ``top_terms`` highest. Null lang, source
    and text count as empty; a group without terms takes part; repeated rows
    are documents each; a language without kept terms has pairs of value 0; an
    empty table gives no rows. Sums stay below 2^63 for vocabularies of up to 8
    billion terms a language.

    A task holds one block: ``block`` terms and the counts they have in all
    sources. A hot source is spread over the blocks by its terms.
    """
    counts = stored(term_counts(docs), "counts")
    vocabulary = ordered_vocabulary(counts, min_docs, block)
    entries = stored(counts.drop("docs").join(vocabulary, ["lang", "term"]), "entries")
    langs = vocabulary.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_total"))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("group_total"))
    groups = stored(_filled(docs).select("lang", "source").distinct()
                    .join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
                    .withColumn("group_total", F.coalesce("group_total", F.lit(0))), "groups")

    p = probability(F.col("n"), F.col("group_total"), F.col("terms"))
    rated = entries.join(groups, ["lang", "source"]).withColumn("p", p)
    zero = F.lit(0).cast("long")
    points = rated.select("lang", "block", "source", "place", F.col("p").alias("value"), zero.alias("length"))
    spans = vocabulary.groupBy("lang", "block").agg(F.min("place").alias("place"), F.count("*").alias("length"))
    whole = groups.join(spans, "lang").select(
        "lang", "block", "source", "place",
        probability(zero, F.col("group_total"), F.col("terms")).alias("value"), "length")
    sums = (points.unionByName(whole).groupBy("lang", "block")
            .applyInArrow(_compare, "lang string, source string, item string, value long")
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    bare = groups.where("terms is null").select("lang", "source")
    alike = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source <> item").withColumn("value", zero)
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = sums.unionByName(alike.select(*sums.columns)).withColumn("rank", F.row_number().over(by_value))

    q = probability(F.col("total"), F.col("lang_total"), F.col("terms"))
    marked = rated.withColumn("q", q).where("p > q").select(
        "lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div q").alias("value"))
    terms = marked.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top_terms)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (pairs.withColumn("part", F.lit("pair")).select(columns)
            .unionByName(terms.withColumn("part", F.lit("term")).select(columns)))
