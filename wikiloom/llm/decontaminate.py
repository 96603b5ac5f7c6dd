"""Benchmark decontamination: every training passage queries an index of test items.

Items are cut into segments of up to 64 words. The inverted index holds the BM25
weight of each term in each segment as a share of the segment's own score, so 1
is a whole segment and one threshold fits short and long ones. Passages of 128
words, one every 64, are the queries: any run of 64 words lies whole in one.

Retrieval follows block-max WAND, for all passages of a batch at once. Terms are
taken by rising upper bound; those before the pivot, whose bounds together stay
under the threshold, cannot make an answer alone. The blocks of segments that
the other terms occur in are bounded by their block maxima plus what the terms
before the pivot can add; only passages with a block that reaches the threshold
are scored in full. Nothing above the threshold is missed.

What is retrieved is verified on the whole document: the share of the item's
5-word shingles that occur in it, for the question and for the answer.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wikiloom.shared import stored

SEGMENT, STRIDE = 64, 64
PASSAGE = SEGMENT + STRIDE
K1, B = 1.2, 0.75
MIN_SCORE = 0.5
SHINGLE, MIN_OVERLAP = 5, 0.8
#: Segments of a block; words of one part of the index about, which bounds what is broadcast.
BLOCK, PART_WORDS = 8, 1 << 20
#: Words that a task looks at together, and pairs of passage and block that are bounded at once.
POOL, GRID = 1 << 17, 1 << 19
PUNCTUATION = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b" " * 32)
SENTENCE_END = re.compile(r"[.?!]+\s+(?=\S)|\n+(?=.*\S)")


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words without ASCII punctuation."""
    return (text or "").lower().encode(errors="replace").translate(PUNCTUATION).split()


def question_and_answer(text: str) -> tuple[int, int]:
    """Number of words of the question, and of the item; the answer is the last sentence or the last third."""
    n, ends = len(words_of(text)), [m.end() for m in SENTENCE_END.finditer(text)]
    question = len(words_of(text[:ends[-1]])) if ends else 0
    return (question if 0 < question < n else n - -(-n // 3)), n


def shingles(words: list[bytes]) -> list[tuple[bytes, ...]]:
    """Shingles in order; of fewer words the whole sequence."""
    if len(words) < SHINGLE:
        return [tuple(words)] if words else []
    return list(zip(*(words[i:] for i in range(SHINGLE))))


@dataclass
class IndexPart:
    """Postings of a bounded number of items, terms numbered by rising upper bound."""

    term: dict[bytes, int]
    bound: np.ndarray  # per term
    at: np.ndarray  # per term, where its postings begin
    segment: np.ndarray
    weight: np.ndarray
    block_at: np.ndarray  # per term, where its blocks begin
    block: np.ndarray
    block_max: np.ndarray
    item_of: np.ndarray  # per segment
    ids: list
    texts: list[str]


def _segment_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for number, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
            words = words_of(text)
            parts = -(-len(words) // SEGMENT)
            for s in range(parts):
                own = words[s * len(words) // parts:(s + 1) * len(words) // parts]
                rows += [(number, s, t, n, len(own)) for t, n in Counter(own).items()]
        for low in range(0, len(rows), 1 << 16):
            columns = zip(*rows[low:low + (1 << 16)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32()))],
                ["item", "part_no", "term", "tf", "len"])


def build_index(items: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Postings and numbered items, stored, with the number of parts.

    Statistics are those of all items. Items without words are left out.
    """
    texts = items.where("text is not null").select("item_id", F.col("text").cast("string").alias("text"))
    numbered = stored(texts.withColumn("item", F.monotonically_increasing_id()), "items")
    terms = stored(numbered.select("item", "text").mapInArrow(
        _segment_terms, "item long, part_no int, term binary, tf int, len int"), "terms")
    segments = terms.groupBy("item", "part_no").agg(F.first("len").alias("len"))
    total, n, mean = segments.agg(F.coalesce(F.sum("len"), F.lit(0)), F.count("*"), F.coalesce(F.avg("len"), F.lit(1.0))).first()
    n_parts = max(1, -(-total // PART_WORDS))
    frequency = terms.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / mean))
    weighted = terms.join(frequency, "term").withColumn("weight", weight)
    own = weighted.groupBy("item", "part_no").agg(F.sum("weight").alias("own"))
    postings = weighted.join(own, ["item", "part_no"]).select(
        "item", "part_no", "term", (F.col("weight") / F.col("own")).alias("weight"))
    part = F.pmod(F.xxhash64("item"), F.lit(n_parts)).alias("part")
    return stored(postings.select("*", part), "postings"), numbered.select("*", part), n_parts


def load_part(postings: DataFrame, items: DataFrame, part: int) -> IndexPart:
    """A part of the index as arrays; PART_WORDS bounds its size."""
    texts = items.where(F.col("part") == part).toPandas().sort_values("item")
    rows = postings.where(F.col("part") == part).select("item", "part_no", "term", "weight").toPandas()
    rows["item"] = np.searchsorted(texts["item"].to_numpy(), rows["item"].to_numpy())
    rows["term"] = [bytes(t) for t in rows["term"]]
    pairs = rows[["item", "part_no"]].drop_duplicates().sort_values(["item", "part_no"]).reset_index(drop=True)
    rows = rows.merge(pairs.assign(segment=pairs.index), on=["item", "part_no"])
    bounds = rows.groupby("term")["weight"].max().sort_values(kind="stable")
    term = {t: i for i, t in enumerate(bounds.index)}
    rows["term"] = [term[t] for t in rows["term"]]
    rows = rows.sort_values(["term", "segment"])
    blocks = rows.assign(block=rows["segment"] // BLOCK).groupby(["term", "block"], as_index=False)["weight"].max()
    edges = np.arange(len(term) + 1)
    return IndexPart(term, bounds.to_numpy(float), np.searchsorted(rows["term"], edges), rows["segment"].to_numpy(np.int64),
                     rows["weight"].to_numpy(float), np.searchsorted(blocks["term"], edges), blocks["block"].to_numpy(np.int64),
                     blocks["weight"].to_numpy(float), pairs["item"].to_numpy(np.int64), texts["item_id"].tolist(), texts["text"].tolist())


def _gather(terms: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry of the lists of ``terms``: which term it is of, and its place."""
    lengths = at[terms + 1] - at[terms]
    which = np.repeat(np.arange(len(terms)), lengths)
    starts = np.repeat(at[terms] - np.r_[0, np.cumsum(lengths)[:-1]], lengths) if len(terms) else np.empty(0, np.int64)
    return which, starts + np.arange(len(which))


def retrieve(index: IndexPart, passage: np.ndarray, term: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages, segments and scores of all pairs that score ``least`` or more.

    ``passage`` and ``term`` are the distinct pairs, sorted; terms are numbered
    by rising bound.
    """
    least -= 1e-9
    starts = np.nonzero(np.r_[True, passage[1:] != passage[:-1]])[0]
    nth = np.cumsum(np.r_[True, passage[1:] != passage[:-1]]) - 1
    reach = np.cumsum(index.bound[term])
    reach -= (reach[starts] - index.bound[term[starts]])[nth]
    behind = reach >= least  # the pivot and what follows it
    before = np.zeros(len(starts))
    np.maximum.at(before, nth[~behind], reach[~behind])
    n_blocks, out = int(index.block.max(initial=0)) + 1, []
    slab = max(1, GRID // n_blocks)
    for low in range(0, len(starts), slab):
        high = min(low + slab, len(starts))
        here = slice(*np.searchsorted(nth, (low, high)))
        own, terms, after = nth[here] - low, term[here], behind[here]
        which, place = _gather(terms[after], index.block_at)
        limit = np.bincount(own[after][which] * n_blocks + index.block[place], index.block_max[place], (high - low) * n_blocks)
        limit = limit + np.repeat(before[low:high], n_blocks)  # counts of nothing are integers
        open_ = np.nonzero(limit >= least)[0]
        number = np.full((high - low) * n_blocks, -1)
        number[open_] = np.arange(len(open_))
        chosen = np.zeros(high - low, bool)
        chosen[open_ // n_blocks] = True
        chosen = chosen[own]
        which, place = _gather(terms[chosen], index.at)
        segment = index.segment[place]
        at = number[own[chosen][which] * n_blocks + segment // BLOCK]
        kept = at >= 0
        score = np.bincount(at[kept] * BLOCK + segment[kept] % BLOCK, index.weight[place[kept]], len(open_) * BLOCK)
        found = np.nonzero(score >= least)[0]
        pair = open_[found // BLOCK]
        out.append((passage[starts][low + pair // n_blocks], pair % n_blocks * BLOCK + found % BLOCK, score[found]))
    return tuple(map(np.concatenate, zip(*out)))


def search(index: IndexPart, documents: list[list[bytes]], least: float) -> dict[tuple[int, int], float]:
    """Document and item numbers with their best score, for all passages of the documents."""
    lengths = np.fromiter(map(len, documents), np.int64, len(documents))
    if not index.term or not lengths.sum():
        return {}
    terms = np.fromiter(map(index.term.get, chain.from_iterable(documents), repeat(-1)), np.int64, int(lengths.sum()))
    n_passages = np.maximum(-(-(lengths - SEGMENT) // STRIDE), 1)
    first = np.r_[0, np.cumsum(n_passages)]
    owner = np.repeat(np.arange(len(documents)), lengths)
    place = np.arange(len(terms)) - np.repeat(np.r_[0, np.cumsum(lengths)[:-1]], lengths)
    step, known = place // STRIDE, terms >= 0
    last = n_passages[owner] - 1
    keys = []
    for back in (0, 1):  # a word lies in the passage of its step and in the one before
        inside = known & (step - back >= 0) & (step - back <= last)
        keys.append((first[owner] + step - back)[inside] * len(index.term) + terms[inside])
    keys = np.sort(np.concatenate(keys))
    if not len(keys):
        return {}
    keys = keys[np.r_[True, keys[1:] != keys[:-1]]]
    passages, segments, scores = retrieve(index, keys // len(index.term), keys % len(index.term), least)
    best: dict[tuple[int, int], float] = {}
    for d, i, score in zip(np.searchsorted(first, passages, side="right") - 1, index.item_of[segments], scores):
        best[d, i] = max(best.get((d, i), 0.0), float(score))
    return best


def overlaps(item: str, document: set[tuple[bytes, ...]]) -> tuple[float, float, float]:
    """Shares of the item's shingles in the document: all, those that end in the question, those in the answer."""
    found = [s in document for s in shingles(words_of(item))]
    question, n = question_and_answer(item)
    cut = max(question - SHINGLE + 1, 0) if n >= SHINGLE else 0
    share = lambda part, none: sum(part) / len(part) if part else none
    whole = share(found, 0.0)
    return whole, share(found[:cut], whole), share(found[cut:], whole)


def _document_shingles(words: list[bytes], index: IndexPart, items: list[int]) -> set[tuple[bytes, ...]]:
    """Those shingles of the document that the given items can have."""
    short = {len(words_of(index.texts[i])) for i in items}
    found = set(shingles(words))
    for n in short:
        if 0 < n < SHINGLE:
            found |= set(zip(*(words[i:] for i in range(n))))
    return found


def _searcher(index, kind: str, min_score: float, min_overlap: float):
    @F.pandas_udf(kind)
    def hits(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in texts:
            rows: list[list[dict]] = [[] for _ in column]
            pool: list[tuple[int, list[bytes]]] = []
            held = 0
            for at, value in enumerate(column):
                pool.append((at, words_of(value)))
                held += len(pool[-1][1])
                if held >= POOL or at == len(column) - 1:
                    _verify(index.value, pool, rows, min_score, min_overlap)
                    pool, held = [], 0
            yield pd.Series(rows, dtype=object)

    return hits


HIT = "score double, overlap double, question_overlap double, answer_overlap double"


def _hits(text: Column, items: DataFrame, min_score: float, min_overlap: float) -> Iterator[tuple[bool, Column]]:
    """Part by part of the index: whether more parts follow or came before, and the array of hits in a text.

    A part has about PART_WORDS words. Only one is held at a time: it is taken
    back when the next one is asked for, so a caller stores what it found
    before that.
    """
    spark = items.sparkSession
    postings, numbered, n_parts = build_index(items)
    kind = f"array<struct<item_id:{items.schema['item_id'].dataType.simpleString()},{HIT.replace(' ', ':').replace(',:', ',')}>>"
    for part in range(n_parts):
        index = spark.sparkContext.broadcast(load_part(postings, numbered, part))
        yield n_parts > 1, _searcher(index, kind, min_score, min_overlap)(text)
        if n_parts > 1:
            index.destroy()


def _verify(index: IndexPart, pool: list[tuple[int, list[bytes]]], rows: list[list[dict]], min_score: float, min_overlap: float) -> None:
    of: dict[int, list[tuple[int, float]]] = {}
    for (d, i), score in search(index, [words for _, words in pool], min_score).items():
        of.setdefault(d, []).append((i, score))
    for d, candidates in of.items():
        at, words = pool[d]
        document = _document_shingles(words, index, [i for i, _ in candidates])
        for i, score in candidates:
            whole, question, answer = overlaps(index.texts[i], document)
            if whole >= min_overlap:
                rows[at].append({"item_id": index.ids[i], "score": score, "overlap": whole,
                                 "question_overlap": question, "answer_overlap": answer})


def contaminated(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """``doc_id, item_id, score, overlap, question_overlap, answer_overlap`` for each leaked item.

    One row per row of ``docs`` and item it contains; repeated rows and repeated
    items each count. Null and empty texts contain nothing, nor do items without
    words. An item of fewer than five words counts where they stand in a row.
    An item counts if the text has ``min_overlap`` of its shingles; the shares
    of question and answer are given beside it.
    """
    found = []
    for several, hits in _hits(F.col("text").cast("string"), items, min_score, min_overlap):
        rows = docs.select("doc_id", F.explode(hits).alias("hit")).select("doc_id", "hit.*")
        found.append(stored(rows, "hits") if several else rows)
    return reduce(DataFrame.unionByName, found)


def clean(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """The rows of ``docs`` that contain no item; nothing is shuffled.

    One narrow pass for each part of the index, over what the parts before it left.
    """
    for several, hits in _hits(F.col("text").cast("string"), items, min_score, min_overlap):
        kept = docs.where(F.size(F.coalesce(hits, F.array())) == 0)
        docs = stored(kept, "clean") if several else kept
    return docs
