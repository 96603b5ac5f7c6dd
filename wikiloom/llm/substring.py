"""Repeated passages, found at difference-cover anchors.

Positions whose remainder by 13 is in {0, 1, 3, 9} carry an anchor, the hash of
the 8 words there. Every difference of two remainders occurs between two members
of that set, so for two equal windows of 20 words there is a shift of at most 12
words after which both have an anchor, and 12 + 8 words still lie inside the
window. So anchors at four of thirteen positions find every repeated window;
those that occur once in the corpus rule out all the windows around them.

Where an anchor repeats, it is extended: the windows of 20 words that contain
it are hashed in full (96 bits) and the first place of each is looked up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wikiloom.shared import stored

WINDOW = 20
PERIOD, COVER = 13, (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
IN_COVER = np.isin(np.arange(PERIOD), COVER)
#: Fixed odd multipliers for the two halves of a hash over consecutive words.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Text bytes whose anchors a task holds together, about; an anchor takes some 20 bytes, and four come of 13 words.
BUCKET_BYTES = 64 << 20
#: Entries that a task looks at together, and rows of one Arrow batch handed on.
POOL, ROWS = 1 << 19, 1 << 16
#: Stands among the places of a document that is a copy of an earlier one.
COPY = -1


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(words: np.ndarray, width: int, factor: int) -> np.ndarray:
    """A 64-bit hash of every ``width`` consecutive word hashes."""
    n = max(len(words) - width + 1, 0)
    out = np.zeros(n, np.uint64)
    mixed = words * np.uint64(factor)
    mixed ^= mixed >> np.uint64(29)
    for i in range(width):
        out *= np.uint64(factor)
        out += mixed[i:i + n]
    out ^= out >> np.uint64(32)
    return out * np.uint64(factor)


def covered(starts: np.ndarray, n: int, width: int = WINDOW) -> np.ndarray:
    """Which of ``n`` words lie in a window that starts at one of ``starts``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + width, n), -1)
    return np.cumsum(steps[:n]) > 0


def _sliced(columns: list[pa.Array], names: list[str]) -> Iterator[pa.RecordBatch]:
    for low in range(0, len(columns[0]), ROWS):
        yield pa.RecordBatch.from_arrays([c.slice(low, ROWS) for c in columns], names)


def _pools(batches: Iterator[pa.RecordBatch], read: Callable) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[np.ndarray]]]:
    """Batch, row numbers and concatenated arrays of what ``read`` finds, POOL entries at a time."""
    for batch in batches:
        texts, rows, found = batch.column("text").cast(pa.large_binary()), [], []
        places = batch.column("places") if "places" in batch.schema.names else [None] * batch.num_rows
        for i, (text, at) in enumerate(zip(texts, places)):
            arrays = read((text.as_py() or b"").split(), at)
            if arrays is not None and len(arrays[0]):
                found.append(arrays)
                rows.append(np.full(len(arrays[0]), i, np.int32))
            if rows and (sum(map(len, rows)) >= POOL or i == batch.num_rows - 1):
                yield batch, np.concatenate(rows), [np.concatenate(x) for x in zip(*found)]
                rows, found = [], []


def _spread(keys: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """``keys``, with those of rows that need no partner replaced by running numbers, which spread and pack well."""
    return np.where(alone, np.arange(len(keys)).astype(np.uint64), keys).view(np.int64)


def _marked(places: np.ndarray, mark: np.ndarray) -> pa.Array:
    """Places with a mark in the lowest bit."""
    return pa.array(places.astype(np.int64) * 2 + mark)


def _anchors(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Anchors in parcels: a row per pool and bucket of hashes, with the columns packed as bytes.

    Of anchors that repeat inside a pool one is sent to its bucket and marked as
    known; the others go to any bucket with a running number for a hash, so a
    passage that most documents share makes one anchor per pool there. Of equal
    texts at equal places one stands for all. 48 bits of a hash
    and its bucket are enough, since an anchor only rules windows in.
    """
    def read(words: list[bytes], _) -> list[np.ndarray]:
        hashes = window_hashes(word_hashes(words), ANCHOR, FACTORS[0])
        at = np.nonzero(IN_COVER[np.arange(len(hashes)) % PERIOD])[0]
        return [hashes[at], at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows, (keys, places) in _pools(batches, read):
            version = batch.column("version").to_numpy()[rows]
            order = np.lexsort((places, version, keys))
            same = keys[order][1:] == keys[order][:-1]
            copied = np.r_[False, same & (version[order][1:] == version[order][:-1]) & (places[order][1:] == places[order][:-1])]
            again = np.r_[False, same]
            group = np.cumsum(~again) - 1
            differs = np.zeros(group[-1] + 1, bool)
            differs[group[again & ~copied]] = True  # at another place or in another text
            alone, known, copied_at = (np.empty(len(order), bool) for _ in range(3))
            alone[order], known[order], copied_at[order] = again, differs[group], copied
            useful = ~alone | (known & ~copied_at)
            number = np.arange(len(keys)).astype(np.uint64)
            keys = np.where(alone, number, keys)[useful]
            version, marked = version[useful], (places * 2 + known)[useful].astype(np.uint32)
            bucket = (keys % np.uint64(buckets)).astype(np.int64)
            keys //= np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            held, edges = np.unique(bucket[order], return_index=True)
            for b, low, high in zip(held, edges, [*edges[1:], len(order)]):
                part = order[low:high]
                starts = np.nonzero(np.r_[True, version[part][1:] != version[part][:-1]])[0]
                columns = [keys[part].astype(np.uint32), (keys[part] >> np.uint64(32)).astype(np.uint16),
                           version[part][starts], np.diff(np.r_[starts, len(part)]).astype(np.uint32),
                           marked[part].astype(np.uint16), (marked[part] >> np.uint32(16)).astype(np.uint16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in columns)], ["bucket", *PARCEL])

    return run


#: Columns of a parcel: halves of the hashes, runs of texts and their lengths, halves of the marked places.
PARCEL = {"low": np.uint32, "high": np.uint16, "version": np.int64, "run": np.uint32, "place": np.uint16, "place_high": np.uint16}


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors whose hash is known to repeat or does so in its bucket; parcels come in order of their buckets."""
    rows = (batch.slice(i, 1) for batch in batches for i in range(batch.num_rows))
    for _, parcels in groupby(rows, key=lambda row: row.column("bucket")[0].as_py()):
        yield from _repeated_in(list(parcels))


def _repeated_in(parcels: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(parcels)
    column = {c: np.frombuffer(b"".join(x.as_py() for x in table[c]), t) for c, t in PARCEL.items()}
    keys = column["low"].astype(np.uint64) | (column["high"].astype(np.uint64) << np.uint64(32))
    version = np.repeat(column["version"], column["run"])
    marked = column["place"].astype(np.int64) | (column["place_high"].astype(np.int64) << 16)
    order = np.argsort(keys, kind="stable")
    keys, version, marked = keys[order], version[order], marked[order]
    starts = np.nonzero(np.r_[True, keys[1:] != keys[:-1]])[0]
    group = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(keys)]))
    place = marked >> 1
    repeats = np.bitwise_or.reduceat(marked & 1, starts) > 0
    for values in (version, place):
        repeats |= np.minimum.reduceat(values, starts) != np.maximum.reduceat(values, starts)
    found = repeats[group]
    yield from _sliced([pa.array(version[found]), pa.array(place[found].astype(np.int32))], ["version", "place"])


def repeated_anchors(docs: DataFrame, text_bytes: int) -> DataFrame:
    """``version, place``: the anchors that occur at another place or in another text too.

    ``text_bytes`` are those of all texts and give the number of buckets, at
    least one per shuffle partition. A task holds the anchors of one bucket;
    beyond 2 ** 16 buckets it gets several, which come one after the other.
    """
    spark = docs.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-text_bytes // BUCKET_BYTES))
    parcels = docs.mapInArrow(_anchors(buckets), "bucket int, " + ", ".join(f"{c} binary" for c in PARCEL))
    dealt = parcels.repartition(min(buckets, 1 << 16), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_repeated, "version long, place int")


def anchor_places(docs: DataFrame, text_bytes: int) -> DataFrame:
    """``version, places``: each repeated anchor's place once, however many copies a text has."""
    return repeated_anchors(docs, text_bytes).groupBy("version").agg(F.collect_set("place").alias("places"))


def text_classes(docs: DataFrame) -> DataFrame:
    """``version, first, n, bytes``: the smallest id, the rows and the bytes in all rows of each text."""
    return docs.groupBy("version").agg(F.min(F.struct("doc_id")).alias("first"), F.count("*").alias("n"), F.sum("bytes").alias("bytes"))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows that contain a repeated anchor, with their hashes.

    Of equal windows of a pool the first is sent to their hash; the others are
    marked as later ones and scattered.
    """
    def read(words: list[bytes], places: pa.ListScalar) -> list[np.ndarray] | None:
        n = len(words) - WINDOW + 1
        if n < 1 or not places.is_valid:
            return None
        anchors = places.values.to_numpy()
        if (anchors == COPY).any():
            return None
        # A window holds an anchor if it starts at most 12 words before it.
        at = np.nonzero(covered(np.maximum(anchors - (WINDOW - ANCHOR), 0), len(words), WINDOW - ANCHOR + 1)[:n])[0]
        hashed = word_hashes(words)
        h1, h2 = (window_hashes(hashed, WINDOW, f)[at] for f in FACTORS)
        return [h1, h2.view(np.int64).astype(np.int32), at.astype(np.int32)]

    for batch, rows, (h1, h2, starts) in _pools(batches, read):
        age = pc.rank(batch.column("doc_id"), null_placement="at_start", tiebreaker="min").to_numpy()[rows]
        order = np.lexsort((starts, age, h2, h1))
        new = np.r_[True, (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])]
        first = np.empty(len(order), np.int64)
        first[order] = order[np.nonzero(new)[0][np.cumsum(new) - 1]]
        later = (age > age[first]) | (starts > starts[first])
        take = pa.array(rows)
        yield from _sliced([pa.array(_spread(h1, later)), pa.array(np.where(later, 0, h2)), batch.column("doc_id").take(take),
                            batch.column("short").take(take), _marked(starts, later)],
                           ["h1", "h2", "doc_id", "short", "start_later"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for text, starts in zip(batch.column("text").cast(pa.large_binary()), batch.column("starts")):
            words = (text.as_py() or b"").split()
            n_words.append(len(words))
            if starts.is_valid:
                at = np.unique(starts.values.to_numpy())
                at = np.arange(max(len(words) - WINDOW + 1, 0)) if at[0] == COPY else at
                gone = covered(at, len(words))
                words = [w for w, g in zip(words, gone) if not g]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array(kept, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept``, one row per row of ``docs``.

    A word goes if it lies in a window of 20 words whose words also start
    earlier, in a smaller ``doc_id`` or at a smaller position of the same
    document. Windows are judged on the input. Equal positions of rows that
    repeat a ``doc_id`` are one place, so such rows do not remove each other; a
    null ``doc_id`` comes before all others. A null text has no words. Only
    ``doc_id`` and ``text`` are read.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("version", F.xxhash64("text"))
    dealt = (docs.select("doc_id", "text", *_keys(F.col("doc_id"))).repartition("row", "short"))  # the text moves once; both joins read it
    narrow = docs.select("doc_id", "version")
    classes = stored(text_classes(docs.select("doc_id", "version", F.octet_length("text").alias("bytes"))), "texts")
    text_bytes = classes.agg(F.sum("bytes")).first()[0] or 0
    copies = (narrow.join(classes.where("n > 1"), "version").where(F.struct("doc_id") > F.col("first"))
              .select(*_keys(F.col("doc_id")), F.lit(COPY).alias("place")))
    first_rows = anchor_places(docs, text_bytes).join(classes, "version").select(*_keys(F.col("first.doc_id")), F.explode("places").alias("place"))
    schema = T.StructType([T.StructField("h1", T.LongType()), T.StructField("h2", T.IntegerType()), docs.schema["doc_id"],
                           T.StructField("short", T.IntegerType()), T.StructField("start_later", T.LongType())])
    windows = _with(dealt, first_rows.unionByName(copies)).mapInArrow(_windows, schema)
    start = F.shiftright("start_later", 1)
    first = Window.partitionBy("h1", "h2").orderBy("doc_id", start)
    later = (windows.withColumn("rank", F.rank().over(first)).where("rank > 1 or start_later % 2 = 1")
             .select(F.xxhash64("doc_id").alias("row"), "short", start.cast("int").alias("place")))
    out = T.StructType([docs.schema["doc_id"], T.StructField("n_words", T.LongType()),
                        T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType()),
                        T.StructField("kept", T.StringType())])
    return _with(dealt, later.unionByName(copies)).withColumnRenamed("places", "starts").mapInArrow(_kept, out)


def _keys(doc_id: Column) -> list[Column]:
    """Hashes of id and text, 96 bits together, which unlike the id are never null."""
    return [F.xxhash64(doc_id).alias("row"), F.shiftright("version", 32).cast("int").alias("short")]


def _with(dealt: DataFrame, places: DataFrame) -> DataFrame:
    """The documents with the list of their places, each once, null where there is none."""
    lists = places.groupBy("row", "short").agg(F.collect_set("place").alias("places"))
    return dealt.join(lists, ["row", "short"], "left").select("doc_id", "short", "text", "places")
