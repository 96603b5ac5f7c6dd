"""Near duplicates by SimHash, with candidates pruned along a ring of segments.

A fingerprint has 64 bits in a ring of 8 segments of 8 bits. Two fingerprints
that differ in at most 3 bits have a segment from which every chain of ``n``
consecutive segments differs in at most ``3 * n / 8`` bits, rounded down: the
first two segments not at all, five in one bit at most, seven in two. So there
is a start at which two segments and two of the next three are equal. Those 32
bits, with start and choice, are an exact join key: 8 * 3 keys a fingerprint.
What shares a key is checked along the chain, then in full.

Keys are made of distinct fingerprints, so a group of equal texts counts once.
Fingerprints within 3 bits of each other share many keys, but a bucket yields a
spanning set of its links, never all pairs. A bucket of more than ``LARGE``
fingerprints goes on along the chain: the bits that its key leaves open are cut
in four, of which a linked pair shares one, so four finer keys replace the key,
again and again until no bucket is large.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wikiloom.llm.components import components
from wikiloom.shared import stored, unused

BITS, SEGMENTS = 64, 8
MAX_DISTANCE = 3
SHINGLE = 3
SEED = 42
#: Bits by which chains of 1, 2, ... 8 segments may differ.
BUDGETS = [MAX_DISTANCE * n // SEGMENTS for n in range(1, SEGMENTS + 1)]
#: Hashes whose bits are counted at once, and rows and columns of a bucket compared at once.
CHUNK, BLOCK = 1 << 16, 1024
#: Fingerprints of a bucket that are compared as they are; more are dealt to finer buckets. At least 8.
LARGE = 4096
#: The bits that a chain key leaves open, by the segment that it skips, seen from the start of the chain.
OPEN = [0xFFFFFF | 0xFF << (56 - 8 * skipped) for skipped in (2, 3, 4)]


def fingerprint(text: bytes | None) -> int:
    """SimHash of the word shingles; 0 if there is no word."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))) if len(words) >= SHINGLE else [b" ".join(words)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=">u8")
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), CHUNK):
        part = hashes[start:start + CHUNK].view(np.uint8).reshape(-1, BITS // 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, version, fp``: hash and fingerprint of each row's text as signed longs.

    A null, empty or blank text has fingerprint 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            fps = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("version"), pa.array(fps.view(np.int64))],
                                             ["doc_id", "version", "fp"])

    text = F.col("text").cast("string")
    schema = T.StructType([docs.schema["doc_id"], T.StructField("version", T.LongType()), T.StructField("fp", T.LongType())])
    return docs.select("doc_id", F.xxhash64(text).alias("version"), text.alias("text")).mapInArrow(run, schema)


def chain_keys(fp: Column) -> Column:
    """The keys of a fingerprint, one of which any linked pair shares."""
    keys = []
    for start in range(SEGMENTS):
        turn = 8 * start
        turned = fp if turn == 0 else F.shiftleft(fp, turn).bitwiseOR(F.shiftrightunsigned(fp, BITS - turn))
        for skipped in (2, 3, 4):
            equal = sum(0xFF << (56 - 8 * s) for s in range(5) if s != skipped)
            mask = equal - (1 << 64) if equal >> 63 else equal
            keys.append(turned.bitwiseAND(F.lit(mask)).bitwiseOR(F.lit(3 * start + skipped - 2).cast("long")))
    return F.array(*keys)


def within_budgets(differing: np.ndarray, start: int) -> np.ndarray:
    """Which of the differing-bit words pass every chain from ``start`` on.

    ``differing`` are XORs of pairs; the last chain is the full distance.
    """
    turn = np.uint64(8 * start)
    turned = (differing << turn) | (differing >> np.uint64(64 - 8 * start)) if start else differing
    passed = np.ones(differing.shape, bool)
    for n, budget in enumerate(BUDGETS, 1):
        passed &= np.bitwise_count(turned >> np.uint64(BITS - 8 * n)) <= budget
    return passed


def bucket_links(fps: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected within a bucket: at most one a row."""
    root = np.arange(len(fps))
    for low, left in ((x, y) for x in range(0, len(fps), BLOCK) for y in range(x, len(fps), BLOCK)):
        rows, columns = np.nonzero(within_budgets(fps[low:low + BLOCK, None] ^ fps[None, left:left + BLOCK], start))
        a, b = root[rows + low], root[columns + left]
        while (open_ := a != b).any():
            a, b = a[open_], b[open_]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root != root[root]).any():
                root = root[root]
            a, b = root[a], root[b]
    below = np.nonzero(root != np.arange(len(fps)))[0]
    return fps[below], fps[root[below]]


def sorted_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """Key and fingerprints of every run of two or more equal keys in sorted rows."""
    keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)
    for batch in chain(batches, [None]):
        if batch is not None:
            keys = np.concatenate([keys, batch.column("key").to_numpy()])
            fps = np.concatenate([fps, batch.column("fp").to_numpy().view(np.uint64)])
        starts = np.nonzero(np.r_[True, keys[1:] != keys[:-1]])[0] if len(keys) else np.empty(0, np.int64)
        ends = np.r_[starts[1:], len(keys)] if len(keys) else starts
        whole = len(starts) if batch is None else max(len(starts) - 1, 0)  # the last run may go on
        for i in np.nonzero(ends[:whole] - starts[:whole] > 1)[0]:
            yield int(keys[starts[i]]), fps[starts[i]:ends[i]]
        rest = starts[whole] if whole < len(starts) else len(keys)
        keys, fps = keys[rest:], fps[rest:]


def _finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Four rows for each: one key per quarter of the bits that the row's key leaves open.

    Fingerprints that share the old key and differ in at most three bits agree
    in a quarter. The lowest byte of a key, its chain, stays.
    """
    for batch in batches:
        keys, opened, fps = (batch.column(c).to_numpy().view(np.uint64) for c in ("key", "open", "fp"))
        turn = keys % np.uint64(256) // np.uint64(3) * np.uint64(8)
        turned = np.where(turn > 0, (fps << turn) | (fps >> (np.uint64(64) - np.maximum(turn, np.uint64(1)))), fps)
        for mask in np.unique(opened):
            bits = [bit for bit in range(BITS) if int(mask) >> bit & 1]
            for part in np.array_split(bits, 4):
                own, here = np.uint64(sum(1 << int(bit) for bit in part)), opened == mask
                finer = (keys[here] ^ own) * np.uint64(0x9E3779B97F4A7C15)
                finer = ((finer ^ (finer >> np.uint64(32))) + (turned[here] & own)) * np.uint64(0xC2B2AE3D27D4EB4F)
                finer = (finer ^ (finer >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) & ~np.uint64(255) | keys[here] % np.uint64(256)
                columns = finer, np.full(len(finer), mask & ~own), fps[here]
                yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], ["key", "open", "fp"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for key, fps in sorted_runs(batches):
        a, b = bucket_links(fps, (key & 0xFF) // 3)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])


def links(distinct: DataFrame) -> DataFrame:
    """``a, b``: links between the distinct fingerprints ``fp`` that connect all components.

    Buckets are counted first, combined before the shuffle; a large one is never
    gathered. Each round leaves three quarters of the open bits, so after at
    most six rounds a bucket holds no more distinct fingerprints than ``LARGE``.
    """
    keys = distinct.select(F.explode(chain_keys(F.col("fp"))).alias("key"), "fp")
    opened = F.element_at(F.array(*map(F.lit, OPEN)), (F.col("key").bitwiseAND(255) % 3 + 1).cast("int"))
    rows, found = keys.withColumn("open", opened), []
    while True:
        large = stored(rows.groupBy("key").count().where(F.col("count") > LARGE).select("key"), "large")
        more = large.head(1)
        small = rows.join(large, "key", "left_anti") if more else rows
        found.append(small.select("key", "fp").repartition("key").sortWithinPartitions("key").mapInArrow(_linked, "a long, b long"))
        if not more:
            return reduce(DataFrame.unionByName, found).distinct()
        rows = stored(rows.join(large, "key", "left_semi").mapInArrow(_finer, "key long, open long, fp long"), "finer")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id, version``, one row per row of ``docs``.

    Fingerprints within 3 bits link; ``component_id`` is the smallest
    ``doc_id`` reachable over links, the row's own included. Rows without text
    have fingerprint zero and link like any other. A null ``doc_id`` is never
    smallest: a component of such rows alone has a null id. Repeated rows each
    keep their row. Only ``doc_id`` and ``text`` are read; ``version`` is the
    XXH64 of the text and tells rows of one id apart.
    """
    return _grouped(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "version")


def _grouped(docs: DataFrame) -> DataFrame:
    """``doc_id, version, fp, component_id, least_version``; the last is the smallest text hash of the component."""
    hashed = stored(fingerprints(docs), "fingerprints")
    groups = stored(hashed.groupBy("fp").agg(F.min("doc_id").alias("smallest"), F.min("version").alias("least")), "groups")
    roots = components(links(groups.select("fp")))
    joined = groups.join(roots, groups["fp"] == roots["node"], "left").select(
        "fp", "smallest", "least", F.coalesce("root", "fp").alias("root"))
    lowest = joined.groupBy("root").agg(F.min("smallest").alias("component_id"), F.min("least").alias("least_version"))
    ids = joined.join(lowest, "root").select("fp", "component_id", "least_version")
    return hashed.join(ids, "fp").select("doc_id", "version", "fp", "component_id", "least_version")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those that have a near duplicate with a smaller ``doc_id``.

    Of rows repeated with id and text one stays. A null ``doc_id`` comes after all
    others; of a component of such rows alone the text with the smallest hash stays.
    """
    later = F.when(F.col("component_id").isNull(), F.col("version") != F.col("least_version")).otherwise(
        ~F.col("doc_id").eqNullSafe(F.col("component_id")))
    judged = stored(_grouped(docs).select("doc_id", "version", later.alias("later")), "near")
    i, v, mine = (unused(docs, name) for name in ("_id", "_version", "_own_version"))
    gone = judged.where("later").select(F.col("doc_id").alias(i), F.col("version").alias(v)).distinct()
    marked = docs.withColumn(mine, F.xxhash64(F.col("text").cast("string")))
    kept = marked.join(gone, F.col("doc_id").eqNullSafe(F.col(i)) & (F.col(mine) == F.col(v)), "left_anti")
    if judged.groupBy("doc_id", "version").count().where("count > 1").head(1):
        kept = kept.dropDuplicates(["doc_id", mine])
    return kept.drop(mine)
