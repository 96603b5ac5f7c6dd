"""Shards of near equal bytes by histogram sort.

Rows are ordered by a 64-bit key: 40 bits of the text's hash, then 24 bits of
the ``doc_id``'s, so equal texts lie together and a large group of them can
still be cut. Rows that agree in both are counted; where such a group is large,
the low bits come from the whole row and its number among equal rows. Probes between the bounds of each splitter are counted exactly
over all partitions, a job a round, until the bytes below each splitter are
within tolerance or no key lies between the bounds. Then the rows move once.

A shard is cut into pieces by further splitters, so a task sorts a piece, not a
shard; the exact rows below each splitter turn places in a piece into slots.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wikiloom.llm.copies import collapsed, numbered, row_hash
from wikiloom.shared import stored, unused

ROW_BYTES = 8
TOLERANCE = 0.001
PROBES = 31
#: Share of a piece by which a cut inside a shard may be off.
INNER_TOLERANCE = 0.25
#: Bytes in a piece about, and the most pieces of one sort: bounds what the driver holds.
PIECE_BYTES, MAX_PIECES = 64 << 20, 1 << 16
#: Rows of one id and text that may stay together whatever their size.
TOGETHER = 8
LOW_BITS = (1 << 24) - 1
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def size_of(text: Column) -> Column:
    """UTF-8 bytes of the text plus 8; a null text has no bytes."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def key_of(doc_id: Column, text: Column) -> Column:
    return _with_low_bits(F.xxhash64(text), F.xxhash64(doc_id))


def _with_low_bits(key: Column, other: Column) -> Column:
    return key.bitwiseAND(F.lit(~LOW_BITS)).bitwiseOR(other.bitwiseAND(F.lit(LOW_BITS)))


def count_below(keyed: DataFrame, probes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows with a key below each of the sorted probes."""
    edges = np.array(probes, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = np.zeros(len(edges) + 1, np.int64), np.zeros(len(edges) + 1, np.int64)
        for batch in batches:
            bins = np.searchsorted(edges, batch.column("key").to_numpy(), side="right")
            np.add.at(size, bins, batch.column("size").to_numpy())
            rows += np.bincount(bins, minlength=len(rows))
        full = np.nonzero(rows)[0]
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(size[full]), pa.array(rows[full])], ["bin", "size", "rows"])

    found = (keyed.select("key", "size").mapInArrow(run, "bin long, size long, rows long")
             .groupBy("bin").agg(F.sum("size").alias("size"), F.sum("rows").alias("rows")).toPandas())  # a row per probe
    size, rows = np.zeros(len(edges) + 1, np.int64), np.zeros(len(edges) + 1, np.int64)
    size[found["bin"]], rows[found["bin"]] = found["size"], found["rows"]
    return np.cumsum(size)[:-1], np.cumsum(rows)[:-1]


def splitters(keyed: DataFrame, total: int, n_pieces: int, exact: set[int], tolerance: int) -> tuple[list[int], list[int]]:
    """Keys that cut ``keyed`` into pieces of near equal bytes, and the rows below each.

    Splitter ``i`` is to have ``i / n_pieces`` of the bytes below it. Those in
    ``exact`` are refined until within ``tolerance``, the others, cuts inside a
    shard, until within a share of a piece; either stops between neighbouring
    keys. Each stays at its index, a cut between the exact ones around it.
    """
    goals = [total * i // n_pieces for i in range(1, n_pieces)]
    within = [tolerance if i + 1 in exact else max(tolerance, int(total / n_pieces * INNER_TOLERANCE)) for i in range(len(goals))]
    low = {i: (LOWEST, 0, 0) for i in range(len(goals))}
    high = {i: (HIGHEST, total, None) for i in low}
    best: dict[int, tuple[int, int, int]] = {i: (total, LOWEST, 0) for i in low}
    open_ = set(low)
    while open_:
        sharp = {(low[i][0], high[i][0]) for i in open_ if i + 1 in exact}
        rough = {(low[i][0], high[i][0]) for i in open_} - sharp
        fewer = max(1, min(PROBES, MAX_PIECES // max(len(rough), 1)))  # bounds the probes of a round
        probes = sorted({a + (b - a) * j // (n + 1) for bounds, n in ((sharp, PROBES), (rough, fewer)) for a, b in bounds for j in range(1, n + 1)}
                        | {a + 1 for a, b in sharp | rough if b > a + 1})
        size, rows = count_below(keyed, probes)
        at = np.searchsorted(size, [goals[i] for i in sorted(open_)])
        for i, k in zip(sorted(open_), at):
            for j in (k - 1, k):
                if 0 <= j < len(probes):
                    best[i] = min(best[i], (abs(int(size[j]) - goals[i]), probes[j], int(rows[j])))
            if k > 0 and probes[k - 1] > low[i][0]:
                low[i] = (probes[k - 1], int(size[k - 1]), int(rows[k - 1]))
            if k < len(probes) and probes[k] < high[i][0]:
                high[i] = (probes[k], int(size[k]), int(rows[k]))
        open_ = {i for i in open_ if best[i][0] > within[i] and high[i][0] - low[i][0] > 1 and high[i][1] > low[i][1]}
    found = _in_order([best[i][1:] for i in range(len(goals))], exact)
    return [key for key, _ in found], [rows for _, rows in found]


def _in_order(found: list[tuple[int, int]], exact: set[int]) -> list[tuple[int, int]]:
    """Key and rows of each splitter, rising; those in ``exact`` keep their index, the others lie between them."""
    ends = [i - 1 for i in sorted(exact)]
    fixed = dict(zip(ends, sorted(found[i] for i in ends)))
    out, least = [], (LOWEST, 0)
    for start, end in zip([0, *(i + 1 for i in ends)], [*ends, len(found)]):
        out += [max(least, min(cut, fixed.get(end, cut))) for cut in sorted(found[start:end])]
        if end in fixed:
            out.append(least := fixed[end])
    return out


def shard_bytes(docs: DataFrame, n_shards: int = 24, tolerance: float = TOLERANCE, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """The rows of ``docs`` with ``size, text_crc32, shard, slot`` (these replace columns of such names).

    ``size``: UTF-8 bytes plus 8. Shards 0 to ``n_shards - 1`` hold near equal
    sizes, off by ``tolerance`` of a shard, or by one row where rows are larger
    than that; up to ``TOGETHER`` rows that agree in ``doc_id`` and text may
    stay together, larger groups are cut. ``slot`` counts a shard's rows from 0
    without gaps. A null text counts as empty (size 8, crc 0); null ids are
    allowed, in any number; repeated rows get a slot each. An empty table gives
    no rows. A task sorts ``piece_bytes`` about.
    """
    text = F.col("text").cast("string")
    rows = docs.withColumns({"size": size_of(text), "text_crc32": F.crc32(F.coalesce(text, F.lit("")).cast("binary"))})
    rows = rows.drop("shard", "slot")
    k = unused(rows, "_key")
    rows = rows.withColumn(k, key_of(F.col("doc_id"), text))
    keyed = stored(rows.select(F.col(k).alias("key"), "size"), "keys")
    total = keyed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    rows, keyed = _cut_heavy(rows, k, keyed, int(total / n_shards * tolerance))
    per_shard = max(1, min(MAX_PIECES // n_shards, -(-total // (n_shards * piece_bytes))))
    exact = {i * per_shard for i in range(1, n_shards)}
    keys, below = splitters(keyed, total, n_shards * per_shard, exact, int(total / n_shards * tolerance)) if total else ([], [])
    first = [0, *below]  # rows before each piece
    starts = [first[i // per_shard * per_shard] if i // per_shard * per_shard < len(first) else 0 for i in range(len(first))]
    table = [(i, i // per_shard, first[i] - starts[i]) for i in range(len(first))]
    return _exchanged(rows, k, keys, table)


def _cut_heavy(rows: DataFrame, k: str, keyed: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` and ``keyed`` with keys of their own for rows of a key with more than ``limit`` bytes.

    There are at most ``n_shards / tolerance`` such keys, so they are sent to
    all tasks. Their rows are collapsed to distinct ones before they move, and
    dealt out again by number.
    """
    heavy = stored(keyed.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
                   .where((F.col("rows") > TOGETHER) & (F.col("bytes") > limit)).select("key"), "heavy")
    if not heavy.head(1):
        return rows, keyed
    c, n, h = (unused(rows, name) for name in ("_count", "_number", "_heavy"))
    keys = F.broadcast(heavy.select(F.col("key").alias(h)))
    equal = stored(collapsed(rows.join(keys, F.col(k) == F.col(h), "left_semi"), c), "equal")
    single = numbered(equal, c, n).withColumn(k, _with_low_bits(F.col(k), F.xxhash64(row_hash(rows), n))).drop(n)
    rows = rows.join(keys, F.col(k) == F.col(h), "left_anti").unionByName(single)
    light = keyed.join(F.broadcast(heavy), "key", "left_anti")
    return rows, stored(light.unionByName(single.select(F.col(k).alias("key"), "size")), "keys")


def _exchanged(rows: DataFrame, k: str, keys: list[int], table: list[tuple[int, int, int]]) -> DataFrame:
    @F.pandas_udf("int")
    def piece(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(keys, np.int64), key.to_numpy(), side="right").astype(np.int32))

    p, n, b = (unused(rows, name) for name in ("_piece", "_place", "_before"))
    pieces = F.broadcast(rows.sparkSession.createDataFrame(table, f"{p} int, shard int, {b} long"))  # MAX_PIECES rows at most
    place = Window.partitionBy(p).orderBy(k, "doc_id", "text_crc32")
    return (rows.withColumn(p, piece(k)).withColumn(n, F.row_number().over(place) - 1)
            .join(pieces, p).withColumn("slot", F.col(b) + F.col(n)).drop(k, p, n, b))
