"""The trie of all conversations' prefixes, built by van Emde Boas recursion.

Depths are cut at powers of two. Going up, the turns of every conversation are
named in blocks of 1, 2, 4, … turns, so that equal stretches have equal names.
Going down, each distinct sequence is cut at half its depth: its upper half
goes on below the same root, its lower half below the name of the cut prefix.
All pieces of one height are cut in the same round, upper and lower ones of all
conversations alike, and equal pieces below one root become one. Pieces of
height one are the nodes. Totals are then grafted upward: the sum of each
forest is added to its cut prefix, height by height, and handed down to all
nodes on the path to it.

The number of rounds is the logarithm of the longest conversation. No row holds
more than one turn's name and no task gathers a conversation, a node's members
or its children.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wikiloom.shared import new_path, stored

#: Bytes of a name. Names are SHA-256 cut short; the name of a turn also has the length of its text.
NAME = 16
ROOT = bytes(NAME)
#: Every conversation takes the first ``crc32(conv_id) % HEADS`` turns of the first one in its ``FAMILY``.
FAMILY, HEADS = 5, 9
#: Conversation ids that a task joins to one text.
IDS_PER_PARCEL = 8_192


def _hash(content: Column) -> Column:
    return F.substring(F.unhex(F.sha2(content, 256)), 1, NAME)


def _under(root: Column, piece: Column) -> Column:
    """The name of the prefix that ends with ``piece`` below ``root``."""
    return _hash(F.concat(F.lit(b"\x01"), root, piece))


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, place, turn``: the turns of a conversation from 0 on, each by its name.

    Order is by turn, null first, then by the name. Rows without ``conv_id``
    belong to no conversation. A conversation may span many tasks: a range of
    the order is numbered in each, and the counts before it are added.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    size = F.octet_length(text)
    name = F.concat(_hash(F.concat(F.lit(b"\x02"), F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))),
                    F.unhex(F.lpad(F.hex(size), 16, "0")))
    order = ["conv_id", "turn", "name"]
    rows = turns.where("conv_id is not null").select("conv_id", "turn", name.alias("name"))
    at = F.monotonically_increasing_id()
    ordered = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", F.col("name").alias("turn"), at.alias("at")).withColumn("part", F.shiftright("at", 33)), "turns")
    spans = ordered.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return ordered.join(spans, ["conv_id", "part"]).select(
        "conv_id", (F.col("before") + F.col("at") - F.col("first")).alias("place"), "turn")


def rebuilt(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Every conversation with its ``length``, and its turns, with the head of its family in place of its own.

    Turns have ``conv_id, place, turn, length``.
    """
    own = stored(numbered_turns(turns), "turns")
    sizes = stored(own.groupBy("conv_id").agg(F.count("*").alias("n")), "sizes")
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    convs = sizes.select("conv_id", "n", head.alias("head"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    heads_of = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    taken_n = F.least("head", F.coalesce("base_n", F.lit(0)))
    convs = stored(convs.join(heads_of, "base", "left").select(
        "conv_id", "base", "head", taken_n.alias("taken"),
        (taken_n + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("length")), "conversations")
    firsts = own.where(F.col("place") < heads - 1).withColumnRenamed("conv_id", "base")
    columns = ["conv_id", "place", "turn", "length"]
    taken = convs.join(firsts, "base").where("place < head").select(columns)
    rest = own.join(convs, "conv_id").where("place >= head").withColumn("place", F.expr("place - head + taken")).select(columns)
    return convs.select("conv_id", "length"), stored(taken.unionByName(rest), "rebuilt")


def named_blocks(turns: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Upward: the cuts of each height, and every conversation as one name.

    Height h, from 1 on, has ``piece, left, right, right_height, right_size``:
    what a name of up to ``2^h`` and more than ``2^(h-1)`` turns is made of.
    Conversations have ``conv_id, piece, height, size``. A conversation takes
    part until one name covers it.
    """
    blocks = turns.select("conv_id", "place", F.col("turn").alias("piece"), F.lit(0).alias("height"),
                          F.lit(1).cast("long").alias("size"), F.col("length").alias("left_over"))
    longest = turns.agg(F.coalesce(F.max("length"), F.lit(0))).first()[0]
    cuts, whole = [], []
    for height in range(1, max(longest - 1, 0).bit_length() + 1):
        whole.append(blocks.where("left_over = 1"))
        is_right, part = F.col("place") % 2 == 1, F.struct("piece", "height", "size")
        pairs = blocks.where("left_over > 1").groupBy("conv_id", F.shiftright("place", 1).alias("place")).agg(
            F.max(F.when(~is_right, part)).alias("l"), F.max(F.when(is_right, part)).alias("r"), F.max("left_over").alias("before"))
        joint = _hash(F.concat(F.lit(b"\x00"), F.col("l.piece"), F.col("r.piece")))
        made = stored(pairs.select(
            "conv_id", "place", F.coalesce(joint, F.col("l.piece")).alias("piece"),
            F.when(F.col("r").isNotNull(), height).otherwise(F.col("l.height")).alias("height"),
            (F.col("l.size") + F.coalesce("r.size", F.lit(0))).alias("size"), F.expr("(before + 1) div 2").alias("left_over"),
            F.when(F.col("r").isNotNull(), F.col("l.piece")).alias("left"), F.col("r.piece").alias("right"),
            F.col("r.height").alias("right_height"), F.col("r.size").alias("right_size")), "blocks")
        cuts.append(made.where("left is not null").select("piece", "left", "right", "right_height", "right_size").distinct())
        blocks = made.select(*blocks.columns)
    whole.append(blocks.where("left_over = 1"))
    columns = ["conv_id", "piece", "height", "size"]
    return cuts, reduce(DataFrame.unionByName, [w.select(columns) for w in whole])


def _merged(pieces: DataFrame) -> DataFrame:
    """Equal pieces below one root as one; a piece of a whole power of two has its end named."""
    same = pieces.groupBy("root", "piece").agg(
        *(F.first(c).alias(c) for c in ("depth", "height", "size")), F.max("end").alias("end"),
        F.max("sequence").alias("sequence"), F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"))
    full = F.when(F.expr("size = shiftleft(1L, height)"), _under(F.col("root"), F.col("piece")))
    return same.withColumn("end", F.coalesce("end", full))


PIECE = ["root", "piece", "depth", "height", "size", "end", "sequence", "n", "conv_id"]


def cut_pieces(sequences: DataFrame, cuts: list[DataFrame]) -> tuple[dict[int, DataFrame], DataFrame]:
    """Downward: the pieces of each height with the name ``cut`` of their upper half, and the nodes.

    ``sequences`` has ``piece, height, size, n, conv_id`` of each distinct
    sequence. A piece has the ``root`` and ``depth`` it hangs below, the name
    ``end`` of the prefix it leads to, and the ``sequence`` that ends with it.
    """
    spark = sequences.sparkSession
    path = new_path(spark, "pieces")
    start = sequences.where("size > 0").select(
        F.lit(ROOT).alias("root"), "piece", F.lit(0).cast("long").alias("depth"), "height", "size",
        F.lit(None).cast("binary").alias("end"), F.col("piece").alias("sequence"), "n", "conv_id").select(PIECE)
    start.write.partitionBy("height").mode("append").parquet(path)
    schema = start.schema
    done = {}
    for height in range(len(cuts), 0, -1):
        pieces = _merged(spark.read.schema(schema).parquet(path).where(F.col("height") == height))
        done[height] = stored(pieces.join(cuts[height - 1], "piece").withColumn("cut", _under(F.col("root"), F.col("left"))), "pieces")
        half = F.lit(1 << (height - 1)).cast("long")
        upper = done[height].select(
            "root", F.col("left").alias("piece"), "depth", F.lit(height - 1).alias("height"), half.alias("size"),
            F.col("cut").alias("end"), F.lit(None).cast("binary").alias("sequence"), "n", "conv_id")
        lower = done[height].select(
            F.col("cut").alias("root"), F.col("right").alias("piece"), (F.col("depth") + half).alias("depth"),
            F.col("right_height").alias("height"), F.col("right_size").alias("size"), "end", "sequence", "n", "conv_id")
        upper.unionByName(lower).select(PIECE).write.partitionBy("height").mode("append").parquet(path)
    return done, stored(_merged(spark.read.schema(schema).parquet(path).where("height = 0")), "nodes")


TOTALS = ["n_leaves", "saved_tokens"]


def grafted(nodes: DataFrame, done: dict[int, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """``root, piece`` and what lies below each node, and the same sums over the whole trie.

    ``nodes`` has ``root, piece`` and its own share of the totals. First the
    forests of 1, 2, 4, … levels below each root are summed; a forest that
    hangs below a cut goes into that of the root above it. Then what hangs
    below a cut is added to all nodes on the path to it, which is cut in halves
    as before.
    """
    sums = [F.sum(c).alias(c) for c in TOTALS]
    flat = stored(nodes.groupBy("root").agg(*sums), "forests")
    grafts, forests = {}, flat
    for height in range(1, len(done) + 1):
        links = done[height].select("root", "left", "cut").distinct()
        grafts[height] = stored(links.join(forests.withColumnRenamed("root", "cut"), "cut").drop("cut"), "grafts")
        forests = reduce(DataFrame.unionByName, [flat, *(g.drop("left") for g in grafts.values())]).groupBy("root").agg(*sums)
    weights = {height: [] for height in range(len(done) + 1)}
    for height in range(len(done), 0, -1):
        weights[height - 1].append(grafts[height].withColumnRenamed("left", "piece"))
        if not weights[height]:
            continue
        here = reduce(DataFrame.unionByName, weights[height]).groupBy("root", "piece").agg(*sums)
        halves = stored(here.join(done[height].select("root", "piece", "left", "right", "right_height", "cut"), ["root", "piece"]), "paths")
        weights[height - 1].append(halves.select("root", F.col("left").alias("piece"), *TOTALS))
        lower = halves.select(F.col("cut").alias("root"), F.col("right").alias("piece"), "right_height", *TOTALS)
        for below in range(height):
            weights[below].append(lower.where(F.col("right_height") == below).drop("right_height"))
    if not weights[0]:
        return nodes.limit(0).select("root", "piece", *TOTALS), forests
    return reduce(DataFrame.unionByName, weights[0]).groupBy("root", "piece").agg(*sums), forests


def ends_sha256(members: DataFrame, key: str) -> DataFrame:
    """``key, ends_sha256``: SHA-256 of the ``conv_id`` of each key's rows, ascending and joined by commas.

    Tasks join neighbouring ids of the whole order to parcels; one stream per
    key hashes its parcels in order and holds one at a time.
    """
    key_type = members.schema[key].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = (batch.column(c).to_pylist() for c in (key, "conv_id"))
            edges = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
            edges = sorted({i for start, end in zip(edges, [*edges[1:], len(keys)]) for i in range(start, end, IDS_PER_PARCEL)})
            joined = [",".join(map(str, ids[start:end])) for start, end in zip(edges, [*edges[1:], len(keys)])]
            yield pa.RecordBatch.from_arrays([pa.array([keys[i] for i in edges], pa.binary()),
                                              pa.array([ids[i] for i in edges], batch.column("conv_id").type), pa.array(joined, pa.string())],
                                             [key, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sha = None, None
        for batch in batches:
            done: tuple[list, list] = ([], [])
            for k, ids in zip(batch.column(key).to_pylist(), batch.column("ids").to_pylist()):
                if sha is not None and k == current:
                    sha.update(b"," + ids.encode())
                    continue
                if sha is not None:
                    done[0].append(current)
                    done[1].append(sha.hexdigest())
                current, sha = k, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.binary()), pa.array(done[1], pa.string())], [key, "ends_sha256"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([sha.hexdigest()], pa.string())], [key, "ends_sha256"])

    id_type = members.schema["conv_id"].dataType.simpleString()
    parcels = (members.select(key, "conv_id").repartitionByRange(key, "conv_id").sortWithinPartitions(key, "conv_id")
               .mapInArrow(pack, f"{key} {key_type}, first {id_type}, ids string"))
    return (parcels.repartition(key).sortWithinPartitions(key, "first")
            .mapInArrow(digest, f"{key} {key_type}, ends_sha256 string"))


NO_ENDS = hashlib.sha256(b"").hexdigest()
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations, the root included.

    ``conv_id`` is the node's smallest member, ``parent_conv_id`` its parent's;
    members, children, leaves below, tokens saved by sharing, and the members
    that end there, as in the module's text. Null role and text count as empty,
    null turns come first, equal turns are ordered by a hash of role and text,
    repeated rows are turns each. Rows without ``conv_id`` are in no conversation. A
    table without conversations gives no rows.
    """
    convs, rows = rebuilt(turns, family, heads)
    cuts, named = named_blocks(rows)
    zero = F.lit(0).cast("long")
    turnless = convs.where("length = 0").select("conv_id", F.lit(ROOT).alias("piece"), F.lit(0).alias("height"), zero.alias("size"))
    members = stored(named.unionByName(turnless), "members")
    sequences = stored(members.groupBy("piece").agg(
        F.first("height").alias("height"), F.first("size").alias("size"), F.count("*").alias("n"), F.min("conv_id").alias("conv_id")), "sequences")
    done, merged = cut_pieces(sequences, cuts)

    children = merged.groupBy(F.col("root").alias("end")).agg(F.count("*").alias("n_children"))
    size = F.conv(F.hex(F.substring("piece", NAME + 1, 8)), 16, 10).cast("long")
    own = stored(merged.join(children, "end", "left").select(
        "root", "piece", "end", "sequence", F.col("conv_id"), (F.col("depth") + 1).alias("depth"), F.col("n").alias("n_convs"),
        F.coalesce("n_children", zero).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n") - 1) * size).alias("saved_tokens")), "own")
    below, forests = grafted(own, done)
    below = below.select("root", "piece", *(F.col(c).alias(f"below_{c}") for c in TOTALS))
    full = own.join(below, ["root", "piece"], "left").withColumns(
        {c: F.col(c) + F.coalesce(f"below_{c}", F.lit(0)) for c in TOTALS})

    whole = sequences.agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs")).where("n_convs > 0")  # one row
    top = whole.select(F.lit(ROOT).alias("end"), "conv_id", "n_convs")
    total = forests.where(F.col("root") == F.lit(ROOT)).select(F.col("root").alias("end"), *TOTALS)
    first = own.where("depth = 1").agg(F.count("*").alias("n_children")).select(F.lit(ROOT).alias("end"), "n_children")
    root = top.join(total, "end", "left").join(first, "end", "left").select(
        F.lit(ROOT).alias("sequence"), "conv_id", zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"), F.coalesce("saved_tokens", zero).alias("saved_tokens"))
    parents = own.select(F.col("end").alias("root"), F.col("conv_id").alias("parent_conv_id")).unionByName(
        top.select(F.col("end").alias("root"), F.col("conv_id").alias("parent_conv_id")))
    nodes = full.join(parents, "root", "left").select(root.columns).unionByName(root)
    ends = ends_sha256(members, "piece").withColumnRenamed("piece", "sequence")
    return nodes.join(ends, "sequence", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))).select(COLUMNS)
