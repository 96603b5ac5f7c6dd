"""Token ids in raw shard files, with a minimal perfect hash index over the documents.

Documents are put in order, encoded, and written by the task that holds a range
of them as one shard: a header, the raw ids, the end of each document. The index
maps a document key to the place of its ids without storing the keys: keys are
dealt to buckets by hash, and in a bucket a cascade of bit fields gives each key
a slot of its own. A slot holds a fingerprint, which tells foreign keys, and the
place. A lookup evaluates a few hashes and reads one slot.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wikiloom.operators.counts import BUCKET_WIDTH, bucket_starts
from wikiloom.shared import new_path, stored

#: Id that ends each document.
END_ID = 0
#: Text bytes that a shard is made of, about; a document counts ROW_BYTES more.
SHARD_BYTES, ROW_BYTES = 64 << 20, 64
#: A shard file: these fields, the ids, the end of each document (8 bytes), the number of documents (8 bytes).
MAGIC, HEADER, HEADER_BYTES = b"TIDS", "<4sI", 8
#: Keys of an index bucket, about.
BUCKET_KEYS = 32_768
#: Unread bytes that a ranged read may span, and its size about; bytes of ids that a reading task gets.
GAP, RANGE_BYTES, TASK_BYTES = 64 << 10, 4 << 20, 64 << 20
#: Bytes of known pieces that an encoder keeps, and those of an entry beside its content.
KNOWN_BYTES, ENTRY_BYTES = 176 << 20, 200
#: Text bytes that an encoder cuts at once, about; new pieces that it gives the library in one call.
CHUNK_BYTES, CALL_PIECES = 4 << 20, 500


# --- encoding --------------------------------------------------------------

class Encoder(dict):
    """Ids of texts as little-endian bytes, 2 or 4 an id, equal to what the library gives for the whole text.

    Where the tokenizer cuts a text into parts before it merges bytes, texts are
    cut here at places that always lie between two parts: before the last
    white space ahead of other text, after it unless it is a space, before
    white space after other text, and before punctuation that follows a letter
    or digit. The different pieces of some texts are looked up together; new
    ones are encoded, many in a call, and remembered: this is the dictionary of
    pieces to ids. Other tokenizers, and texts that spell a special token, get
    whole texts.
    """

    # What a byte is: the letters are those of ASCII and from U+00C0 to U+023F, known by their last byte.
    _OTHER, _SPACE, _BREAK, _WORD, _STOP, _LEAD = range(6)
    _KIND = np.full(256, _OTHER, np.uint8)
    _KIND[0x21:0x7F] = _STOP
    for _first, _last in ("09", "AZ", "az"):
        _KIND[ord(_first):ord(_last) + 1] = _WORD
    _KIND[0x09:0x0E], _KIND[0x20], _KIND[0xC2:0xF5] = _BREAK, _SPACE, _LEAD
    _WIDE = [c.encode() for c in "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))]
    _WIDE_2 = [int.from_bytes(c, "big") for c in _WIDE if len(c) == 2]
    _WIDE_3 = [int.from_bytes(c, "big") for c in _WIDE if len(c) == 3]
    # By the kinds of two neighbours: a cut between them, a cut before both.
    _BETWEEN, _BEFORE = np.zeros((6, 6), bool), np.zeros((6, 6), bool)
    _BETWEEN[_WORD, _STOP] = True
    _BETWEEN[_WORD, [_SPACE, _BREAK]] = _BETWEEN[_STOP, [_SPACE, _BREAK]] = True
    _BETWEEN[_BREAK, [_WORD, _STOP, _LEAD]] = True
    _BEFORE[_SPACE, [_WORD, _STOP, _LEAD]] = _BEFORE[_BREAK, [_WORD, _STOP, _LEAD]] = True
    _BETWEEN, _BEFORE = _BETWEEN.ravel(), _BEFORE.ravel()

    def __init__(self, tokenizer_json: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.dtype = id_type(tokenizer_json)
        self.width = int(self.dtype[-1])
        self.end = np.array([END_ID], self.dtype).tobytes()
        spec = json.loads(tokenizer_json)
        cut = spec.get("pre_tokenizer") or {}
        self.cuts = (spec.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
                     and not cut.get("add_prefix_space")
                     and all(spec.get(part) is None for part in ("post_processor", "truncation", "padding")))
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.held = 0

    def _starts(self, raw: np.ndarray, ends: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Where pieces of the texts in ``raw`` start, texts that are ``whole`` having one."""
        start = np.zeros(len(raw) + 2, bool)
        if self.cuts and not whole.all():
            kind = self._KIND[raw]
            at = np.flatnonzero(kind == self._LEAD)
            first, second, third = (np.take(raw, at + i, mode="clip").astype(np.int32) for i in range(3))
            latin = (first >= 0xC3) & (first <= 0xC8) & ((first > 0xC3) | (second & 0xDF != 0x97))  # but not U+00D7, U+00F7
            kind[at[latin] + 1] = self._WORD
            two = first << 8 | second
            kind[at[np.isin(two, self._WIDE_2) | np.isin(two << 8 | third, self._WIDE_3)]] = self._OTHER
            pair = kind[:-1] * np.uint8(6) + kind[1:]
            pair[ends[(ends > 0) & (ends < len(raw))] - 1] = 0  # neighbours in two texts
            start[1:len(pair) + 1] = self._BETWEEN[pair]
            start[:len(pair)] |= self._BEFORE[pair]
        for i in np.flatnonzero(whole):
            start[ends[i - 1] if i else 0:ends[i]] = False
        start[0] = True
        start[ends] = True
        return np.flatnonzero(start[:len(raw)])

    def _encoded(self, piece: bytes) -> bytes:
        return np.array(self.tokenizer.encode(piece.decode(), add_special_tokens=False).ids, self.dtype).tobytes()

    def _learn(self, pieces: list[bytes]) -> None:
        """Encodes new pieces of cut texts, ``CALL_PIECES`` a call."""
        for i in range(0, len(pieces), CALL_PIECES):
            some = pieces[i:i + CALL_PIECES]
            got = self.tokenizer.encode([piece.decode() for piece in some], is_pretokenized=True, add_special_tokens=False)
            ids = np.array(got.ids, self.dtype).tobytes()
            ends = np.bincount(np.array(got.word_ids, np.int64), minlength=len(some)).cumsum() * self.width
            at = 0
            for piece, end in zip(some, ends.tolist()):
                self[piece] = ids[at:end]
                at = end

    def _ids(self, raw: np.ndarray, ends: np.ndarray, whole: np.ndarray) -> tuple[pa.Buffer, np.ndarray]:
        """Ids of the texts in ``raw``, and the end of each in bytes."""
        starts = self._starts(raw, ends, whole)
        cut = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(raw))), pa.py_buffer(raw)])
        found = cut.dictionary_encode()
        pieces = _contents(found.dictionary)
        data = list(map(self.get, pieces))
        new = [i for i, known in enumerate(data) if known is None]
        if new:
            wanted = [pieces[i] for i in new]
            if self.cuts and not whole.any():
                self._learn(wanted)
            else:
                special = [token.encode() for token in self.special]
                alone = [not self.cuts or any(token in piece for token in special) for piece in wanted]
                self.update((piece, self._encoded(piece)) for piece, one in zip(wanted, alone) if one)
                self._learn([piece for piece, one in zip(wanted, alone) if not one])
            for i, piece in zip(new, wanted):
                data[i] = self[piece]
            self.held += sum(ENTRY_BYTES + len(piece) + len(self[piece]) for piece in wanted)
            if self.held > KNOWN_BYTES:
                self.clear()
                self.held = 0
        before = np.searchsorted(starts, ends)  # pieces before the end of each text
        codes = np.insert(found.indices.to_numpy(), before, len(pieces))
        ids = pa.array([*data, self.end], pa.large_binary()).take(pa.array(codes))
        places = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)
        return ids.buffers()[2].slice(0, int(places[-1])), places[before + np.arange(1, len(ends) + 1)]

    def encode_all(self, texts: pa.Array) -> Iterator[tuple[pa.Buffer, np.ndarray]]:
        """Ids of the texts one after the other, with the end of each in ids, for some ``CHUNK_BYTES`` of text at a time."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        whole = np.full(len(texts), not self.cuts)
        for token in self.special if self.cuts else []:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + CHUNK_BYTES, "right")) - 1)
            data, places = self._ids(raw[ends[at]:ends[to]], ends[at + 1:to + 1] - ends[at], whole[at:to])
            yield data, places // self.width
            at = to

    def encode(self, text: str | None) -> bytes:
        return b"".join(data.to_pybytes() for data, _ in self.encode_all(pa.array([text], pa.string())))


def _contents(values: pa.Array) -> list[bytes]:
    """``to_pylist()`` of large binary values that start at the first, several times faster."""
    if not len(values):
        return []
    ends = np.frombuffer(values.buffers()[1], np.int64, len(values) + 1).tolist()
    data = values.buffers()[2].slice(0, ends[-1]).to_pybytes()
    return [data[start:end] for start, end in zip(ends, ends[1:])]


@lru_cache(maxsize=1)
def encoder_of(tokenizer_json: str) -> Encoder:
    """Kept by the Python worker, so that its next task knows the pieces of the last one."""
    return Encoder(tokenizer_json)


def id_type(tokenizer_json: str) -> str:
    """Two bytes an id if the vocabulary allows it."""
    spec = json.loads(tokenizer_json)
    ids = [*spec["model"]["vocab"].values(), *(t["id"] for t in spec.get("added_tokens", []))]
    return "<u2" if max(ids, default=0) < 1 << 16 else "<u4"


# --- shards ----------------------------------------------------------------

def _uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def write_shards(docs: DataFrame, path: str, tokenizer_json: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode ``docs`` and write their ids in ascending ``doc_id`` order below ``path``.

    Returns the stored ``doc_id, shard, file, ordinal, offset, length`` of each
    document: its number in the shard and its place there, in ids. A task that
    is run again writes a file of its own; only those of finished tasks are
    listed. Null ids come first, null texts are empty, equal ids are ordered by
    a hash of the text, repeated rows are documents each.
    """
    folder = f"{_uri(path)}/ids"
    text = F.col("text").cast("string")
    total = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES)).first()[0] or 0
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("row"))
    order = ["doc_id", "hash", "row"]  # a text that a third of the rows repeat is split by the row
    ordered = rows.repartitionByRange(-(-total // shard_bytes) or 1, *order).sortWithinPartitions(*order).select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # a vocabulary file of a few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, (store, place), out = encoder_of(shared.value), fs.FileSystem.from_uri(folder), None
        shard, name, at, ends = TaskContext.get().partitionId(), f"{uuid.uuid4().hex}.ids", 0, [np.empty(0, np.int64)]
        first = 0
        for batch in batches:
            if out is None and batch.num_rows:
                store.create_dir(place, recursive=True)
                out = store.open_output_stream(f"{place}/{name}", compression=None)
                out.write(struct.pack(HEADER, MAGIC, encoder.width))
            n, start, some = batch.num_rows, at, []
            for data, places in encoder.encode_all(batch.column("text")):
                out.write(data)
                some.append(at + places)
                at = int(some[-1][-1])
            ends += some
            stops = np.concatenate([[start], *some])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([shard] * n, pa.int64()), pa.array([name] * n, pa.string()),
                 pa.array(range(first, first + n), pa.int64()), pa.array(stops[:-1], pa.int64()), pa.array(np.diff(stops), pa.int64())],
                ["doc_id", "shard", "file", "ordinal", "offset", "length"])
            first += n
        if out is not None:
            out.write(np.concatenate(ends).astype("<u8").tobytes() + struct.pack("<Q", first))
            out.close()

    schema = T.StructType([docs.schema["doc_id"], T.StructField("shard", T.LongType()), T.StructField("file", T.StringType()),
                           *(T.StructField(c, T.LongType()) for c in ("ordinal", "offset", "length"))])
    return stored(ordered.mapInArrow(run, schema), "places")


def read_shard(data: bytes) -> list[np.ndarray]:
    """All documents of a shard file, without an index."""
    magic, width = struct.unpack_from(HEADER, data)
    if magic != MAGIC:
        raise ValueError("not a file of token ids")
    n = struct.unpack("<Q", data[-8:])[0]
    ends = np.frombuffer(data, "<u8", n, len(data) - 8 - 8 * n)
    ids = np.frombuffer(data, f"<u{width}", int(ends[-1]) if n else 0, HEADER_BYTES)
    return np.split(ids, ends[:-1].astype(np.int64)) if n else []


def shard_starts(places: DataFrame) -> DataFrame:
    """``shard, file``, and the documents and ids of all shards before it."""
    shards = stored(places.groupBy("shard", "file").agg(
        F.count("*").alias("docs"), F.sum("length").alias("ids")), "shards")
    most, levels = shards.agg(F.max("shard")).first()[0] or 0, 0
    while most >= BUCKET_WIDTH:
        most, levels = most // BUCKET_WIDTH, levels + 1

    def before(column: str) -> DataFrame:
        sums = bucket_starts(shards.select(F.col("shard").alias("_bucket"), F.col(column).alias("_n")), BUCKET_WIDTH, levels)
        return sums.select(F.col("_bucket").alias("shard"), F.col("_start").cast("long").alias(f"{column}_before"))

    return stored(shards.select("shard", "file").join(before("docs"), "shard").join(before("ids"), "shard"), "shards")


# --- index -----------------------------------------------------------------

SLOT = np.dtype([("print", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("length", "<u8")])


def _mixed(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    """64 well-mixed bits of a key's two hashes, other ones at each level."""
    x = a ^ (b + np.uint64((0x9E3779B97F4A7C15 * (2 * level + 1)) % (1 << 64)))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _fields(a: np.ndarray, b: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit fields of a bucket, and the slot of each of its keys.

    A key takes the bit it falls on if no other key does; those that meet go on
    to a smaller field. The slot is the number of set bits before.
    """
    left, fields, slots, used = np.arange(len(a)), [], np.empty(len(a), np.int64), 0
    while len(left):
        size = max(64, 2 * len(left))
        at = (_mixed(a[left], b[left], len(fields)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        mine = alone[at]
        slots[left[mine]] = used + (np.cumsum(alone) - 1)[at[mine]]
        used += int(alone.sum())
        fields.append(alone)
        left = left[~mine]
    return fields, slots


def _slots(fields: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The slot of each key, -1 for those that fall on no set bit."""
    slots, left, used = np.full(len(a), -1, np.int64), np.arange(len(a)), 0
    for level, field in enumerate(fields):
        at = (_mixed(a[left], b[left], level) % np.uint64(len(field))).astype(np.int64)
        hit = field[at]
        slots[left[hit]] = used + (np.cumsum(field) - 1)[at[hit]]
        used += int(field.sum())
        left = left[~hit]
    return slots


def _hashes(keys: DataFrame, buckets: int) -> DataFrame:
    """Adds the two hashes of ``doc_id, copy`` and their ``bucket``."""
    key = [F.col("doc_id").cast("string"), F.col("copy").cast("long")]
    hashed = keys.withColumns({"a": F.xxhash64(F.lit(1), *key), "b": F.xxhash64(F.lit(2), *key)})
    return hashed.withColumn("bucket", F.pmod(F.xxhash64("a", "b"), F.lit(buckets)))


def with_copy(places: DataFrame, starts: DataFrame) -> DataFrame:
    """Adds ``copy``: 0 for the first document of an id, counting on where ids repeat."""
    number = F.col("docs_before") + F.col("ordinal")
    numbered = places.join(starts.drop("file", "ids_before"), "shard").withColumn("number", number).drop("docs_before")
    again = (numbered.groupBy(F.col("doc_id").alias("id")).agg(F.min("number").alias("first"), F.count("*").alias("n"))
             .where("n > 1").drop("n"))
    return (numbered.join(again, F.col("doc_id").eqNullSafe(F.col("id")), "left")
            .withColumn("copy", F.coalesce(F.col("number") - F.col("first"), F.lit(0))).drop("id", "first", "number"))


def build_index(places: DataFrame, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """The stored index of ``doc_id, copy, shard, offset, length``: a row per bucket.

    ``bucket``, its number of keys ``n``, the keys of all buckets before it
    ``before``, the ``sizes`` and ``bits`` of its fields, and its ``slots``. The
    keys themselves are not stored.
    """
    buckets = -(-places.count() // bucket_keys) or 1

    def build(bucket: pa.Table) -> pa.Table:
        a, b = (bucket[c].to_numpy().view(np.uint64) for c in ("a", "b"))
        fields, slots = _fields(a, b)
        table = np.empty(len(a), SLOT)
        for name, values in (("print", b >> np.uint64(32)), *((c, bucket[c].to_numpy()) for c in ("shard", "offset", "length"))):
            table[name][slots] = values
        return pa.table({
            "bucket": bucket["bucket"][:1], "n": pa.array([len(a)], pa.int64()), "sizes": pa.array([[len(f) for f in fields]], pa.list_(pa.int64())),
            "bits": pa.array([np.packbits(np.concatenate(fields)).tobytes()], pa.binary()), "slots": pa.array([table.tobytes()], pa.binary())})

    keys = _hashes(places.select("doc_id", "copy", "shard", "offset", "length"), buckets).drop("doc_id", "copy")
    rows = stored(keys.groupBy("bucket").applyInArrow(build, "bucket long, n long, sizes array<long>, bits binary, slots binary"), "buckets")
    levels, most = 0, buckets
    while most > BUCKET_WIDTH:
        most, levels = most // BUCKET_WIDTH, levels + 1
    before = bucket_starts(rows.select(F.col("bucket").alias("_bucket"), F.col("n").alias("_n")), BUCKET_WIDTH, levels)
    full = rows.join(before.select(F.col("_bucket").alias("bucket"), F.col("_start").cast("long").alias("before")), "bucket")
    return stored(full.withColumn("buckets", F.lit(buckets)), "index")


def lookup(index: DataFrame, keys: DataFrame) -> DataFrame:
    """``doc_id, copy, rank, shard, offset, length`` of the ``keys`` that the index has.

    ``keys`` has different ``doc_id, copy``. ``rank`` is the key's number under
    the perfect hash, from 0 without gaps. A foreign key is taken for one of
    the index with odds of one in four billion.
    """
    head = index.select("buckets").first()
    schema = T.StructType([keys.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("copy", "rank", "shard", "offset", "length"))])

    def find(asked: pa.Table, bucket: pa.Table) -> pa.Table:
        columns = {c: asked[c] for c in ("doc_id", "copy")}
        slots, table = np.full(asked.num_rows, -1, np.int64), np.empty(0, SLOT)
        if bucket.num_rows and asked.num_rows:
            row = bucket.to_pylist()[0]
            a, b = (asked[c].to_numpy().view(np.uint64) for c in ("a", "b"))
            bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[:sum(row["sizes"])].astype(bool)
            slots = _slots(np.split(bits, np.cumsum(row["sizes"])[:-1]), a, b)
            table = np.frombuffer(row["slots"], SLOT)
            known = slots >= 0
            known[known] = table["print"][slots[known]] == b[known] >> np.uint64(32)
            slots[~known] = -1
            columns["rank"] = pa.array(slots + row["before"], pa.int64())
        found = slots >= 0
        columns.setdefault("rank", pa.array(slots, pa.int64()))
        out = pa.table({c: columns[c] for c in ("doc_id", "copy", "rank")}).filter(pa.array(found))
        for name in ("shard", "offset", "length"):
            out = out.append_column(name, pa.array(table[name][slots[found]].astype(np.int64)))
        return out

    asked = _hashes(keys.select("doc_id", F.col("copy").cast("long").alias("copy")), head[0] if head else 1)
    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(find, schema)


# --- reading ---------------------------------------------------------------

def read_ids(found: DataFrame, path: str) -> DataFrame:
    """The rows of ``found`` (with ``file, offset, length``) and their ``ids``, little-endian and 4 bytes each.

    Neighbouring places are read at once. The number of tasks follows from the
    summed lengths.
    """
    folder = f"{_uri(path)}/ids"
    columns = found.columns

    def fetched(store, name: str, rows: list[tuple[int, int]]) -> list[bytes]:
        """Ids of places in rising order, by as few reads as the gaps allow."""
        with store.open_input_file(name) as file:
            magic, width = struct.unpack(HEADER, file.read_at(HEADER_BYTES, 0))
            if magic != MAGIC:
                raise ValueError(f"{name}: not a file of token ids")
            out, i = [], 0
            while i < len(rows):
                start, end, j = rows[i][0], sum(rows[i]), i + 1
                while j < len(rows) and (rows[j][0] - end) * width <= GAP and (sum(rows[j]) - start) * width <= RANGE_BYTES:
                    end, j = max(end, sum(rows[j])), j + 1
                data = np.frombuffer(file.read_at((end - start) * width, HEADER_BYTES + start * width), f"<u{width}")
                out += [data[at - start:at - start + n].astype("<u4").tobytes() for at, n in rows[i:j]]
                i = j
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = fs.FileSystem.from_uri(folder)
        for batch in batches:
            files, offsets, lengths = (batch.column(c).to_pylist() for c in ("file", "offset", "length"))
            start = 0
            while start < len(files):
                end, held = start, 0
                while end < len(files) and files[end] == files[start] and (held == 0 or held + 4 * lengths[end] <= 2 * RANGE_BYTES):
                    held, end = held + 4 * lengths[end], end + 1
                ids = fetched(store, f"{place}/{files[start]}", list(zip(offsets[start:end], lengths[start:end])))
                rows = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(ids, pa.binary())], [*columns, "ids"])
                start = end

    n_bytes = found.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0] * 4
    part = F.floor(F.col("offset") * 4 / TASK_BYTES)
    dealt = found.repartition(-(-n_bytes // TASK_BYTES) or 1, "file", part).sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(run, T.StructType([*found.schema, T.StructField("ids", T.BinaryType())]))


def round_trip(docs: DataFrame, tokenizer_json: str, path: str | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``doc_id, copy, start, length, ids`` of every document, found by its key and read from the shards.

    ``start`` is the number of ids before it, in the order of :func:`write_shards`,
    where odd rows are defined. An empty table gives no rows.
    """
    path = path or new_path(docs.sparkSession, "tokens")
    places = write_shards(docs, path, tokenizer_json, shard_bytes)
    starts = shard_starts(places)
    keyed = stored(with_copy(places, starts), "keyed")
    index = build_index(keyed)
    found = stored(lookup(index, keyed.select("doc_id", "copy")), "found")
    placed = found.join(starts.drop("docs_before"), "shard").withColumn("start", F.col("ids_before") + F.col("offset"))
    return read_ids(placed.select("doc_id", "copy", "file", "offset", "length", "start"), path).select(
        "doc_id", "copy", "start", "length", "ids")
