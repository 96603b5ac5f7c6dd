"""The corpus operators where one host, range, row or text holds most of the rows, bytes or matches."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from wikiloom.llm import copies, host_rules, mixing, secrets, sharding, simhash, substring, warc
from wikiloom.llm.components import components
from wikiloom.shared import new_path

RNG = random.Random(5)
DOCS = "doc_id long, text string, source string, _row string, _counts string, _host string"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hosts():
    """A hot host with a third of the rows, a bad host, others; null among them."""
    good = lambda: " ".join(RNG.choice("abcdefghij") + str(RNG.randint(0, 10**6)) for _ in range(60))
    rows = [(i, good(), ["hot", "b", None][i % 3] if i % 9 else f"h{i}", "r", "c", "h") for i in range(300)]
    rows += [(1000 + i, "too short" if i % 20 else good(), "bad", "r", "c", "h") for i in range(400)]
    return rows


@pytest.mark.parametrize("most", [10_000, 0])
def test_keep_good_with_rejected_hosts(spark, most):
    rows = hosts()
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    kept = host_rules.keep_good(docs, most_broadcast=most)
    assert kept.columns == docs.columns
    want = {r.doc_id for r in host_rules.apply_rules(docs).collect() if r.kept}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    assert not any(1000 <= i for i in want) and len(want) > 200


def test_texts_stay_where_they_are(spark):
    rows = hosts()
    some = host_rules.keep_good(spark.createDataFrame(rows, DOCS).repartition(4))
    none = host_rules.keep_good(spark.createDataFrame(rows[:300], DOCS).repartition(4))
    assert "Exchange hashpartitioning" not in plan_of(some) and "BroadcastExchange" in plan_of(some)
    assert "Exchange" not in plan_of(none) and none.count() == 300


def test_ranges_are_dealt_by_their_bytes(spark):
    rows = [(i, f"http://e.org/{i}", "".join(RNG.choice("abcdef ") for _ in range(3000))) for i in range(1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    path = "file://" + new_path(spark, "warc")
    index = warc.write_archives(pages, path)
    read = warc.read_records(index, path, task_bytes=50_000)
    total = index.agg(F.sum("length")).first()[0]
    assert read.rdd.getNumPartitions() >= total // 50_000 > 10
    assert read.count() == 1000


def test_numbered(spark, monkeypatch):
    monkeypatch.setattr(copies, "BLOCK", 10)
    monkeypatch.setattr(copies, "BLOCKS", 2)
    rows = spark.createDataFrame([("a", 95, "x"), ("b", 10, "x"), ("c", 1, "x"), ("d", 0, "x")], "k string, c long, _first string")
    got = copies.numbered(rows, "c", "i")
    assert got.columns == ["k", "_first", "i"]
    assert sorted((r.k, r.i) for r in got.collect()) == [("a", i) for i in range(95)] + [("b", i) for i in range(10)] + [("c", 0)]
    deep = spark.createDataFrame([([None, 1], {"a": 1}, None, "x"), ([1, None], {"a": 1}, "x", None), ([None, 1], {"a": 1}, None, "x")],
                                 "a array<int>, `m.x` map<string,int>, s string, t string")
    hashes = [r[0] for r in deep.select(copies.row_hash(deep)).collect()]
    assert hashes[0] == hashes[2] != hashes[1]
    assert sorted(r.n for r in copies.collapsed(deep, "n").collect()) == [1, 2]


@pytest.mark.parametrize("piece_bytes", [64 << 20, 20_000])
@pytest.mark.parametrize("other", [lambda i: "same", lambda i: f"row {i}"])
def test_equal_rows_are_cut(spark, monkeypatch, other, piece_bytes):
    """A third of the rows without id and of one text, alike or not in other columns."""
    monkeypatch.setattr(copies, "BLOCK", 100)
    text = "one text that many rows hold " * 4
    rows = [(None if i % 3 == 0 else i, text if i % 3 == 0 else text[: i % 90], other(i), None) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _heavy string, _count string").repartition(3)
    result = sharding.shard_bytes(docs, piece_bytes=piece_bytes)
    got = result.collect()
    assert set(result.columns) == set(docs.columns) | {"size", "text_crc32", "shard", "slot"}
    assert sorted(map(repr, (tuple(r)[:4] for r in result.select(docs.columns).collect()))) == sorted(map(repr, rows))
    sizes = np.zeros(24, int)
    for r in got:
        sizes[r.shard] += r.size
    assert sizes.max() - sizes.min() < 4 * (len(text) + 8)
    for shard in range(24):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    again = sharding.shard_bytes(docs.repartition(5), piece_bytes=piece_bytes).collect()
    place = lambda r: repr((r.doc_id, r.size, r.shard, r.slot))
    assert sorted(map(place, got)) == sorted(map(place, again))


def heavy_mix(spark):
    """Three sources; a third of all rows share null id and size, half of those all columns."""
    rows = [(None, "w " * 50 if i % 2 else f"w{i} " * 50, "hot", i % 7) for i in range(4000)]
    rows += [(i, "w " * RNG.randint(1, 200), ["b", "c"][i % 2], 0) for i in range(8000)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, _hash int").repartition(4), rows


def test_groups_of_equal_rows_are_bounded(spark, monkeypatch):
    docs, rows = heavy_mix(spark)
    largest = spark.sparkContext.accumulator(0)
    fly = mixing._fly

    def counting(last):
        run = fly(last)

        def counted(group):
            if group.num_rows > 300:
                largest.add(1)
            return run(group)

        return counted

    monkeypatch.setattr(mixing, "_fly", counting)
    got = mixing.mix(docs, group=200).collect()
    assert len(got) == len(rows) and largest.value == 0
    taken, target = {}, {r.source: r.target for r in got}
    for r in got:
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - target[s]) <= 200 for s in target)  # several levels of groups, one text at most off


@pytest.mark.parametrize("part", [10_000, 20])
def test_mixed_takes_equal_rows_together(spark, monkeypatch, part):
    monkeypatch.setattr(mixing, "HOT_PART", part)
    docs, rows = heavy_mix(spark)
    out = mixing.mixed(docs, group=500)
    got = out.collect()
    assert out.columns == docs.columns and {tuple(r) for r in got} <= set(rows)
    targets = {r.source: r.target for r in mixing.mix(docs).select("source", "target").distinct().collect()}
    for source, target in targets.items():
        assert abs(sum(len(r.text.split()) for r in got if r.source == source) - target) <= 200
    most = {r: 3 * rows.count(r) for r in set(rows[:60])}
    assert all(sum(tuple(g) == r for g in got) <= n for r, n in most.items())
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mixed(docs, group=500).collect()))


def test_many_secrets_in_one_text(spark):
    text = "é token=abcdef1 " * 100_000
    docs = spark.createDataFrame([(1, text), (2, "none")], "doc_id long, text string")
    path, start = new_path(spark, "ledger"), time.monotonic()
    secrets.scan(docs, path)
    report = secrets.findings(docs, path)
    got = {r.doc_id: r for r in report.collect()}
    assert time.monotonic() - start < 30
    assert got[1].n_assign == 100_000 and got[2].spans == ""
    assert got[1].spans == ",".join(f"assign:{16 * i + 2}:{16 * i + 15}" for i in range(100_000))
    assert "Python" not in plan_of(report)


@pytest.mark.parametrize("large", [60, simhash.LARGE])
def test_large_buckets_are_dealt_on(spark, monkeypatch, large):
    """Fingerprints that share long runs of bits: the components are those of a comparison of all with all."""
    rng = np.random.default_rng(3)
    dense = np.uint64(0xABCD_1234_0000_0000) | rng.integers(0, 1 << 14, 900, dtype=np.uint64) << np.uint64(9)  # most keys in common
    turned = (dense << np.uint64(24)) | (dense >> np.uint64(40))
    fps = np.unique(np.concatenate([dense, turned, rng.integers(0, 2 ** 63, 200, dtype=np.uint64)]))
    monkeypatch.setattr(simhash, "LARGE", large)
    rows = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = {r.node: r.root for r in components(simhash.links(rows)).collect()}
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= simhash.MAX_DISTANCE
    root = np.arange(len(fps))
    while (new := np.array([root[near[i]].min() for i in range(len(root))])).tolist() != root.tolist():
        root = new
    pairs = {(int(r), got.get(int(x), int(x))) for r, x in zip(root, fps.view(np.int64))}
    assert len(pairs) == len({r for r, _ in pairs}) == len({g for _, g in pairs}) > 1


def test_finer_buckets_get_small():
    """Each round a linked pair keeps a key in common, and 2 ** 32 fingerprints of one key fall apart."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 32, 3000, dtype=np.uint64)
    key = 3 * 2 + 1  # the chain from the third segment on that skips its fourth one
    turn, opened = np.uint64(16), simhash.OPEN[1]
    bits = [b for b in range(64) if opened >> b & 1]
    spread = lambda x: sum(((x >> np.uint64(i) & np.uint64(1)) << np.uint64(b)) for i, b in enumerate(bits))
    flips = np.array([sum(1 << int(b) for b in rng.choice(32, 3, replace=False)) for _ in base], np.uint64)
    fps = np.concatenate([spread(base), spread(base ^ flips)])
    fps = (fps >> turn) | (fps << (np.uint64(64) - turn))
    rows = pa.RecordBatch.from_arrays([pa.array(np.full(len(fps), key)), pa.array(np.full(len(fps), opened)), pa.array(fps.view(np.int64))],
                                      ["key", "open", "fp"])
    place = {int(x): i for i, x in enumerate(fps)}
    for _ in range(2):
        rows = pa.Table.from_batches(simhash._finer([rows])).combine_chunks().to_batches()[0]
        keys, held = rows.column("key").to_numpy(), rows.column("fp").to_numpy().view(np.uint64)
        assert set(keys & 0xFF) == {key}
        of = [set() for _ in fps]
        for k, x in zip(keys.tolist(), held.tolist()):
            of[place[x]].add(k)
        assert all(of[i] & of[i + len(base)] for i in range(len(base)))
    assert np.unique(keys, return_counts=True)[1].max() < 20


def test_anchor_buckets_follow_the_texts(spark, monkeypatch):
    """More buckets than shuffle partitions, several a task, and the same repeats."""
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, " ".join(f"w{RNG.randint(0, 10**9)}" for _ in range(50)) + (f" {passage}" if i % 2 else "")) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    plain = sorted(map(tuple, substring.remove_repeats(docs).collect()))
    monkeypatch.setattr(substring, "BUCKET_BYTES", 1000)
    assert sorted(map(tuple, substring.remove_repeats(docs).collect())) == plain
    anchors = substring.repeated_anchors(docs.withColumn("version", F.xxhash64("text")), 40_000)
    assert anchors.rdd.getNumPartitions() == 40 and sum(r[2] for r in plain) == 29 * 40
