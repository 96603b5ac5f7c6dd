"""Every operator against brute force, and on odd tables: nulls, blanks, ties, repeats, none, clashing columns."""

from __future__ import annotations

import hashlib
import random
import tracemalloc

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from wikiloom.llm import (decontaminate, host_rules, language, mixing, quality_gam, secrets, sharding, simhash, substring,
                          warc)
from wikiloom.llm.components import components
from wikiloom.shared import new_path

SCHEMA = "doc_id long, text string, lang string, source string, shard string, size string, _key string, _id string"
RNG = random.Random(7)
WORDS = ["".join(RNG.choice("abcdefghij") for _ in range(RNG.randint(2, 7))) for _ in range(400)]


def prose(n: int) -> str:
    return " ".join(RNG.choice(WORDS) for _ in range(n))


PASSAGE, LONG = prose(60), prose(30_000)
BASE = prose(120)


def odd_rows() -> list[tuple]:
    texts = [None, "", " \n\t", "one", "two words", prose(80), PASSAGE + " " + prose(70), prose(55) + "\n" + PASSAGE,
             LONG, BASE, BASE, BASE.replace(BASE.split()[60], "changed"), "x\x1cy é z", "ha " * 200, prose(300)]
    rows = [(i, t, ["en", None, "fr"][i % 3], ["a", None, "b", ""][i % 4], "s", "z", "k", "q") for i, t in enumerate(texts)]
    return rows + [rows[5], rows[6], (6, prose(66), "en", "a", "s", "z", "k", "q"), (None, prose(77), "en", "b", None, None, None, None),
                   (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = odd_rows()
    return spark.createDataFrame(rows, SCHEMA).repartition(3), rows


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def multiset(rows) -> list[str]:
    return sorted(map(repr, rows))


# --- op 1 ------------------------------------------------------------------

def test_mix(odd, none):
    docs, rows = odd
    got = mixing.mix(docs, group=4).collect()
    assert multiset((r.doc_id, r.size) for r in got) == multiset((r[0], len(words(r[1]))) for r in rows)
    assert all(0 <= r.copies <= 3 and r.taken == r.copies * r.size for r in got)
    assert abs(sum({r.source: r.target for r in got}.values()) - sum(r.size for r in got)) < 1e-6
    assert multiset(got) == multiset(mixing.mix(docs, group=4).collect())
    assert mixing.mix(none).count() == 0
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in got)


def test_targets_fill_up(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 10), ("c", 1), (None, 50)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    free, want = {"a": 1, "b": 2, "c": 3, None: 1}, {}
    size, left = {"a": 100, "b": 10, "c": 1, None: 50}, 161.0
    while True:
        share = left / sum(free.values())
        over = [s for s, w in free.items() if w * share > 3 * size[s]]
        if not over:
            break
        for s in over:
            want[s] = 3.0 * size[s]
            left -= want[s]
            del free[s]
    want |= {s: w * share for s, w in free.items()}
    assert all(abs(got[s] - want[s]) < 1e-9 for s in size)


def test_flight_keeps_both_sums():
    rng = np.random.default_rng(3)
    prob, size = rng.random(500), rng.integers(0, 900, 500).astype(float)
    moved = mixing.flight(prob, size, rng.random(500))
    assert abs(moved.sum() - prob.sum()) < 1e-6 and abs((moved * size).sum() - (prob * size).sum()) < 1e-4
    assert ((moved > 1e-9) & (moved < 1 - 1e-9)).sum() <= 2
    means = np.mean([mixing.flight(np.full(9, 0.4), np.arange(9.0), rng.random(9)) for _ in range(4000)], axis=0)
    assert np.abs(means - 0.4).max() < 0.04
    assert set(mixing.land(np.array([0.0, 0.5, 1.0, 0.25]), np.array([3.0, 9.0, 4.0, 2.0]))) <= {0.0, 1.0}


# --- op 2 ------------------------------------------------------------------

def test_language(spark, odd, none):
    kinds = {"en": ["the", "and", "house", "with", "this"], "de": ["der", "und", "haus", "mit", "diese"]}
    rows = [(i, " ".join(RNG.choice(kinds[k]) for _ in range(60)), k) for i in range(200) for k in [("en", "de")[i % 2]]]
    docs = spark.createDataFrame(rows + [(900, rows[0][1] + " " + rows[1][1], None), (901, None, "en"), (902, "12 !", "en")],
                                 "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert all(got[i].lang_pred == k for i, _, k in rows) and any(got[i].held_out for i in range(200))
    assert set(got[900].mixture) == {"en", "de"} and abs(got[900].mixture["en"] - 0.5) < 0.15
    assert (got[901].lang_pred, got[901].score, got[902].lang_pred) == ("und", 0.0, "und")
    odd_docs, odd_list = odd
    assert language.identify(odd_docs).count() == len(odd_list) and language.identify(none).count() == 0
    assert {r.lang_pred for r in language.predict(odd_docs, [], np.zeros((language.BUCKETS, 0), np.float32)).collect()} == {"und"}


# --- op 3 ------------------------------------------------------------------

def test_quality(spark, odd, none):
    rows = [(i, prose(60) if i % 3 else "spam " * 60) for i in range(240)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i, _ in rows] + [(5, None), (7, 1)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = quality_gam.quality(docs, labels).collect()
    assert all(r.predicted == int(r.doc_id % 3 > 0) for r in got if r.held_out) and any(r.held_out for r in got)
    docs, rows = odd
    assert quality_gam.quality(docs, labels).count() == len(rows)
    assert quality_gam.quality(none, labels).count() == 0
    assert all(0 <= r.score <= 1 for r in quality_gam.quality(docs, labels.where("false")).collect())


def test_quality_model_uses_pairs():
    rng = np.random.default_rng(5)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    assert ((quality_gam.fit(x, y).score(x) > 0.5) == y).mean() > 0.9


# --- op 4 ------------------------------------------------------------------

def test_shards(spark, odd, none):
    docs, rows = odd
    got = sharding.shard_bytes(docs, 3)
    assert set(got.columns) == set(docs.columns) | {"text_crc32", "slot"}
    got = got.collect()
    assert len(got) == len(rows)
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert sharding.shard_bytes(none).count() == 0
    many = spark.createDataFrame([(i, BASE if i % 3 == 0 else prose(20 + i % 40)) for i in range(3000)], "doc_id long, text string")
    sizes = np.zeros(24, int)
    for r in sharding.shard_bytes(many).select("shard", "size").collect():
        sizes[r.shard] += r.size
    assert sizes.max() - sizes.min() < 2000  # a hot group is cut, too; rows have up to 700 bytes


def test_shards_of_several_pieces(spark):
    """A third of the rows of one text, cut into far smaller pieces."""
    rows = [(i, BASE if i % 3 == 0 else prose(20 + i % 40)) for i in range(3000)]
    size = sum(len(t) + 8 for _, t in rows)
    got = sharding.shard_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 3, piece_bytes=-(-size // 57)).collect()
    sizes = np.zeros(3, int)
    for r in got:
        sizes[r.shard] += r.size
    assert len(got) == len(rows) and sizes.max() - sizes.min() < 2000
    for shard in range(3):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))


@pytest.mark.parametrize("n_shards, per_shard", [(24, 19), (3, 19), (6, 4), (5, 1)])
def test_cuts_inside_a_group(monkeypatch, n_shards, per_shard):
    rng = np.random.default_rng(2)
    keys = rng.integers(-(1 << 63), 1 << 63, 60_000)
    hot = rng.random(60_000) < 1 / 3
    keys[hot] = (keys[0] & ~((1 << 24) - 1)) | rng.integers(0, 1 << 24, hot.sum())
    keys = np.sort(keys)
    total, pieces = 700 * len(keys), n_shards * per_shard

    def count_below(_, probes):
        assert probes == sorted(set(probes))
        rows = np.searchsorted(keys, np.array(probes, np.int64), side="left")
        return 700 * rows, rows

    monkeypatch.setattr(sharding, "count_below", count_below)
    exact = {i * per_shard for i in range(1, n_shards)}
    cuts, below = sharding.splitters(None, total, pieces, exact, int(total / n_shards * 0.001))
    assert cuts == sorted(cuts) and below == np.searchsorted(keys, cuts).tolist()
    ends = [0, *(below[i - 1] for i in sorted(exact)), len(keys)]
    assert np.abs(np.diff(ends) - len(keys) / n_shards).max() <= 2 * max(1, len(keys) / n_shards * 0.001)
    assert np.diff([0, *below, len(keys)]).max() <= 1.6 * len(keys) / pieces


# --- op 5 ------------------------------------------------------------------

def test_decontamination(spark, odd, none):
    items = [(i, prose(20 + i * 7) + ". " + prose(9) + ".") for i in range(30)] + [(100, None), (101, ""), (102, "zzq zzr")]
    texts = [(i, prose(200)) for i in range(60)] + [(60 + i, prose(70) + " " + t.upper() + " " + prose(90)) for i, t in items[:30]]
    texts += [(200, None), (201, "zzr zzq"), (202, "a zzq zzr b"), (203, items[3][1][: len(items[3][1]) // 2])]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for d, t in texts:
        have = decontaminate.words_of(t)
        for i, item in items:
            w = decontaminate.words_of(item)
            n = min(5, len(w))
            if n:
                grams = {tuple(have[k:k + n]) for k in range(len(have) - n + 1)}
                own = [tuple(w[k:k + n]) for k in range(len(w) - n + 1)]
                if sum(g in grams for g in own) >= 0.8 * len(own):
                    want.add((d, i))
    got = decontaminate.contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(want) >= 31
    docs, rows = odd
    assert decontaminate.clean(docs, bench).count() == len(rows) and decontaminate.clean(docs, bench).columns == docs.columns
    assert decontaminate.contaminated(docs, bench.where("false")).count() == 0
    assert decontaminate.contaminated(none, bench).count() == 0


def test_parts_of_the_index_come_one_by_one(spark, monkeypatch):
    items = [(i, prose(20)) for i in range(40)]
    texts = [(i, prose(150)) for i in range(10)] + [(10 + i, prose(40) + " " + t + " " + prose(80) + " " + items[0][1]) for i, t in items]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = {tuple(r) for r in decontaminate.contaminated(docs, bench).select("doc_id", "item_id").collect()}
    monkeypatch.setattr(decontaminate, "PART_WORDS", 300)
    monkeypatch.setattr(decontaminate, "GRID", 8)
    held, load = [], decontaminate.load_part
    monkeypatch.setattr(decontaminate, "load_part", lambda *a: held.append(len((part := load(*a)).ids)) or part)
    assert {tuple(r) for r in decontaminate.contaminated(docs, bench).select("doc_id", "item_id").collect()} == whole
    assert len(held) == 3 and sum(held) == 40 and len(whole) == 79
    assert sorted(r.doc_id for r in decontaminate.clean(docs, bench).collect()) == list(range(10))
    weak = spark.createDataFrame([(1, f"zzq {items[0][1].split()[0]} zzr")], "doc_id long, text string")  # far below any bound
    assert decontaminate.clean(weak, bench).count() == 1


def test_retrieval_is_complete(spark):
    items = spark.createDataFrame([(i, prose(30)) for i in range(80)], "item_id long, text string")
    postings, numbered, parts = decontaminate.build_index(items)
    index = decontaminate.load_part(postings, numbered, 0)
    queries = [decontaminate.words_of(prose(100)) for _ in range(40)]
    got = decontaminate.search(index, queries, 0.2)
    name = {n: t for t, n in index.term.items()}
    dense = np.zeros((len(name), len(index.item_of)))
    for t in name:
        dense[t, index.segment[index.at[t]:index.at[t + 1]]] = index.weight[index.at[t]:index.at[t + 1]]
    for q, ws in enumerate(queries):
        scores = np.zeros(len(index.item_of))
        for p in range(max(-(-(len(ws) - 64) // 64), 1)):
            scores = np.maximum(scores, dense[sorted({index.term[w] for w in ws[64 * p:64 * p + 128] if w in index.term})].sum(axis=0))
        want = {(q, int(index.item_of[s])): scores[s] for s in np.nonzero(scores >= 0.2)[0]}
        assert {k for k in got if k[0] == q} == set(want) and all(abs(got[k] - v) < 1e-9 for k, v in want.items())
    assert parts == 1


# --- op 6 ------------------------------------------------------------------

def test_secrets(spark, odd, none):
    found = "é\nAPI_KEY = 'abcdef123' token:abc secret=token: xyzxyz AKIA" + "B" * 17 + " " + "0" * 30 + " password=\"hunter22\""
    docs = spark.createDataFrame([(1, found), (2, found), (3, None), (4, "x" * 2_000_000 + " token=abcdefg " + "y" * 2_000_000)],
                                 "doc_id long, text string")
    ledger = new_path(spark, "ledger")
    secrets.scan(docs, ledger, secrets.BASE)
    got = {r.doc_id: r for r in secrets.findings(docs, ledger, secrets.BASE).collect()}
    assert got[1].spans == got[2].spans and (got[1].n_assign, got[1].n_access, got[1].n_hex) == (2, 1, 1)
    for span in got[1].spans.split(","):
        kind, low, high = span.split(":")
        assert found[int(low):int(high)].startswith({"assign": ("API", "pass"), "access": "AKIA", "hex": "0"}[kind])
    assert got[3].base_sha256 == hashlib.sha256(b"").hexdigest() and got[4].spans == "assign:2000001:2000014"
    assert secrets.read_ledger(spark, ledger).count() == 3  # blobs, not paths
    secrets.scan(docs.union(spark.createDataFrame([(5, "new")], "doc_id long, text string")), ledger, secrets.BASE)
    assert secrets.read_ledger(spark, ledger).count() == 4
    secrets.scan(docs, ledger)  # more rules: only those run on known blobs
    again = secrets.read_ledger(spark, ledger).collect()
    assert sorted(len(r.rules) for r in again) == [3, 3, 3, 3, 3, 3, 3]
    odd_docs, rows = odd
    path = new_path(spark, "ledger")
    secrets.scan(odd_docs, path)
    assert secrets.findings(odd_docs, path).count() == len(rows)
    empty = new_path(spark, "ledger")
    secrets.scan(none, empty)
    assert secrets.findings(none, empty).count() == 0


# --- op 7 ------------------------------------------------------------------

def test_warc(spark):
    big, other = "é<b>\r\n\r\n" * 300, "z" * 1200
    rows = [(1, "http://a/ü?x=%41", big, 0), (2, None, big, 0), (3, "u", other, 0), (4, "u", "small", 0), (5, "u", "small", 0), (6, "u", None, 0),
            (7, "u", other, 0), (7, "u", other, 0), (None, "u", other, 0), (None, "v", "", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int").repartition(3)
    top = {big: 2, other: 7}
    want = []
    for page, _, html, _ in rows:
        data = (html or "").encode()
        target = top.get(html)
        revisit = target is not None and page is not None and page != target
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", target if revisit else None))
    assert multiset(map(tuple, warc.round_trip(pages).collect())) == multiset(want)
    path = "file://" + new_path(spark, "warc")
    index = warc.write_archives(pages, path)
    read = warc.read_records(index.where("page_id = 1 or page_id = 2"), path).collect()
    assert {(r.page_id, r.url, bytes(r.payload).decode()) for r in read} == {(1, "http://a/ü?x=%41", ""), (2, None, big)}
    assert index.where("length <= 0").count() == 0 and warc.round_trip(pages.where("false")).count() == 0


def test_ranges_are_coalesced(spark):
    index = spark.createDataFrame([("f", 0, 10), ("f", 10, 5), ("f", 500, 5), ("g", 3, 4)], "file string, offset long, length long")
    got = {(r.file, r.start, r.end): len(r.records) for r in warc.coalesced(index, gap=100).collect()}
    assert got == {("f", 0, 15): 2, ("f", 500, 505): 1, ("g", 3, 7): 1}


# --- op 8 ------------------------------------------------------------------

def repeated_by_hand(ws: list[bytes]) -> int:
    grams = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    inside = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)}
    return len(inside)


def test_host_rules(spark, odd, none):
    for _ in range(40):
        ws = [RNG.choice([b"a", b"b", b"c"]) for _ in range(RNG.randint(0, 30))]
        assert host_rules.repeated_words(ws) == repeated_by_hand(ws)
    assert host_rules.base_counts("é #x\n\nab\nab\n \n".encode()) == (4, 7, 1, 3, 1, 0)
    docs, rows = odd
    got = host_rules.apply_rules(docs).collect()
    assert len(got) == len(rows) and all(r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words) for r in got)
    assert host_rules.apply_rules(none).count() == 0
    kept = host_rules.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    table = [(i, "## " * 30 + prose(60) if i % 20 else prose(60), "bad") for i in range(200)]
    table += [(1000 + i, prose(60), f"h{i % 5}") for i in range(300)] + [(2000, "## " * 40 + prose(60), "one")]
    got = host_rules.apply_rules(spark.createDataFrame(table, "doc_id long, text string, source string")).collect()
    assert {r.source for r in got if r.host_rejected} == {"bad"}


# --- op 9 ------------------------------------------------------------------

def test_near_duplicates(odd, none):
    docs, rows = odd
    def by_hand(text):
        ws = [w.lower() for w in words(text)]
        grams = [b" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] if len(ws) > 2 else [b" ".join(ws)] if ws else []
        hs = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    fps = [by_hand(r[1]) for r in rows]
    root = list(range(len(rows)))
    for _ in rows:
        root = [min(root[j] for j in range(len(rows)) if bin(fps[i] ^ fps[j]).count("1") <= 3) for i in range(len(rows))]
    lowest = {}
    for r, c in zip(rows, root):
        lowest.setdefault(c, []).append(r[0])
    want = [(r[0], f"{f:016x}", min((i for i in lowest[c] if i is not None), default=None)) for r, f, c in zip(rows, fps, root)]
    assert multiset(tuple(r)[:3] for r in simhash.near_duplicates(docs).collect()) == multiset(want)
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {w[0] for w in want if w[0] is None or w[0] == w[2]}


def test_one_row_stays_whatever_its_id(spark):
    texts = [prose(200) for _ in range(3)]
    near = texts[0].replace(" ", "  ")  # another text with the same fingerprint
    rows = [(4, texts[0]), (None, near), (None, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[1].replace(" ", "\n")), (None, texts[2])]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert multiset((r.doc_id, " ".join(r.text.split())) for r in kept) == multiset([(4, texts[0]), (None, texts[1]), (None, texts[2])])


def test_links_find_every_component(spark):
    rng = np.random.default_rng(11)
    seeds = rng.integers(0, 2 ** 63, 40, dtype=np.uint64)
    fps = {int(s) for s in seeds}
    for s in seeds:
        for _ in range(15):
            x = int(s)
            for b in rng.choice(64, rng.integers(1, 5), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    all_ = np.array(sorted(fps), np.uint64)
    signed = spark.createDataFrame([(int(x),) for x in all_.view(np.int64)], "fp long")
    got = {r.node: r.root for r in components(simhash.links(signed)).collect()}
    root = np.arange(len(all_))
    near = np.bitwise_count(all_[:, None] ^ all_[None, :]) <= 3
    while (new := np.array([root[near[i]].min() for i in range(len(root))])).tolist() != root.tolist():
        root = new
    groups = {}
    for i, x in enumerate(all_.view(np.int64).tolist()):
        groups.setdefault(got.get(x, x), set()).add(int(root[i]))
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(root.tolist()))


def test_large_buckets_are_compared_in_blocks():
    rng = np.random.default_rng(13)
    fps = rng.integers(0, 2 ** 63, 6000, dtype=np.uint64)
    fps[3000:3200] = fps[:200] ^ np.uint64(1)  # in another block than its partner
    tracemalloc.start()
    a, b = simhash.bucket_links(fps, 0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {(int(x), int(y)) for x, y in zip(a, b)} == {(int(x) ^ 1, int(x)) for x in fps[:200]}
    assert peak < 64e6


# --- op 10 -----------------------------------------------------------------

def test_repeats(spark, odd, none):
    def by_hand(rows):
        place = sorted({(-1 if r[0] is None else r[0]) for r in rows})
        first = {}
        for r in rows:
            ws = words(r[1])
            for i in range(len(ws) - 19):
                at = (place.index(-1 if r[0] is None else r[0]), i)
                key = tuple(ws[i:i + 20])
                first[key] = min(first.get(key, at), at)
        out = []
        for r in rows:
            ws, gone = words(r[1]), set()
            for i in range(len(ws) - 19):
                if first[tuple(ws[i:i + 20])] < (place.index(-1 if r[0] is None else r[0]), i):
                    gone |= set(range(i, i + 20))
            kept = b" ".join(w for j, w in enumerate(ws) if j not in gone)
            out.append((r[0], len(ws), len(gone), hashlib.sha256(kept).hexdigest()))
        return out

    docs, rows = odd
    assert multiset(tuple(r)[:4] for r in substring.remove_repeats(docs).collect()) == multiset(by_hand(rows))
    assert substring.remove_repeats(none).count() == 0
    pieces = [prose(RNG.randint(18, 45)) for _ in range(12)]
    rows = [(i, " ".join(RNG.choice(pieces) if RNG.random() < 0.5 else prose(RNG.randint(1, 30)) for _ in range(6))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert multiset(tuple(r)[:4] for r in substring.remove_repeats(docs).collect()) == multiset(by_hand(rows))


def test_places_do_not_grow_with_copies(spark):
    """A hot text that shares a passage with others: one place each, in a pool, over pools and in the lists."""
    hot = PASSAGE + " " + prose(60)
    rows = [(i, hot if i % 3 else prose(30) + " " + PASSAGE) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("version", F.xxhash64("text"))
    one_pool = substring.repeated_anchors(docs.coalesce(1), 1)
    assert one_pool.count() == one_pool.distinct().count() > 0
    lists = {r.version: r.places for r in substring.anchor_places(docs.repartition(5), 1).collect()}
    assert len(lists) == 101 and all(len(p) == len(set(p)) <= 150 for p in lists.values())
    dealt = docs.where("doc_id = 0").select("doc_id", "text", *substring._keys(F.col("doc_id")))
    places = dealt.select("row", "short", F.explode(F.array_repeat(F.lit(3), 1000)).alias("place"))
    assert [r.places for r in substring._with(dealt, places).collect()] == [[3]]


def test_cover_aligns_every_pair():
    n = substring.PERIOD
    for i in range(n):
        for j in range(n):
            assert any((i + s) % n in substring.COVER and (j + s) % n in substring.COVER for s in range(n))


# --- pipeline --------------------------------------------------------------

def test_stages(spark, odd, none, tmp_path):
    docs, _ = odd
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for table in (docs, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, str(tmp_path))
            rows = out.collect()
            if name == "sharding":
                assert len(rows) == table.count()
            else:
                assert out.columns == docs.columns
    documents = spark.createDataFrame([(i, prose(90), "en", f"s{i % 3}") for i in range(60)] + [(70, PASSAGE + " " + prose(60), "en", "s0"), (71, "short", "en", "s0")],
                                      "doc_id long, text string, lang string, source string")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert out and {r.doc_id for r in out} <= set(range(60))
