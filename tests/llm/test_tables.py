"""Divergence audit, prefix trie and token store against brute force, and on odd tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wikiloom.llm import divergence, prefix_trie, token_store
from wikiloom.shared import new_path

RNG = random.Random(11)
DOCS = "doc_id long, text string, lang string, source string, place string, value string, shard string"
TURNS = "conv_id long, turn long, role string, text string, piece string, size string"


# --- op 11 -----------------------------------------------------------------

def audit_by_hand(rows, min_docs=3, top=200):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in term.findall(text or "")]
        groups.add((lang, source))
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        sources = sorted(s for l, s in groups if l == lang)
        total = Counter()
        for s in sources:
            total.update(counts[lang, s])

        def chances(counter):
            n = sum(counter[t] for t in kept)
            return [1 + 10**9 * (counter[t] + 1) // (n + len(kept)) for t in kept]

        p = {s: chances(counts[lang, s]) for s in sources}
        q = chances(total)
        for s in sources:
            pairs = [(sum((a - b) ** 2 // b for a, b in zip(p[s], p[o])), o) for o in sources if o != s]
            terms = [((a - b) ** 2 // b, t) for t, a, b in zip(kept, p[s], q) if counts[lang, s][t] and a > b]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i) for i, (v, item) in enumerate(found, 1) if part == "pair" or i <= top]
    return sorted(out)


def odd_documents():
    words = ["Alpha", "béta", "ÉTÉ", "x1y", "gamma", "d", "ö"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9)]
    rows = []
    for i in range(90):
        text = " ".join(RNG.choice(words[:RNG.choice([7, 40, len(words)])]) for _ in range(RNG.randint(1, 60)))
        rows.append((i, text, RNG.choice(["en", "en", "fr", None, ""]), RNG.choice(["a", "a", "b", None, "c", "é"]), "p", "v", "s"))
    rows += [(200, None, "en", "bare", "p", "v", "s"), (201, "", "zz", "a", None, None, None), (202, None, "zz", "b", "p", "v", "s"),
             (203, "one two", "zz", None, "p", "v", "s"), rows[3], rows[3], (None, "w" * 30_000, None, "a", "p", "v", "s")]
    return rows


@pytest.mark.parametrize("block", [5, 1000])
def test_audit(spark, block):
    rows = odd_documents()
    got = divergence.audit(spark.createDataFrame(rows, DOCS).repartition(4), block=block, top_terms=20)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == audit_by_hand(rows, top=20)


def test_audit_of_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0


def test_run_length_columns():
    places = np.array([12, 13, 17])
    starts, values = divergence.runs(10, 10, 1, places, np.array([5, 5, 7]))
    assert starts.tolist() == [0, 2, 4, 7, 8] and values.tolist() == [1, 5, 1, 7, 1]


def test_probability_beyond_64_bits(spark):
    n = 4_000_000_000_000_000
    got = spark.range(1).select(divergence.probability(F.lit(n), F.lit(3 * n), F.lit(7)).alias("p")).first().p
    assert got == 1 + 10**9 * (n + 1) // (3 * n + 7)


def test_equal_counts_are_neighbours(spark):
    """Runs are fewer than counts: the order brings equal columns together."""
    rows = [("en", s, f"t{i:03d}", 1 + (i % 3 == 0), 3) for i in range(300) for s in ("a", "b")]
    vocabulary = divergence.ordered_vocabulary(spark.createDataFrame(rows, "lang string, source string, term string, n long, docs long"))
    kinds = [int(r.term[1:]) % 3 == 0 for r in vocabulary.orderBy("block", "place").collect()]
    assert sum(a != b for a, b in zip(kinds, kinds[1:])) == 1


# --- op 12 -----------------------------------------------------------------

def trie_by_hand(rows, family=5, heads=9):
    order = lambda r: (r[1] is not None, r[1] or 0)
    own = defaultdict(list)
    for row in rows:
        if row[0] is not None:
            own[row[0]].append(row)
    own = {c: [(r[2] or "", r[3] or "") for r in sorted(found, key=order)] for c, found in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        full[c] = own.get(c - c % family, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids, leaves, saved = Counter(k[:-1] for k in members if k), Counter(), Counter()
    for k, found in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += kids[k] == 0
            saved[k[:d]] += (len(found) - 1) * len(k[-1][1].encode()) if k else 0
    return sorted(((min(found), len(k), min(members[k[:-1]]) if k else -1, len(found), kids[k], leaves[k], saved[k],
                    hashlib.sha256(",".join(str(c) for c in sorted(found) if len(full[c]) == len(k)).encode()).hexdigest())
                   for k, found in members.items()))


def odd_conversations():
    rows = []
    for c in range(60):
        for t in range(RNG.choice([1, 2, 3, 5, 8, 13, 40])):
            turn = None if t == 0 and c % 7 == 0 else t
            rows.append((c, turn, RNG.choice(["user", None]) if t % 5 == 4 else "user", RNG.choice(["é", "b", None, "long " * 50]) if t % 3 else "same", "p", "s"))
    rows += [(c, t, "user", f"copy {t}", "p", "s") for c in range(100, 160) for t in range(6)]
    return rows + [(None, 1, "user", "nobody", "p", "s"), (7001, 0, None, "", None, None), rows[0], (9004, None, None, None, None, None)]


def as_rows(df):
    return sorted(tuple(-1 if x is None else x for x in r) for r in df.collect())


def test_trie(spark):
    rows = odd_conversations()
    got = prefix_trie.trie(spark.createDataFrame(rows, TURNS).repartition(5))
    assert got.columns == prefix_trie.COLUMNS
    # rows[0] repeats a turn, so two of its conversation's turns are equal and their order does not matter
    assert as_rows(got) == trie_by_hand(rows)


def test_small_tries(spark):
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).count() == 0
    one = [(8, 0, "user", "x", "p", "s")]  # its head is that of a conversation that is not there
    for rows in (one, one * 2, [(5, i, "user", "x" * i, "p", "s") for i in range(33)]):
        assert as_rows(prefix_trie.trie(spark.createDataFrame(rows, TURNS))) == trie_by_hand(rows)


def test_numbers_across_tasks(spark):
    """One conversation with most rows, numbered by many tasks."""
    rows = [(1, i // 2 if i else None, "user", f"t{i}", "p", "s") for i in range(3000)] + [(2, 0, "user", "x", "p", "s")]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = prefix_trie.numbered_turns(spark.createDataFrame(rows, TURNS)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert sorted(r.place for r in numbered if r.conv_id == 1) == list(range(3000))


def test_ends_in_parcels(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_PER_PARCEL", 7)
    rows = [(bytearray([i % 3]), i) for i in range(-20, 500)]
    got = {bytes(r.key): r.ends_sha256 for r in prefix_trie.ends_sha256(spark.createDataFrame(rows, "key binary, conv_id long"), "key").collect()}
    for k in range(3):
        ids = ",".join(str(i) for key, i in rows if key[0] == k)
        assert got[bytes([k])] == hashlib.sha256(ids.encode()).hexdigest()


# --- op 13 -----------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer_json():
    tokenizers = pytest.importorskip("public_tokenizers")
    with open(tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


TEXTS = [None, "", " ", "a", "two words", "  lead", "trail  ", "a  b", "a   b", "a\n b", "a \n b", "a\n\n  b\t c", "tab\t x",
         "it's we'll 12 34x -- ... !? a.b", "é x   y", "\x1c x", "　 全角 文字", "<|endoftext|> in text <|endoftext|>", "end <|endoftext",
         "word " * 3000, "x" * 5000, "🙂 🙂🙂", "a\u0085 b", "​ z"]


def test_encoder_equals_library(tokenizer_json):
    from tokenizers import Tokenizer

    library, encoder = Tokenizer.from_str(tokenizer_json), token_store.Encoder(tokenizer_json)
    alphabet = list("ab é1.'\n\t  \x1c") + [" "] * 6
    texts = TEXTS + ["".join(RNG.choice(alphabet) for _ in range(RNG.randint(1, 40))) for _ in range(3000)]
    for text in texts:
        want = library.encode(text or "", add_special_tokens=False).ids + [0]
        assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == want, repr(text)


def test_new_pieces_share_calls(tokenizer_json):
    from tokenizers import Tokenizer

    library, encoder, calls = Tokenizer.from_str(tokenizer_json), token_store.Encoder(tokenizer_json), []

    class Counted:
        def encode(self, *args, **options):
            calls.append(args)
            return library.encode(*args, **options)

    encoder.tokenizer = Counted()
    text = " ".join(f"{a}é{b}n*** {b}q{a}." for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz")
    got = np.frombuffer(encoder.encode(text), encoder.dtype).tolist()
    assert len(calls) < 10  # 1,352 words, hardly one like another
    assert got == library.encode(text, add_special_tokens=False).ids + [0]


def test_encoder_equals_library_by_column(tokenizer_json, monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    library, encoder = Tokenizer.from_str(tokenizer_json), token_store.Encoder(tokenizer_json)
    alphabet = [*"aZ0.,'*#_\n\r\t\x1c\x00é×÷ȿɐ²«“Ж全か🙂\x85\xa0\u1680\u2003\u200b\u2028\u3000", "'s", "<|endoftext|>", *[" "] * 8]
    for chunk, known, pieces in ((1, 1000, 3), (60, 1 << 20, 1), (1 << 20, 1 << 20, 500)):
        for name, value in (("CHUNK_BYTES", chunk), ("KNOWN_BYTES", known), ("CALL_PIECES", pieces)):
            monkeypatch.setattr(token_store, name, value)
        texts = TEXTS + ["".join(RNG.choice(alphabet) for _ in range(RNG.randint(0, 25))) for _ in range(1500)] + [None, ""]
        got = []
        for data, ends in encoder.encode_all(pa.array(texts, pa.string()).slice(1)):
            got += [ids.tolist() for ids in np.split(np.frombuffer(data, encoder.dtype), ends[:-1])]
        assert got == [library.encode(text or "", add_special_tokens=False).ids + [0] for text in texts[1:]]


def test_truncating_tokenizer_gets_whole_texts(tokenizer_json):
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(tokenizer_json)
    library.enable_truncation(4)
    encoder = token_store.Encoder(library.to_str())
    text = "one two three four five six"
    assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == library.encode(text, add_special_tokens=False).ids + [0]


def test_round_trip(spark, tokenizer_json):
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(tokenizer_json)
    rows = [(i * 3, t, "en", "s", "p", "v", "w") for i, t in enumerate(TEXTS)]
    rows += [rows[4], rows[4], (3, "another text with the same id", "en", "s", "p", "v", "w"), (None, "no id", "en", "s", "p", "v", "w"), (None, None, None, None, None, None, None)]
    docs, path = spark.createDataFrame(rows, DOCS).repartition(3), new_path(spark, "tokens")
    got = token_store.round_trip(docs, tokenizer_json, path, shard_bytes=4000).collect()
    want = Counter((r[0], tuple(library.encode(r[1] or "", add_special_tokens=False).ids + [0])) for r in rows)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and r.length == len(r.ids) // 4
        at += r.length
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert sorted(r.copy for r in got if r.doc_id == 12) == [0, 1, 2]
    files = spark.read.format("binaryFile").load(f"{path}/ids").collect()
    assert len(files) > 2
    assert Counter(tuple(d.tolist()) for f in files for d in token_store.read_shard(bytes(f.content))) == Counter(k[1] for k in want.elements())


def test_store_of_nothing(spark, tokenizer_json):
    assert token_store.round_trip(spark.createDataFrame([], DOCS), tokenizer_json).count() == 0


def test_index_is_minimal_and_perfect(spark):
    places = spark.range(20_000).select(
        (F.col("id") * 7919).alias("doc_id"), F.lit(0).cast("long").alias("copy"), (F.col("id") % 5).alias("shard"),
        F.col("id").alias("offset"), (F.col("id") + 1).alias("length"))
    index = token_store.build_index(places, bucket_keys=1500)
    found = token_store.lookup(index, places.select("doc_id", "copy")).collect()
    assert sorted(r.rank for r in found) == list(range(20_000))
    assert all(r.doc_id == r.offset * 7919 and r.shard == r.offset % 5 and r.length == r.offset + 1 for r in found)
    foreign = spark.range(20_000).select((F.col("id") * 7919 + 1).alias("doc_id"), F.lit(0).alias("copy"))
    assert token_store.lookup(index, foreign).count() == 0
