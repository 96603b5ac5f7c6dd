"""One query per operator over the given tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom.llm import (decontaminate, divergence, host_rules, language, mixing, prefix_trie, quality_gam, secrets,
                          sharding, simhash, substring, token_store, warc)
from wikiloom.shared import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORD = r"[^\x20\x09-\x0D]+"


@query()
def op1_mixing(spark, sf_dir):
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op2_language(spark, sf_dir):
    return language.identify(_table(spark, sf_dir, "documents")).drop("mixture")


@query()
def op3_quality(spark, sf_dir):
    return quality_gam.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query()
def op4_sharding(spark, sf_dir):
    return sharding.shard_bytes(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query()
def op5_decontamination(spark, sf_dir):
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def _secrets_sql() -> str:
    kinds = []
    for rank, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace(",}+", ",}")  # RE2 needs and has no possessive repeats
        match = "'" + rf"([\s\S]*?)({pattern})".replace("'", "''") + "'"
        parts = ", ".join(f"unnest(regexp_extract_all(t, {match}, {i})) AS {name}"
                          for i, name in ((1, "gap"), (2, "found"), (3 if rule.value else 2, "val")))
        kinds.append(f"SELECT rid, '{rule.kind}' AS kind, {rank} AS rank, {rule.least} AS least, {parts}, "
                     f"unnest(range(1, len(regexp_extract_all(t, {match}, 2)) + 1)) AS k FROM d")
    base = ", ".join(f"'{rule.kind}'" for rule in secrets.BASE)
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{rule.kind}') AS n_{rule.kind}" for rule in secrets.BASE)
    listed = "string_agg(concat(kind, ':', stop - length(found), ':', stop), ',' ORDER BY stop - length(found), rank)"
    return (
        "WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents), "
        f"p AS ({' UNION ALL '.join(kinds)}), "
        "s AS (SELECT *, CAST(sum(length(gap) + length(found)) OVER (PARTITION BY rid, kind ORDER BY k) AS BIGINT) AS stop FROM p), "
        f"f AS (SELECT rid, {counts}, coalesce({listed} FILTER (WHERE kind IN ({base})), '') AS base, {listed} AS spans "
        "FROM s WHERE length(val) >= least GROUP BY rid) "
        "SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, "
        "sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN f USING (rid)")


@query(_secrets_sql())
def op6_secrets(spark, sf_dir):
    docs, ledger = _table(spark, sf_dir, "documents"), new_path(spark, "ledger")
    secrets.scan(docs, ledger)
    return secrets.findings(docs, ledger)


@query(
    "WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages), "
    "m AS (SELECT digest, n, max(page_id) AS target FROM p WHERE n >= 1000 GROUP BY digest, n) "
    "SELECT page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.digest AS payload_digest, "
    "CASE WHEN page_id <> target THEN 'revisit' ELSE 'response' END AS record_type, "
    "CASE WHEN page_id <> target THEN target END AS refers_to FROM p LEFT JOIN m ON p.digest = m.digest AND p.n = m.n")
def op7_warc(spark, sf_dir):
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def _host_rules_sql() -> str:
    fails = ", ".join(f"CAST(count(*) FILTER (WHERE {rule}) AS DOUBLE) AS fail_{name}" for name, rule in host_rules.RULES.items())
    moments = ", ".join(f"sum(fail_{n}) / sum(n) AS mean_{n}, sum(fail_{n} * fail_{n} / n) AS kk_{n}" for n in host_rules.RULES)
    bad = []
    for n in host_rules.RULES:
        chance = f"(mean_{n} * (1 - mean_{n}))"
        between = f"((kk_{n} - total * mean_{n} * mean_{n} - (hosts - 1) * {chance}) / nullif(total - squares / total, 0))"
        strength = (f"CASE WHEN {between} > {chance} / {host_rules.STRONGEST} THEN greatest({chance} / {between} - 1, "
                    f"{host_rules.WEAKEST}) ELSE {host_rules.STRONGEST} END")
        rate = f"((mean_{n} * ({strength}) + fail_{n}) / (({strength}) + n))"
        bad.append(f"({rate} - 2 * sqrt({rate} * (1 - {rate}) / (({strength}) + n + 1)) > {host_rules.MAX_RATE} "
                   f"AND fail_{n} / n > {host_rules.MAX_RATE})")
    failed = " OR ".join(f"({host_rules.RULES[n]})" for n in host_rules.BASE_RULES)
    return (
        f"WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t, "
        f"regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents), "
        "g AS (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d), "
        "r AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS times FROM g), "
        "rep AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM r WHERE times > 1) GROUP BY rid), "
        f"l AS (SELECT rid, count(*) AS n, count(DISTINCT line) AS u FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d) "
        f"WHERE regexp_matches(line, '{WORD}') GROUP BY rid), "
        "c AS (SELECT d.rid, doc_id, source, CAST(len(w) AS BIGINT) AS n_words, "
        "CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, "
        "CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(l.n, 0) AS n_lines, "
        "coalesce(l.n - l.u, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words "
        "FROM d LEFT JOIN l USING (rid) LEFT JOIN rep USING (rid)), "
        f"h AS (SELECT source, count(*) AS n, {fails} FROM c GROUP BY source), "
        f"m AS (SELECT sum(n) AS total, count(*) AS hosts, sum(n * n) AS squares, {moments} FROM h), "
        f"v AS (SELECT source, ({' OR '.join(bad)}) AS rejected FROM h, m) "
        f"SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({failed}) AS base_failed, "
        f"NOT ({failed}) AND NOT rejected AS kept FROM c JOIN v ON c.source IS NOT DISTINCT FROM v.source")


@query(_host_rules_sql())
def op8_host_rules(spark, sf_dir):
    return host_rules.apply_rules(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query()
def op9_simhash(spark, sf_dir):
    return simhash.near_duplicates(_table(spark, sf_dir, "documents")).drop("version")


@query(
    f"WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents), "
    "x AS (SELECT rid, doc_id, i, array_to_string(w[i:i + 19], ' ') AS words FROM "
    "(SELECT rid, doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)), "
    "k AS (SELECT rid, i, rank() OVER (PARTITION BY words ORDER BY doc_id NULLS FIRST, i) AS place FROM x), "
    "gone AS (SELECT DISTINCT rid, unnest(range(i, i + 20)) AS j FROM k WHERE place > 1), "
    "each_word AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d), "
    "kept AS (SELECT rid, string_agg(word, ' ' ORDER BY e.j) AS words, count(*) AS n FROM each_word e "
    "ANTI JOIN gone USING (rid, j) GROUP BY rid) "
    "SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, "
    "sha256(coalesce(words, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (rid)")
def op10_substring(spark, sf_dir):
    return substring.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def _divergence_sql() -> str:
    def chance(n: str, total: str) -> str:
        return f"1 + (CAST({divergence.SCALE} AS HUGEINT) * ({n} + 1)) // ({total} + v)"
    ranked = "CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (
        "WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, "
        "coalesce(text, '') AS t FROM documents), "
        f"w AS (SELECT rid, lang, source, unnest(regexp_extract_all(translate(t, '{upper}', '{upper.lower()}'), "
        r"'[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d), "
        f"k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT rid) >= {divergence.MIN_DOCS}), "
        "l AS (SELECT lang, count(*) AS v, sum(total) AS nl FROM k GROUP BY lang), "
        "c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL), "
        "g AS (SELECT lang, source, coalesce((SELECT sum(n) FROM c WHERE c.lang = x.lang AND c.source = x.source), 0) AS ng "
        "FROM (SELECT DISTINCT lang, source FROM d) AS x), "
        f"p AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, {chance('coalesce(n, 0)', 'ng')} AS p, "
        f"{chance('total', 'nl')} AS q FROM g JOIN l ON g.lang = l.lang JOIN k ON g.lang = k.lang "
        "LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term), "
        "s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value "
        "FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL), "
        "r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value "
        "FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source "
        "LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source), "
        "t AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value "
        "FROM p WHERE n > 0 AND p > q) "
        f"SELECT *, {ranked} FROM r UNION ALL SELECT * FROM (SELECT *, {ranked} FROM t) WHERE rank <= {divergence.TOP_TERMS}")


@query(_divergence_sql())
def op11_divergence(spark, sf_dir):
    return divergence.audit(_table(spark, sf_dir, "documents"))


def _trie_sql() -> str:
    # CRC-32 of the decimal digits, bit by bit.
    bit = "CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END"
    byte = f"list_reduce(list_prepend(xor(c, ascii(x)), [CAST(0 AS BIGINT) FOR i IN range(8)]), lambda r, i: {bit})"
    crc = (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]), "
           f"lambda c, a: {byte.replace('ascii(x)', 'a')}), 4294967295)")
    n = prefix_trie.HEADS
    return (
        "WITH t AS (SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) "
        "ORDER BY turn NULLS FIRST, role, text) AS l FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id), "
        f"h AS (SELECT conv_id, l, {crc} % {n} AS h FROM t), "
        f"r AS (SELECT h.conv_id, list_concat(coalesce(b.l[1:h.h], []), h.l[h.h + 1:]) AS l FROM h "
        f"LEFT JOIN t b ON b.conv_id = h.conv_id - h.conv_id % {prefix_trie.FAMILY}), "
        "p AS (SELECT conv_id, d, l[1:d] AS k, d = len(l) AS last FROM (SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS d FROM r)), "
        "g AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, "
        "sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256 FROM p GROUP BY k, d), "
        "c AS (SELECT k[1:d - 1] AS k, count(*) AS n_children FROM g WHERE d > 0 GROUP BY 1), "
        "o AS (SELECT g.*, coalesce(n_children, 0) AS n_children, "
        "CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * octet_length(encode(g.k[d].text)) END AS saved FROM g LEFT JOIN c ON c.k = g.k), "
        "a AS (SELECT k[1:e] AS k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens "
        "FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM o) GROUP BY 1) "
        "SELECT o.conv_id, CAST(o.d AS BIGINT) AS depth, q.conv_id AS parent_conv_id, o.n_convs, o.n_children, n_leaves, "
        "CAST(saved_tokens AS BIGINT) AS saved_tokens, o.ends_sha256 FROM o JOIN a ON a.k = o.k LEFT JOIN g q ON q.d = o.d - 1 AND q.k = o.k[1:o.d - 1]")


@query(_trie_sql())
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(_table(spark, sf_dir, "conversations"))


@query()
def op13_token_store(spark, sf_dir):
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    return token_store.round_trip(_table(spark, sf_dir, "documents"), tokenizer).select(
        "doc_id", "start", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
