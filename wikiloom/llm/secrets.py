"""Secret scans with a ledger of blobs.

A text is stored history like any other: its SHA-256 is the name of a blob, and
any number of paths and versions may hold the same blob. The ledger keeps one
row per blob and scan: the versions of the rules that ran and what they found. A
scan takes the distinct blobs of its input, leaves out the rule versions that
the ledger has for each, runs the rest and appends. Findings are joined from
the ledger to all paths. Only SQL functions run on the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A pattern whose group ``value`` must have ``least`` characters; a new pattern needs a new version.

    ``hint`` is a cheaper pattern that every text with a match has too.
    """

    kind: str
    pattern: str
    least: int = 1
    value: int = 0
    hint: str = ""
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# Fixed patterns of the base rules.
BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 1,
         r"(?i)password|passwd|secret|token|api_?key"),
    Rule("access", r"AKIA[A-Z0-9]+", 20, 0, "AKIA"),
    Rule("hex", r"[0-9a-f]+", 24, 0, r"[0-9a-f]{24}"),
)
EXTRA = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", hint="PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}+[.]eyJ[A-Za-z0-9_-]{10,}+[.][A-Za-z0-9_-]{10,}+", hint=r"[.]eyJ"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}+", hint=r"gh[pousr]_"),
)
RULES = BASE + EXTRA
LEDGER = "blob binary, rules array<string>, findings array<struct<kind:string,start:int,end:int>>"


def matches(text: Column, rule: Rule) -> Column:
    """Array of ``kind, skipped, length, keep`` of the rule's matches, lengths in code points.

    Leftmost matches that do not overlap; ``keep`` is false for those with too
    short a value, which take their characters all the same. The gap before
    each match is extracted with it and tied to the end of the match before, so
    places are running sums of ``skipped + length`` and the rest of the text is
    read once.
    """
    whole = F.lit(rf"\G([\s\S]*?)({rule.pattern})")
    gaps, found = (F.regexp_extract_all(text, whole, F.lit(i)) for i in (1, 2))
    values = F.regexp_extract_all(text, whole, F.lit(3)) if rule.value else found
    parts = F.arrays_zip(gaps.alias("gap"), found.alias("match"), values.alias("value"))
    return F.transform(parts, lambda part: F.struct(
        F.lit(rule.kind).alias("kind"), F.length(part["gap"]).alias("skipped"), F.length(part["match"]).alias("length"),
        (F.length(part["value"]) >= rule.least).alias("keep")))


def placed(found: DataFrame) -> DataFrame:
    """``blob, rules, findings`` from ``blob, rules, matches``, one row per blob.

    A match is a row: its end is a running sum over the blob's matches of its
    kind, so a text with very many takes time by their number. The rows are
    narrow and stay where the blobs are.
    """
    before = Window.partitionBy("blob", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("match.skipped") + F.col("match.length")).over(before).cast("int")
    span = F.struct("kind", (F.col("end") - F.col("match.length")).alias("start"), "end")
    return (found.select("blob", "rules", F.posexplode_outer("matches").alias("at", "match"))
            .withColumn("kind", F.col("match.kind")).withColumn("end", end)
            .groupBy("blob").agg(F.any_value("rules").alias("rules"), F.collect_list(F.when(F.col("match.keep"), span)).alias("findings")))


def _text(docs: DataFrame) -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows; none where nothing was scanned yet."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(LEDGER).parquet(path) if there else spark.createDataFrame([], LEDGER)


def unseen(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``blob, text, todo``: distinct blobs with the rule versions that have not seen them."""
    text = _text(docs)
    blobs = docs.select(blob_of(text).alias("blob"), text.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    wanted = F.array(*(F.lit(rule.name) for rule in rules))
    todo = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
    return blobs.join(seen, "blob", "left").select("blob", "text", todo.alias("todo")).where(F.size("todo") > 0)


def scan(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan what the ledger at ``path`` has not seen, and append to it.

    One write appends pairs and findings together, so a scan that fails leaves
    no pair marked as seen; a scan that is repeated finds nothing to do.
    """
    none = F.array().cast("array<struct<kind:string,skipped:int,length:int,keep:boolean>>")
    found = [F.when(F.array_contains("todo", rule.name) & F.col("text").rlike(rule.hint or rule.pattern),
                    matches(F.col("text"), rule)).otherwise(none) for rule in rules]
    (placed(unseen(docs, read_ledger(docs.sparkSession, path), rules)
            .select("blob", F.col("todo").alias("rules"), F.flatten(F.array(*found)).alias("matches")))
     .write.mode("append").parquet(path))


def _joined(findings: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` by start, then kind as listed, joined by commas."""
    order = F.array(*map(F.lit, kinds))
    ranked = F.transform(F.filter(findings, lambda f: f["kind"].isin(kinds)), lambda f: F.struct(
        f["start"], F.array_position(order, f["kind"]).alias("rank"), f["end"], f["kind"]))
    return F.concat_ws(",", F.transform(F.array_sort(ranked), lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])))


def findings(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, n_<base kind>..., base_sha256, spans``: the ledger's findings at every path.

    A row per row of ``docs``; a null text is an empty one and has no finding.
    Findings of other rule versions are left out. Repeated rows and copies get
    the findings of their blob; a hot blob is one row of the ledger, and the
    paths of it are split by the skew join.
    """
    names = F.array(*(F.lit(rule.name) for rule in rules))
    kinds = {rule.kind: rule.name for rule in rules}
    kind = F.split_part("rule", F.lit("@"), F.lit(1))
    known = (read_ledger(docs.sparkSession, path)
             .select("blob", F.explode(F.array_intersect("rules", names)).alias("rule"), "findings")
             .select("blob", "rule", F.filter("findings", lambda f: f["kind"] == kind).alias("findings"))
             .where(F.size("findings") > 0)
             .groupBy("blob", "rule").agg(F.any_value("findings").alias("findings"))  # a rule that ran twice found the same
             .groupBy("blob").agg(F.flatten(F.collect_list("findings")).alias("findings")))
    base = [rule.kind for rule in BASE]
    all_spans = _joined(F.col("findings"), list(kinds))
    report = known.select("blob", *(F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")
                                    for kind in base),
                          F.sha2(_joined(F.col("findings"), base).cast("binary"), 256).alias("base_sha256"), all_spans.alias("spans"))
    paths = docs.select("doc_id", blob_of(_text(docs)).alias("blob"))
    return paths.join(report, "blob", "left").select(
        "doc_id", *(F.coalesce(f"n_{kind}", F.lit(0)).cast("long").alias(f"n_{kind}") for kind in base),
        F.coalesce("base_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"))
