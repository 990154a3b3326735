"""Secret scans with an incremental blob ledger.

Every version of every path is content-addressed (SHA-256 of its UTF-8 bytes). The ledger holds
which (blob, rule version) pairs have been scanned and what was found. A run scans only distinct
blobs that the ledger lacks for its rule version, and joins the findings to all paths of a blob. The
rule version is a digest of the rules, so a changed rule scans everything once more.

Spans are in code points, end exclusive. A rule's matches are the leftmost, non-overlapping ones;
positions come from the lengths of the pieces between matches, summed by a window over one blob's
matches. Only DataFrame functions are used.

Defined cases: null text is the empty blob; equal texts are one blob with the same spans on every
row; an empty table gives an empty result; a blob without findings is in the ledger too, so that it
isn't scanned again; a run that stops between its two appends leaves findings that the next run
finds again, and readers drop the repetitions. Columns named digest or spans are replaced.
"""

from __future__ import annotations

import hashlib
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, named_back, set_apart

BLOBS = "digest binary, rules string"
FINDINGS = "digest binary, rules string, kind string, start long, end long"
SPANS = "array<struct<start: long, rank: int, end: long, kind: string>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern, and the group whose length must reach ``least``."""

    kind: str
    pattern: str
    group: int
    least: int


#: The base kinds, then those this scan adds. Runs of hex digits and of access key characters are
#: maximal, so a least length in the pattern finds just the matches that are long enough; for the
#: assignments a match that is too short still uses up its text, so it is found first and then dropped.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}", 0, 40),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
)


def rule_version(rules: tuple[Rule, ...]) -> str:
    return hashlib.sha256(repr([astuple(r) for r in rules]).encode()).hexdigest()


def _read(spark: SparkSession, path: str, schema: str, version: str) -> DataFrame:
    """A ledger table's rows of one rule version; empty before the first append."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).where(F.col("rules") == version).dropDuplicates()


def find_spans(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(digest, kind, start, end) of every match in blobs (digest, text)."""
    def parts(rule: Rule):
        pattern = F.lit(rule.pattern)
        return F.when(F.col("text").rlike(rule.pattern), F.arrays_zip(
            F.transform(F.split("text", rule.pattern, -1), lambda x: F.length(x)).alias("between"),
            F.transform(F.regexp_extract_all("text", pattern, F.lit(0)), lambda x: F.length(x)).alias("whole"),
            F.transform(F.regexp_extract_all("text", pattern, F.lit(rule.group)), lambda x: F.length(x)).alias("value")))

    found = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.least).alias("least"), parts(r).alias("parts")) for r in rules])
    each = blobs.select("digest", F.explode(found).alias("f")).where("f.parts IS NOT NULL")
    each = each.select("digest", "f.kind", "f.least", F.posexplode("f.parts").alias("at", "p")).where("p.whole IS NOT NULL")
    along = Window.partitionBy("digest", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.withColumn("end", F.sum((F.col("p.between") + F.col("p.whole")).cast("long")).over(along))
    return each.where("p.value >= least").select("digest", "kind", (F.col("end") - F.col("p.whole")).alias("start"), "end")


def scan_secrets(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """``versions`` without its text, with the digest of each row's blob and its spans, sorted by
    start and then by the rules' order. The ledger at ``ledger`` is brought up to date."""
    spark, version = versions.sparkSession, rule_version(rules)
    left_out = (text_col, "digest", "spans")
    versions, names = set_apart(versions)
    text_col, names = names[text_col], {c: given for c, given in names.items() if c not in left_out}
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.sha2(text, 256)).alias("digest")
    paths = materialise(versions.select(*names.values(), digest), "blob-paths")
    seen = _read(spark, f"{ledger}/blobs", BLOBS, version).select("digest")
    fresh = versions.select(digest, text.alias("text")).join(seen, "digest", "left_anti").dropDuplicates(["digest"])
    (find_spans(fresh, rules).select("digest", F.lit(version).alias("rules"), "kind", "start", "end")
     .write.mode("append").parquet(f"{ledger}/findings"))
    (paths.select("digest").join(seen, "digest", "left_anti").distinct().select("digest", F.lit(version).alias("rules"))
     .write.mode("append").parquet(f"{ledger}/blobs"))

    rank = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("kind")).cast("int")
    spans = (_read(spark, f"{ledger}/findings", FINDINGS, version)
             .groupBy(F.col("digest").alias("_digest")).agg(F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind"))).alias("spans")))
    joined = paths.join(spans, F.col("digest") == F.col("_digest"), "left")
    found = joined.select(*names.values(), "digest", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))
    return named_back(found, names, left_out, ("digest", "spans"))


def span_text(spans):
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
