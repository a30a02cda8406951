"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every version of a text is addressed by the SHA-256 of its bytes (its blob). The ledger, a
Parquet table in a shared folder, holds one row for each (blob, rule_version) that has been scanned,
with the spans found. A scan hashes all versions, keeps one representative row for each blob
that the ledger lacks under the current rule version, runs the rules on those alone, appends
the results and joins the ledger back to every path that carries the blob.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import free_name

CONF_LEDGER = "spillway.secrets.ledger"
SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost non-overlapping matches of ``pattern``; those with a ``group`` under ``least`` characters are dropped."""

    kind: str
    pattern: str
    group: int
    least: int
    base: bool = True


# The base rules and two more of this scan.
KEYWORD = ("([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
           "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])")
# A private key from its header to its END line. Where that is missing: the header, header fields, the run of base64
# pieces (line breaks may be escaped) and a last short piece that is padded or alone on its line.
# Loops are possessive, so long keys need no stack and a text is read once.
PEM_BEGIN = "-----BEGIN [A-Z ]*PRIVATE KEY(?: BLOCK)?-----"
PEM_END = "-----END [A-Z ]*PRIVATE KEY(?: BLOCK)?-----"
_GAP = r"""(?:[\s"'+,>]|\\[nr])*+"""
PEM = (PEM_BEGIN + "(?:(?:[^-]++|-(?!----))*+" + PEM_END
       + r"|(?:\s*+(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset): ?[^\n]*+)*+"
       + "(?:(?:" + _GAP + "[A-Za-z0-9+/]{16,}+={0,2})++"
       + "(?:" + _GAP + r"[A-Za-z0-9+/]{1,15}+={1,2}|[\x20\t\r]*+\n[\x20\t]*+[A-Za-z0-9+/]{1,15}+(?=[\x20\t\r]*+(?:\n|\z)))?)?)")
RULES = (
    Rule("assign", KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]{24,}", 0, 24),  # a run of 24 or more starts where its [0-9a-f]+ match does
    Rule("private_key", PEM, 0, 1, base=False),
    Rule("vendor_token", "(?:gh[pousr]_|xox[abprs]-|glpat-)[A-Za-z0-9_-]{20,}", 0, 20, base=False),
)
RULE_VERSION = "1.1"


def _kind_spans(text: Column, kind: int, rule: Rule) -> Column:
    """Spans of one rule: the gaps between matches and the matches, laid end to end, give the code point positions."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    steps = F.arrays_zip(F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"),
                         F.transform(found, F.length).alias("size"), F.transform(value, F.length).alias("value"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(None).cast(SPANS).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), (begin + x["size"]).alias("end"))
        spans = F.when(x["value"] >= rule.least, F.concat(F.coalesce(acc["spans"], F.array().cast(SPANS)), F.array(span)))
        return F.struct((begin + F.coalesce(x["size"], F.lit(0))).alias("at"), F.coalesce(spans, acc["spans"]).alias("spans"))

    spans = F.aggregate(steps, start, step, lambda acc: acc["spans"])
    return F.when(text.rlike(rule.pattern), F.coalesce(spans, F.array().cast(SPANS))).otherwise(F.array().cast(SPANS))


def find_secrets(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All spans of a non-NULL text, by start, then kind as listed; code points, end exclusive."""
    return F.sort_array(F.concat(*[_kind_spans(text, k, r) for k, r in enumerate(rules)]))


def scan_versions(versions: DataFrame, ledger: str, path_col: str = "doc_id", text_col: str = "text",
                  rules: tuple[Rule, ...] = RULES, rule_version: str = RULE_VERSION) -> DataFrame:
    """(path, blob, spans): the findings of every version, scanning only what the ledger lacks.

    ``ledger`` is a folder in a shared store (need not exist yet). Each call appends at most one
    batch to it: a failed call leaves no committed rows, and a repeated one finds nothing to add.

    Defined cases: a NULL text is the empty blob; repeated rows and copies are scanned once and
    reported for every row; a NULL path is a path like any other; an empty table adds and
    returns no rows; other columns are ignored. A very long text is one row and is scanned whole.
    """
    spark = versions.sparkSession
    rows = versions.select(F.col(path_col).alias("path"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("blob", F.unhex(F.sha2("text", 256)))
    known = read_ledger(spark, ledger).where(F.col("rule_version") == rule_version)
    fresh = rows.groupBy("blob").agg(F.min("path").alias("path"))
    fresh = fresh.join(known.select("blob"), "blob", "left_anti") if not known.isEmpty() else fresh
    # one representative row a blob: the small id table is the hash side, so texts move once, unsorted
    pick = fresh.select(F.col("blob").alias("b"), F.col("path").alias("p")).hint("shuffle_hash")
    text = rows.join(pick, rows.path.eqNullSafe(pick.p) & (rows.blob == pick.b), "left_semi")
    found = (text.select("blob", find_secrets(F.col("text"), rules).alias("spans"))
             .dropDuplicates(["blob"]).select("blob", F.lit(rule_version).alias("rule_version"), "spans"))
    found.write.mode("append").parquet(ledger)
    done = findings(spark, ledger, rule_version).select(F.col("blob").alias("b"), "spans")
    return (rows.select("path", "blob").join(done, F.col("blob") == F.col("b"), "left")
            .select("path", "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans")))


def read_ledger(spark, ledger: str) -> DataFrame:
    """The ledger table; no rows where the folder does not exist yet."""
    schema = f"blob binary, rule_version string, spans {SPANS}"
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(schema).parquet(ledger) if there else spark.createDataFrame([], schema)


def findings(spark, ledger: str, rule_version: str) -> DataFrame:
    """(blob, spans) of the blobs with a finding, one row each: overlapping scans may have added a pair twice, with the same spans."""
    rows = read_ledger(spark, ledger).where((F.col("rule_version") == rule_version) & (F.size("spans") > 0))
    return rows.select("blob", "spans").dropDuplicates(["blob"])


def ledger_path(spark) -> str:
    """The ledger folder that the session names (``spillway.secrets.ledger``), which later scans go on from; else a new one."""
    return spark.conf.get(CONF_LEDGER, None) or scratch_path(spark, "secret-ledger")


def digest(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_spans) of scan_versions()."""
    base = [k for k, r in enumerate(rules) if r.base]
    only = F.filter("spans", lambda s: s["kind"].isin(base))

    def count(k: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint")

    return findings.select(
        F.col("path").alias("doc_id"), *[count(k).alias(f"n_{rules[k].kind}") for k in base],
        F.sha2(digest(only, rules), 256).alias("base_sha256"), digest(F.col("spans"), rules).alias("spans"),
        F.size("spans").cast("bigint").alias("n_spans"))


def masked(text: Column, spans: Column, mask: str = "[REDACTED]") -> Column:
    """``text`` with every span (overlaps merged) replaced by ``mask``."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        fresh = F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, F.lit(mask)).alias("out"))
        joined = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when((s["start"] < acc["at"]) & (acc["at"] > 0), joined).otherwise(fresh)

    return F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))


def mask_secrets(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """``docs`` with the secrets in ``text`` masked (n_chars brought in line); no row is dropped.

    Only rows that carry a finding take part in the masking; a NULL text stays NULL.
    The texts move once, keyed by blob; copies of one blob are split by the adaptive skew join.
    """
    spark = docs.sparkSession
    ledger = ledger or ledger_path(spark)
    scan_versions(docs, ledger)
    done = findings(spark, ledger, RULE_VERSION)
    b, s, k = (free_name(docs.columns, x) for x in ("blob_", "spans_", "own_blob_"))
    done = done.select(F.col("blob").alias(b), F.col("spans").alias(s))
    # texts without a secret-like match carry a NULL key: they meet nothing and need no hash
    suspect = F.lit(False)
    for r in RULES:
        suspect = suspect | F.col("text").rlike(r.pattern)
    own = docs.withColumn(k, F.when(suspect, F.unhex(F.sha2("text", 256))))
    hit = own.where(F.col(k).isNotNull()).join(done, F.col(k) == F.col(b), "left")
    text = F.when(F.size(s) > 0, masked(F.col("text"), F.col(s))).otherwise(F.col("text"))
    hit = hit.withColumn(s, F.coalesce(s, F.array().cast(SPANS)))
    hit = hit.withColumn("text", text).select(*docs.columns)
    if "n_chars" in docs.columns:
        own_chars = F.when(F.col("n_chars").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType))
        hit = hit.withColumn("n_chars", own_chars)
    return hit.unionByName(own.where(F.col(k).isNull()).select(*docs.columns))
