"""Secret scanning with an incremental blob ledger.

Every version of every document is addressed by the SHA-256 of its text (a blob).
The ledger is a table in the shared folder with one row per scanned blob and rule
version. A scan reads only blobs that the ledger lacks under the current rules,
one copy of each, appends their findings, and joins the ledger back to all rows
that hold the blob. Adding versions costs the new blobs; changing a rule changes
the rule version and scans every blob once more.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldfit.llm.common import free_name, stored
from fieldfit.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds leftmost non-overlapping matches; one counts if ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int
    least: int


RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    # For these two a run that is too short holds no long enough match either.
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)

LEDGER = "blob string, rules string, spans array<struct<start:bigint,kind:int,stop:bigint>>"


def rule_version(rules: tuple[Rule, ...]) -> str:
    return hashlib.sha256(repr(rules).encode()).hexdigest()


def address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def findings(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(``blob``, ``spans``) for every row of ``blobs`` (``blob``, ``text``), one row per blob.

    Offsets come from the lengths of matches and of the gaps between them, summed
    per blob and kind over its matches.
    """
    text = F.col("text")
    found = [
        F.struct(F.lit(i).alias("kind"), F.regexp_extract_all(text, F.lit(r.pattern), F.lit(0)).alias("whole"))
        for i, r in enumerate(rules)
    ]
    none = F.struct(F.lit(-1).alias("kind"), F.array(F.lit("")).alias("whole"))  # keeps blobs without a match
    hits = blobs.select("blob", "text", F.explode(F.array(*found, none)).alias("hit")).where(F.size("hit.whole") > 0)

    def per_rule(make):
        out = F.lit(None)
        for i, r in enumerate(rules):
            out = F.when(F.col("hit.kind") == i, make(r)).otherwise(out)
        return out

    gaps = per_rule(lambda r: F.split(text, r.pattern, -1))
    groups = per_rule(lambda r: F.regexp_extract_all(text, F.lit(r.pattern), F.lit(r.group)) if r.group else F.col("hit.whole"))
    least = per_rule(lambda r: F.lit(r.least))
    lengths = lambda c: F.transform(c, F.length)
    each = hits.select(
        "blob",
        F.col("hit.kind").alias("kind"),
        least.alias("least"),
        F.posexplode(
            F.arrays_zip(
                lengths(F.col("hit.whole")).alias("n"),
                F.slice(F.coalesce(lengths(gaps), F.array(F.lit(0))), F.lit(1), F.size("hit.whole")).alias("gap"),
                F.coalesce(lengths(groups), F.array(F.lit(0))).alias("group"),
            )
        ).alias("nth", "m"),
    )
    so_far = Window.partitionBy("blob", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("stop", F.sum(F.col("m.gap") + F.col("m.n")).over(so_far))
    span = F.struct((F.col("stop") - F.col("m.n")).cast("bigint").alias("start"), "kind", F.col("stop").cast("bigint").alias("stop"))
    counts = (F.col("kind") >= 0) & (F.col("m.group") >= F.col("least"))
    return placed.groupBy("blob").agg(F.sort_array(F.collect_list(F.when(counts, span))).alias("spans"))


def scan(spark: SparkSession, docs: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Brings the ledger at path ``ledger`` up to date with ``docs`` and returns its rows for ``rules``.

    Only blobs without a ledger row for this rule version are scanned.
    """
    version = rule_version(rules)
    blobs = docs.select(address(F.col(f"`{text}`")).alias("blob"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    known = read_ledger(spark, ledger)
    if known is not None:
        blobs = blobs.join(known.where(F.col("rules") == version).select("blob"), "blob", "left_anti")
    one = Window.partitionBy("blob").orderBy(F.lit(0))
    fresh = blobs.withColumn("nth", F.row_number().over(one)).where("nth = 1").drop("nth")
    findings(fresh, rules).select("blob", F.lit(version).alias("rules"), "spans").write.mode("append").parquet(ledger)
    return read_ledger(spark, ledger).where(F.col("rules") == version)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame | None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(LEDGER).parquet(ledger)


def secrets(
    docs: DataFrame, key: str = "doc_id", text: str = "text", ledger: str | None = None, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """One row per row of ``docs``: key, ``blob`` and its ``spans`` (start, kind number, end; code points).

    * NULL text counts as empty; every row of a repeated text gets its findings.
    * Without ``ledger`` a new one is begun in the shared folder.
    * NULL and repeated keys keep their rows; other columns may have any name; an
      empty table gives an empty result.
    """
    spark = docs.sparkSession
    book = scan(spark, docs, ledger or scratch_path(spark, "blob-ledger"), text, rules)
    paths = docs.select(F.col(f"`{key}`").alias(key), address(F.col(f"`{text}`")).alias("blob"))
    return paths.join(book.select("blob", "spans"), "blob").select(key, "blob", "spans")


def written(spans: Column, rules: tuple[Rule, ...]) -> Column:
    """Spans as ``kind:start:end``, joined by commas in order of start, then of rule."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", ledger: str | None = None) -> DataFrame:
    """Counts per kind, digest and text of the spans of every row."""
    found = secrets(docs, key, text, ledger)
    of = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("bigint")
    return found.select(
        key,
        *[of(i).alias(f"n_{r.kind}") for i, r in enumerate(RULES)],
        F.sha2(written(F.col("spans"), RULES), 256).alias("base_sha256"),
        written(F.col("spans"), RULES).alias("spans"),
    )


def redacted(docs: DataFrame, text: str = "text", mark: str = "[secret]", ledger: str | None = None) -> DataFrame:
    """``docs`` with every found span replaced by ``mark``; overlapping spans become one.

    Rows without findings, NULL texts included, stay as they are. A column
    ``n_chars`` follows the new text.
    """
    spark = docs.sparkSession
    book = scan(spark, docs, ledger or scratch_path(spark, "blob-ledger"), text)
    found = stored(book.where(F.size("spans") > 0).select("blob", "spans"), "findings")
    blob, spans = free_name(docs, "_blob", "_spans")
    rows = docs.withColumn(blob, address(F.col(f"`{text}`")))
    joined = rows.join(found.withColumnsRenamed({"blob": blob, "spans": spans}), blob, "left")
    # spans in order; a piece runs from the furthest end so far to the next start
    old = F.col(f"`{text}`")
    start = F.struct(F.lit(0).cast("bigint").alias("upto"), F.array().cast("array<string>").alias("parts"))

    def step(acc, s):
        cut = F.when(
            s["start"] >= acc["upto"],
            F.concat(acc["parts"], F.array(old.substr((acc["upto"] + 1).cast("int"), (s["start"] - acc["upto"]).cast("int")), F.lit(mark))),
        ).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["upto"], s["stop"]).alias("upto"), cut.alias("parts"))

    def finish(acc):
        return F.concat(F.array_join(acc["parts"], ""), old.substr((acc["upto"] + 1).cast("int"), F.length(old)))

    new = F.when(F.col(spans).isNull(), old).otherwise(F.aggregate(F.col(spans), start, step, finish))
    out = joined.withColumn(text, new)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length(F.col(f"`{text}`")).cast(docs.schema["n_chars"].dataType)))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


SQL = r"""
WITH rules(k, kind, pattern, grp, least) AS (VALUES
  (0, 'assign', '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
  (1, 'access', 'AKIA[A-Z0-9]+', 0, 20),
  (2, 'hex', '[0-9a-f]+', 0, 24)
), d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), m AS (
  SELECT r, k, kind, least, regexp_extract_all(t, pattern, 0) AS ms, string_split_regex(t, pattern) AS gs,
         CASE WHEN k = 0 THEN regexp_extract_all(t, '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2)
              ELSE regexp_extract_all(t, pattern, 0) END AS vs
  FROM d CROSS JOIN rules
), e AS (
  SELECT r, k, kind, least, length(ms[i]) AS n, length(gs[i]) AS gap, length(vs[i]) AS v, i
  FROM (SELECT *, unnest(generate_series(1, len(ms))) AS i FROM m WHERE len(ms) > 0)
), p AS (
  SELECT r, k, kind, least, v, n, sum(gap + n) OVER (PARTITION BY r, k ORDER BY i ROWS UNBOUNDED PRECEDING)::BIGINT AS stop FROM e
), s AS (
  SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg(kind || ':' || (stop - n) || ':' || stop, ',' ORDER BY stop - n, k) AS spans
  FROM p WHERE v >= least GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN s USING (r)
"""
