"""Secret scans over an incremental blob ledger, in built-in functions only.

Every version of a file is named by the hash of its content. The ledger keeps, per blob, which
rule versions have scanned it and what they found; an update scans only the pairs of blob and
rule version it has not seen, and findings lead back to every path that holds the blob.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspan.llm.common import join_with_hot_keys, scratch_path, sized, stored


@dataclass(frozen=True)
class Rule:
    """A pattern; ``least`` characters are asked of its group ``group`` (0: of the match)."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# Fixed values. The lengths of access and hex are part of the pattern: a run is taken whole, so
# no shorter match can hide a longer one. The first three are the base kinds, in their order.
RULES = (
    Rule(
        "assign", 1,
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
    Rule("pem", 2, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    # Only from the start of a run of its characters, so that no run is read more than once.
    Rule("jwt", 2, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
)
BASE = ("assign", "access", "hex")
SPAN = "struct<start: int, kind_no: int, end: int>"
# What the ledger keeps: a rule's place in the list may change, its name and version may not.
PART = "struct<start: int, end: int>"
FOUND = f"array<struct<rule: string, spans: array<{PART}>>>"


def spans(text: Column, rule: Rule) -> Column:
    """(start, end) of the leftmost non-overlapping matches, in code points.

    The pieces between the matches and the matches themselves alternate, so their lengths
    add up to the positions.
    """
    pattern = F.lit(rule.pattern)
    pieces = F.transform(F.split(text, pattern, -1), F.length)
    hits = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    sizes = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{PART}>").alias("found"))

    def step(state: Column, m: Column) -> Column:
        here = state["at"] + m["gap"]
        span = F.struct(here.alias("start"), (here + m["hit"]).alias("end"))
        more = F.concat(state["found"], F.array(span.cast(PART)))
        return F.struct(
            (here + m["hit"]).alias("at"), F.when(m["size"] >= rule.least, more).otherwise(state["found"]).alias("found")
        )

    rows = F.arrays_zip(pieces.alias("gap"), hits.alias("hit"), sizes.alias("size"))
    matched = F.filter(rows, lambda m: m["hit"].isNotNull())
    none = F.array().cast(f"array<{PART}>")
    return F.when(text.rlike(rule.pattern), F.aggregate(matched, start, step, lambda s: s["found"])).otherwise(none)


class BlobLedger:
    """A Parquet folder of rows (blob, found), appended by each update; found has the spans of each
    rule version that the update scanned for, under its name, also where there are none."""

    def __init__(self, spark: SparkSession, path: str, rules: tuple[Rule, ...] = RULES):
        self.spark, self.path, self.rules = spark, path, rules

    def _read(self) -> DataFrame:
        schema = f"blob string, found {FOUND}"
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except Exception as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return self.spark.createDataFrame([], schema)

    def update(self, versions: DataFrame, text_col: str = "text") -> int:
        """Scan what is new; returns how many blobs had an unseen rule version.

        Null texts are the empty blob. Copies of a blob are one before anything moves.
        """
        text = F.coalesce(F.col(text_col), F.lit(""))
        rows = versions.select(F.sha2(text.cast("binary"), 256).alias("blob"), text.alias("text"))
        names = F.array(*[F.lit(r.name) for r in self.rules])
        seen = self._read()
        if seen.isEmpty():
            todo = rows.groupBy("blob").agg(F.first("text").alias("text")).withColumn("unseen", names)
        else:
            known = seen.select("blob", F.explode("found.rule").alias("rule")).groupBy("blob").agg(
                F.collect_set("rule").alias("known")
            )
            unseen = F.array_except(names, F.coalesce("known", F.array().cast("array<string>")))
            # Hashes tell what is new before any text moves.
            new = rows.select("blob").distinct().join(known, "blob", "left").select("blob", unseen.alias("unseen"))
            new = sized(stored(new.filter(F.size("unseen") > 0), "unseen"))
            todo = rows.join(new, "blob").groupBy("blob").agg(F.first("text").alias("text"), F.first("unseen").alias("unseen"))
        found = F.array(
            *[
                F.when(
                    F.array_contains("unseen", r.name),
                    F.struct(F.lit(r.name).alias("rule"), spans(F.col("text"), r).alias("spans")),
                )
                for r in self.rules
            ]
        )
        fresh = stored(todo.select("blob", F.array_compact(found).cast(FOUND).alias("found")), "scanned")
        fresh.write.mode("append").parquet(self.path)
        return fresh.count()

    def findings(self, versions: DataFrame, path_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(path, blob, spans) for every row of ``versions``; spans sorted, maybe empty.

        Only the spans of the ledger's current rule versions count. Repeated paths and rows
        without a path give a row each. A blob in very many paths goes to them by broadcast.
        """
        paths = stored(
            versions.select(
                F.col(path_col).alias("path"),
                F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256).alias("blob"),
            ),
            "paths",
        )
        names = F.array(*[F.lit(r.name) for r in self.rules])
        kind_no = (F.array_position(names, F.col("one.rule")) - 1).cast("int")
        spans_of = (
            self._read()
            .select("blob", F.explode("found").alias("one"))
            .filter((F.size("one.spans") > 0) & F.col("one.rule").isin([r.name for r in self.rules]))
            .select("blob", kind_no.alias("kind_no"), F.explode("one.spans").alias("s"))
            .groupBy("blob")
            .agg(F.array_sort(F.collect_set(F.struct("s.start", "kind_no", "s.end"))).cast(f"array<{SPAN}>").alias("spans"))
        )
        counted = paths.groupBy("blob").agg(F.count("*").alias("copies")).join(spans_of, "blob")
        joined = join_with_hot_keys(paths, stored(counted, "findings"), "blob", "copies", paths.count())
        return joined.select(
            "path", "blob", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans")
        )


def scan(docs: DataFrame, path_col: str = "doc_id", text_col: str = "text", ledger: str | None = None) -> DataFrame:
    """Update a ledger, a new one unless a path is given, with these rows and return their findings."""
    book = BlobLedger(docs.sparkSession, ledger or scratch_path(docs.sparkSession, "blob-ledger"))
    book.update(docs, text_col)
    return book.findings(docs, path_col, text_col)


def listed(spans_col: str | Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(
        F.transform(spans_col, lambda s: F.concat_ws(":", F.get(names, s["kind_no"]), s["start"], s["end"])), ","
    )
