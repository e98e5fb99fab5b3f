"""Secret scans over a history of texts, with an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its content (the
blob).  The ledger is a folder of Parquet files, one row per scanned blob: which
rule versions have run on it and what they found.  A scan looks up which (blob,
rule version) pairs are not in the ledger yet, reads the text of just one row
for each such blob, runs just the missing rules on it, and appends the outcome.
Findings are then joined back to all paths that hold the blob.  Copies are
scanned once, and a second scan over the same history reads no text at all
beyond hashing it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import map_arrow, same, shared_path, steps, text_col, unused, written


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` (leftmost, not overlapping) of which ``group`` has
    ``least`` characters or more.  A change of any of these needs a new ``version``.
    ``hints``: a text without any of them (any case) cannot match."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    flags: int = re.ASCII
    hints: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: The three base rules.
BASE = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8,
         re.ASCII | re.IGNORECASE, ("passw", "secret", "token", "api")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", 1, r"[0-9a-f]+", 0, 32),
)
#: Further kinds with a plain prefix of their own.
RULES = BASE + (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
FINDINGS = "array<struct<start:long,end:long,kind:string,rule:string>>"
LEDGER = f"blob binary, rules array<string>, findings {FINDINGS}"


def matches(rule: Rule, text: str, lower: str | None = None) -> list[tuple[int, int]]:
    """Start and end (code points, end exclusive) of the rule's matches."""
    if rule.hints and not any(h in (text.lower() if lower is None else lower) for h in rule.hints):
        return []
    return [m.span() for m in re.finditer(rule.pattern, text, rule.flags) if len(m[rule.group]) >= rule.least]


def _scanner(rules: tuple[Rule, ...]):
    by_name = {r.name: r for r in rules}
    # A run of hex digits that is too short can't match, so runs are found by their least length.
    long_run = re.compile(r"[0-9a-f]{32,}")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finding = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("rule", pa.string())])
        for batch, texts in steps(batches):
            found = []
            for names, text in zip(batch.column("missing").to_pylist(), texts):
                lower, out = text.lower(), []
                for k, name in enumerate(names):
                    rule = by_name[name]
                    spans = [m.span() for m in long_run.finditer(text)] if rule == BASE[2] else matches(rule, text, lower)
                    out += [{"start": a, "end": b, "kind": rule.kind, "rule": name} for a, b in spans]
                found.append(out)
            yield pa.RecordBatch.from_arrays([batch.column("blob"), batch.column("missing"), pa.array(found, pa.list_(finding))],
                                             names=["blob", "rules", "findings"])

    return scan


def open_ledger(spark, folder: str) -> DataFrame:
    """The ledger's rows; makes it if there is none."""
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(folder)
    return spark.read.schema(LEDGER).parquet(folder)


def _known(ledger: DataFrame, names: list[str]) -> DataFrame:
    """One row per blob: which of the rules have run, and their findings (rows
    that a repeated scan has added again count once)."""
    active = F.array(*(F.lit(n) for n in names))
    some = ledger.where(F.arrays_overlap("rules", active))
    return some.groupBy("blob").agg(
        F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"),
        F.array_distinct(F.flatten(F.collect_list(F.filter("findings", lambda f: F.array_contains(active, f["rule"]))))).alias("findings"))


def blob_of(text: str = "text"):
    return F.unhex(F.sha2(text_col(text).cast("binary"), 256))


def scan_history(versions: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES,
                 path: str = "doc_id", text: str = "text") -> DataFrame:
    """``path``, ``blob`` and ``findings`` (``start``, ``end``, ``kind``, ``rule``,
    ordered by start, then by the rules' order) of every row of ``versions``.

    ``ledger`` is a folder that all executors reach; without one, a new ledger
    is begun.  A null text is empty; null paths are paths.  Repeated rows are
    repeated in the result.
    """
    spark = versions.sparkSession
    folder = ledger or shared_path(spark, "ledger")
    names = [r.name for r in rules]
    active = F.array(*(F.lit(n) for n in names))
    rows = written(versions.select(F.col(path).alias("path"), blob_of(text).alias("blob")), "blobs")
    # One row to read for each blob with missing pairs.
    first = rows.groupBy("blob").agg(F.min("path").alias("b_path")).withColumnRenamed("blob", "b_blob")
    seen = _known(open_ledger(spark, folder), names).select(F.col("blob").alias("s_blob"), "seen")
    nothing = F.array().cast("array<string>")
    todo = first.join(seen, F.col("b_blob") == F.col("s_blob"), "left").select(
        "b_blob", "b_path", F.array_except(active, F.coalesce("seen", nothing)).alias("missing")).where(F.size("missing") > 0)
    texts = versions.select(F.col(path).alias("path"), F.col(text).cast("string").alias("text")).withColumn("blob", blob_of("text"))
    unseen = texts.join(todo.hint("shuffle_hash"), same(F.col("path"), F.col("b_path")) & (F.col("blob") == F.col("b_blob")))
    scanned = map_arrow(unseen.select("blob", "missing", "text"), _scanner(rules), LEDGER)
    scanned.write.mode("append").option("compression", "zstd").parquet(folder)
    place = F.create_map(*(x for k, r in enumerate(rules) for x in (F.lit(r.name), F.lit(k))))
    ordered = F.transform(
        F.array_sort(F.transform("findings", lambda f: F.struct(f["start"], F.element_at(place, f["rule"]).alias("place"), f["end"], f["kind"], f["rule"]))),
        lambda f: F.struct(f["start"], f["end"], f["kind"], f["rule"]))
    found = _known(open_ledger(spark, folder), names).where(F.size("findings") > 0).select(F.col("blob").alias("f_blob"), ordered.alias("findings"))
    return rows.join(found, F.col("blob") == F.col("f_blob"), "left").select(
        F.col("path").alias(path), "blob", F.coalesce("findings", F.array().cast(FINDINGS)).alias("findings"))


def mask_secrets(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with each found secret replaced by ``[kind]`` (findings that
    overlap: once, by the first kind).  ``n_chars``, if there is such a column,
    follows the new text.  Documents without findings are unchanged; none go."""
    found = scan_history(docs, ledger, rules, doc_id, text).where(F.size("findings") > 0).select(
        F.col(doc_id).alias("f_id"), F.col("blob").alias("f_blob"), F.col("findings").alias("f_findings")).distinct()
    blob = unused(docs, "blob")
    joined = docs.withColumn(blob, blob_of(text)).join(
        found.hint("shuffle_hash"), same(F.col(doc_id), F.col("f_id")) & (F.col(blob) == F.col("f_blob")), "left")
    body = text_col(text)

    def add(state, f):
        # The text so far and the place up to which the original is used up.
        before = F.substring(body, (state["at"] + 1).cast("int"), (f["start"] - state["at"]).cast("int"))
        return (F.when(f["start"] >= state["at"], F.struct(F.concat(state["out"], before, F.lit("["), f["kind"], F.lit("]")).alias("out"), f["end"].alias("at")))
                .otherwise(F.struct(state["out"].alias("out"), F.greatest(state["at"], f["end"]).alias("at"))))

    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    masked = F.aggregate("f_findings", start, add, lambda s: F.concat(s["out"], F.substring(body, (s["at"] + 1).cast("int"), 2**31 - 1)))
    hit = F.col("f_blob").isNotNull()
    out = joined.withColumn(text, F.when(hit, masked).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(hit, F.char_length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
