"""Findings and coverage: what rules report, and what was looked at.

A rule is a condition on the rows of a table.  All rules of a table are one projection to an array of structs, filtered and
exploded, so a table is scanned once however many rules apply to it.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FINDING = T.StructType([
    T.StructField("source_id", T.StringType()), T.StructField("source_sha256", T.StringType()), T.StructField("rule_id", T.StringType()), T.StructField("severity", T.StringType()),
    T.StructField("sheet", T.StringType()), T.StructField("source_row", T.LongType()), T.StructField("cell", T.StringType()), T.StructField("field", T.StringType()),
    T.StructField("record_id", T.StringType()), T.StructField("original_value", T.StringType()), T.StructField("message", T.StringType()), T.StructField("proposed_action", T.StringType()),
])
COVERAGE = T.StructType([T.StructField(n, T.StringType()) for n in ("check", "state", "sheet", "reason")])
ERROR, WARNING, INFORMATION = "error", "warning", "information"
STATES = ("assessed", "not_assessed", "not_applicable")


@dataclass
class Table:
    """A rectangular table of text: frame has source_row, a string column for each field and `types`, a struct of storage types."""

    name: str
    fields: list[str]
    frame: DataFrame
    role: str = "data"
    index: int = 0
    rows: int = 0
    columns: int = 0
    usable: bool = True
    excluded: list[str] = field(default_factory=list)
    key_field: str = ""
    key_scope: str = ""

    @property
    def kept(self) -> list[str]:
        return [f for f in self.fields if f not in self.excluded]

    @classmethod
    def of(cls, name: str, df: DataFrame, types: dict[str, str] | None = None, row: Column | None = None, **more) -> Table:
        """Any DataFrame as a table: values become text, `types` are the storage types (text unless given), row numbers source_row."""
        kinds = types or {}
        fields = [c for c in df.columns if c != "source_row"]
        row = row if row is not None else (F.col("source_row") if "source_row" in df.columns else F.lit(None))
        kind = F.struct(*[F.when(F.col(f).isNull(), "blank").otherwise(kinds.get(f, "text")).alias(f) for f in fields])
        return cls(name, fields, df.select(row.cast("long").alias("source_row"), *[F.col(f).cast("string").alias(f) for f in fields], kind.alias("types")), **more)


@dataclass
class Rule:
    """A finding for each row of a table for which `when` holds."""

    rule_id: str
    severity: str
    when: Column
    message: str | Column
    field: str | None = None
    value: Column | None = None
    action: str = ""


@dataclass
class Findings:
    """The findings and the coverage of a run, as they come up."""

    spark: SparkSession
    source_id: str = ""
    source_sha256: str = ""
    frames: list[DataFrame] = field(default_factory=list)
    plain: list[tuple] = field(default_factory=list)
    covered: list[tuple[str, str, str, str]] = field(default_factory=list)

    def add(self, rule_id: str, severity: str, message: str, sheet: str = "", row: int | None = None, field: str = "", value: str | None = None, action: str = "", cell: str = "", record: str | None = None) -> None:
        """A finding known on the driver (about a sheet, a declaration or a run)."""
        self.plain.append((self.source_id, self.source_sha256, rule_id, severity, sheet, row, cell, field, record, value, message, action))

    def cover(self, check: str, state: str, reason: str = "", sheet: str = "") -> None:
        if state not in STATES:
            raise ValueError(f"unknown state {state}")
        self.covered.append((check, state, sheet, reason))

    def evaluate(self, table: Table, rules: Iterable[Rule]) -> DataFrame | None:
        """All findings of the rules on the table, from one scan."""
        rules = list(rules)
        if not rules:
            return None
        frame = evaluate(table, rules).select(F.lit(self.source_id).alias("source_id"), F.lit(self.source_sha256).alias("source_sha256"), *FINDING.names[2:])
        self.frames.append(frame)
        return frame

    def extend(self, frame: DataFrame) -> None:
        """Findings from a join or an aggregation: any of the fields but the source's."""
        have = set(frame.columns)
        self.frames.append(frame.select(F.lit(self.source_id).alias("source_id"), F.lit(self.source_sha256).alias("source_sha256"), *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in FINDING.fields[2:]]))

    def findings(self) -> DataFrame:
        first = self.spark.createDataFrame(self.plain, FINDING)
        return reduce(DataFrame.unionByName, self.frames, first)

    def coverage(self) -> DataFrame:
        return self.spark.createDataFrame(self.covered, COVERAGE)


def evaluate(table: Table, rules: list[Rule]) -> DataFrame:
    """rule_id, severity, sheet, source_row, cell, field, record_id, original_value, message, proposed_action."""
    from ..functions.scalars import cell_ref

    def hit(r: Rule) -> Column:
        at = cell_ref(F.lit(table.fields.index(r.field) + 1), F.col("source_row")) if r.field in table.fields else F.lit("")
        value = r.value if r.value is not None else (F.col(f"`{r.field}`") if r.field in table.fields else F.lit(None))
        message = F.lit(r.message) if isinstance(r.message, str) else r.message
        return F.when(r.when, F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("severity"), at.alias("cell"), F.lit(r.field or "").alias("field"), value.cast("string").alias("original_value"), message.alias("message"), F.lit(r.action).alias("proposed_action")))

    record = F.col(f"`{table.key_field}`") if table.key_field in table.fields else F.lit(None).cast("string")
    hits = table.frame.select("source_row", record.alias("record_id"), F.explode(F.filter(F.array(*[hit(r) for r in rules]), lambda x: x.isNotNull())).alias("f"))
    return hits.select("f.rule_id", "f.severity", F.lit(table.name).alias("sheet"), "source_row", "f.cell", "f.field", "record_id", "f.original_value", "f.message", "f.proposed_action")


def severity_counts(findings: DataFrame) -> DataFrame:
    return findings.groupBy("severity").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"))


def has_errors(findings: DataFrame) -> bool:
    return bool(findings.where(F.col("severity") == ERROR).limit(1).count())


def corrections(findings: DataFrame) -> DataFrame:
    """Findings to act on: errors, and those with a proposal."""
    return findings.where((F.col("severity") == ERROR) | (F.coalesce("proposed_action", F.lit("")) != ""))


def incomplete_checks(required: DataFrame, coverage: DataFrame, name: str = "check") -> DataFrame:
    """Required checks that nothing covers, or that something leaves unassessed."""
    seen = coverage.groupBy(name).agg(F.bool_or(F.col("state") == "not_assessed").alias("open"))
    return required.select(name).distinct().join(seen, name, "left").where(F.coalesce("open", F.lit(True))).select(name)
