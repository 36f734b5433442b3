"""Rules on streams: the same projection as for tables, without state, so late or repeated rows need no watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from ..operators.findings import Rule, Table, evaluate


def stream_findings(stream: DataFrame, name: str, rules: list[Rule], types: dict[str, str] | None = None, key_field: str = "") -> DataFrame:
    """Findings of the rules on each row of a stream, as a stream."""
    return evaluate(Table.of(name, stream, types, key_field=key_field), rules)


def write_findings(findings: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """A writer that hands each batch of findings to `each`, once per batch number, from a checkpoint."""
    return findings.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(each)
