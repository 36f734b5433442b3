"""The rule projection gives the same findings on a stream as on a table."""

from assayer.operators.findings import Table, evaluate
from assayer.operators.values import FieldRule, value_rules
from assayer.streaming.rules import stream_findings, write_findings


def test_stream_equals_table(spark, tmp_path):
    table = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_orderstatus")
    table.repartition(3).write.parquet(str(tmp_path / "in"))
    rules = value_rules(Table.of("orders", table), "o_orderstatus", FieldRule(type="text"), None, ["F", "O"])
    want = {r.record_id for r in evaluate(Table.of("orders", table, key_field="o_orderkey"), rules).collect()}
    got = []
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = write_findings(stream_findings(stream, "orders", rules, key_field="o_orderkey"), str(tmp_path / "checkpoint"), lambda df, _: got.extend(r.record_id for r in df.collect())).start()
    query.processAllAvailable()
    query.stop()
    assert set(got) == want and len(got) == len(want)
