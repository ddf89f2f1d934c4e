import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.plans.quality import landed_summary
from tallyloom.sinks.tables import append, read_table
from tallyloom.streaming import ingest
from tallyloom.streaming.contracts import Contract, Rule, contract_from_schema, optional, validated

HUBS = {
    "parcel_hub": Contract({"parcel_no": Rule(("string",))}, ("parcel_no",)),
    "product_hub": Contract({}, ("parcel_no", "product")),
}

PARCEL = contract_from_schema(
    {
        "definitions": {
            "Leg": {
                "type": "object",
                "required": ["carrier", "grams"],
                "properties": {
                    "carrier": {"type": "string"},
                    "grams": {"type": ["number", "null"]},
                    "stops": {"type": "array", "items": {"$ref": "#/definitions/Stop"}},
                },
            },
            "Stop": {"properties": {"place": {"type": ["string", "null"]}}, "additionalProperties": False},
            "Site": {"required": ["geo"], "properties": {"geo": {"properties": {"lat": {"type": "number"}}, "required": ["lat"]}}},
        },
        "type": "object",
        "required": ["sent", "legs"],
        "properties": {
            "sent": {"type": ["datetime", "null"]},
            "fragile": {"type": ["boolean", "null"]},
            "legs": {"type": "array", "items": {"$ref": "#/definitions/Leg"}},
            "notes": {"type": "array", "items": {"type": ["string", "null"]}},
            "origin": {"$ref": "#/definitions/Site"},
        },
    }
)


def check(spark, hub, message, contracts=HUBS):
    df = spark.createDataFrame([(hub, message)], "hub string, json_str string")
    return validated(df, contracts).select("is_valid", "error").first()


@pytest.mark.parametrize(
    "message, hub, valid, error",
    [
        ('{"parcel_no": "1", "x": 2}', "parcel_hub", True, None),
        ('{"x": 2}', "parcel_hub", False, "'parcel_no' is a required property"),
        ('{"parcel_no": 5}', "parcel_hub", False, "'parcel_no' is not of type 'string'"),
        ('{"parcel_no": null}', "parcel_hub", False, "'parcel_no' is not of type 'string'"),
        ('{"parcel_no": "1"}', "product_hub", False, "'product' is a required property"),
        ('{"parcel_no": "1"}', "no_hub", False, "unknown hub: no_hub"),
        ('{"parcel_no": ', "parcel_hub", False, "malformed JSON"),
        ("", "parcel_hub", False, "malformed JSON"),
        (None, "parcel_hub", False, "malformed JSON"),
        ("[1]", "parcel_hub", False, "message is not an object"),
    ],
)
def test_validator_scenarios(spark, message, hub, valid, error):
    got = check(spark, hub, message)
    assert (got.is_valid, got.error) == (valid, error)


def parcel(**change):
    return {"sent": "20240115093000", "legs": [{"carrier": "c", "grams": 1.5}]} | change


@pytest.mark.parametrize(
    "message, error",
    [
        (parcel(), None),
        (parcel(fragile=True, colour="kept: the parcel is open"), None),
        (parcel(sent=None, legs=[]), None),
        (parcel(sent="2024-01-15"), "'sent' is not of type 'datetime', 'null'"),
        (parcel(fragile="yes"), "'fragile' is not of type 'boolean', 'null'"),
        (parcel(legs="none"), "'legs' is not of type 'array'"),
        (parcel(legs=[{"carrier": 1}]), "'grams' is a required property in legs[] | 'carrier' is not of type 'string' in legs[]"),
        (parcel(legs=[7]), "element is not of type 'object' in legs[]"),
        (parcel(legs=[{"carrier": "c", "grams": 1, "stops": [{"place": "o"}, {"other": 1}]}]), "Additional properties are not allowed: other in legs[].stops[]"),
        (parcel(notes=["a", None]), None),
        (parcel(notes=["a", 1, 2]), "element is not of type 'string', 'null' in notes[]"),
        (parcel(origin={"geo": {"lat": 1.5}}), None),
        (parcel(origin={}), "'geo' is a required property in origin"),
        (parcel(origin={"geo": {"lat": "north"}}), "'lat' is not of type 'number' in origin.geo"),
    ],
)
def test_nested_contract(spark, message, error):
    got = check(spark, "parcel", json.dumps(message), {"parcel": PARCEL})
    assert (got.is_valid, got.error) == (error is None, error)


def test_key_with_a_dot_or_quote(spark):
    names = ("a.b", "it's", "why?", "'\"?")
    contract = Contract(dict.fromkeys(names, Rule(("number",))), names)
    assert check(spark, "h", json.dumps(dict.fromkeys(names, 1)), {"h": contract}).is_valid
    for name in names:
        assert check(spark, "h", json.dumps(dict.fromkeys(names, 1) | {name: "x"}), {"h": contract}).error == f"'{name}' is not of type 'number'"
    assert not check(spark, "h", json.dumps(dict.fromkeys(names[1:], 1) | {"a": {"b": 1}}), {"h": contract}).is_valid


def test_decode(spark, rows):
    df = spark.createDataFrame([("parcel_hub", bytearray(b'{"a": 1}')), ("x", bytearray("ngày".encode()))], "topic string, value binary")
    assert rows(ingest.decode(df)) == [("parcel_hub", '{"a": 1}'), ("x", "ngày")]


def test_widen_keeps_every_field():
    old = T.StructType.fromDDL("a BIGINT, b STRUCT<x: BIGINT>, c STRING")
    new = T.StructType.fromDDL("a DOUBLE, b STRUCT<y: STRING>, d BOOLEAN, c BIGINT")
    assert ingest.widen(old, new).simpleString() == "struct<a:double,b:struct<x:bigint,y:string>,c:string,d:boolean>"


def messages(spark, path, n, start=0):
    good = F.concat(F.lit('{"parcel_no": "'), F.col("id"), F.lit('"}'))
    body = F.when(F.col("id") % 3 == 0, F.lit('{"x": 1}')).otherwise(good)
    spark.range(start, start + n).select(F.lit("parcel_hub").alias("topic"), F.encode(body, "UTF-8").alias("value")).coalesce(1).write.mode("append").parquet(path)


def test_split_survives_a_replayed_batch(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "checked")
    messages(spark, source, 30)
    sink = ingest.split_sink(target, "checker", F.to_timestamp(F.lit("2024-01-15 00:00:00")))

    def twice(batch, batch_id):
        sink(batch, batch_id)
        sink(batch, batch_id)

    def run():
        stream = validated(ingest.decode(ingest.message_files(spark, source, max_files=1)), HUBS)
        ingest.run_batches(stream, twice, str(tmp_path / "checkpoint")).awaitTermination()

    run()
    messages(spark, source, 30, start=30)
    run()
    run()
    assert ingest.read_side(spark, target, True).count() == 40
    bad = ingest.read_side(spark, target, False)
    assert bad.count() == 20
    assert {r["error"] for r in bad.select("error").distinct().collect()} == {"'parcel_no' is a required property"}


def test_landing_audit_counts_each_row_once(spark, tmp_path):
    source, table, audit = (str(tmp_path / n) for n in ("json", "landed", "audit"))
    spark.range(20).select("id", F.when(F.col("id") < 5, "20240114000000").alias("ProcDate")).write.json(source)
    now = F.to_timestamp(F.lit("2024-01-15 00:00:00"))
    sink = ingest.landing_sink("hub", table, audit, "ProcDate", now)
    for _ in range(2):
        stream = ingest.with_stamp(ingest.json_files(spark, source, "id BIGINT, ProcDate STRING"), "ProcDate", now)
        ingest.run_batches(stream, sink, str(tmp_path / "checkpoint")).awaitTermination()
    counts = {r["proc_date"]: r["row_count"] for r in read_table(spark, audit).collect()}
    assert {str(k): v for k, v in counts.items()} == {"20240114": 5, "20240115": 15}
    assert read_table(spark, table).count() == 20


def partition_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("PartitionFilters: ")[1].split("]")[0]


def test_sides_and_days_are_read_by_partition(spark, tmp_path):
    target, landed = str(tmp_path / "checked"), str(tmp_path / "landed")
    rows = spark.createDataFrame([("h", "{}", i % 2 == 0, None if i % 2 == 0 else "bad") for i in range(10)], "hub string, json_str string, is_valid boolean, error string")
    ingest.split_sink(target, "w", F.to_timestamp(F.lit("2024-01-15 00:00:00")))(rows, 0)
    valid = ingest.read_side(spark, target, True)
    assert valid.count() == 5 and "is_valid" in partition_filters(valid)
    append(spark.createDataFrame([("h", "20240114"), ("h", "20240115"), ("g", "20240115")], "hub string, load_day string"), landed, ["load_day"])
    summary = landed_summary(read_table(spark, landed), F.lit("20240115"))
    assert {(r.hub, r.landed_count) for r in summary.collect()} == {("h", 1), ("g", 1)} and "load_day" in partition_filters(summary)


def test_a_landed_batch_is_run_once_and_a_replay_completes_its_audit(spark, tmp_path):
    table, audit = str(tmp_path / "landed"), str(tmp_path / "audit")
    runs = spark.sparkContext.accumulator(0)

    def seen(x):
        runs.add(1)
        return x

    batch = spark.createDataFrame([(i, "20240115000000") for i in range(8)], "id int, ProcDate string").coalesce(1)
    counted = batch.select(F.udf(seen, "int")("id").alias("id"), "ProcDate")
    now = F.to_timestamp(F.lit("2024-01-15 00:00:00"))
    sink = ingest.landing_sink("hub", table, audit, "ProcDate", now)
    append(batch.withColumns({"batch_id": F.lit(3).cast("long"), ingest.LOAD_DAY: F.lit("20240115")}), table, [ingest.LOAD_DAY], load=("hub", 3))
    sink(batch, 3)  # landed before a failure, the audit is still missing
    sink(counted, 4)
    assert runs.value <= 8 + 1  # the write, and the row that shows that the batch is not empty
    assert {(r.batch_id, r.row_count) for r in read_table(spark, audit).collect()} == {(3, 8), (4, 8)}
    assert read_table(spark, table).count() == 16


def test_timed_trigger_ends_after_its_batches_and_goes_on_from_the_checkpoint(spark, tmp_path):
    source, out = str(tmp_path / "json"), str(tmp_path / "out")
    spark.range(30).repartition(3).write.json(source)
    stream = spark.readStream.schema("id BIGINT").option("maxFilesPerTrigger", 1).json(source)
    sink = lambda batch, i: append(batch, out, load=("timed", i))
    first = ingest.run_timed(stream, sink, str(tmp_path / "checkpoint"), "300 milliseconds", 2, at_most=120)
    assert list(first)[:2] == [0, 1] and all(first.values())
    rest = ingest.run_timed(stream, sink, str(tmp_path / "checkpoint"), "300 milliseconds", 3 - len(first), at_most=120) if len(first) < 3 else {}
    assert set(first) | set(rest) == {0, 1, 2} and sum((first | rest).values()) == 30
    assert read_table(spark, out).distinct().count() == 30 == read_table(spark, out).count()


def test_schema_store_reads_new_files_only(spark, tmp_path):
    source, store = tmp_path / "json", str(tmp_path / "store")
    spark.createDataFrame([(1,)], "a long").write.json(str(source / "day=1"))
    assert ingest.inferred_schema(spark, str(source), store).simpleString() == "struct<a:bigint>"
    assert ingest.inferred_schema(spark, str(source), store).simpleString() == "struct<a:bigint>"  # nothing came
    for file in (source / "day=1").glob("part-*.json"):  # would widen the type if it were read again
        times = (file.stat().st_atime_ns, file.stat().st_mtime_ns)
        file.write_text('{"a": "text"}\n')
        os.utime(file, ns=times)
    spark.createDataFrame([(2.5,)], "b double").write.json(str(source / "day=2"))
    assert ingest.inferred_schema(spark, str(source), store).simpleString() == "struct<a:bigint,b:double>"
