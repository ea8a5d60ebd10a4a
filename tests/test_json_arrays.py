"""JSON arrays in parts, and raw payloads without a given schema."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.sources import readers
from postloom.sources.json_array import array_records

SCHEMA = (T.StructType().add("id", "long").add("text", "string")
          .add("inner", T.StructType().add("a", "string")).add("list", T.ArrayType(T.StringType())))


def hard_records(seed, n=200):
    rng = random.Random(seed)
    bits = ["}", "{", "[", "]", '"', "\\", "\\\\", ",", "\n", "é", "😀", "a b", "},{", '\\"}', "}]"]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
    return [{"id": i, "text": text(), "inner": {"a": text()}, "list": [text() for _ in range(rng.randint(0, 3))]}
            for i in range(n)]


@pytest.mark.parametrize("part_bytes", [40, 257, 1 << 20])
def test_one_file_over_many_tasks(spark, tmp_path, part_bytes):
    first, second = hard_records(1), hard_records(2, 37)
    (tmp_path / "a.json").write_text(json.dumps(first, ensure_ascii=False), "utf-8")
    (tmp_path / "b.json").write_text(json.dumps(second, indent=3), "utf-8")
    (tmp_path / "c.json").write_text(" [ ]\n", "utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", part_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        if part_bytes == 257:
            scan = spark.read.option("lineSep", "}").text(str(tmp_path))
            assert scan.rdd.getNumPartitions() > 50
        rows = readers.read_json_array(spark, str(tmp_path), SCHEMA).orderBy("record_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    wanted = [(i << 40) + k for i, part in enumerate((first, second)) for k in range(len(part))]
    assert [r.record_no for r in rows] == wanted
    assert [(r.id, r.inner.a, list(r.list)) for r in rows] == [
        (d["id"], d["inner"]["a"], d["list"]) for d in first + second]
    assert all(r.text in (d["text"], None) for r, d in zip(rows, first + second, strict=True))


@pytest.mark.parametrize("broken", [
    "", "{}", '[{"id":1}', '[{"id":1},]', '[{"id":1} {"id":2}]', '[1, {"id":1}]', '{"id":1}]', "[{]}",
    '[{"id":1}]]', '[{"id":}]', "null", '[{"id":1}] x', '["}"]', '[,{"id":1}]', '[[{"id":1}]]'])
def test_a_broken_file_has_no_records(spark, tmp_path, broken):
    (tmp_path / "bad.json").write_text(broken)
    (tmp_path / "good.json").write_text('[{"id": 7}]')
    assert [(r.pos, r.json) for r in array_records(spark, str(tmp_path)).collect()] == [(0, '{"id": 7}')]


PAYLOADS = [
    '{"a":1,"b":"x","we ird":true,"o":{"p":1,"q":[1,2.5]},"record_no":5}', '{"a":"t","c":1.5,"o":{"r":"s"},"d.e":"z"}',
    '{"c":2,"quo\'te":3,"n":null,"tick`s":1,"B":"upper","VARIANT":"VARIANT","OBJECT":1}', '{"a":{"k":[1]}}',
    "[1,2]", "broken", None, "5", '{}',
]


@pytest.mark.parametrize("kind", ["text", "variant"])
def test_records_have_the_keys_of_all_payloads(spark, kind):
    table = spark.createDataFrame([(p,) for p in PAYLOADS], "raw_data string")
    if kind == "variant":
        table = table.select(F.try_parse_json("raw_data").alias("raw_data"))
    got = readers.parse_raw(table)
    assert set(got.columns) == {"record_no", "a", "B", "c", "d.e", "n", "o", "quo'te", "tick`s", "we ird",
                                "VARIANT", "OBJECT"}
    kinds = dict(got.dtypes)
    assert (kinds["a"], kinds["c"], kinds["we ird"], kinds["n"]) == ("string", "double", "boolean", "string")
    assert kinds["o"] == "struct<p:bigint,q:array<double>,r:string>"
    rows = sorted((r["a"] or "", r["B"] or "", r["c"], r["VARIANT"]) for r in got.collect())
    assert rows == [("", "", None, None), ("", "upper", 2.0, "VARIANT"), ("1", "x", None, None),
                    ("t", "", 1.5, None), ('{"k":[1]}', "", None, None)]


def test_no_payloads_have_no_keys(spark):
    table = spark.createDataFrame([("[]",), (None,)], "raw_data string")
    got = readers.parse_raw(table)
    assert got.columns == ["record_no"] and got.count() == 0
    many = spark.range(30).select(F.concat(F.lit('{"k'), F.col("id"), F.lit('":1}')).alias("raw_data"))
    with pytest.raises(ValueError):
        readers.payload_schema(many, max_keys=20)
