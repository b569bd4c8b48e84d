import datetime as dt
import json

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldfit.operators.snapshots import last_arrivals, upsert
from fieldfit.plans.completeness import Warehouse, completeness_by_deal
from fieldfit.schemas import INPUTS
from fieldfit.sources import SnapshotStore, load_bundle, load_chunks, load_payload, load_table, write_chunks
from fieldfit.streaming import stream_upsert

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def dump(path, value):
    path.write_text(json.dumps(value), encoding="utf-8")


def test_bundle_missing_key_and_file_are_empty(spark, tmp_path, rows):
    dump(tmp_path / "latest.json", {"t": [{"k": "a", "v": 1}, {"k": "b"}], "other": [{"k": "z"}]})
    path = str(tmp_path / "latest.json")
    assert rows(load_bundle(spark, path, "t", SCHEMA), "k", "v", "arrival_pos") == [("a", 1, 0), ("b", None, 1)]
    assert load_bundle(spark, path, "absent", SCHEMA).count() == 0
    assert load_bundle(spark, str(tmp_path / "none.json"), "t", SCHEMA).count() == 0


def test_payload_order_is_bundle_then_chunks_then_position(spark, tmp_path, rows):
    dump(tmp_path / "latest.json", {"t": [{"k": "a", "v": 1}, {"k": "b", "v": 1}]})
    dump(tmp_path / "t-01.json", [{"k": "a", "v": 5}])
    dump(tmp_path / "t-00.json", [{"k": "a", "v": i} for i in range(2, 5)] + [{"k": "c", "v": 7}, {"k": "c", "v": 8}])
    dump(tmp_path / "tt-00.json", [{"k": "x", "v": 9}])
    payload = load_payload(spark, str(tmp_path / "latest.json"), str(tmp_path), "t", SCHEMA)
    assert payload.count() == 8
    assert rows(last_arrivals(payload, ["k"])) == [("a", 5), ("b", 1), ("c", 8)]
    assert load_chunks(spark, str(tmp_path), "nothing", SCHEMA).count() == 0


def chunk_arrays(folder, wrap=None):
    """Arrays of the files in the order of their names."""
    texts = [json.loads(f.read_text()) for f in sorted(folder.glob("part-*"))]
    return [t[wrap] for t in texts] if wrap else texts


def test_chunk_files_have_fixed_size_and_key_order(spark, tmp_path, rows):
    df = spark.range(1250).select(F.format_string("%05d", "id").alias("k"), F.when(F.col("id") != 7, F.col("id")).alias("v"))
    write_chunks(df.orderBy(F.rand(3)), str(tmp_path / "t-00.json"), ["k"], 100)
    arrays = chunk_arrays(tmp_path / "t-00.json")
    assert [len(a) for a in arrays] == [100] * 12 + [50]
    assert [r["k"] for a in arrays for r in a] == [f"{i:05d}" for i in range(1250)]
    assert {"k": "00007", "v": None} in arrays[0]
    assert rows(load_chunks(spark, str(tmp_path), "t", SCHEMA), "k", "v") == rows(df)


@pytest.mark.parametrize("n, size", [(1, 5), (5, 5), (6, 5), (7, 1), (400, 3)])
def test_chunk_files_split_repeated_rows_and_wrap(spark, tmp_path, n, size):
    # most rows are the same one
    df = spark.range(n).select(F.when(F.col("id") % 10 > 0, "hot \n \"row\"").otherwise(F.col("id").cast("string")).alias("a.b"))
    write_chunks(df, str(tmp_path / "b"), ["a.b"], size, wrap='the "t"')
    arrays = chunk_arrays(tmp_path / "b", 'the "t"')
    assert [len(a) for a in arrays] == [size] * (n // size) + [n % size] * (n % size > 0)
    assert [r["a.b"] for a in arrays for r in a] == sorted(r[0] for r in df.collect())


def test_no_rows_give_no_chunk_rows(spark, tmp_path):
    write_chunks(spark.createDataFrame([], SCHEMA), str(tmp_path / "t-00.json"), ["k"], 10)
    assert "".join(f.read_text() for f in (tmp_path / "t-00.json").glob("part-*")) == ""
    with pytest.raises(ValueError, match="rows_per_file"):
        write_chunks(spark.createDataFrame([], SCHEMA), str(tmp_path / "u"), ["k"], 0)


def test_chunk_files_take_one_range_shuffle_and_gather_nothing(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    plans = []
    keep = lambda how: lambda self, path: (plans.append(self._df._jdf.queryExecution().optimizedPlan().toString()), how(self, path))
    for how in ("parquet", "text"):
        monkeypatch.setattr(DataFrameWriter, how, keep(getattr(DataFrameWriter, how)))
    write_chunks(spark.range(50).withColumnRenamed("id", "k"), str(tmp_path / "t"), ["k"], 10)
    assert sum(p.count("RepartitionByExpression") for p in plans) == 2
    assert not any("collect_list" in p for p in plans)


def test_declared_schema_is_checked(spark, tmp_path, frame, rows):
    root = str(tmp_path)
    df = frame("ID int, v float, t timestamp_ntz, m decimal(9,3), tags array<string>, more string", (1, 0.5, None, None, ["x"], "y"))
    df.write.parquet(f"{root}/x")
    wanted = "id bigint, v double, t timestamp, m decimal(38,6), tags array<string>"
    schema = T.StructType.fromDDL(wanted)
    got = load_table(spark, root, "x", schema=schema)
    assert got.schema.simpleString() == "struct<id:bigint,v:double,t:timestamp,m:decimal(9,3),tags:array<string>>"
    assert rows(got, "id", "v", "tags") == [(1, 0.5, ["x"])]
    assert "more" not in got._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(TypeError, match="x: column id is int, not string; column gone is missing; column tags is array<string>, not array<bigint>"):
        load_table(spark, root, "x", schema=T.StructType.fromDDL("id string, gone date, v double, tags array<bigint>"))
    # a wider stored type is not cut down
    with pytest.raises(TypeError, match="column v is float, not int"):
        load_table(spark, root, "x", schema=T.StructType.fromDDL("v int"))
    # renamed columns are checked under their own names
    renamed = load_table(spark, root, "x", {"key": "ID"}, schema=T.StructType.fromDDL("key bigint, v double"))
    assert rows(renamed) == [(1, 0.5)]
    with pytest.raises(TypeError, match="column key is missing"):
        load_table(spark, root, "x", {"key": "absent"}, schema=T.StructType.fromDDL("key bigint, v double"))


def test_declared_schema_parses_json_tables(spark, tmp_path, rows):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text('{"Key": "a", "n": 1, "x": []}\n{"Key": "b"}\n')
    schema = T.StructType.fromDDL("k string, n bigint")
    assert rows(load_table(spark, str(tmp_path), "j", {"k": "Key"}, "json", schema)) == [("a", 1), ("b", None)]
    (tmp_path / "j" / "b.json").write_text('{"Key": "c", "n": "many"}\n')
    with pytest.raises(Exception, match="many|MALFORMED"):
        load_table(spark, str(tmp_path), "j", {"k": "Key"}, "json", schema).collect()


def test_warehouse_is_loaded_as_declared(spark, tmp_path):
    for name in ("lines", "companies", "associations", "groups", "cube", "deliveries", "devices", "finished"):
        spark.createDataFrame([], INPUTS[name]).write.parquet(str(tmp_path / name))
    loaded = Warehouse.load(spark, str(tmp_path), {"tickets": "cube"})
    assert loaded.tickets.columns == INPUTS["cube"].names and loaded.lines.columns == INPUTS["lines"].names
    assert completeness_by_deal(loaded, dt.date(2026, 1, 1)).count() == 0
    stored = spark.createDataFrame([], INPUTS["finished"]).withColumn("data_servico", F.lit("2026"))
    stored.write.parquet(str(tmp_path / "other"))
    with pytest.raises(TypeError, match="other: column data_servico is string, not date"):
        Warehouse.load(spark, str(tmp_path), {"tickets": "cube", "finished": "other"})


def test_table_renames(spark, tmp_path, rows):
    spark.range(3).withColumnRenamed("id", "Stored_ID").write.parquet(str(tmp_path / "x"))
    assert load_table(spark, str(tmp_path), "x").columns == ["stored_id"]
    assert rows(load_table(spark, str(tmp_path), "x", {"ours": "Stored_ID"})) == [(0,), (1,), (2,)]


def test_store_publish_and_merge(spark, tmp_path, frame, rows):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    assert store.current("t") is None
    store.merge(frame("k string, v bigint", ("a", 1)), "t", ["k"])
    store.merge(frame("k string, v bigint", ("a", 2), ("b", 3)), "t", ["k"])
    assert rows(store.current("t")) == [("a", 2), ("b", 3)]
    store.publish(store.current("t").withColumn("v", F.col("v") * 10), "t", ["k"])  # reads itself
    assert rows(store.current("t")) == [("a", 20), ("b", 30)]
    store.publish(frame("k string, v bigint", ("c", 4)), "t")
    store.merge(frame("k string, v bigint", ("c", 5), ("d", 6)), "t", ["k"])
    assert rows(store.current("t")) == [("c", 5), ("d", 6)]
    # other keys or another number of buckets lay the table out anew
    SnapshotStore(spark, str(tmp_path / "store"), buckets=3).merge(frame("k string, v bigint", ("c", 7)), "t", ["k"])
    store.merge(frame("k string, v bigint", ("c", 7)), "t", ["k", "v"])
    assert rows(store.current("t")) == [("c", 7), ("d", 6)]


def test_a_failing_change_leaves_the_table(spark, tmp_path, frame, rows):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    store.merge(frame("k string, v bigint", ("a", 1)), "t", ["k"])
    broken = frame("k string, v bigint", ("a", 2)).withColumn("v", F.raise_error(F.lit("broken")).cast("bigint"))
    for write in (lambda: store.merge(broken, "t", ["k"]), lambda: store.publish(broken, "t", ["k"])):
        with pytest.raises(Exception, match="broken"):
            write()
        assert rows(store.current("t")) == [("a", 1)]


def test_replace_and_patch_touch_only_their_partitions(spark, tmp_path, frame, rows):
    store = SnapshotStore(spark, str(tmp_path / "store"), buckets=8)
    store.merge(spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(0).alias("v")), "t", ["k"])
    files = lambda: {f: f.stat().st_mtime_ns for f in (tmp_path / "store" / "t").rglob("*.parquet")}
    before = files()
    store.replace(frame("k string, v int", ("7", 9), ("7", 10)), "t", "k")
    changed = {f.parent.name for f in files().items() ^ before.items() for f in f[:1]}
    assert len(changed) == 1
    before = files()
    store.patch(frame("k string, v int", ("8", 5), ("unknown", 6)), "t", "k", ["v"])
    changed = {f.parent.name for f in files().items() ^ before.items() for f in f[:1]}
    assert 1 <= len(changed) <= 2
    assert rows(store.current("t").filter("v > 0")) == [("7", 10), ("7", 9), ("8", 5)] and store.current("t").count() == 101
    base = spark.read.parquet(str(tmp_path / "store" / "t"))
    name = next(c for c in base.columns if c.startswith("_bucket_"))
    plan = base.filter(F.col(name).isin([1, 2]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and name in plan.split("PartitionFilters")[1]


def run_stream(spark, tmp_path, store):
    query = stream_upsert(spark, str(tmp_path / "in"), store, "t", SCHEMA, ["k"], str(tmp_path / "checkpoint"))
    query.awaitTermination()
    assert query.exception() is None


def test_stream_applies_new_files_once(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    store = SnapshotStore(spark, str(tmp_path / "store"))
    dump(tmp_path / "in" / "t-00.json", [{"k": "a", "v": 1}, {"k": "a", "v": 2}, {"k": "b", "v": 3}])
    run_stream(spark, tmp_path, store)
    assert rows(store.current("t")) == [("a", 2), ("b", 3)]
    run_stream(spark, tmp_path, store)
    dump(tmp_path / "in" / "t-01.json", [{"k": "b", "v": None}, {"k": "c", "v": 4}])
    run_stream(spark, tmp_path, store)
    assert rows(store.current("t")) == [("a", 2), ("b", None), ("c", 4)]


def test_two_streams_and_a_new_checkpoint_on_one_table(spark, tmp_path, rows):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    for name, key in (("x", "x0"), ("y", "y0")):
        (tmp_path / name).mkdir()
        dump(tmp_path / name / "t-00.json", [{"k": key, "v": 1}])
        stream_upsert(spark, str(tmp_path / name), store, "t", SCHEMA, ["k"], str(tmp_path / f"checkpoint-{name}")).awaitTermination()
    assert rows(store.current("t")) == [("x0", 1), ("y0", 1)]
    dump(tmp_path / "x" / "t-01.json", [{"k": "x1", "v": 2}])
    stream_upsert(spark, str(tmp_path / "x"), store, "t", SCHEMA, ["k"], str(tmp_path / "fresh")).awaitTermination()
    assert rows(store.current("t")) == [("x0", 1), ("x1", 2), ("y0", 1)]


def test_unknown_fields(spark, tmp_path, frame, rows):
    dump(tmp_path / "latest.json", {"t": [{"k": "a", "size": 2}]})
    dump(tmp_path / "t-00.json", [{"k": "a", "v": 1, "size": 1.5, "new": {"x": [1]}}, {"k": "b", "flag": True, "gone": None}])
    dump(tmp_path / "t-01.json", [{"k": "c", "flag": "yes"}])
    load = lambda **how: load_payload(spark, str(tmp_path / "latest.json"), str(tmp_path), "t", SCHEMA, **how)
    got = load()
    assert dict(got.dtypes) | {"size": "double", "flag": "string", "gone": "string", "new": "struct<x:array<bigint>>"} == dict(got.dtypes)
    merged = upsert(frame("k string, v bigint", ("a", 0), ("z", 5)), got, ["k"])
    assert rows(merged, "k", "v", "size", "flag", "new.x") == [
        ("a", 1, 1.5, None, [1]), ("b", None, None, "true", None), ("c", None, None, "yes", None), ("z", 5, None, None, None)
    ]
    assert "size" not in load(unknown="drop").columns
    with pytest.raises(Exception, match="fields no schema knows: size"):
        load(unknown="raise").collect()


def test_every_object_speaks_for_itself(spark, tmp_path, frame, rows):
    base = frame("k string, v bigint, w string", ("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z"))
    schema = T.StructType([*SCHEMA.fields, T.StructField("w", T.StringType())])
    dump(tmp_path / "latest.json", {"t": [{"k": "a", "w": "bundle"}]})
    dump(tmp_path / "t-00.json", [])
    dump(tmp_path / "t-01.json", [{"k": "a", "v": 10}, {"k": "b", "w": None}, {"k": "n"}])
    dump(tmp_path / "t-02.json", [{"k": "b", "v": None}])
    payload = load_payload(spark, str(tmp_path / "latest.json"), str(tmp_path), "t", schema)
    merged = upsert(base, payload, ["k"])
    assert rows(merged, "k", "v", "w") == [("a", 10, "bundle"), ("b", None, None), ("c", 3, "z"), ("n", None, None)]


def test_new_payload_columns_are_added(frame, rows):
    merged = upsert(frame("k string", ("a",), ("b",)), frame("k string, extra int", ("a", 5)), ["k"])
    assert rows(merged, "k", "extra") == [("a", 5), ("b", None)]


@pytest.mark.parametrize("text", ['[{"k": "a", "v": 1}, {"k": "b", "v"', '[{"k": "a", "v": "word"}]', "{"])
def test_damaged_files_stop_the_job(spark, tmp_path, text):
    dump(tmp_path / "t-00.json", [{"k": "a", "v": 1}])
    (tmp_path / "t-01.json").write_text(text)
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST"):
        load_chunks(spark, str(tmp_path), "t", SCHEMA).collect()
    (tmp_path / "latest.json").write_text('{"t": [{"k": "a"}, {"k"')
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST"):
        load_bundle(spark, str(tmp_path / "latest.json"), "t", SCHEMA).collect()


def test_merge_leaves_untouched_partitions_in_place(spark, tmp_path, frame, rows):
    store = SnapshotStore(spark, str(tmp_path / "store"), buckets=8)
    store.merge(spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(0).alias("v")), "t", ["k"])
    before = set((tmp_path / "store" / "t").rglob("*.parquet"))
    store.merge(frame("k string, v int", ("7", 9)), "t", ["k"])
    new = set((tmp_path / "store" / "t").rglob("*.parquet")) - before
    assert len({f.parent.name for f in new}) == 1 and len({f.parent.name for f in before - set((tmp_path / "store" / "t").rglob("*.parquet"))}) == 1
    assert rows(store.current("t").filter("v = 9")) == [("7", 9)] and store.current("t").count() == 100
    # an empty payload and a new column
    store.merge(frame("k string, v int", ("7", 9)).limit(0), "t", ["k"])
    store.merge(frame("k string, w int", ("7", 1), ("new", 2)), "t", ["k"])
    assert rows(store.current("t").filter("w is not null"), "k", "v", "w") == [("7", 9, 1), ("new", None, 2)]
