"""Readers and sinks."""

import json
import random
import re
from datetime import date

import pytest
from panel_rows import plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourpanel.session import checkpoint_root, materialise
from hourpanel.sources import readers, schemas, sinks


def test_day_without_rows_disappears_and_others_stay(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame(
        [(date(2026, 1, d), d) for d in range(1, 6)] + [(None, 99), (date(2026, 3, 1), 31)],
        "day date, v int",
    )
    first = sinks.replace_days(df, root, F.col("day"), date(2026, 1, 1), date(2026, 1, 31))
    assert first.rows == 5
    revised = df.filter("v != 3").withColumn("v", F.col("v") * 10)
    again = sinks.replace_days(revised, root, F.col("day"), date(2026, 1, 2), date(2026, 1, 4))
    assert again.partitions == ("2026-01-02", "2026-01-04")
    stored = readers.read_tree(spark, root, df.schema)
    assert sorted(r.v for r in stored.collect()) == [1, 5, 20, 40]


def test_empty_replacement_clears_the_range(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([(date(2026, 1, 1), 1), (date(2026, 1, 2), 2)], "day date, v int")
    sinks.replace_days(df, root, F.col("day"), date(2026, 1, 1), date(2026, 1, 2))
    sinks.replace_days(df.limit(0), root, F.col("day"), date(2026, 1, 1), date(2026, 1, 1))
    assert [r.v for r in readers.read_tree(spark, root, df.schema).collect()] == [2]


def test_partition_column_prunes(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([(date(2026, 1, d), d) for d in range(1, 5)], "day date, v int")
    sinks.replace_days(df, root, F.col("day"), date(2026, 1, 1), date(2026, 1, 31))
    schema = schemas.columns(f"day date, v int, {sinks.DAY_PARTITION} date")
    pruned = readers.read_tree(spark, root, schema, sinks.DAY_PARTITION).filter(
        F.col(sinks.DAY_PARTITION) == F.lit(date(2026, 1, 2))
    )
    assert [r.v for r in pruned.collect()] == [2]
    assert re.search(r"PartitionFilters: \[[^\]]*part_day", plan_of(pruned))


@pytest.mark.parametrize(("keys", "left"), [([2024], {"a": 1}), (["x"], {"b": 2})])
def test_unlisted_keys_stay(spark, tmp_path, keys, left):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([("2024.0", 1), ("x", 2)], "k string, v int")
    sinks.replace_keys(df, root, "k", [2024, "x"])
    assert readers.read_tree(spark, root, df.schema).count() == 2
    sinks.replace_keys(df.filter("v = 0"), root, "k", keys)
    assert readers.read_tree(spark, root, df.schema).count() == 1


def test_missing_tree_is_empty_and_required_tree_raises(spark, tmp_path):
    assert readers.read_tree(spark, str(tmp_path / "no"), schemas.COUNTS.schema).isEmpty()
    assert readers.read_optional(spark, str(tmp_path / "no")) is None
    with pytest.raises(FileNotFoundError):
        readers.read_required(spark, str(tmp_path / "no"))
    spark.range(0).write.parquet(str(tmp_path / "none"))
    with pytest.raises(ValueError):
        readers.read_required(spark, str(tmp_path / "none"))


def test_drifting_folders_unite_by_name(spark, tmp_path):
    root = tmp_path / "t"
    spark.createDataFrame([(1, 10)], "id bigint, n bigint").write.parquet(f"{root}/d=1")
    spark.createDataFrame([(2, 2.5)], "id bigint, n double").write.parquet(f"{root}/d=2")
    spark.createDataFrame([(3,)], "id int").write.parquet(f"{root}/d=3")
    df = readers.read_foreign_tree(spark, str(root), schemas.columns("id bigint, n double"))
    assert {(r.id, r.n) for r in df.collect()} == {(1, 10.0), (2, 2.5), (3, None)}


def test_drift_in_one_folder_and_files_at_the_root_lose_nothing(spark, tmp_path):
    root, want = str(tmp_path / "t"), set()
    kinds = ["id bigint, n bigint", "id bigint, n double", "id bigint", "id bigint, n double, extra string", "id bigint, n bigint, extra string"]
    for i in range(15):
        schema = kinds[i % 5]
        row = (i, *({"n bigint": (i,), "n double": (i + 0.5,)}.get(schema.split(", ")[1], ()) if "n " in schema else ()), *(("x",) if "extra" in schema else ()))
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(root if i % 3 == 0 else f"{root}/d{i % 2}")
        want.add((i, float(row[1]) if "n " in schema else None))
    files = readers.data_files(spark, root)
    groups = readers.footer_catalogue(spark, files)
    assert len(files) == 15 and len(groups) == 2 and sorted(f for _, members in groups for f in members) == files
    assert {(r.id, r.n) for r in readers.read_foreign_tree(spark, root, schemas.columns("id bigint, n double")).collect()} == want


def test_key_inside_the_files_keeps_its_type(spark, tmp_path):
    root = str(tmp_path / "t")
    spark.createDataFrame([("2026-01-01", 1)], "date string, v int").write.parquet(f"{root}/date=2026-01-01")
    df = readers.read_tree(spark, root, schemas.columns("date string, v int"))
    assert df.first().date == "2026-01-01"


def test_csv_comments_are_skipped(spark, tmp_path):
    path = tmp_path / "terms.csv"
    path.write_text(
        "# a remark, with a comma\n# another\nyear,term,start_date,end_date,jurisdiction,source_note\n"
        "2024,1,2024-01-29,2024-03-28,VIC,x\n"
    )
    df = readers.read_calendar_csv(spark, str(path), schemas.TERMS.schema)
    assert [(r.year, r.term, r.start_date) for r in df.collect()] == [(2024, 1, date(2024, 1, 29))]


def test_json_array_export(spark, tmp_path):
    path = tmp_path / "counts.json"
    path.write_text(json.dumps([
        {"id": 1, "location_id": 52, "sensing_date": "2026-08-01", "hourday": 0, "direction_1": 0,
         "direction_2": 0, "pedestriancount": 0, "sensor_name": "n", "location": {"lon": 1.5, "lat": 2.5}},
        {"id": 2, "location_id": 52, "sensing_date": "bad", "hourday": 1, "pedestriancount": None},
    ]))
    rows = readers.read_json_export(spark, str(path), schemas.COUNTS.schema).orderBy("id").collect()
    assert rows[0].location.lon == 1.5 and rows[0].sensing_date == date(2026, 8, 1)
    assert rows[1].sensing_date is None and rows[1].location is None


ROW = schemas.columns("time string, rain double")


def payloads(spark, tmp_path, document):
    path = tmp_path / "p.json"
    path.write_text(json.dumps(document))
    return spark.read.schema(readers.columnar_schema(ROW)).json(str(path))


def test_columnar_payload_flattens(spark, tmp_path):
    df = payloads(spark, tmp_path, {"hourly": {"time": ["a", "b"], "rain": [1.0, None]}})
    assert [tuple(r) for r in readers.flatten_columnar(df, ROW).collect()] == [("a", 1.0), ("b", None)]


@pytest.mark.parametrize(
    ("document", "text"),
    [({"error": True, "reason": "out of range"}, "out of range"), ({"latitude": 1}, "no hourly")],
)
def test_bad_payload_fails(spark, tmp_path, document, text):
    df = payloads(spark, tmp_path, document)
    with pytest.raises(Exception, match=text):
        readers.flatten_columnar(df, ROW).collect()


def test_outputs(spark, tmp_path):
    df = spark.createDataFrame([("a", float("nan")), ("b", 1.5)], "k string, v double")
    sinks.write_json(df, str(tmp_path / "j"))
    rows = [json.loads(line) for line in spark.read.text(str(tmp_path / "j")).toPandas()["value"]]
    assert sorted(rows, key=lambda r: r["k"]) == [{"k": "a", "v": None}, {"k": "b", "v": 1.5}]
    sinks.write_export(df, str(tmp_path / "p"), str(tmp_path / "c"), single_csv=True)
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    files = list((tmp_path / "c").glob("*.csv"))
    assert len(files) == 1 and files[0].read_text().splitlines()[0] == "k,v"


def test_materialised_table_lies_below_the_checkpoint_folder(spark):
    df = materialise(spark.range(5), "probe")
    root = checkpoint_root(spark).split(":", 1)[-1].lstrip("/")
    assert all(root in f for f in df.inputFiles()) and df.count() == 5


def test_one_large_json_array_is_read_by_many_tasks(spark, tmp_path):
    rng = random.Random(3)
    signs = ['"', "\\", "{", "}", "[", "]", ",", ":", "\n", "a", "é", " ", "}{", '\\"', "\\\\"]
    rows = [{"id": i, "s": "".join(rng.choice(signs) for _ in range(rng.randint(0, 30))), "o": {"x": i % 7, "t": rng.choice(["}", "{", '"}', None])}, "e": {}} for i in range(2000)]
    (tmp_path / "one").mkdir()
    for name, data, indent in (("a", rows, None), ("b", rows[:50], 2), ("empty", [], None)):
        (tmp_path / "one" / f"{name}.json").write_text(json.dumps([{**r, "f": name} for r in data], ensure_ascii=name == "a", indent=indent), encoding="utf-8")
    (tmp_path / "one" / "lines.json").write_text("\n".join(json.dumps({**r, "f": "lines"}) for r in rows[:5]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert spark.read.option("lineSep", "}").text(str(tmp_path / "one" / "a.json")).rdd.getNumPartitions() > 20
        got = readers.read_json_export(spark, str(tmp_path / "one"), T.StructType.fromDDL("id bigint, s string, o struct<x:bigint,t:string>, f string")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [(r["id"], r["s"], r["o"]["x"], r["o"]["t"], f) for f, n in (("a", 2000), ("b", 50), ("lines", 5)) for r in rows[:n]]
    assert sorted((r.id, r.s, r.o.x, str(r.o.t), r.f) for r in got) == sorted((*w[:3], str(w[3]), w[4]) for w in want)
    (tmp_path / "cut.json").write_text('[{"id": 1}, {"id": 2, "s": "x')
    with pytest.raises(Exception, match="unfinished object"):
        readers.read_json_export(spark, str(tmp_path / "cut.json"), schemas.columns("id bigint")).collect()


def test_pieces_of_one_split_are_summed_in_blocks(spark, tmp_path, monkeypatch):
    rows = [{"id": i, "s": "}{" * (i % 5) + '"', "o": {"x": i}} for i in range(700)]
    (tmp_path / "one.json").write_text(json.dumps(rows))
    monkeypatch.setattr(readers, "BLOCK_BITS", 3)
    seen = []
    met = readers._before
    monkeypatch.setattr(readers, "_before", lambda pieces, *args: seen.append(pieces.groupBy("path", "split", "block").count().agg(F.max("count"), F.count("*")).first()) or met(pieces, *args))
    got = readers.read_json_export(spark, str(tmp_path / "one.json"), T.StructType.fromDDL("id bigint, s string, o struct<x:bigint>")).collect()
    assert sorted((r.id, r.s, r.o.x) for r in got) == [(r["id"], r["s"], r["id"]) for r in rows]
    assert all(most <= 8 and blocks > 100 for most, blocks in seen) and len(seen) == 3
