import hashlib
import json
import os
import random

import pytest

from fleetlake.sources import files
from fleetlake.sources.json_arrays import array_records, records_of, scan_json_array, walk

SCHEMA = "a long, s string, n struct<x: double, l: array<struct<k: string>>>"


def objects(n, seed=3):
    rnd = random.Random(seed)
    odd = ['{', '}', '}{', '"', '\\', '\\"', '\\\\', '[', ']', ',', '\n', 'ñ', '😀', '},{"a":1}', '{"a": "}"}', '']
    return [{"a": k, "s": "".join(rnd.choice(odd) for _ in range(rnd.randint(0, 12))),
             "n": {"x": k / 4, "l": [{"k": rnd.choice(odd)} for _ in range(rnd.randint(0, 3))]}} for k in range(n)]


def plain(rows):
    return sorted(((r.a, r.s, None if r.n is None else (r.n.x, [e.k for e in r.n.l])) for r in rows), key=str)


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("indent", [None, 1])
def test_an_array_is_read_by_several_tasks_with_the_rows_of_multiline(spark, tmpdir_path, small_splits, indent):
    rows = objects(60)
    rows[30]["s"] = "long } { " * 400                     # a record over several splits
    with open(os.path.join(tmpdir_path, "a.json"), "w") as f:
        json.dump(rows, f, indent=indent, ensure_ascii=False)
    with open(os.path.join(tmpdir_path, "b.json"), "w") as f:
        json.dump(objects(1, 9)[0], f)                    # a single object
    for name, text in (("c", "[]"), ("d", ""), ("e", ' [ {"a": 7} ] \n')):
        with open(os.path.join(tmpdir_path, f"{name}.json"), "w") as f:
            f.write(text)
    got = scan_json_array(spark, tmpdir_path, SCHEMA)
    want = spark.read.schema(SCHEMA).option("multiLine", True).json(tmpdir_path)
    assert plain(got.collect()) == plain(want.where("a is not null").collect())
    assert got.count() == 62
    raw = spark.read.option("lineSep", "}").text(os.path.join(tmpdir_path, "a.json"))
    assert raw.rdd.getNumPartitions() > 5
    text = array_records(spark, os.path.join(tmpdir_path, "a.json")).orderBy("start", "place").collect()
    assert [json.loads(r.text) for r in text] == rows     # in file order


def test_context_is_composable():
    text = json.dumps(objects(20))
    cuts = [k + 1 for k, c in enumerate(text) if c == "}"]
    state, at = (False, 0), 0
    for c in cuts:
        state, at = walk(text[at:c], *state), c
    assert state == (False, 1) == walk(text[:cuts[-1]], False, 0)
    pieces = [p + "}" for p in '[{"a":"}"},{"b":{}}'.split("}")[:-1]]
    assert [k for k, _ in records_of(iter(pieces), False, 0, 1)] == ["whole", "whole"]


def test_json_array_to_ndjson_round_trip(spark, tmpdir_path):
    src, dst = os.path.join(tmpdir_path, "w.json"), os.path.join(tmpdir_path, "nd")
    with open(src, "w") as f:
        json.dump([{"fecha": "2024-01-01", "condicion": "Lluvia", "temperatura_promedio": None},
                   {"fecha": "2024-01-02", "condicion": "Nublado", "temperatura_promedio": 12.5}], f, indent=2)
    assert files.json_array_to_ndjson(spark, src, dst).count() == 2
    assert sorted(r.condicion for r in files.scan_ndjson(spark, dst, files.WEATHER_SCHEMA).collect()) == ["Lluvia", "Nublado"]


def test_a_file_above_the_limit_has_the_same_digest(spark, tmpdir_path, small_splits):
    rnd = random.Random(1)
    body = {"noise.bin": rnd.randbytes(20_000), "lines.txt": b"a\r\nb\n\nc\n" * 900, "open.txt": b"x" * 3000 + b"\nlast",
            "bom.csv": files.BOM + b"h\n" * 800, "bom_open.csv": files.BOM + b"h\n" * 800 + b"z", "feeds": b"\n" * 2000,
            "one.txt": b"y" * 5000, "small": b"s"}
    for name, data in body.items():
        with open(os.path.join(tmpdir_path, name), "wb") as f:
            f.write(data)
    got = {os.path.basename(r.path): (r.bytes, r.md5) for r in files.ingest_raw(spark, [tmpdir_path], whole_file=1000).collect()}
    assert got == {n: (len(d), hashlib.md5(d).hexdigest()) for n, d in body.items()}
    with pytest.raises(Exception):
        files.ingest_raw(spark, [os.path.join(tmpdir_path, "absent")]).collect()


def test_large_files_are_streamed_unsorted_whatever_their_names(spark, tmpdir_path, small_splits):
    import gzip
    rnd = random.Random(2)
    body = {"a b.bin": rnd.randbytes(30_000), "c%20d.bin": rnd.randbytes(5000), "lines.txt": b"a\n" * 4000,
            "packed.gz": gzip.compress(rnd.randbytes(3000)), "small": b"s", "small.gz": gzip.compress(b"s")}
    for name, data in body.items():
        with open(os.path.join(tmpdir_path, name), "wb") as f:
            f.write(data)
    out = files.ingest_raw(spark, [tmpdir_path], whole_file=1000)
    got = {r.path.split("/")[-1]: (r.bytes, r.md5) for r in out.collect()}
    assert got == {n: (len(d), hashlib.md5(d).hexdigest()) for n, d in body.items()}
    # from the running digest down to the file: nothing is sorted or sent
    lines = out._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow")[1].split("Relation")[0]
    assert "Sort" not in lines and "Repartition" not in lines
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "700"


def test_a_large_file_is_one_task_and_small_or_packed_ones_are_no_lines(spark, tmpdir_path, small_splits, monkeypatch):
    for name, n in (("big1", 9000), ("big2", 5000), ("small", 10), ("packed.gz", 5000)):
        with open(os.path.join(tmpdir_path, name), "wb") as f:
            f.write(b"0123456789\n" * (n // 11 + 1))
    seen, frame = [], type(spark.range(1))
    keep = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow",
                        lambda df, fn, schema: (seen.append(df.rdd.getNumPartitions()), keep(df, fn, schema))[1])
    assert files.ingest_raw(spark, [tmpdir_path], whole_file=1000).count() == 4
    assert seen == [2]
