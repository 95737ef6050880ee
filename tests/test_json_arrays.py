"""JSON array files cut into many byte ranges against a whole parse of each file."""

import json
import random
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import types as T

from oreworks.sources import landing
from oreworks.sources.json_arrays import read_split_arrays

_C = T.ArrayType(T.StructType().add("c", "integer"))
SCHEMA = T.StructType().add("id", "string").add("n", "long")
SCHEMA = SCHEMA.add("inner", T.StructType().add("a", "string").add("b", _C))
HARD = ['}', '{', '"', '\\', '\\"}', '},{', '[', ']', '\n', 'é', ' ', ',', 'x' * 40, '', '}}}']


@contextmanager
def split_at(spark, size):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n in names:
            spark.conf.set(n, str(size))
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def put(folder, name, text):
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / name).write_bytes(text.encode())


def rows_of(df):
    found = df.orderBy("file_name", "byte_offset").collect()
    return [(r.id, r.n, r.inner and r.inner.asDict(True), r.corrupt_text) for r in found]


def made(seed, count):
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice(HARD) for _ in range(pick.randrange(5)))
    out = []
    for i in range(count):
        inner = None
        if pick.random() < 0.5:
            inner = {"a": word(), "b": [{"c": pick.randrange(9)} for _ in range(pick.randrange(4))]}
        out.append({"id": f"{i}{word()}", "n": i, "inner": inner})
    return out


@pytest.mark.parametrize("size", [97, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_any_cut_gives_the_records_of_a_whole_parse(spark, folder, size, indent):
    files = {f"{k}.json": made(k, 40) for k in range(3)}
    for name, records in files.items():
        put(folder, name, json.dumps(records, indent=indent, ensure_ascii=name == "1.json"))
    with split_at(spark, size):
        found = rows_of(read_split_arrays(spark, f"{folder}/*.json", SCHEMA))
    wanted = [(r["id"], r["n"], r["inner"], None) for k in range(3) for r in files[f"{k}.json"]]
    assert found == wanted


def test_one_file_is_many_tasks(spark, folder):
    put(folder, "a.json", json.dumps([{"id": str(i), "n": i} for i in range(3000)]))
    with split_at(spark, 4096):
        read = spark.read.option("lineSep", "}").text(folder)
        assert read.rdd.getNumPartitions() >= 15
        found = read_split_arrays(spark, folder, SCHEMA)
        assert sorted(r.n for r in found.collect()) == list(range(3000))


def test_a_damaged_record_keeps_its_text_and_harms_no_other(spark, folder):
    broken = '{"id": "b", "n": , "inner": {"a": "}"}}'
    wrong = '{"id": "c", "n": "many"}'
    put(folder, "a.json", f'[{{"id": "a", "n": 1}},\n {broken}, {wrong},\n{{"id": "d", "n": 4}}\n]\n')
    with split_at(spark, 16):
        found = rows_of(read_split_arrays(spark, folder, SCHEMA))
    assert [(r[0], r[1], r[3]) for r in found if r[3] is None] == [("a", 1, None), ("d", 4, None)]
    assert [r[3] for r in found if r[3] is not None] == [broken, wrong]
    assert [r[0] for r in found] == ["a", None, "c", "d"]  # what fits is kept


@pytest.mark.parametrize("size", [16, 1 << 20])
def test_a_cut_file_keeps_its_end_as_text(spark, folder, size):
    put(folder, "a.json", '[{"id": "a", "n": 1}, {"id": "b", "n": 2, "inner": {"a": "x"}, "lost": "')
    put(folder, "b.json", '[{"id": "c", "n": 3}, {"id": "d, "n": 4}, {"id": "e", "n": 5}]')
    put(folder, "c.json", '[{"id": "f", "n": 6}')
    with split_at(spark, size):
        found = rows_of(read_split_arrays(spark, folder, SCHEMA))
    assert [r[0] for r in found if r[3] is None] == ["a", "c", "f"]
    lost = [r[3] for r in found if r[3] is not None]
    assert lost == [
        '{"id": "b", "n": 2, "inner": {"a": "x"}',
        '"lost": "',
        '{"id": "d, "n": 4}',
        '{"id": "e", "n": 5}',
    ]


def test_files_without_records_and_other_shapes(spark, folder):
    for name, text in {
        "empty.json": "",
        "blank.json": " \n",
        "none.json": "[ ]\n",
        "object.json": '{"id": "o", "n": 7}',
        "lines.json": '{"id": "l", "n": 8}\n{"id": "m", "n": 9}\n',
        "number.json": "[1, 2]",
    }.items():
        put(folder, name, text)
    found = rows_of(read_split_arrays(spark, folder, SCHEMA))
    assert sorted(r[0] for r in found if r[3] is None) == ["l", "m", "o"]
    assert [r[3] for r in found if r[3] is not None] == ["1, 2]"]


def test_same_records_as_the_whole_file_reader(spark, folder):
    records = [{"id": str(i), "symbol": "s", "market_cap": i + 0.5 * (i % 2)} for i in range(50)]
    put(folder, "a.json", json.dumps(records))
    whole = landing.read_json_arrays(spark, folder)
    with split_at(spark, 100):
        split = read_split_arrays(spark, folder)
        assert split.filter("corrupt_text IS NOT NULL").count() == 0
        ours = split.select(*whole.columns)
        assert ours.exceptAll(whole).count() == 0 and whole.exceptAll(ours).count() == 0
