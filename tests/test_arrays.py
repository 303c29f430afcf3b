"""Large JSON documents read piece by piece equal what a whole parse gives."""

import json
import random

import pytest
from pyspark.sql import functions as F

from postline.sources import arrays

TRICKY = [1, 2.5, None, True, "a}b", '{["', "\\", 'q"}', "é漢\n", "[", "]", '"jobs": [', ""]
MALFORMED = [
    "", "null", "5", '""', '[{"a":1}', '{"jobs":[{"a":1}]', '[{"a":1},2]', '[1,{"a":1}]', '{"a":1}', '{"jobs":{"a":[]}}', '[{"a":1} {"b":2}]',
    '[{"a":1},]', '[,{"a":1}]', '{"jobs":[{"a":1}],}', '[{"a":}]', '[[{"a":1}]]', '{"x":{"jobs":[{"a":1}]}}', '[{"a":1}]]', '[{"a":1}] x',
    '{"jobs":[]} {"a":1}', '{"jobs":[{"a":1}]}[]',
]


@pytest.fixture
def small_ranges(spark):
    """Files are read in ranges of a few hundred bytes, so that items cross them."""
    names = {"spark.sql.files.maxPartitionBytes": "499", "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def value(r, depth):
    x = r.random()
    if depth == 0 or x < 0.6:
        return r.choice(TRICKY)
    if x < 0.8:
        return [value(r, depth - 1) for _ in range(r.randrange(3))]
    return {r.choice(["a", "b}", "jobs", 'x"jobs']): value(r, depth - 1) for _ in range(r.randrange(4))}


def document(r, n):
    items = [{r.choice(["id", "t{", "jobs", "z"]): value(r, 3) for _ in range(r.randrange(5))} for _ in range(n)]
    if r.random() < 0.4:
        return items, items
    around = [{r.choice(names): value(r, 3) for _ in range(r.randrange(3))} for names in (["m", 'x"jobs', "k"], ["n", "o"])]
    return items, {**around[0], "jobs": items, **around[1]}


def read(spark, path):
    rows = arrays.array_items(spark, path).select(F.regexp_extract("file", "[^/]+$", 0).alias("f"), "pos", F.to_json("item").alias("t")).collect()
    got = {(x["f"], x["pos"]): json.loads(x["t"]) for x in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("seed", [1, 6])
def test_items_equal_a_whole_parse(spark, tmp_path, small_ranges, seed):
    r, want = random.Random(seed), {}
    for i, n in enumerate((0, 1, 3, 60, 150)):
        items, doc = document(r, n)
        text = json.dumps(doc, indent=r.choice([None, 1, 4]), ensure_ascii=r.random() < 0.5)
        (tmp_path / f"f{i}.json").write_text(r.choice(["", "\n"]) + text + r.choice(["", " \n"]), encoding="utf-8")
        want |= {(f"f{i}.json", p): x for p, x in enumerate(items)}
    assert read(spark, str(tmp_path)) == want


def test_one_file_is_read_by_several_tasks(spark, tmp_path, small_ranges):
    for indent in (None, 2):  # also where the whole document is one line
        path = tmp_path / f"{indent}.json"
        path.write_text(json.dumps([{"id": i, "text": "x}" * 40} for i in range(100)], indent=indent))
        found = arrays.pieces(spark, str(path))
        assert found.select("range").distinct().count() > 10
        assert [x["id"] for _, x in sorted(read(spark, str(path)).items())] == list(range(100))


@pytest.mark.parametrize("group", range(3))
def test_malformed_documents_are_errors(spark, tmp_path, group):
    for i, text in enumerate(MALFORMED[group::3]):
        path = tmp_path / f"{i}.json"
        path.write_text(text)
        with pytest.raises(Exception, match="expected a JSON array|MALFORMED_RECORD"):
            read(spark, str(path))


def test_one_bad_file_among_good_ones_is_named(spark, tmp_path):
    (tmp_path / "good.json").write_text('[{"a": 1}]')
    (tmp_path / "bad.json").write_text('[{"a": 1}')
    with pytest.raises(ValueError, match="bad.json"):
        read(spark, str(tmp_path))
