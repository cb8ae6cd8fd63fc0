"""Records that span lines: cut in parallel, equal to Spark's own multi-line reader."""

import random

import pyarrow as pa
import pytest

from tradewind.sources import landing, multiline

TEXTS = ["plain", 'say ""hi""', "a\nb", "\n", "x" * 200 + "\n" + "y" * 150, 'q""\n""z\n\n', "", "a,b\r\nc", "end\n" * 90]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("split", ["150", "1000", "128m"])
def test_equal_to_the_reader_of_whole_files(spark, tmp_path, split):
    rng = random.Random(split)
    lines = [f'{i},"{rng.choice(TEXTS)}",{i / 2}' if rng.random() < 0.9 else f"{i},simple,{i}" for i in range(80)]
    (tmp_path / "a.csv").write_text("id,text,v\n" + "\n".join(lines) + "\n", newline="")
    (tmp_path / "b.csv").write_text("id,text,v\n\n" + "\n".join(lines[:9]) + "\n1,2\n3,4,5,6\n7,\"open\nto the end", newline="")
    (tmp_path / "c.csv").write_text("id,text,v\n", newline="")
    paths = [f"{tmp_path}/{c}.csv" for c in "abc"]
    conf = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        found = multiline.records(spark, paths)
        assert found.rdd.getNumPartitions() > (20 if split == "150" else 0)
        got = multiline.parsed(found, ["id", "text", "v"], "bad")
        want = (spark.read.options(header=True, escape='"', multiLine=True, columnNameOfCorruptRecord="bad")
                .schema("id string, text string, v string, bad string").csv(paths))
        assert rows(got.drop("__path")) == rows(want)
        assert [f.dataType.simpleString() for f in multiline.infer(got.limit(80), ["id", "v"]).fields] == ["int", "double"]
        assert rows(landing.read_text_csv(spark, paths[0], True)) == rows(
            spark.read.options(header=True, escape='"', multiLine=True).csv(paths[0]))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_each_pass_sends_its_own_rows():
    """The pass over the borders sends at most two pieces a split, however many records this holds."""
    schema = multiline.T._parse_datatype_string(multiline.PLACE)
    lines = ['end"', *[f'{i},"x"' for i in range(5000)], '5000,"open']
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in (lines, ["p"] * len(lines), [7] * len(lines), [1] * len(lines))],
                                       names=["value", "path", "block", "opened"])
    sent = {pieces: [r for b in multiline._cut([], schema, pieces)([batch]) for r in b.to_pylist()] for pieces in (False, True)}
    assert [(r["__n"], r["__record"]) for r in sent[False]] == [(i + 1, f'{i},"x"') for i in range(5000)]
    assert [(r["__n"], r["__kind"], r["__record"]) for r in sent[True]] == [
        (0, multiline.HEAD, 'end"'), (5001, multiline.TAIL, '5000,"open')]
