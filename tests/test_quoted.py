"""Quoted files cut into records by blocks of any size."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnlake.sinks import tables
from learnlake.sources import quoted

SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


@pytest.fixture
def blocks(spark):
    """Files are split every so many bytes."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = {n: spark.conf.get(n) for n in names}

    def size(n):
        spark.conf.set(names[0], str(n))
        spark.conf.set(names[1], "1")

    yield size
    for n, v in old.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("size", [7, 16, 33, 64, 1000])
def test_every_split_gives_the_same_rows(spark, tmp_path, blocks, size):
    rng = random.Random(size)
    bits = ["x", '"', "\\", "\n", "\r\n", ",", "é", "\\\n", '\\"', "\n\n", '"\n"', "long " * 9]
    text = lambda: "t" + "".join(rng.choice(bits) for _ in range(rng.randint(0, 8))) + "t"
    rows = [(i, text(), None if i % 5 == 0 else text()) for i in range(60)]
    frame = spark.createDataFrame(rows, SCHEMA)
    tables.write_csv(frame.coalesce(1), f"{tmp_path}/csv")
    tables.write_csv(frame.limit(0), f"{tmp_path}/none")
    blocks(size)
    lines = spark.read.option("lineSep", "\n").text(f"{tmp_path}/csv")
    assert lines.rdd.getNumPartitions() > 1
    got, rejected = tables.read_csv(spark, f"{tmp_path}/csv", SCHEMA)
    assert sorted(map(tuple, got.collect())) == rows and rejected.count() == 0
    assert quoted.records(spark, f"{tmp_path}/none").count() == 0


def test_a_value_longer_than_many_blocks_and_an_open_quote(spark, tmp_path, blocks):
    (tmp_path / "a.csv").write_text('"1","' + "line\n" * 200 + '","x"\n"2","y","z"\n"3","never closed\n"4"', newline="")
    (tmp_path / "b.csv").write_text('5,plain,text\n\n"bad","6","7"\n', newline="")
    blocks(50)
    got, rejected = tables.read_csv(spark, str(tmp_path), SCHEMA)
    rows = {r.n: (r.a, r.b) for r in got.collect()}
    assert rows[1] == ("line\n" * 200, "x") and rows[2] == ("y", "z") and rows[5] == ("plain", "text")
    assert [r.value for r in rejected.where(F.col("value").contains("bad")).collect()] == ['"bad","6","7"']
    assert got.count() + rejected.count() == 5
