"""S1: a CSV file in many splits, with line breaks inside quotes, reads as by one task."""

import os
import random

import pytest

from traitlens.operators.catalog import ORDINAL
from traitlens.sources.catalog_csv import read_catalog_csv, read_whole_files

HEAD = "id,na me,c\n"


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    yield
    for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{name}")


def read_both(spark, path):
    ours = read_catalog_csv(spark, path).orderBy(ORDINAL)
    got = [tuple(r) for r in ours.drop(ORDINAL).collect()]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    try:
        whole = read_whole_files(spark, path)
        return got, [tuple(r) for r in whole.collect()], ours.drop(ORDINAL).columns == whole.columns
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64")


def field(rng):
    kind = rng.randrange(6)
    if kind == 0:
        return ""
    if kind == 1:
        return '""'
    words = rng.choices(["a", "bb", "é", "日本", "12,5", 'q""q', "line\nbreak", "\n", "\n\n", " x ", "," * 3, "z" * rng.randrange(1, 90)], k=rng.randrange(1, 5))
    return '"' + "".join(words) + '"' if kind < 5 else rng.choice(["plain", "x y", "7", "-"])


def test_many_splits_equal_one_task(spark, tmpdir_path, small_splits):
    rng = random.Random(7)
    folder = os.path.join(tmpdir_path, "csv")
    os.makedirs(folder)
    for f, end in (("a.csv", "\n"), ("b.csv", ""), ("c.csv", "\n")):
        rows = "\n".join(",".join([str(i), field(rng), field(rng)]) for i in range(120))
        with open(os.path.join(folder, f), "w", encoding="utf-8", newline="") as fh:
            fh.write(HEAD + rows + end)
    got, expected, same = read_both(spark, folder)
    assert same and len(expected) == 360
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    one = os.path.join(folder, "a.csv")
    got, expected, _ = read_both(spark, one)
    assert got == expected  # in order
    assert spark.read.option("lineSep", "\n").text(one).rdd.getNumPartitions() > 40


def test_a_value_longer_than_many_splits(spark, tmpdir_path, small_splits):
    path = os.path.join(tmpdir_path, "long.csv")
    value = "\n".join(f"row {i}, with a comma" for i in range(200))
    with open(path, "w", newline="") as fh:
        fh.write(HEAD + f'1,"{value}",x\n2,b,"{value}"\n3,c,d\n')
    got, expected, _ = read_both(spark, path)
    assert got == expected == [("1", value, "x"), ("2", "b", value), ("3", "c", "d")]


def test_crlf_blank_lines_and_empty_files(spark, tmpdir_path, small_splits):
    path = os.path.join(tmpdir_path, "crlf.csv")
    with open(path, "w", newline="") as fh:
        fh.write((HEAD + '1,"a\nb",x\n\n2,,"y ""z"""\n').replace("\n", "\r\n"))
    got, expected, _ = read_both(spark, path)
    assert got == expected == [("1", "a\nb", "x"), ("2", None, 'y "z"')]
    only_head = os.path.join(tmpdir_path, "head.csv")
    with open(only_head, "w", newline="") as fh:
        fh.write(HEAD)
    assert read_catalog_csv(spark, only_head).collect() == []
