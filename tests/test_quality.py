"""V1-V4 as one data-driven check; valid + rejected rows account for the input."""

from pyspark.sql import functions as F

from traitlens.operators.quality import validate
from traitlens.schemas import RULES, Rule


def test_validate_partitions_rows(spark):
    df = spark.createDataFrame(
        [("1", "a" * 20), ("2", "b" * 21), (None, "c"), (None, "d" * 30), ("3" * 31, None)],
        "prd_id string, category string",
    )
    valid, rejects = validate(df, RULES["product_raw"], "catalog")
    assert sorted(r.prd_id for r in valid.collect()) == ["1"]
    rules = sorted(((r.prd_id, r.rule, r.column_name) for r in rejects.collect()), key=repr)
    assert rules == sorted(
        [
            ("2", "max_len", "category"),
            (None, "not_null", "prd_id"),
            (None, "not_null", "prd_id"),
            (None, "max_len", "category"),
            ("3" * 31, "max_len", "prd_id"),
        ],
        key=repr,
    )
    # every input row is either valid or has at least one reject row
    assert valid.count() + 4 == df.count()


def test_width_counts_characters_not_bytes(spark):
    df = spark.createDataFrame([("1", "셔" * 20)], "prd_id string, category string")
    valid, rejects = validate(df, [Rule("category", "max_len", 20)], "s")
    assert valid.count() == 1 and rejects.count() == 0


def test_materialized_validate_same_result(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("prd_id"), F.repeat(F.lit("x"), F.col("id").cast("int")).alias("category"))
    v1, r1 = validate(df, RULES["product_raw"], "catalog")
    v2, r2 = validate(df, RULES["product_raw"], "catalog", materialize=True)
    assert sorted(v1.collect()) == sorted(v2.collect())
    assert sorted(r1.collect()) == sorted(r2.collect())


def test_cluster_partition_sizing():
    from traitlens.session import cluster_sql_conf

    conf = cluster_sql_conf(100 * 2**40)
    assert conf["spark.sql.shuffle.partitions"] == "409600"
    assert conf["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    assert cluster_sql_conf(1)["spark.sql.shuffle.partitions"] == "200"
