"""S1, P1-P8, K2/J3: CSV scan, cleaning, rejects, insert-ignore."""

import os
from decimal import Decimal

from pyspark.sql import functions as F

from traitlens.constants import DEFAULT_CATEGORY_MAP
from traitlens.operators import catalog
from traitlens.sources.catalog_csv import read_catalog_csv

LINK = next(iter(DEFAULT_CATEGORY_MAP))

CSV = (
    "web-scraper-order,web-scraper-start-url,category-link-0-href,name,price3,rating,ratingValue,image-src,image2-src\n"
    f'"1","u","{LINK}","셔츠 (오버핏)","12,300원","(1,234)","4.5","http://i/1.jpg","http://d/1.png"\n'
    f'"2","u","{LINK}","multi\nline ""quoted"" name","9,900원","(12)","","http://i/2.jpg",""\n'
    '"3","u","https://unknown/link","plain","N/A","","NaN","http://i/3.jpg",""\n'
    f'"1","u","{LINK}","duplicate of 1","1원","(3)","1.0","http://i/1b.jpg",""\n'
    f'"","u","{LINK}","no id","1원","(3)","1.0","",""\n'
)


def _write_csv(tmpdir_path):
    path = os.path.join(tmpdir_path, "catalog.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(CSV)
    return path


def test_csv_scan_is_all_strings_with_ordinal(spark, tmpdir_path):
    df = read_catalog_csv(spark, _write_csv(tmpdir_path))
    assert all(f.dataType.simpleString() == "string" for f in df.schema.fields if f.name != "_ord")
    rows = df.orderBy("_ord").collect()
    assert len(rows) == 5
    assert rows[1]["name"] == 'multi\nline "quoted" name'


def test_clean_catalog_values_and_rejects(spark, tmpdir_path):
    raw = read_catalog_csv(spark, _write_csv(tmpdir_path))
    valid, rejects = catalog.clean_catalog(raw, "/imgs/")
    rows = {(r.prd_id, r.prd_name): r for r in valid.collect()}
    r1 = rows[("1", "셔츠 (오버핏)")]
    assert r1.category == DEFAULT_CATEGORY_MAP[LINK]
    assert r1.price == Decimal("12300.0000")
    assert r1.review is None  # "1,234": thousands separator kept -> not castable -> reject
    assert r1.review_rating == Decimal("4.5000")
    assert r1.prd_img == "/imgs/prd_img/1.jpg"
    r3 = rows[("3", "plain")]
    assert r3.category is None and r3.price is None and r3.review_rating is None
    rej = {(r.prd_id, r.rule, r.column_name) for r in rejects.collect()}
    assert ("1", "cast_decimal", "review") in rej
    assert (None, "not_null", "prd_id") in rej
    assert all(r.prd_id is not None for r in valid.collect())


def test_insert_ignore_first_row_wins_and_is_idempotent(spark, tmpdir_path):
    raw = read_catalog_csv(spark, _write_csv(tmpdir_path))
    valid, _ = catalog.clean_catalog(raw, "/imgs/")
    empty = valid.select("prd_id").limit(0)
    first = catalog.insert_ignore(valid, empty)
    got = {r.prd_id: r.prd_name for r in first.collect()}
    assert got == {"1": "셔츠 (오버핏)", "2": 'multi\nline "quoted" name', "3": "plain"}
    again = catalog.insert_ignore(valid, first.select("prd_id"))
    assert again.count() == 0


def test_strip_thousands_option(spark, tmpdir_path):
    raw = read_catalog_csv(spark, _write_csv(tmpdir_path))
    valid, _ = catalog.clean_catalog(raw, "/imgs/", strip_thousands_in_review=True)
    r = valid.where((F.col("prd_id") == "1") & (F.col("prd_name") == "셔츠 (오버핏)")).first()
    assert r.review == Decimal("1234.0000")


def test_missing_header_is_a_clear_error(spark):
    import pytest

    raw = spark.createDataFrame([("1", "x")], "`web-scraper-order` string, name string")
    with pytest.raises(ValueError, match="price3"):
        catalog.clean_catalog(raw, "/imgs/")


def test_numbers_that_would_lose_digits_are_rejects(spark):
    from pyspark.sql import functions as F

    from traitlens.operators.catalog import exact_decimal

    texts = ["4.5678", "4.56789", "12300", "1e-5", "1E2", "0.00000000000000000001", "4.50000000", "1500e-02", "1500e-2", "15e-5", "150e-5", "1.25E+2", "0e-99", "1e-99", "-0.00010", "7e", "x", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", exact_decimal(F.col("t")).alias("v")).collect()
    kept = {r.t: (None if r.v is None else float(r.v)) for r in rows}
    assert kept == {
        "4.5678": 4.5678, "4.56789": None, "12300": 12300.0, "1e-5": None, "1E2": 100.0, "0.00000000000000000001": None, "1500e-02": 15.0, "1500e-2": 15.0, "15e-5": None, "150e-5": 0.0015, "1.25E+2": 125.0, "0e-99": 0.0, "1e-99": None, "-0.00010": -0.0001, "7e": None,
        "4.50000000": 4.5, "x": None, None: None,
    }


def test_first_row_wins_over_files_of_unequal_size(spark, tmpdir_path):
    import os

    from traitlens.operators.catalog import first_per_key
    from traitlens.sources.catalog_csv import read_catalog_csv

    with open(os.path.join(tmpdir_path, "a.csv"), "w") as fh:
        fh.write("web-scraper-order,name\n7,from a\n")
    with open(os.path.join(tmpdir_path, "b.csv"), "w") as fh:
        fh.write("web-scraper-order,name\n" + "".join(f"{i},from b\n" for i in range(2000)) + "7,again\n")
    for quoted in (True, False):
        df = read_catalog_csv(spark, tmpdir_path, quoted_newlines=quoted).withColumnRenamed("web-scraper-order", "prd_id")
        got = {r.prd_id: r.name for r in first_per_key(df).collect()}
        assert len(got) == 2000 and got["7"] == "from a" and got["8"] == "from b"
