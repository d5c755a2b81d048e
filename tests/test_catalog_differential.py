"""Catalog scan + cleaning vs a pandas statement of the original semantics, on generated CSV rows."""

import csv
import os
import random
from decimal import Decimal, InvalidOperation

import pandas as pd

from traitlens.constants import DEFAULT_CATEGORY_MAP
from traitlens.operators import catalog
from traitlens.sources.catalog_csv import read_catalog_csv

LINKS = list(DEFAULT_CATEGORY_MAP) + ["https://unknown.example/x"]
TRICKY = ["", "N/A", "NA", "null", "None", "nan", "-NaN", "#N/A", "a,b", 'say "hi"', "line\nbreak", " padded ", "셔츠 (L)"]


def _row(rnd, i):
    def pick(values, p=0.3):
        return rnd.choice(values) if rnd.random() < p else None

    name = pick(TRICKY, 0.4) or f"item {i} {rnd.choice(['red', 'blue'])}"
    price = pick(["N/A", ""], 0.1) or f"{rnd.randint(0, 99):,}{rnd.randint(100, 999)}원"
    rating = pick(["", "NA"], 0.2) or f"({rnd.choice([5, 12, 1234, 98765]):,})"
    value = pick(["", "n/a", "abc"], 0.2) or f"{rnd.randint(0, 5)}.{rnd.randint(0, 9)}"
    return {
        "web-scraper-order": f"id-{i}",
        "category-link-0-href": rnd.choice(LINKS),
        "name": name,
        "price3": price,
        "rating": rating,
        "ratingValue": value,
        "image-src": f"http://img/{i}.jpg",
        "image2-src": "",
    }


def _expected(path, image_dir, bad_casts):
    """The original steps, stated with pandas: NA tokens -> missing, dictionary, strip, rename, '' -> None."""
    df = pd.read_csv(path, dtype=str)
    out = {}
    for _, r in df.iterrows():
        def val(x):
            return None if pd.isna(x) else x

        review = val(r["rating"])
        review = review.replace("(", "").replace(")", "") if review is not None else None
        price = val(r["price3"])
        price = price.replace("원", "").replace(",", "") if price is not None else None

        pid = val(r["web-scraper-order"])

        def dec(x, column):
            if x in (None, ""):
                return None
            try:
                return Decimal(x).quantize(Decimal("0.0001"))
            except InvalidOperation:
                bad_casts.add((pid, column))  # the database would refuse it; our rule: null + reject
                return None

        out[pid] = (
            DEFAULT_CATEGORY_MAP.get(val(r["category-link-0-href"])),
            val(r["name"]) or None,
            dec(price, "price"),
            dec(review, "review"),
            dec(val(r["ratingValue"]), "review_rating"),
            f"{image_dir}prd_img/{pid}.jpg",
        )
    return out


def test_clean_catalog_matches_pandas_statement(spark, tmpdir_path):
    rnd = random.Random(11)
    rows = [_row(rnd, i) for i in range(300)]
    path = os.path.join(tmpdir_path, "catalog.csv")
    with open(path, "w", encoding="utf-8", newline="") as fh:
        w = csv.DictWriter(fh, fieldnames=list(rows[0]), quoting=csv.QUOTE_ALL)
        w.writeheader()
        w.writerows(rows)
    bad_casts = set()
    expected = _expected(path, "/imgs/", bad_casts)
    valid, rejects = catalog.clean_catalog(read_catalog_csv(spark, path), "/imgs/")
    got = {
        r.prd_id: (r.category, r.prd_name, r.price, r.review, r.review_rating, r.prd_img) for r in valid.collect()
    }
    assert got.keys() == expected.keys()
    for k in expected:
        assert got[k] == expected[k], (k, got[k], expected[k])
    # every value the database could not have cast is reported, and nothing else
    cast_rejects = {(r.prd_id, r.column_name) for r in rejects.where("rule = 'cast_decimal'").collect()}
    assert bad_casts and cast_rejects == bad_casts
