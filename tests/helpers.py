"""Small hand-made review frames."""

from __future__ import annotations

import datetime as dt

REVIEW_SCHEMA = """review_id string, customer_id string, product_id string, product_category string, star_rating int,
    helpful_votes int, total_votes int, verified_purchase boolean, review_body string, review_date date"""
FIELDS = [part.split()[0] for part in REVIEW_SCHEMA.split(",")]
DAY = dt.date(2015, 3, 1)


def day(offset: int) -> dt.date:
    return DAY + dt.timedelta(days=offset)


def reviews(spark, rows, **defaults):
    """Rows as dicts; what is not given gets a default, the id counts up."""
    base = {"customer_id": "c", "product_id": "p", "product_category": "Books", "star_rating": 3, "helpful_votes": 0,
            "total_votes": 0, "verified_purchase": True, "review_body": "fine", "review_date": DAY, **defaults}
    filled = [{"review_id": f"r{i}", **base, **row} for i, row in enumerate(rows)]
    return spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in filled], REVIEW_SCHEMA)


def as_dict(frame, key, *values):
    """Rows by key: the value itself for one column, a tuple for more."""
    out = {}
    for row in frame.collect():
        found = tuple(row[v] for v in values)
        out[row[key]] = found[0] if len(values) == 1 else found
    return out
