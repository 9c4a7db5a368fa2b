from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta

import pytest

from haulmark import schemas
from haulmark.plans.survival import survival_by_make_site, survival_dataset

D = date
TYPES = [(1, "FAIL", "Failure"), (2, "PM", "Maintenance"), (3, "X", "Other")]


def rows(df):
    return Counter(tuple(row) for row in df.collect())


def frames(spark, assets, orders):
    return (
        spark.createDataFrame(
            [(i, name, None, installed, 1, 10) for i, name, installed in assets],
            schemas.OPERATIONAL_ASSET,
        ),
        spark.createDataFrame(TYPES, schemas.WORK_TYPE),
        spark.createDataFrame(
            [(n, asset, kind, raised, done) for n, (asset, kind, raised, done) in enumerate(orders)],
            schemas.WORK_ORDER,
        ),
    )


def expected_rows(assets, orders):
    """Row-by-row statement of the same dataset."""
    installed = {i: (name, day) for i, name, day in assets}
    used = [o for o in orders if o[2] is not None and o[2].year >= 2016 and o[0] in installed]
    failed = [o for o in used if o[1] == 1]
    first, last = min(o[2] for o in failed), max(o[2] for o in failed)
    found = Counter()
    for asset, (name, start) in installed.items():
        mine = sorted(o[2] for o in failed if o[0] == asset)
        maintained = [o for o in used if o[0] == asset and o[1] == 2]
        if mine:
            line = [(day, 1) for day in mine] + [(last, 0)]
        elif maintained:
            line = [(last, 0)]
        else:
            continue
        before = first
        for day, fail in line:
            done = sum(1 for o in maintained if o[3] is not None and o[3] <= day)
            if start is not None:
                age = (day - D(start.year, 1, 1)).days
                found[(asset, fail, age, (day - before).days, name, done)] += 1
            before = day
    return found


def test_named_cases(spark):
    assets = [
        (1, "once", D(2010, 6, 1)), (2, "at the end", D(2011, 1, 1)), (3, "maintained", D(2012, 1, 1)),
        (4, "neither", D(2012, 1, 1)), (5, "no year", None), (6, "open", D(2013, 1, 1)),
    ]
    orders = [
        (1, 1, D(2016, 1, 10), None), (2, 1, D(2016, 3, 1), None), (1, 2, D(2016, 1, 2), D(2016, 1, 10)),
        (1, 2, D(2016, 1, 2), D(2016, 1, 11)), (3, 2, D(2016, 1, 5), D(2016, 2, 1)),
        (4, 3, D(2016, 1, 5), None), (5, 1, D(2016, 1, 20), None), (6, 2, D(2016, 1, 5), None),
        (1, 1, D(2015, 12, 31), None), (1, 1, None, None), (77, 1, D(2015, 1, 1), None),
        (77, 1, D(2020, 1, 1), None),
    ]
    found = rows(survival_dataset(*frames(spark, assets, orders)))
    age = lambda day, year: (day - D(year, 1, 1)).days
    assert found == Counter(
        {
            (1, 1, age(D(2016, 1, 10), 2010), 0, "once", 1): 1,
            (1, 0, age(D(2016, 3, 1), 2010), 51, "once", 2): 1,
            (2, 1, age(D(2016, 3, 1), 2011), 51, "at the end", 0): 1,
            (2, 0, age(D(2016, 3, 1), 2011), 0, "at the end", 0): 1,
            (3, 0, age(D(2016, 3, 1), 2012), 51, "maintained", 1): 1,
            (6, 0, age(D(2016, 3, 1), 2013), 51, "open", 0): 1,
        }
    )
    assert found == expected_rows(assets, orders)


@pytest.mark.parametrize("seed", [4, 5])
def test_random_histories_equal_the_row_by_row_statement(spark, seed):
    pick = random.Random(seed)
    assets = [
        (i, f"asset {i}", None if pick.random() < 0.1 else D(pick.randrange(1995, 2015), 7, 1))
        for i in range(25)
    ]

    def day(missing):
        if pick.random() < missing:
            return None
        return D(2015, 11, 1) + timedelta(days=pick.randrange(150))

    orders = [
        (0 if pick.random() < 0.33 else pick.randrange(28), pick.choice([1, 1, 2, 2, 3]), day(0.05), day(0.2))
        for _ in range(370)
    ]
    found = rows(survival_dataset(*frames(spark, assets, orders)))
    assert found == expected_rows(assets, orders)


def test_make_and_site_replace_the_asset(spark):
    assets = [(1, "same", D(2010, 1, 1)), (2, "same", D(2010, 1, 1)), (3, "no make", D(2010, 1, 1))]
    orders = [(i, 1, D(2016, 5, 1), None) for i in (1, 2, 3)]
    asset, types, order = frames(spark, assets, orders)
    codes = spark.createDataFrame(
        [(10, "CRANE", None, None), (30, "MAKE", None, None)], schemas.LOOKUP_TABLE
    )
    view = spark.createDataFrame([(1, "NORTH")], schemas.OPERATIONAL_VIEW)
    attribute = spark.createDataFrame([(1, 30, "Noell "), (2, 30, "terex")], schemas.TABLE_ATTRIBUTE)
    data = survival_dataset(asset, types, order)
    found = survival_by_make_site(data, asset, codes, view, attribute)
    age = (D(2016, 5, 1) - D(2010, 1, 1)).days
    assert rows(found) == Counter(
        {
            (1, age, 0, "same", 0, "NORTH", "terex", "CRANE"): 1,
            (0, age, 0, "same", 0, "NORTH", "terex", "CRANE"): 1,
        }
    )
    none = survival_by_make_site(
        data, asset, codes, view, attribute, name_parts=["same"]
    )
    assert none.count() == 0
