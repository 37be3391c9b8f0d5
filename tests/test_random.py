"""Rates and rankings over random tables against plain loops."""

from __future__ import annotations

import random
import statistics
from collections import defaultdict

import pytest

from rollcall.operators import patterns, regional
from tests.rows import dicts, mart
from tests.rows import regional as row


def _random_rows(seed: int) -> list[dict]:
    chance = random.Random(seed)
    rows = []
    for _ in range(chance.randrange(5, 80)):
        rows.append(
            row(
                # One region has a third of all rows or more.
                chance.choice(["North", "North", "South", "East", "null", None]),
                chance.choice([199899, 199900, 200001, 200102]),
                chance.randrange(0, 40),
                chance.choice([0, 50, 100, 200]),
                chance.choice(["Total", "Primary", "Special"]),
            )
        )
    return rows


def _pool(rows, *keys):
    sums = defaultdict(lambda: [0, 0])
    for r in rows:
        cell = sums[tuple(r[k] for k in keys)]
        cell[0] += r["sess_overall"]
        cell[1] += r["sess_possible"]
    return {k: (m, p, 100.0 * m / p if p else None) for k, (m, p) in sums.items()}


def _named(rows, total: bool):
    return [
        r
        for r in rows
        if r["region_name"] not in (None, "null") and (r["school_type"] == "Total") == total
    ]


@pytest.mark.parametrize("seed", range(5))
def test_regional_performance(spark, seed):
    rows = _random_rows(seed)
    pooled = _pool(_named(rows, True), "region_name", "time_period")
    expected = {}
    for region in {key[0] for key in pooled}:
        years = sorted(key[1] for key in pooled if key[0] == region)
        rates = {y: pooled[region, y][2] for y in years}
        known = [100 - rate for rate in rates.values() if rate is not None]
        ends = rates[years[0]], rates[years[-1]]
        expected[region] = (
            None if None in ends else ends[0] - ends[1],
            statistics.fmean(known) if known else None,
        )
    found = regional.performance(regional.regional_rates(mart(spark, *rows)))
    for r in dicts(found):
        change, average = expected.pop(r["region_name"])
        assert r["average"] == (None if average is None else pytest.approx(average))
        assert r["change"] == (None if change is None else pytest.approx(change, abs=1e-9))
        assert (r["status"] is None) == (change is None)
    assert expected == {}


@pytest.mark.parametrize("seed", range(5))
def test_pattern_rankings(spark, seed):
    rows = _random_rows(seed)
    typed = _named(rows, False)
    cells = patterns.pattern_cells(mart(spark, *rows))
    for keys, found in (
        (("school_type", "region_name"), patterns.absence_ranked(cells)),
        (("school_type",), patterns.absence_by_school_type(cells, 100)),
        (("region_name",), patterns.absence_by_region(cells, 100)),
    ):
        pooled = _pool(typed, *keys)
        order = sorted(
            pooled, key=lambda k: (pooled[k][2] is None, -(pooled[k][2] or 0.0), k)
        )
        assert [tuple(r[k] for k in keys) for r in dicts(found)] == order
        for r in dicts(found):
            assert r["avg_absence_rate"] == pooled[tuple(r[k] for k in keys)][2]
