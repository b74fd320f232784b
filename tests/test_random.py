"""Random small tables with planted repeats, nulls, NaN and key collisions,
against plain Python."""

from __future__ import annotations

import math
import random
from datetime import datetime

import pytest

from starweave.operators import clean
from starweave.plans import match_star as ms
from tests.conftest import rows

STATS = ", ".join(f"{n} {t}" for n, t in ms.STATS_TYPES.items())
NATURAL = ("match_id", "time", "killer_name", "victim_name")


def tables(seed):
    rng = random.Random(seed)
    some = lambda value: None if rng.random() < 0.05 else value
    number = lambda top: some(rng.choice([float("nan"), float(rng.randint(0, top))] if rng.random() < 0.1 else [float(rng.randint(0, top))]))
    match = lambda: rng.choice(["AAAAA1", "AAAAA2", "BBBBB1", "CC"])
    player = lambda: rng.choice(["p1", "p2", "1p", "p"])
    stats = [
        (
            some(f"2017-10-0{rng.randint(1, 3)}T10:00:00+0000"),
            some(rng.randint(50, 52)), some(match()), some(rng.choice(["tpp", "fpp"])),
            some(rng.randint(0, 1)), some(0), number(2), number(2), some(rng.randint(0, 3)),
            some(rng.randint(0, 2)), some(player()), number(2),
        )
        for _ in range(60)
    ]
    kills = [
        (
            some(rng.choice(["AK", "M4"])), some(player()), number(3), number(2), number(2),
            some(rng.choice(["E", "M"])), some(match()), some(rng.randint(1, 21)),
            some(player()), number(3), number(1), number(1),
        )
        for _ in range(120)
    ]
    return stats + rng.sample(stats, 20), kills + rng.sample(kills, 40)


def whole(data):
    kept = {r for r in data if not any(v is None or (isinstance(v, float) and math.isnan(v)) for v in r)}
    return sorted(kept)


def lowest(found):
    """One row per first column: the lowest of the others."""
    best = {}
    for row in found:
        if row[0] not in best or row < best[row[0]]:
            best[row[0]] = row
    return sorted(best.values(), key=repr)


def named(*parts):
    """Parts with their lengths before them."""
    return "".join(f"{len(str(p))}:{p}" for p in parts)


#: Keys of a player and of a kill, for each way to make them.
STYLES = {
    "cut": ({"prefix_len": 5}, lambda r: f"{r[2][:5]}-{r[10]}", lambda r: f"{r[6][:5]}{r[7]}{r[1]}"),
    "plain": ({}, lambda r: f"{r[2]}-{r[10]}", lambda r: f"{r[6]}{r[7]}{r[1]}"),
    "whole": ({"whole": True}, lambda r: named(r[2], r[10]), lambda r: named(r[6], r[7], r[1], r[8])),
}


@pytest.mark.parametrize("style", STYLES)
@pytest.mark.parametrize("seed", range(3))
def test_match_star(spark, seed, style):
    options, performance, detail = STYLES[style]
    raw_stats, raw_kills = tables(seed)
    stats = clean(spark.createDataFrame(raw_stats, STATS).repartition(seed + 1))
    kills = clean(spark.createDataFrame(raw_kills, ms.KILLS_SCHEMA).repartition(seed + 2))
    star = ms.match_star(kills, stats, **options)

    s = whole(raw_stats)
    k = whole(raw_kills)
    assert rows(stats) == sorted(s, key=repr) and rows(kills) == sorted(k, key=repr)
    when = lambda text: datetime.strptime(text, "%Y-%m-%dT%H:%M:%S+%f")

    assert rows(star.dims["performances"]) == lowest(
        (performance(r), r[10], r[2], r[5], r[6], r[7], r[8], r[9], r[11], r[4]) for r in s
    )
    assert rows(star.dims["details"]) == lowest(
        (detail(r), r[6], r[1], int(r[2]), r[8], int(r[9]), r[0], r[7]) for r in k
    )
    dates = rows(star.dims["dates"].select("game_time", "match_id"))
    assert dates == lowest((when(r[0]), r[2]) for r in s)
    assert rows(star.dims["matches"]) == lowest(
        (a[2], a[1], a[3], b[5]) for a in s for b in k if a[2] == b[6]
    )
    facts = sorted(
        (
            (b[3], b[4], b[10], b[11], b[6], detail(b), when(a[0]), performance(a))
            for b in k
            for a in s
            if a[2] == b[6] and a[10] == b[1]
        ),
        key=repr,
    )
    assert rows(star.fact.drop("location_id")) == facts
    assert star.join().count() == len(facts)

    # The same facts and dimension rows when only a part is built.
    where = ms.area_and_month(1.0, 2.0, 10)
    part = ms.match_star(kills, stats, where=where, **options)
    assert rows(part.join().drop("locations_location_id")) == rows(
        star.filtered(where).join().drop("locations_location_id")
    )
    wanted = ms.area_report(star, 1.0, 2.0, 10)
    assert rows(ms.area_report(part, 1.0, 2.0, 10)) == rows(wanted)
    first = ms.area_report(star, 1.0, 2.0, 10, 7).collect()
    order = [(r["killer_position_x"], r["detail_id"]) for r in first]
    every = sorted((r["killer_position_x"], r["detail_id"]) for r in wanted.collect())
    assert order == every[:7]
