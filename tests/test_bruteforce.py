"""Operators against plain Python on random input: ties, NULLs, copies, unmatched ids."""

import random
import re
from collections import Counter, defaultdict

import pytest

from catalog_marts.functions import lenient_cast
from catalog_marts.operators import (
    crew_rollup,
    dense_rank_spread,
    explode_category,
    left_join_spread,
    region_rollup,
    top_n_per_group,
    weighted_rating,
)
from catalog_marts.operators.rollups import CREW_ROLES
from catalog_marts.plans import cast_mart
from pyspark.sql import functions as F

CATEGORIES = ["actor", "actress", "director", "producer", "writer", None]


def rng(seed):
    return random.Random(seed)


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema).repartition(7)


def catalogue(seed):
    """Credits, ratings and names with copies, gaps and NULLs."""
    r = rng(seed)
    credits = [(f"t{r.randrange(60)}" if r.random() > .03 else None,
                r.choice([None, r.randrange(8), r.randrange(60000)]),
                f"n{r.randrange(40)}" if r.random() > .05 else None,
                r.choice(CATEGORIES)) for _ in range(900)]
    credits += r.choices(credits, k=200)
    ratings = [(f"t{i}", r.choice([None, i % 10 + .5]), r.choice([None, r.randrange(5000)]))
               for i in range(5, 70)]
    ratings += r.choices(ratings, k=6)
    names = [(f"n{i}", r.choice([None, f"P{i % 9}"]), r.choice([None, 1950 + i % 3]), None)
             for i in range(3, 50)]
    names += r.choices(names, k=5)
    return credits, ratings, names


def scores_of(ratings, prior=1000.0):
    known = [a for _, a, _ in ratings if a is not None]
    mean = sum(known) / len(known)
    return [
        (t, None if None in (a, v) else v / (v + prior) * a + prior / (v + prior) * mean)
        for t, a, v in ratings
    ]


CREDITS = "title_id string, ordering int, name_id string, category string"
RATINGS = "title_id string, average_rating float, num_votes int"
NAMES = "name_id string, primary_name string, birth_year int, death_year int"


@pytest.mark.parametrize("seed", [1, 2])
def test_weighted_rating(spark, seed):
    _, ratings, _ = catalogue(seed)
    got = weighted_rating(frame(spark, ratings, RATINGS)).select("title_id", "weighted_rating")
    want = Counter((t, s if s is None else round(s, 9)) for t, s in scores_of(ratings))
    assert Counter((t, s if s is None else round(s, 9)) for t, s in got.collect()) == want


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_crew(spark, seed):
    credits, _, names = catalogue(seed)
    by_id = defaultdict(list)
    for n, name, *_ in names:
        by_id[n].append(name)
    want = {t: {role: [] for role in CREW_ROLES} for t, *_ in credits}
    for t, o, n, c in credits:
        for role, cats in CREW_ROLES.items():
            if c in cats:
                want[t][role] += [((o is not None, o), name) for name in by_id[n] if name]

    def joined(found):
        return ",".join(name for _, name in sorted(found, key=lambda p: (
            p[0][0], p[0][1] or 0, p[1])))

    text = {t: tuple(joined(w[role]) for role in CREW_ROLES) for t, w in want.items()}
    got = crew_rollup(frame(spark, credits, CREDITS), frame(spark, names, NAMES)).collect()
    assert {r.title_id: (r.actors, r.directors, r.producers) for r in got} == text
    assert len(got) == len(text)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("method", ["spread", "window"])
def test_cast(spark, seed, method):
    credits, ratings, names = catalogue(seed)
    scores, people = defaultdict(list), defaultdict(list)
    for t, s in scores_of(ratings):
        scores[t].append(s)
    for n, *rest in names:
        people[n].append(tuple(rest))
    groups = defaultdict(list)
    for t, _, n, c in credits:
        for person in people.get(n) or [(None, None, None)]:
            groups[(n, *person, c)] += scores.get(t) or [None]
    want = {}
    for key, found in groups.items():
        rated = [s for s in found if s is not None]
        want[key] = (round(sum(rated) / len(rated), 9) if rated else None, len(rated))  # ranks by this
    ranks = {}
    for c in CATEGORIES:
        distinct = {m for k, (m, _) in want.items() if k[-1] == c}
        order = sorted(distinct, key=lambda m: (m is None, -(m or 0)))
        ranks.update({(c, m): i + 1 for i, m in enumerate(order)})
    cast = cast_mart(frame(spark, credits, CREDITS), frame(spark, ratings, RATINGS),
                     frame(spark, names, NAMES))
    got = {(r.name_id, r.primary_name, r.birth_year, r.death_year, r.category):
           (r.avg_weighted_rating and round(r.avg_weighted_rating, 9), r.total_movies, r["rank"])
           for r in cast.collect()}
    assert got == {k: (m, n, ranks[(k[-1], m)]) for k, (m, n) in want.items()}
    assert cast.count() == len(want)


def test_regions(spark):
    r = rng(4)
    rows = [(f"t{r.randrange(30)}", r.choice(["US", "FR", "DE", "IN", "Unknown", None]))
            for _ in range(700)]
    want = defaultdict(list)
    for t, region in rows:
        if region not in (None, "Unknown"):
            want[t].append(region)
    got = region_rollup(frame(spark, rows, "title_id string, region string")).collect()
    assert {x.title_id: (x.regions, x.region_count) for x in got} == {
        t: (",".join(sorted(v)), len(set(v))) for t, v in want.items()}


def test_explode(spark):
    r = rng(5)
    texts = [None, ""] + ["".join(r.choices("ab, ", k=r.randrange(9))) for _ in range(300)]
    rows = list(enumerate(texts))
    want = Counter((i, tok.strip(" ") or "unknown") for i, t in rows
                   for tok in ([""] if t is None else t.split(",")))
    got = explode_category(frame(spark, rows, "id int, genres string")).collect()
    assert Counter((x.id, x.genres) for x in got) == want


@pytest.mark.parametrize("chunks", [None, 6, 30])
def test_dense_rank(spark, chunks):
    r = rng(6)
    rows = [(i, r.choice([None, "a", "b", f"g{r.randrange(40)}"]),
             r.choice([None, 1.0, r.randrange(30) / 4])) for i in range(2000)]
    got = dense_rank_spread(frame(spark, rows, "id int, g string, s double"), "g", "s", "k", chunks)
    groups = defaultdict(set)
    for _, g, s in rows:
        groups[g].add(s)
    place = {(g, s): i + 1 for g, v in groups.items()
             for i, s in enumerate(sorted(v, key=lambda s: (s is None, -(s or 0))))}
    assert {x.id: (x.g, x.s, x.k) for x in got.collect()} == {
        i: (g, s, place[(g, s)]) for i, g, s in rows}


def test_top_n(spark):
    r = rng(7)
    rows = [(i, r.choice([None, "a", f"g{r.randrange(20)}"]), r.choice([None, r.randrange(6)]),
             r.choice([None, r.randrange(3)])) for i in range(1500)]
    got = top_n_per_group(frame(spark, rows, "id int, g string, x int, y int"),
                          ["g"], ["x desc", "y"], 3, "k").collect()

    def key(v):
        return (v[0] is None, -(v[0] or 0), v[1] is not None, v[1] or 0)

    groups = defaultdict(set)
    for _, g, x, y in rows:
        groups[g].add((x, y))
    place = {(g, *v): i + 1 for g, vs in groups.items() for i, v in enumerate(sorted(vs, key=key))}
    assert Counter(tuple(x) for x in got) == Counter(
        (*row, place[row[1:]]) for row in rows if place[row[1:]] <= 3)


def test_spread_join(spark):
    r = rng(8)
    left = [(i, r.choice([None, "hot", "warm", f"k{r.randrange(30)}"])) for i in range(1500)]
    right = [("hot", 1), ("hot", 2), (None, 3)] + [(f"k{i}", i) for i in range(20, 50)]
    other = [("warm", "w"), ("hot", "h"), ("k25", "x"), ("k25", "y")]
    got = left_join_spread(frame(spark, left, "id int, k string"), "k",
                           frame(spark, right, "k string, v int"),
                           frame(spark, other, "k string, o string"))
    want = Counter((i, k, v, o) for i, k in left
                   for v in [v for rk, v in right if rk == k and k] or [None]
                   for o in [o for ok, o in other if ok == k] or [None])
    assert Counter((x.id, x.k, x.v, x.o) for x in got.collect()) == want


def test_lenient_int(spark):
    r = rng(9)
    texts = ["".join(r.choices("0123456789 -+.x", k=r.randrange(1, 13))) for _ in range(2000)]
    texts += ["2147483647", "2147483648", "-2147483648", "-2147483649", "", " 7 ", None]

    def parse(t):
        if t is None or not re.fullmatch(r" *[+-]?\d+ *", t):
            return None
        n = int(t)
        return n if -2**31 <= n < 2**31 else None

    df = frame(spark, [(t,) for t in texts], "t string")
    got = df.select("t", lenient_cast(F.col("t"), "int").alias("n")).collect()
    assert Counter((x.t, x.n) for x in got) == Counter((t, parse(t)) for t in texts)
