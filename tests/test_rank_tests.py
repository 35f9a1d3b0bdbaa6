import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from marketlens.functions.rank_tests import chi_square_tail, exact_counts, exact_p, kruskal_wallis, mann_whitney, normal_tail


def mid_ranks(values):
    order = sorted(values)
    return [sum(1 for x in order if x < v) + (sum(1 for x in order if x == v) + 1) / 2 for v in values]


def brute_u(a, b):
    return sum((x > y) + 0.5 * (x == y) for x in a for y in b)


def brute_p(u, n1, n2, values, two_sided):
    n = n1 + n2
    ties = sum(c**3 - c for c in (values.count(v) for v in set(values)))
    sigma = math.sqrt(n1 * n2 / 12 * ((n + 1) - ties / (n * (n - 1))))
    best = max(u, n1 * n2 - u) if two_sided else n1 * n2 - u
    tail = 0.5 * math.erfc((best - n1 * n2 / 2 - 0.5) / sigma / math.sqrt(2))
    return min(1.0, 2 * tail) if two_sided else tail


@pytest.mark.parametrize("alternative", ["less", "two-sided"])
def test_mann_whitney_against_all_pairs(spark, alternative):
    rng = random.Random(3)
    a = [rng.randint(1, 5) for _ in range(60)]
    b = [rng.choice([3, 4, 5, 5]) for _ in range(90)]
    df = spark.createDataFrame([(x, True) for x in a] + [(x, False) for x in b], "v int, first boolean")
    got = mann_whitney(df, "v", F.col("first"), alternative).first()
    u = brute_u(a, b)
    assert (got["n1"], got["n2"], got["u_statistic"]) == (60, 90, u)
    assert got["p_value"] == pytest.approx(brute_p(u, 60, 90, a + b, alternative == "two-sided"), rel=1e-6)
    assert got["effect_size_rank_biserial"] == round(1 - 2 * u / 5400, 4)


def test_exact_distribution_is_the_enumeration_of_all_orders():
    for n1 in range(1, 9):
        for n2 in range(1, 9):
            counts = [0] * (n1 * n2 + 1)
            for places in itertools.combinations(range(n1 + n2), n1):
                counts[sum(places) - n1 * (n1 - 1) // 2] += 1
            assert exact_counts(n1, n2) == counts, (n1, n2)
    assert sum(exact_counts(8, 2000)) == math.comb(2008, 8)


@pytest.mark.parametrize("alternative", ["less", "two-sided"])
def test_small_untied_samples_have_an_exact_p(spark, alternative):
    a, b = [1.1, 2.2, 4.0, 7.5], [3.0, 5.0, 6.1, 8.0, 9.9, 12.0]
    df = spark.createDataFrame([(x, True) for x in a] + [(x, False) for x in b], "v double, first boolean")
    got = mann_whitney(df, "v", F.col("first"), alternative).first()
    u, both = brute_u(a, b), a + b
    orders = [brute_u([both[i] for i in c], [both[i] for i in range(10) if i not in c]) for c in itertools.combinations(range(10), 4)]
    below = sum(x <= u for x in orders) / len(orders)
    want = below if alternative == "less" else min(1.0, 2 * min(below, sum(x >= u for x in orders) / len(orders)))
    assert (got["method"], got["p_value"]) == ("exact", pytest.approx(want)) and exact_p(u, 4, 6, alternative) == pytest.approx(want)
    tied = spark.createDataFrame([(x, True) for x in [*a, 3.0]] + [(x, False) for x in b], "v double, first boolean")
    assert mann_whitney(tied, "v", F.col("first"), alternative).first()["method"] == "asymptotic"


def test_kruskal_wallis_against_ranks(spark):
    rng = random.Random(5)
    groups = {g: [round(rng.gauss(i, 2), 1) for _ in range(20 + i)] for i, g in enumerate("abc")}
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    got = kruskal_wallis(spark.createDataFrame(rows, "g string, v double"), "v", "g", ["a", "b", "c"]).first()
    values = [v for _, v in rows]
    ranks, n = mid_ranks(values), len(values)
    sums = {g: sum(r for r, (h, _) in zip(ranks, rows) if h == g) for g in groups}
    ties = sum(c**3 - c for c in (values.count(v) for v in set(values)))
    h = (12 / (n * (n + 1)) * sum(s * s / len(groups[g]) for g, s in sums.items()) - 3 * (n + 1)) / (1 - ties / (n**3 - n))
    assert got["h_statistic"] == pytest.approx(h) and got["p_value"] == pytest.approx(math.exp(-h / 2), rel=1e-9)


def test_tails(spark):
    one = spark.range(1)
    for z in (-2.0, 0.0, 1.5, 8.0):
        p = one.select(normal_tail(F.lit(z))).first()[0]
        assert p == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), rel=1e-7)
    # chi-square with 1 and 3 degrees: closed forms through erfc
    x = 4.2
    q1 = math.erfc(math.sqrt(x / 2))
    q3 = q1 + math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
    got = one.select(chi_square_tail(F.lit(x), 1), chi_square_tail(F.lit(x), 3), chi_square_tail(F.lit(x), 2)).first()
    assert list(got) == pytest.approx([q1, q3, math.exp(-x / 2)], rel=1e-7)


def test_equal_groups_are_not_significant(spark):
    df = spark.createDataFrame([(float(i % 7), i % 2 == 0) for i in range(140)], "v double, first boolean")
    got = mann_whitney(df, "v", F.col("first"))
    assert got.first()["effect_size_rank_biserial"] == 0.0 and not got.first()["statistically_significant"]


def test_degenerate_samples(spark):
    same = spark.createDataFrame([(1.0, True), (1.0, False), (1.0, False)], "v double, first boolean")
    got = mann_whitney(same, "v", F.col("first")).first()
    assert (got["p_value"], got["effect_size_rank_biserial"]) == (1.0, 0.0)
    lone = mann_whitney(same.filter("first"), "v", F.col("first")).first()
    assert (lone["p_value"], lone["mean2"], lone["effect_size_rank_biserial"]) == (1.0, None, None)
    groups = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "g string, v double")
    got = kruskal_wallis(groups, "v", "g", ["a", "b", "c"]).first()
    assert got["h_statistic"] is None and got["p_value"] is None
