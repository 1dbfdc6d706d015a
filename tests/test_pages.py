"""Flattened ranges against a look at every range."""

import random

from learnstream.operators import pages

RANGES = "province string, ip_from long, ip_to long"


def smallest(ranges, ip):
    held = [(b - a, a, p) for p, a, b in ranges if a is not None and b is not None and a <= ip <= b]
    return min(held)[2] if held else None


def check(spark, ranges, ips):
    flat = pages.flatten(spark.createDataFrame(ranges, RANGES))
    pieces = sorted((r.ip_from, r.ip_to) for r in flat.collect())
    assert all(a <= b for a, b in pieces) and all(x[1] < y[0] for x, y in zip(pieces, pieces[1:]))
    counts = spark.createDataFrame([(ip, 1 + ip % 3) for ip in sorted(set(ips))], "ip_num long, c long")
    got = {r.ip_num: r.province for r in pages.locate(counts, flat).collect()}
    assert got == {ip: p for ip in ips if (p := smallest(ranges, ip)) is not None}


def test_nested_overlapping_equal_and_broken_ranges(spark):
    rnd = random.Random(7)
    ranges = [("all", 0, 2 ** 32 - 1), ("none", 9, 3), (None, 5, 5), ("open", None, 7), ("b", 100, 200), ("a", 100, 200),
              ("one", 150, 150), ("end", 2 ** 32 - 1, 2 ** 32 - 1), ("cross", 65_000, 200_000)]
    for k in range(60):
        low = rnd.randrange(400_000)
        ranges.append((f"r{k}", low, low + rnd.choice([0, 10, 5_000, 70_000])))
    # as many ranges in one another
    ranges += [(f"n{k}", 500_000 + k, 501_000 - k) for k in range(200)]
    edges = [x + d for _, a, b in ranges if a is not None and b is not None for x in (a, b) for d in (-1, 0, 1)]
    ips = {x for x in edges if 0 <= x < 2 ** 32} | {rnd.randrange(600_000) for _ in range(2000)}
    check(spark, [r for r in ranges if r[0] is not None], sorted(ips))


def test_no_ranges_and_disjoint_ranges(spark):
    check(spark, [], [1, 2, 3])
    check(spark, [("a", 10, 20), ("b", 30, 70_000), ("c", 70_001, 70_001)], range(0, 71_000, 7))
