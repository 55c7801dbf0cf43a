"""Quotas and blocks of the mix, and benchmark windows, against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwood.llm import decontam, mixing


def _seats(weights, seats):
    """Highest quotients one seat at a time; ties to the party first in order."""
    quota = [0] * len(weights)
    for _ in range(seats if any(weights) else 0):
        quota[max(range(len(weights)), key=lambda i: (weights[i] / (2 * quota[i] + 1), -i))] += 1
    return quota


def test_quotas_of_groups_with_ties_and_a_hot_group(spark):
    r = random.Random(11)
    groups = {"hot": [r.choice([500, 500, 501]) for _ in range(900)], None: [7] * 30, "one": [4], "zero": [0, 0, 9]}
    seats = {"hot": 1333, None: 45, "one": 9, "zero": 4}
    rows = [(g, k if k < len(w) - 1 or g != "hot" else None, x, seats[g]) for g, w in groups.items() for k, x in enumerate(w)]
    p = spark.createDataFrame(rows, "g string, k int, w long, seats long").repartition(7)
    got = {(x["g"], x["k"]): x["quota"] for x in mixing.sainte_lague(p, ["g"], ["k"], "w", "seats").collect()}
    for g, w in groups.items():
        want = _seats(w, seats[g])
        names = [k if k < len(w) - 1 or g != "hot" else None for k in range(len(w))]
        assert [got.get((g, k), 0) for k in names] == want, g
    alone = mixing.sainte_lague(p.filter("g = 'hot'").drop("g"), [], ["k"], "w", "seats").agg(F.sum("quota"), F.count("*")).first()
    assert tuple(alone) == (1333, 900)
    assert mixing.sainte_lague(p.limit(0), ["g"], ["k"], "w", "seats").count() == 0


def test_no_window_runs_over_all_shards_of_a_source(spark):
    from driftwood.plans.inspect import physical_plan

    p = spark.createDataFrame([("a", k, 5, 7) for k in range(50)], "g string, k int, w long, seats long")
    text = physical_plan(mixing.sainte_lague(p, ["g"], ["k"], "w", "seats"))
    over = [x for x in text.splitlines() if "windowspecdefinition" in x.lower()]
    assert over and all("__part" in x or "__bin" in x for x in over)


def test_take_equals_laying_out_every_word():
    r = random.Random(12)
    for case in range(200):
        n, block, most = r.randint(0, 12), r.choice([1, 3, 8]), 2
        sizes = np.array([r.choice([0, 1, r.randint(0, 40)]) for _ in range(n)], np.int64)
        order = np.array([r.randint(0, 5) for _ in range(n)], np.uint64)
        total = int(sizes.sum())
        blocks = -(-total // block)
        quota = r.randint(0, 3 * blocks + 2)
        taken, pieces = mixing.take(order, sizes, quota, block, most, case)
        # every word in its place, one by one
        line = [(d, k) for d in sorted(range(n), key=lambda i: (order[i], sizes[i], i)) for k in range(sizes[d])]
        times = {}
        for d, ps in enumerate(pieces):
            for a, b, t in ps:
                assert 0 <= a < b <= sizes[d] and t >= 1
                for k in range(a, b):
                    assert (d, k) not in times
                    times[d, k] = t
        assert [sum(times.get((d, k), 0) for k in range(sizes[d])) for d in range(n)] == taken.tolist()
        per_block = [{times.get(x, 0) for x in line[b * block : (b + 1) * block]} for b in range(blocks)]
        assert all(len(x) == 1 for x in per_block)
        got = [x.pop() for x in per_block]
        assert sum(got) == min(quota, most * blocks) and (not got or max(got) - min(got) <= 1 and max(got) <= most)


@pytest.mark.parametrize("part", [8 << 20, 3000])
def test_decontamination_equals_brute_force(spark, part):
    r = random.Random(13)
    word = lambda: r.choice(["a", "B", "c1", "é", "x"])
    items = [(k, " ".join(word() for _ in range(r.choice([0, 2, 13, 18])))) for k in range(25)] + [(3, "dup dup"), (None, "no id here"), (9, None)]
    docs = [(k, ", ".join(word() for _ in range(r.randint(0, 60))) + r.choice(["", " DUP-dup", " no id HERE", " " + items[r.randint(0, 24)][1]])) for k in range(80)] + [(99, None)]
    found = decontam.scan(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), part_bytes=part)
    got = {x["doc_id"]: (x["found"]["n_words"], x["found"]["n_hit"], x["found"]["items"]) for x in found.collect()}
    for doc_id, text in docs:
        w, hit, ids = decontam.item_words(text), set(), set()
        for item_id, t in items:
            q = decontam.item_words(t)
            for k in range(max(1, len(q) - 12)) if q else ():
                at = [i for i in range(len(w)) if w[i : i + len(q[k : k + 13])] == q[k : k + 13]]
                if at:
                    ids.add("" if item_id is None else str(item_id))
                    hit |= {i + j for i in at for j in range(len(q[k : k + 13]))}
        assert got[doc_id] == (len(w), len(hit), sorted(ids))


def test_more_buckets_than_shuffle_partitions_give_equal_rows(spark):
    from driftwood.llm import anchors

    r = random.Random(14)
    shared = " ".join(r.choice("abcdefgh") * r.randint(1, 4) for _ in range(90))
    docs = spark.createDataFrame([(k, " ".join(r.choice("abcdefgh") * r.randint(1, 4) for _ in range(40)) + (" " + shared if k % 3 == 0 else "")) for k in range(60)], "doc_id long, text string")
    size = sum(len(x["text"]) for x in docs.collect())
    few = sorted(map(repr, anchors.cut(docs).collect()))
    many = sorted(map(repr, anchors.cut(docs, bucket_bytes=size // 30).collect()))
    assert few == many and any("n_removed=90" in x for x in few)
