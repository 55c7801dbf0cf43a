"""Range join of vectors, conversation repair and Merkle manifest against brute force."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwood.llm import conversation, merkle, metric, queries

VEC = "vec_id long, embedding array<float>, label int"


# ---------------------------------------------------------------- op11

def _links(rows, cosine=0.95):
    """Every pair, in double precision."""
    dim = max((len(v) for _, v in rows if v), default=0)
    x, live = np.zeros((len(rows), dim)), np.zeros(len(rows), bool)
    for k, (_, v) in enumerate(rows):
        if v and all(c is not None and np.isfinite(np.float32(c)) for c in v):
            w = np.array(v, np.float32).astype(float)
            if w.any():
                x[k, : len(w)], live[k] = w / np.linalg.norm(w), True
    near = (x @ x.T >= cosine) & live[:, None] & live[None, :]
    np.fill_diagonal(near, False)
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in zip(*np.nonzero(near)):
        root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, int(near[k].sum()), least.get(find(k)) if live[k] else i, (least.get(find(k)) if live[k] else i) == i) for k, (i, _) in enumerate(rows)]


def _vectors():
    r = np.random.default_rng(5)
    centres = r.normal(size=(6, 16))
    rows = [(k, list(map(float, r.normal(size=16)))) for k in range(60)]  # unclustered
    for c, (n, spread) in enumerate([(150, 0.02), (120, 0.1), (120, 0.2), (60, 0.3), (40, 0.15), (30, 0.4)]):
        rows += [(1000 * (c + 1) + k, list(map(float, centres[c] / np.linalg.norm(centres[c]) * 4 + r.normal(size=16) * spread))) for k in range(n)]
    rows += [(9000, rows[70][1]), rows[71], (9001, [2 * x for x in rows[72][1]]), (9002, [-x for x in rows[72][1]])]
    rows += [(9100, None), (9101, []), (9102, [0.0] * 16), (9103, [1.0, None]), (9104, [float("nan")] * 16), (9105, [float("inf")] + [1.0] * 15), (None, rows[0][1]), (None, None)]
    rows += [(9200, [1.0]), (9201, [1.0, 0.0, -0.0]), (9202, [1e-30] + [0.0] * 15)]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"cell": 40}, {"cell": 7, "pivots": 9}, {"cell": 5, "pivots": 300}])
def test_range_join(spark, sizes):
    rows = _vectors()
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VEC).withColumns({"key": F.lit("clash"), "n": F.lit(1)}).repartition(3)
    got = [tuple(r) for r in metric.links(df, **sizes).collect()]
    assert sorted(got, key=repr) == sorted(_links(rows), key=repr)


def test_range_join_costs_a_tight_group_no_visits(spark):
    """A group of near copies with many pivots inside is linked by bounds alone."""
    r = np.random.default_rng(1)
    base = r.normal(size=32)
    rows = [(k, list(map(float, base + r.normal(size=32) * 0.05)), 0) for k in range(400)]
    df = spark.createDataFrame(rows, VEC)
    distinct = metric.keyed(df).withColumn("w", F.lit(1).cast("long")).select("key", "v", "w")
    centres = metric.units([x["v"] for x in distinct.orderBy("key").limit(20).collect()], 32, "float32")
    bound = float(np.arccos(0.95))
    p, angle, band = metric.nearest(metric.units([x["v"] for x in distinct.collect()], 32, "float32"), centres, bound)
    found = [{"pivot": int(k), "band": int(b), "n": 1, "w": 1, "low": a, "high": a, "rep": bytes(16)} for k, b, a in
             [(k, b, float(angle[(p == k) & (band == b)].max())) for k, b in set(zip(p.tolist(), band.tolist()))]]
    cells = metric.Cells(centres, bound, found, 20)
    share = spark.sparkContext.broadcast(cells)
    dealt, _ = metric._dealt(distinct, share, "float32", 0.95)
    assert dealt.filter(F.col("kind") == metric.VISITOR).count() == 0
    assert {(x[1], x[3]) for x in metric.links(df, cell=20).collect()} == {(399, True), (399, False)}


def test_range_join_of_no_rows_and_of_doubles(spark):
    assert metric.links(spark.createDataFrame([], VEC)).count() == 0
    assert [tuple(r) for r in metric.links(spark.createDataFrame([(3, None, 0)], VEC)).collect()] == [(3, 0, 3, True)]
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.3]), (3, [1.0, 0.33])]
    got = [tuple(r) for r in metric.links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()]
    assert sorted(got) == sorted(_links(rows))


# ---------------------------------------------------------------- op12

def _repair(rows):
    """Cheapest path, then least initials, over (rows read, automaton state)."""
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    heap, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, s, out = heapq.heappop(heap)
        if (i, s) in done:
            continue
        done.add((i, s))
        if i == len(rows) and s in (0, 3):
            break
        for c, role in (("u", "user"), ("a", "assistant")):
            if (s, c) in after:
                heapq.heappush(heap, (cost + 3, audit + "I", i, after[s, c], (*out, ("I", role, ""))))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, s, out))
            late = 3 if faults[i] == "truncated" else 0
            if faults[i] in ("", "truncated"):
                if (s, role[:1]) in after:
                    heapq.heappush(heap, (cost + late, audit + "K", i + 1, after[s, role[:1]], (*out, ("K", role, text))))
                for c, to in (("u", "user"), ("a", "assistant")):
                    if (s, c) in after:
                        heapq.heappush(heap, (cost + late + 3, audit + "R", i + 1, after[s, c], (*out, ("R", to, text))))
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit), out


def _in_order(rows):
    return sorted(rows, key=lambda z: (z[0] is not None, z[0] or 0, z[1].encode(), hashlib.sha256(z[2].encode()).digest()))


def _conversations():
    r = random.Random(3)
    rows = []
    for c in range(120):
        for t in range(r.choice([1, 2, 3, 5, 9, 25])):
            role = r.choice(["user", "assistant"] * 4 + ["system", "tool", "", "assist", None, "u"])
            rows.append((c, r.choice([t, t, t, t + 3, None, t - 1]), role, r.choice(["Yes.", "no", "Why? ", "", " \t", None, "Well!\n", "end . x"] + [f"text {k}." for k in range(6)])))
    return rows + [(None, 0, "user", "a."), (None, 1, "assistant", "b."), rows[0], rows[0]]


def _damaged(rows):
    out = {}
    for c, t, role, text in rows:
        own = out.setdefault(c, [])
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            own += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


@pytest.mark.parametrize("block", [conversation.BLOCK, 4])
def test_conversation_repair(spark, block):
    rows = _conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"conv": F.lit(1), "edits": F.lit("clash")}).repartition(5)
    hurt = conversation.damaged(df)
    plan = conversation.plan(hurt, block)
    got = {r["conv_id"]: tuple(r)[1:] for r in conversation.report(hurt, plan).collect()}
    kept: dict = {}
    for r in conversation.repaired(hurt, plan).orderBy("place").collect():
        kept.setdefault(r["conv_id"], []).append((r["edit"], r["role"], r["text"]))
    want = _damaged(rows)
    assert got.keys() == want.keys()
    for c, own in want.items():
        told, out = _repair(_in_order(own))
        assert got[c] == (*told, hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in out).encode()).hexdigest()), c
        assert kept.get(c, []) == list(out)


def test_giant_conversation_over_many_batches(spark):
    r = random.Random(8)
    rows = [(1, t, r.choice(["user", "user", "assistant", "system"]), r.choice(["ok.", "cut", "", f"n {t}."])) for t in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        plan = conversation.plan(df, 100)
        assert plan.count() == 31
        got = conversation.report(df, plan).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    told, out = _repair(_in_order([x[1:] for x in rows]))
    assert [tuple(x)[1:-1] for x in got] == [told]


# ---------------------------------------------------------------- op13

def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _tree(nodes):
    paths, own = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(a, min(a + 3, len(nodes))) for a in range(0, len(nodes), 3)]
        for run in runs:
            for k in run:
                for leaf in own[k]:
                    paths[leaf].append(("".join(nodes[x] for x in run if x < k), "".join(nodes[x] for x in run if x > k)))
        nodes, own = [_h(*[nodes[k] for k in run]) for run in runs], [sum((own[k] for k in run), []) for run in runs]
    return nodes[0], paths


def _manifest(rows):
    """rows: (source, order, leaf)."""
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    done = []
    for g in names:
        own = sorted(groups[g], key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        done.append((own, *_tree([r[2] for r in own])))
    root, last = _tree([d[1] for d in done])
    return [(*r, sub, root, p + q) for (own, sub, paths), q in zip(done, last) for r, p in zip(own, paths)]


@pytest.mark.parametrize("depth", [1, 2, 6])
def test_manifest(spark, depth):
    rows = []
    for source, n in [("a", 1), ("b", 2), ("é", 3), ("B", 4), (None, 9), ("d", 10), ("e", 27), ("f", 28), ("hot", 250), ("", 82)]:
        rows += [(source, k, _h(str(source), str(k))) for k in range(n)]
    rows += [("b", None, _h("x")), ("b", 1, _h("y")), ("b", 1, _h("y")), (None, None, _h("z"))]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "source string, doc_id long, leaf string").repartition(4)
    found = merkle.manifest(df, "source", ["doc_id"], depth)
    got = found.withColumns({"proof": merkle.proof(F.col("path")), "again": merkle.folded(F.col("leaf"), F.col("path"))}).collect()
    want = _manifest(rows)
    told = [(r["source"], r["doc_id"], r["leaf"], r["subroot"], r["root"], [tuple(x) for x in r["path"]]) for r in got]
    assert sorted(told, key=repr) == sorted(want, key=repr)
    assert all(r["again"] == r["root"] and r["proof"] == _h(*[a + b for a, b in r["path"]]) for r in got)


def test_manifest_finds_a_changed_row(spark):
    df = spark.createDataFrame([("s", k, _h(str(k))) for k in range(20)], "source string, doc_id long, leaf string")
    d = merkle.manifest(df, "source", ["doc_id"])
    bad = d.withColumn("now", F.when(F.col("doc_id") == 7, F.lit(_h("other"))).otherwise(F.col("leaf")))
    wrong = bad.filter(merkle.folded(F.col("now"), F.col("path")) != F.col("root")).select("doc_id").collect()
    assert [r[0] for r in wrong] == [7]


def test_manifest_query(spark, sf):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, t: _h(field(r["doc_id"]), field(r["source"]), field(r["lang"]), field(r["n_chars"]), field(t))
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    text = {r["doc_id"]: r for r in docs}
    want = []
    for _, i, own, sub, root, path in _manifest([(r["source"], r["doc_id"], leaf(r, r["text"])) for r in docs]):
        t = text[i]["text"]
        node = leaf(text[i], t.replace("\n", "") if t is not None and zlib.crc32(str(i).encode()) % 2 == 0 else t)
        for a, b in path:
            node = _h(a, node, b)
        want.append((i, own, sub, root, _h(*[a + b for a, b in path]), node, node == root))
    got = [tuple(r) for r in queries.queries()["op13_merkle_manifest"](spark, sf).collect()]
    assert sorted(got) == sorted(want) and 0 < sum(r[-1] for r in got) < len(got)
