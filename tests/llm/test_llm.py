"""The training-data operators on small tables with nulls, empty and repeated rows, against brute force."""


import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from driftwood.llm import anchors, bwt, components, decontam, gam, langid, mixing, queries, ratio, simhash, sql, suffix, urlfilter, warc

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _texts():
    r = random.Random(4)
    vocabulary = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(300)]
    make = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    shared, long_ = make(70), make(3000)
    out = [make(20) + "\n" + shared + "  " + make(30), shared, make(5) + " " + shared, "", None, "one two", long_, make(40) + " " + long_[2000:6000],
           "ab " * 400, "ab " * 300, make(120)]
    return out + [out[0], out[2], make(60)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(_texts())]
    rows += [rows[0], (None, rows[1][1], None, None, None)]  # a repeated row and a row of nulls
    return spark.createDataFrame(rows, DOC).withColumn("n_words", F.lit("clash")).repartition(3)


def _plain(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def _cover(n, starts, width):
    out = np.zeros(n, bool)
    for s in starts:
        out[s : s + width] = True
    return out


def test_fixed_block_anchors(docs):
    rows = [(i, WORD.findall(t or "")) for i, t in _plain(docs)]
    first = {}
    for i, w in rows:
        for k in range(len(w) - 49) if i is not None else ():
            first[tuple(w[k : k + 50])] = min(i, first.get(tuple(w[k : k + 50]), i))
    want = []
    for i, w in rows:
        c = _cover(len(w), [k for k in range(len(w) - 49) if i is not None and first[tuple(w[k : k + 50])] < i], 50)
        want.append((i, len(w), int(c.sum()), " ".join(x for x, y in zip(w, c) if not y)))
    for sizes in ({}, {"bucket_bytes": 1 << 12, "chunk": 200}):
        got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in anchors.cut(docs, **sizes).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_anchors_where_tasks_hold_short_documents_only(spark):
    short = [(k, t) for k, t in enumerate(["one two", "", None, "a " * 49])]
    docs = spark.createDataFrame(short, "doc_id long, text string").coalesce(1)
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in anchors.cut(docs).collect()) == [(0, 2, 0), (1, 0, 0), (2, 0, 0), (3, 49, 0)]
    # the tail of a task after a full chunk, and a task beside one with long documents
    long_ = [(k, " ".join(f"w{x}" for x in range(60))) for k in (10, 11)]
    tail = [pa.RecordBatch.from_pylist([{"doc_id": k, "text": t} for k, t in rows]) for rows in (long_, short)]
    assert len(list(anchors._probes(tail, 1, 50, 25, 1))) == 1
    both = docs.union(spark.createDataFrame(long_, docs.schema).coalesce(1))
    assert sorted((r["doc_id"], r["n_removed"]) for r in anchors.cut(both).collect()) == [(0, 0), (1, 0), (2, 0), (3, 0), (10, 0), (11, 60)]


def test_interval_expansion(docs):
    rows = [(i, (t or "").encode()) for i, t in _plain(docs)]
    seen = {}
    for _, b in rows:
        for k in range(len(b) - 399):
            seen[b[k : k + 400]] = seen.get(b[k : k + 400], 0) + 1
    want = []
    for i, b in rows:
        c = _cover(len(b), [k for k in range(len(b) - 399) if seen[b[k : k + 400]] > 1], 400)
        want.append((i, len(b), int(c.sum()), bytes(np.frombuffer(b, np.uint8)[~c])))
    for sizes in ({}, {"bucket_bytes": 1 << 11, "hot_bytes": 1000}):
        got = [(r["doc_id"], r["n_bytes"], r["n_removed"], bytes(r["kept"])) for r in suffix.cut(docs, **sizes).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_stretches_of_a_long_text_hold_every_window(monkeypatch):
    r = random.Random(9)
    texts = [bytes(r.choice(b"abcd") for _ in range(3000)), b"xyz" * 900, b"q" * 2500 + bytes(r.choice(b"ab") for _ in range(900))]
    for text in texts:
        buf = np.frombuffer(text, np.uint8)

        def anchors_by_window():
            out = {}
            for _, h, _, first, last, anchor, copies, n in suffix._stretches(buf, np.array([0, len(buf)]), 400, 32):
                for x, a, b, c, k, m in zip(h, first, last, copies, n, anchor):
                    assert c > 1 or b - a + 1 == k
                    for w in range(a, b + 1):
                        assert w not in out
                        out[w] = (int(x), int(m) if c == 1 else None)
            return out

        monkeypatch.setattr(suffix, "STRETCH", 1 << 20)
        whole = anchors_by_window()
        monkeypatch.setattr(suffix, "STRETCH", 700)
        cut = anchors_by_window()
        assert sorted(whole) == sorted(cut) == list(range(len(text) - 399))
        assert all(whole[w][0] == cut[w][0] for w in whole)


def test_transform_against_brute_force(monkeypatch):
    r = np.random.default_rng(1)
    for trial in range(150):
        monkeypatch.setattr(bwt, "LARGE", 3 if trial % 4 == 0 else 8192)
        strings = list({bytes(r.integers(97, 98 + r.integers(1, 4), r.integers(0, 50)).astype(np.uint8)) for _ in range(r.integers(1, 10))})
        copies, least, seen = r.integers(1, 3, len(strings)), int(r.integers(1, 8)), {}
        for s, c in zip(strings, copies):
            for k in range(len(s) - least + 1):
                seen[s[k : k + least]] = seen.get(s[k : k + least], 0) + c
        want = [[k for k in range(len(s) - least + 1) if seen[s[k : k + least]] > 1] for s in strings]
        assert [list(x) for x in bwt.repeated(strings, copies, least)] == want


def test_transform_beyond_the_first_keys(monkeypatch):
    # common prefixes shorter and longer than what a sort key holds, and strings that end within one
    r = np.random.default_rng(3)
    for trial in range(120):
        monkeypatch.setattr(bwt, "LARGE", 3 if trial % 4 == 0 else 8192)
        base = r.integers(0, int(r.choice([2, 5, 100, 256])), 200).astype(np.uint8)
        strings = list({bytes(base[a : a + n]) + b"\x01" * int(r.integers(0, 3)) for a, n in r.integers(0, 120, (10, 2))})
        copies, least, seen = r.integers(1, 3, len(strings)), int(r.integers(1, 80)), {}
        for s, c in zip(strings, copies):
            for k in range(len(s) - least + 1):
                seen[s[k : k + least]] = seen.get(s[k : k + least], 0) + c
        want = [[k for k in range(len(s) - least + 1) if seen[s[k : k + least]] > 1] for s in strings]
        assert [list(x) for x in bwt.repeated(strings, copies, least)] == want


def test_only_windows_that_may_repeat_are_transformed(monkeypatch):
    r = random.Random(5)

    def text(n):
        return bytes(r.choice(b"abcdefgh ") for _ in range(n))

    length, gram = 60, 8
    half = (length - gram) // 2
    for _ in range(40):
        shared = [text(r.randrange(gram, 150)) for _ in range(3)]
        texts = [text(r.randrange(0, 50)) + r.choice(shared) + text(r.randrange(0, 50)) for _ in range(12)]
        buf = np.frombuffer(b"".join(texts), np.uint8)
        row, h, d, first, _, anchor, copies, n = suffix.segments_of(buf, np.cumsum([0, *map(len, texts)]), length, gram)
        one = {}
        for k in range(len(h)):
            total, *rest = one.get((h[k], d[k]), (0, texts[row[k]][first[k] : first[k] + n[k] - 1 + length], anchor[k] - first[k]))
            one[h[k], d[k]] = (total + int(copies[k]), *rest)
        seen, near = {}, {}
        for (x, _), (total, s, a) in one.items():
            for w in range(len(s) - length + 1):
                seen[s[w : w + length]] = seen.get(s[w : w + length], 0) + total
            sides = [("before", s[a - half : a])] if a >= half else []
            sides += [("after", s[a + gram : a + gram + half])] if a - (len(s) - length) < half else []
            for side in sides:
                near[x, *side] = near.get((x, *side), 0) + total
        given = []
        monkeypatch.setattr(suffix, "repeated", lambda strings, copies, least: given.extend(strings) or bwt.repeated(strings, copies, least))
        table = pa.table({"h": [int(x) for x, _ in one], "d": [int(x) for _, x in one], "total": [x[0] for x in one.values()],
                          "anchor": pa.array([int(x[2]) for x in one.values()], pa.int64()), "bytes": pa.array([x[1] for x in one.values()], pa.binary())})
        got = {(x["h"], x["d"]): [w for a, b in np.frombuffer(x["at"], np.int32).reshape(-1, 2) for w in range(a, b + 1)]
               for x in suffix._bucket(table, length, gram).to_pylist()}
        want = {k: [w for w in range(len(s) - length + 1) if seen[s[w : w + length]] > 1] for k, (_, s, a) in one.items()}
        assert got == {k: v for k, v in want.items() if v}
        windows = 0
        for (x, _), (total, s, a) in one.items():
            for w in range(len(s) - length + 1):
                windows += near[(x, "before", s[a - half : a]) if a - w >= half else (x, "after", s[a + gram : a + gram + half])] > 1
        assert sum(len(s) - length + 1 for s in given) == windows < sum(len(x[1]) - length + 1 for x in one.values())


def test_suffix_order_of_any_alphabet():
    r = np.random.default_rng(2)
    for trial in range(60):
        size, base = int(r.choice([1, 2, 3, 100, 130, 256])), r.integers(0, 256, 60)
        strings = [bytes((base[a : a + 40] % size).astype(np.uint8)) for a in r.integers(0, 60, 1 + trial % 6)]
        sym = np.concatenate([[*(x + 1 for x in s), 0] for s in strings]).astype(np.uint16)
        ends = np.flatnonzero(sym == 0)
        stop = np.repeat(ends, np.diff([-1, *ends])).astype(np.int32)
        rank, sa = bwt.suffix_order(sym, stop)
        # ends are different symbols, in order of place
        want = sorted(range(len(sym)), key=lambda k: ([int(x) for x in sym[k : stop[k]]] + [0], int(stop[k])))
        assert list(sa) == want and list(rank[sa]) == list(range(len(sym)))


def test_ball_hashing(docs):
    import xxhash

    prints = {}
    rows = _plain(docs)
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        s = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        prints[t] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0
    values = sorted(set(prints.values()))
    group = {v: v for v in values}
    for _ in values:
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= 2:
                    group[a] = group[b] = min(group[a], group[b])
    least = {}
    for i, t in rows:
        g = group[prints[t]]
        least[g] = min((x for x in (i, least.get(g)) if x is not None), default=None)
    want = sorted(repr((i, prints[t], least[group[prints[t]]])) for i, t in rows)
    assert sorted(repr((r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"])) for r in simhash.near_duplicates(docs).collect()) == want


def test_links_reach_every_near_fingerprint(spark):
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(5)]
    values = {b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 4))) for b in base for _ in range(30)}
    signed = [v - 2**64 if v >> 63 else v for v in values]
    found = components.components(simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"))).collect()
    root = {v: v for v in signed} | {x["u"]: x["root"] for x in found}
    group = {v: v for v in signed}
    changed = True
    while changed:
        changed = False
        for a in signed:
            for b in signed:
                if ((a ^ b) & (2**64 - 1)).bit_count() <= 2 and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    assert root == group


def test_base_rules_and_ratio(docs, spark):
    got = {(r["doc_id"], r["text"]): r for r in ratio.judge(docs.drop("n_words"), F.col("doc_id") < 8).collect()}
    for (i, t), r in got.items():
        w = WORD.findall(t or "")
        seen = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        repeated = int(_cover(len(w), [k for k, x in enumerate(seen) if seen.count(x) > 1], 5).sum())
        failed = len(w) < 10 or 100 * repeated > 20 * len(w)
        assert (r["n_words"], r["n_repeat_words"], r["base_failed"]) == (len(w), repeated, failed)
        assert not (failed and r["kept"])
    assert ratio.judge(docs.drop("n_words").limit(0), F.lit(False)).count() == 0


def test_ratio_against_brute_force(docs, spark):
    import math
    from collections import Counter

    import xxhash

    buckets, threshold = 64, -0.05
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    odd = [(50, "a # b\n\n  \na # b\n a # b\nc"), (51, "*" * 20 + " é日本"), (52, " \t\n "), (53, "|".join("<>&%$#*") + "\n" * 3)]
    rows += odd
    signed = lambda h: h - 2**64 if h >> 63 else h

    def grams(w):
        one = [signed(xxhash.xxh64_intdigest(x.encode(), 42)) % buckets for x in w]
        two = [signed(xxhash.xxh64_intdigest(b.encode(), xxhash.xxh64_intdigest(a.encode(), 42))) % buckets for a, b in zip(w, w[1:])]
        return one + two

    trusted = lambda i: i is not None and i < 8
    raw, target = Counter(range(buckets)), Counter(range(buckets))  # a pseudo count each
    for i, t in rows:
        raw.update(grams(WORD.findall(t or "")))
        if trusted(i):
            target.update(grams(WORD.findall(t or "")))
    weight = [math.log(target[b] / target.total()) - math.log(raw[b] / raw.total()) for b in range(buckets)]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"words": F.lit(1), "ratio": F.lit("clash"), "kept": F.lit("clash")})
    got = {(r["doc_id"], r["text"]): r for r in ratio.judge(d, F.coalesce(F.col("doc_id") < 8, F.lit(False)), threshold=threshold, buckets=buckets).collect()}
    for i, t in rows:
        r, w = got[i, t], WORD.findall(t or "")
        g = grams(w)
        want = sum(weight[b] for b in g) / len(g) if g else 0.0
        assert abs(r["ratio"] - want) < 1e-9
        assert r["kept"] == (not r["base_failed"] and r["ratio"] >= threshold)
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        assert (r["word_chars"], r["n_symbols"], r["n_dup_lines"]) == (sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)))
    assert {r["ratio"] for r in ratio.judge(d, F.lit(False)).collect()} == {0.0}


def test_urls(spark):
    urls = ["http://A.example.NET/en/x?q", "http://x.net", "http://x.net/", "https://example.com/de/1#t", "https://example.comx/de/", "no url", None, "http://a.org/fr/", "http://a.org/fr", "://net//"]
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)] + [(0, urls[0])], "page_id long, url string").withColumn("verdict", F.lit("clash"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge(pages, spark.createDataFrame(queries.RULES, "host string, path string, verdict string")).collect()}
    assert [got[k] for k in range(len(urls))] == [
        ("a.example.net", "/en/x", "example.net/en/", "allow"), ("x.net", "", None, "allow"), ("x.net", "/", "net/", "block"), ("example.com", "/de/1", "example.com/de/", "block"),
        ("example.comx", "/de/", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("a.org", "/fr/", "org/fr/", "allow"), ("a.org", "/fr", None, "allow"), ("net", "//", "net/", "block")]
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r["verdict"] for r in urlfilter.judge(pages, none).collect()} == {"allow"}


def test_decontamination_spans_and_parts(spark):
    item = " ".join(f"w{k}" for k in range(20))
    items = spark.createDataFrame([(2, item), (10, "Short one"), (10, "Short one"), (11, None), (12, "")], "item_id long, text string")
    text = "Say: É " + item.upper().replace(" ", ", ") + "! short-ONE"
    docs = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "short two")], "doc_id long, text string")
    for part in (1 << 20, 30):
        got = {r["doc_id"]: r["found"] for r in decontam.scan(docs, items, part_bytes=part).collect()}
        assert (got[1]["n_words"], got[1]["n_hit"], got[1]["items"]) == (24, 22, ["10", "2"])
        assert text[got[1]["spans"][0]["start"] : got[1]["spans"][0]["stop"]].lower().endswith("one")
        assert [got[k]["n_hit"] for k in (2, 3, 4)] == [0, 0, 0]
    assert decontam.scan(docs, items.limit(0)).select(F.sum("found.n_hit")).first()[0] == 0


def test_mix(spark):
    r = random.Random(5)
    rows = [(k, "w " * r.randint(0, 400), r.choice(["a", "b", None])) for k in range(300)] + [(1, None, "a"), (None, "w w", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, shard_words=5000).collect()
    again = mixing.mix(docs.repartition(5), shard_words=5000).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again)) and len(got) == len(rows)
    taken, goal = {}, {}
    for x in got:
        assert 0 <= x["taken"] <= 2 * x["size"]
        assert x["taken"] == sum((p["stop"] - p["first"]) * p["times"] for p in x["pieces"])
        taken[x["source"]] = taken.get(x["source"], 0) + x["taken"]
        goal[x["source"]] = x["target"]
    assert all(abs(taken[s] - goal[s]) <= 0.01 * goal[s] + 2 * mixing.BLOCK for s in goal)


def test_mix_keeps_rows_without_words_out_of_the_shards(spark):
    words_ = [(k, "w " * (k % 40 + 1), "ab"[k % 2]) for k in range(200)]
    bare = [(1000 + k, [None, "", " \n"][k % 3], ["a", "e", None][k % 3]) for k in range(600)] + [(2000 + k, "", "e") for k in range(1400)]
    schema = "doc_id long, text string, source string"
    got = mixing.mix(spark.createDataFrame(words_ + bare, schema).repartition(8), shard_words=500)
    rows = got.collect()
    assert len(rows) == len(words_ + bare)
    assert all(r["taken"] == 0 and r["pieces"] == [] for r in rows if r["doc_id"] >= 1000)
    assert sum(r["taken"] for r in rows) > 0
    # not one task for all rows of source e
    assert got.filter("source = 'e'").select(F.spark_partition_id()).distinct().count() > 1


def _reshared(sizes, share=1.5, most=2.0):
    """Targets by resharing the excess of full sources again and again."""
    weights = [mixing.WEIGHTS[k % len(mixing.WEIGHTS)] for k in range(len(sizes))]
    full = set()
    while True:
        left = share * sum(sizes) - sum(most * sizes[k] for k in full)
        level = left / max(sum(w for k, w in enumerate(weights) if k not in full), 1e-300)
        new = {k for k, w in enumerate(weights) if k not in full and most * sizes[k] < level * w}
        if not new:
            return [most * n if k in full else level * w for k, (n, w) in enumerate(zip(sizes, weights))]
        full |= new


def test_targets_of_tied_sources(spark):
    r = random.Random(8)
    lists = [[1000, 3000, 500, 1000, 3000, 500], [900, 300, 600], [10, 0, 0, 10]] + [[r.choice([100, 300, 600, 3000]) for _ in range(r.randint(1, 9))] for _ in range(10)]
    for sizes in lists:
        rows = [(f"s{k}" if k + 1 < len(sizes) else None, n) for k, n in enumerate(sizes)]
        got = {x["source"]: x["target"] for x in mixing.targets(spark.createDataFrame(rows, "source string, source_size long")).collect()}
        assert [got[s] for s, _ in rows] == pytest.approx(_reshared(sizes)), sizes
    assert _reshared(lists[0])[1] == 3750


def test_sainte_lague(spark):
    r = random.Random(6)
    weights = [r.randint(1, 1000) for _ in range(40)]
    seats = 333
    quota = [0] * len(weights)
    for _ in range(seats):
        k = max(range(len(weights)), key=lambda i: (weights[i] / (2 * quota[i] + 1), -i))
        quota[k] += 1
    p = spark.createDataFrame([("g", k, w, seats) for k, w in enumerate(weights)], "g string, k int, w long, seats long")
    assert [x["quota"] for x in mixing.sainte_lague(p, ["g"], ["k"], "w", "seats").orderBy("k").collect()] == quota


def test_language_and_quality_on_held_out_rows(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    got = queries.op6_rank_order(spark, sf).join(d, "doc_id").filter("held_out AND lang IS NOT NULL")
    assert got.filter("lang_pred = lang").count() >= 0.95 * got.count()
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !"), (4, "été")], "doc_id long, text string")
    learned = langid.profiles(d)
    assert [r["language"]["lang"] for r in langid.predict(odd, learned).orderBy("doc_id").collect()][:3] == ["und"] * 3
    assert {r["language"]["lang"] for r in langid.predict(odd, {}).collect()} == {"und"}
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = queries.op4_additive_model(spark, sf).join(labels, "doc_id").filter("held_out")
    assert scored.filter("predicted = quality").count() >= 0.9 * scored.count()
    assert all(0 <= r["quality"]["score"] <= 1 for r in gam.predict(odd, gam.Model()).collect())


def test_languages_of_few_texts_teach(spark):
    few = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("l"), F.col("id") % 20).alias("lang"), F.concat(F.lit("text of language "), F.col("id") % 20).alias("text"))
    # a text that is two thirds of a language's rows, and a language of one row repeated among rows without a letter
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("hot").alias("lang"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("other "), "id")).alias("text"))
    bare = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("bare").alias("lang"), F.when(F.col("id") < 10, "abc").otherwise(F.concat(F.lit("1"), "id")).alias("text"))
    docs = few.union(hot).union(bare)
    assert sorted(langid.profiles(docs, sample=60)) == sorted(["hot", "bare", *(f"l{k}" for k in range(20))])
    n = {r["lang"]: r for r in langid.sampled(docs, 60).groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("text") == "hot").alias("copies")).collect()}
    assert all(25 <= r["n"] <= 120 for r in n.values())
    assert 0.4 < n["hot"]["copies"] / n["hot"]["n"] < 0.9


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "<p>Tom &amp; <b>J</b>é</p><script>x</script>"), (2, None, None), (1, "http://a/", "")], "page_id long, url string, html string")
    source = warc.responses(pages)
    records = warc.derive(source)
    warc.write(records.coalesce(1), str(tmp_path / "w"), "none")
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*")))
    parsed = warc.parse(data)
    ids = {r["record_id"] for r in source.collect()}
    assert len(parsed) == 6 and {h["WARC-Refers-To"] for h, _ in parsed} == ids
    for h, block in parsed:
        assert h["WARC-Block-Digest"] == warc.digest(block) and int(h["Content-Length"]) == len(block)
    assert b"Tom & J\xc3\xa9" in [b for h, b in parsed if h["WARC-Type"] == "conversion"]
    assert warc.derive(source.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(sql.ORACLES))
def test_sql(spark, duck, sf, name):
    want = duck.execute(sql.ORACLES[name])
    columns = [c[0] for c in want.description]
    got = queries.queries()[name](spark, sf).select(*columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))


CLASHES = ("found", "quality", "language", "label", "size", "h", "mark", "words", "n_words", "fp", "bits", "at", "z", "bucket", "taken", "shard", "kept", "rule", "verdict", "held_out", "key", "conv", "dropped", "block", "leaf", "pos", "path", "place", "top", "node")
TABLES = {"documents": DOC, "pages": "page_id long, url string, html string", "benchmark": "item_id long, text string", "labels": "doc_id long, quality int",
          "embeddings": "vec_id long, embedding array<float>", "conversations": "conv_id long, turn long, role string, text string"}


def _tables(spark, folder, rows):
    for name, schema in TABLES.items():
        extra = {c: F.lit(f"clash {c}") for c in CLASHES if c not in schema and not (name == "labels" and c == "quality")}
        spark.createDataFrame(rows.get(name, []), schema).withColumns(extra).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_every_query_on_empty_tables(spark, tmp_path):
    folder = _tables(spark, tmp_path, {})
    for name, query in queries.queries().items():
        assert query(spark, folder).count() == 0, name


def test_every_query_on_odd_rows(spark, tmp_path):
    long_ = "Ein sehr langer Text ohne Ende. " * 40_000
    documents = [(k, t, "en" if k % 2 else None, None if k % 3 else "s", None) for k, t in enumerate(_texts())]
    documents += [documents[0], documents[0], (None,) * 5, (None, "x y z", None, None, 3), (90, long_, "de", "s", 1), (91, "\n\n", "", "", 0), (92, "\u0000 \ud7ff é\u0301", "fr", "", 0)]
    pages = [(1, "http://a.net/x", "<p>x"), (1, "http://a.net/x", "<p>x"), (None, None, None), (2, "", ""), (3, "://", "<script>")]
    benchmark = [(1, documents[0][1]), (1, documents[0][1]), (None, None), (None, "one two"), (3, "")]
    labels = [(k, k % 2) for k in range(10)] + [(1, 1), (None, 1), (5, None), (400, 0)]
    embeddings = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [2.0, 4.0]), (None, [1.0]), (3, None), (4, []), (5, [0.0, 0.0]), (None, None)]
    conversations = [(1, 0, "user", long_), (1, 0, "user", long_), (1, None, None, None), (None, 1, "system", ""), (2, -5, "", "\n")]
    folder = _tables(spark, tmp_path, {"documents": documents, "pages": pages, "benchmark": benchmark, "labels": labels,
                                        "embeddings": embeddings, "conversations": conversations})
    n = {"op1_warc_derivatives": 2 * len(pages), "op7_blocked_bloom": len(pages), "op11_metric_range_join": len(embeddings), "op12_conversation_repair": 3}
    for name, query in queries.queries().items():
        got = query(spark, folder).collect()
        if name != "pipeline":
            assert len(got) == n.get(name, len(documents)), name
        else:
            assert {r["doc_id"] for r in got} <= {d[0] for d in documents}


def test_pipeline_keeps_its_columns(spark, docs, sf):
    import corpus_pipeline as c

    d = docs.drop("n_words").withColumn("lang", F.when(F.col("doc_id") < 8, "en"))
    for name, stage in c.STAGES[:-1]:
        out = stage(spark, d, sf)
        assert out.columns == d.columns
        d = spark.createDataFrame(out.collect(), out.schema)
    assert d.count() == d.select("doc_id").distinct().count()
    final = c.mix(spark, d, sf)
    assert final.count() == d.count()
