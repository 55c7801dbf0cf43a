"""Cases for arrays, maps, structs and JSON.

Arrays are built from the fact table (one array per order), so every case
grows with the data. Results that are arrays are rendered with
``array_join`` over sorted or positional elements to give both engines the
same flat value.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwood.functions import nested
from driftwood.plans.registry import case
from driftwood.tables import load

# one row per order: sorted part keys, line numbers in line order, flags
ARR_SQL = """WITH a AS (
  SELECT l_orderkey AS o, list_sort(list(l_partkey)) AS parts, list(l_linenumber ORDER BY l_linenumber, l_suppkey, l_returnflag) AS lines,
         list(l_suppkey ORDER BY l_linenumber, l_suppkey, l_returnflag) AS supps,
         list(l_returnflag ORDER BY l_linenumber, l_suppkey, l_returnflag) AS flags
  FROM lineitem GROUP BY l_orderkey)"""


def order_arrays(spark, d):
    li = load(spark, d, "lineitem")
    g = li.groupBy(F.col("l_orderkey").alias("o")).agg(
        F.sort_array(F.collect_list("l_partkey")).alias("parts"),
        F.sort_array(F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_returnflag"))).alias("__s"))
    return g.select("o", "parts", F.col("__s.l_linenumber").alias("lines"), F.col("__s.l_suppkey").alias("supps"),
                    F.col("__s.l_returnflag").alias("flags"))


def js(c):
    """Render an array as 'a,b,c'."""
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


# ------------------------------------------------------------------ 2.12 arrays

@case("arr_build", """
SELECT l_orderkey, l_linenumber, array_to_string([l_linenumber::BIGINT, l_partkey, l_suppkey], ',') AS arr FROM lineitem""")
def arr_build(spark, d):
    li = load(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", js(F.array("l_linenumber", "l_partkey", "l_suppkey")).alias("arr"))


@case("arr_access", ARR_SQL + """
SELECT o, parts[1] AS first_part, parts[-1] AS last_part, lines[2] AS second_line, parts[100] AS missing FROM a""")
def arr_access(spark, d):
    a = order_arrays(spark, d)
    return a.select("o", F.col("parts")[0].alias("first_part"), F.element_at("parts", -1).alias("last_part"),
                    F.get("lines", 1).alias("second_line"), F.try_element_at("parts", F.lit(100)).alias("missing"))


@case("arr_size", ARR_SQL + " SELECT o, CAST(len(parts) AS INT) AS n_parts, CAST(len(flags) AS INT) AS n_flags FROM a")
def arr_size(spark, d):
    a = order_arrays(spark, d)
    return a.select("o", F.size("parts").alias("n_parts"), F.array_size("flags").alias("n_flags"))


@case("arr_contains", ARR_SQL + " SELECT o, list_contains(flags, 'R') AS has_return FROM a")
def arr_contains(spark, d):
    return order_arrays(spark, d).select("o", F.array_contains("flags", "R").alias("has_return"))


@case("arr_explode", ARR_SQL + " SELECT o, unnest(parts) AS part FROM a")
def arr_explode(spark, d):
    return order_arrays(spark, d).select("o", F.explode("parts").alias("part"))


@case("arr_explode_outer", ARR_SQL + """, b AS (SELECT o, list_filter(parts, lambda x: x < 100) AS small FROM a)
SELECT o, unnest(CASE WHEN len(small) = 0 THEN [NULL::BIGINT] ELSE small END) AS part FROM b""")
def arr_explode_outer(spark, d):
    a = order_arrays(spark, d).select("o", F.filter("parts", lambda x: x < 100).alias("small"))
    return a.select("o", F.explode_outer("small").alias("part"))


@case("arr_posexplode", ARR_SQL + """
SELECT o, CAST(generate_subscripts(supps, 1) - 1 AS INT) AS pos, unnest(supps) AS supp FROM a""")
def arr_posexplode(spark, d):
    return order_arrays(spark, d).select("o", F.posexplode("supps").alias("pos", "supp"))


@case("arr_inline", "SELECT l_orderkey AS o, l_linenumber, l_quantity FROM lineitem")
def arr_inline(spark, d):
    li = load(spark, d, "lineitem")
    items = li.groupBy(F.col("l_orderkey").alias("o")).agg(
        F.collect_list(F.struct("l_linenumber", "l_quantity")).alias("items"))
    return items.select("o", F.inline("items"))


@case("arr_flatten", ARR_SQL + """
SELECT o, CAST(len(flatten([parts, supps])) AS INT) AS n,
       array_to_string(list_sort(flatten([parts, supps])), ',') AS keys FROM a""")
def arr_flatten(spark, d):
    """Nested arrays to one array, per order (groups stay bounded by the
    order's size; no customer-wide collection)."""
    a = order_arrays(spark, d)
    flat = F.flatten(F.array("parts", "supps"))
    return a.select("o", F.size(flat).alias("n"), js(F.sort_array(flat)).alias("keys"))


@case("arr_reverse", ARR_SQL + " SELECT o, array_to_string(list_reverse(lines), ',') AS rev FROM a")
def arr_reverse(spark, d):
    return order_arrays(spark, d).select("o", js(F.reverse("lines")).alias("rev"))


@case("arr_sort", ARR_SQL + """
SELECT o, array_to_string(list_sort(supps, 'DESC'), ',') AS desc_supps, array_to_string(list_sort(supps), ',') AS asc_supps
FROM a""")
def arr_sort(spark, d):
    a = order_arrays(spark, d)
    return a.select("o", js(F.sort_array("supps", asc=False)).alias("desc_supps"),
                    js(F.array_sort("supps")).alias("asc_supps"))


@case("arr_slice", ARR_SQL + " SELECT o, array_to_string(parts[1:2], ',') AS first_two FROM a")
def arr_slice(spark, d):
    return order_arrays(spark, d).select("o", js(F.slice("parts", 1, 2)).alias("first_two"))


@case("arr_distinct", ARR_SQL + " SELECT o, array_to_string(list_sort(list_distinct(flags)), ',') AS flags FROM a")
def arr_distinct(spark, d):
    return order_arrays(spark, d).select("o", js(F.array_sort(F.array_distinct("flags"))).alias("flags"))


@case("arr_setops", ARR_SQL + """
SELECT o, array_to_string(list_sort(list_distinct(list_concat(parts, supps))), ',') AS u,
       array_to_string(list_sort(list_distinct(list_intersect(parts, supps))), ',') AS i,
       array_to_string(list_sort(list_distinct(list_filter(parts, lambda x: NOT list_contains(supps, x)))), ',') AS e
FROM a""")
def arr_setops(spark, d):
    a = order_arrays(spark, d)
    return a.select("o", js(F.array_sort(F.array_union("parts", "supps"))).alias("u"),
                    js(F.array_sort(F.array_intersect("parts", "supps"))).alias("i"),
                    js(F.array_sort(F.array_except("parts", "supps"))).alias("e"))


@case("arr_join", ARR_SQL + " SELECT o, array_to_string(flags, '-') AS flag_str FROM a")
def arr_join(spark, d):
    return order_arrays(spark, d).select("o", F.array_join("flags", "-").alias("flag_str"))


@case("arr_transform", ARR_SQL + " SELECT o, array_to_string(list_transform(lines, lambda x: x * 10), ',') AS t FROM a")
def arr_transform(spark, d):
    return order_arrays(spark, d).select("o", js(F.transform("lines", lambda x: x * 10)).alias("t"))


@case("arr_filter", ARR_SQL + " SELECT o, array_to_string(list_filter(parts, lambda x: x % 2 = 0), ',') AS even FROM a")
def arr_filter(spark, d):
    return order_arrays(spark, d).select("o", js(F.filter("parts", lambda x: x % 2 == 0)).alias("even"))


@case("arr_fold", ARR_SQL + " SELECT o, CAST(list_reduce(lines, lambda acc, x: acc + x) AS INT) AS line_sum FROM a")
def arr_fold(spark, d):
    return order_arrays(spark, d).select(
        "o", F.aggregate("lines", F.lit(0), lambda acc, x: acc + x).alias("line_sum"))


@case("arr_zip", ARR_SQL + """
SELECT o, array_to_string(list_transform(range(len(lines)), lambda i: lines[i + 1] || ':' || supps[i + 1]), ',') AS z
FROM a""")
def arr_zip(spark, d):
    a = order_arrays(spark, d)
    z = F.arrays_zip("lines", "supps")
    return a.select("o", F.array_join(F.transform(z, lambda s: F.concat_ws(":", s["lines"].cast("string"),
                                                                         s["supps"].cast("string"))), ",").alias("z"))


# ------------------------------------------------------------------ 2.13 maps and structs

NR_SQL = "FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey"


@case("map_build", f"""
SELECT n.n_nationkey, MAP {{'region': r.r_name, 'nation': n.n_name}}['region'] AS region,
       CAST(cardinality(MAP {{'region': r.r_name, 'nation': n.n_name}}) AS INT) AS n_entries {NR_SQL}""")
def map_build(spark, d):
    n, r = load(spark, d, "nation"), load(spark, d, "region")
    m = F.create_map(F.lit("region"), F.col("r_name"), F.lit("nation"), F.col("n_name"))
    j = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", m.alias("m"))
    return j.select("n_nationkey", F.col("m")["region"].alias("region"), F.size("m").alias("n_entries"))


@case("map_from_arrays", """
SELECT c_custkey, map(['name', 'segment'], [c_name, c_mktsegment])['segment'] AS segment FROM customer""")
def map_from_arrays(spark, d):
    c = load(spark, d, "customer")
    m = F.map_from_arrays(F.array(F.lit("name"), F.lit("segment")), F.array("c_name", "c_mktsegment"))
    return c.select("c_custkey", m["segment"].alias("segment"))


@case("map_from_entries", """
WITH m AS (SELECT n_regionkey, map_from_entries(list(struct_pack(k := n_name, v := n_nationkey))) AS m
           FROM nation GROUP BY n_regionkey)
SELECT n_regionkey, CAST(cardinality(m) AS INT) AS n_nations, m['NATION_0'] AS nation0 FROM m""")
def map_from_entries(spark, d):
    n = load(spark, d, "nation")
    g = n.groupBy("n_regionkey").agg(F.map_from_entries(F.collect_list(F.struct("n_name", "n_nationkey"))).alias("m"))
    return g.select("n_regionkey", F.size("m").alias("n_nations"), F.element_at("m", F.lit("NATION_0")).alias("nation0"))


@case("map_lookup", """
SELECT c_custkey, map(['seg', 'nation'], [c_mktsegment, CAST(c_nationkey AS VARCHAR)])['nation'] AS nation,
       map(['seg', 'nation'], [c_mktsegment, CAST(c_nationkey AS VARCHAR)])['missing'] AS missing FROM customer""")
def map_lookup(spark, d):
    c = load(spark, d, "customer")
    m = F.create_map(F.lit("seg"), F.col("c_mktsegment"), F.lit("nation"), F.col("c_nationkey").cast("string"))
    return c.select("c_custkey", m["nation"].alias("nation"), F.element_at(m, F.lit("missing")).alias("missing"))


@case("map_parts", f"""
SELECT n.n_nationkey, array_to_string(map_keys(MAP {{'region': r.r_name, 'nation': n.n_name}}), ',') AS keys,
       array_to_string(map_values(MAP {{'region': r.r_name, 'nation': n.n_name}}), ',') AS vals,
       CAST(cardinality(MAP {{'region': r.r_name, 'nation': n.n_name}}) AS INT) AS size {NR_SQL}""")
def map_parts(spark, d):
    n, r = load(spark, d, "nation"), load(spark, d, "region")
    m = F.create_map(F.lit("region"), F.col("r_name"), F.lit("nation"), F.col("n_name"))
    j = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", m.alias("m"))
    return j.select("n_nationkey", F.array_join(F.map_keys("m"), ",").alias("keys"),
                    F.array_join(F.map_values("m"), ",").alias("vals"), F.size("m").alias("size"))


@case("map_concat", """
SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS nation, c_mktsegment AS seg, 'v2' AS version FROM customer""")
def map_concat(spark, d):
    c = load(spark, d, "customer")
    old = F.create_map(F.lit("nation"), F.col("c_nationkey").cast("string"), F.lit("version"), F.lit("v1"))
    new = F.create_map(F.lit("seg"), F.col("c_mktsegment"), F.lit("version"), F.lit("v2"))
    m = nested.map_merge_last_wins(old, new)
    return c.select("c_custkey", m["nation"].alias("nation"), m["seg"].alias("seg"), m["version"].alias("version"))


@case("map_explode", f"""
SELECT n.n_nationkey, unnest(['region', 'nation']) AS key, unnest([r.r_name, n.n_name]) AS value {NR_SQL}""")
def map_explode(spark, d):
    n, r = load(spark, d, "nation"), load(spark, d, "region")
    m = F.create_map(F.lit("region"), F.col("r_name"), F.lit("nation"), F.col("n_name"))
    j = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", m.alias("m"))
    return j.select("n_nationkey", F.explode("m").alias("key", "value"))


@case("map_filter", """
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS bal, CAST(c_nationkey AS DOUBLE) AS nation FROM customer""")
def map_filter(spark, d):
    c = load(spark, d, "customer")
    m = F.create_map(F.lit("bal"), F.col("c_acctbal"), F.lit("nation"), F.col("c_nationkey").cast("double"))
    f = F.map_filter(m, lambda k, v: (k == "nation") | (v > 0))
    return c.select("c_custkey", f["bal"].alias("bal"), f["nation"].alias("nation"))


@case("map_transform", """
SELECT c_custkey, upper(c_mktsegment) AS seg_key_value, c_nationkey + 100 AS nation_plus FROM customer""")
def map_transform(spark, d):
    c = load(spark, d, "customer")
    m = F.create_map(F.lit("seg"), F.lit(1), F.lit("nation"), F.col("c_nationkey"))
    keys = F.transform_keys(m, lambda k, v: F.upper(k))
    vals = F.transform_values(m, lambda k, v: v + 100)
    return c.select("c_custkey", F.when(keys["SEG"] == 1, F.upper("c_mktsegment")).alias("seg_key_value"),
                    vals["nation"].alias("nation_plus"))


@case("struct_build", """
SELECT o_orderkey, o_custkey AS cust, o_totalprice AS total, o_orderstatus AS status FROM orders""")
def struct_build(spark, d):
    o = load(spark, d, "orders")
    s = o.select("o_orderkey", F.struct(F.col("o_custkey").alias("cust"), F.col("o_totalprice").alias("total")).alias("s"),
                 F.named_struct(F.lit("status"), F.col("o_orderstatus")).alias("n"))
    return s.select("o_orderkey", "s.cust", "s.total", "n.status")


@case("struct_access", """
SELECT o_orderkey, o_totalprice AS total, o_orderpriority AS priority, o_custkey AS customer_id FROM orders""")
def struct_access(spark, d):
    o = load(spark, d, "orders")
    n = o.select("o_orderkey", F.struct(
        F.struct(F.col("o_totalprice").alias("total"), F.col("o_orderpriority").alias("priority")).alias("details"),
        F.struct(F.col("o_custkey").alias("id")).alias("customer")).alias("order"))
    return n.select("o_orderkey", F.col("order.details.total").alias("total"),
                    F.col("order.details.priority").alias("priority"), F.col("order.customer.id").alias("customer_id"))


@case("struct_rewrite", """
SELECT l_orderkey AS o, l_linenumber, '****' || right(CAST(l_suppkey AS VARCHAR), 2) AS supplier_ref, l_quantity,
       'MASKED' AS header_ref FROM lineitem""")
def struct_rewrite(spark, d):
    li = load(spark, d, "lineitem")
    tx = li.groupBy(F.col("l_orderkey").alias("o")).agg(
        F.struct(F.lit("H").alias("kind"), F.max("l_partkey").cast("string").alias("ref")).alias("header"),
        F.collect_list(F.struct("l_linenumber", F.col("l_suppkey").cast("string").alias("supplier_ref"),
                                "l_quantity")).alias("tenders"))
    masked = nested.rewrite_nested(
        tx, {"header.ref": lambda c: F.lit("MASKED")},
        {"tenders": {"supplier_ref": lambda c: F.concat(F.lit("****"), F.right(c, F.lit(2)))}})
    return masked.select("o", F.col("header.ref").alias("header_ref"), F.inline("tenders"))


# ------------------------------------------------------------------ 2.14 JSON and variant

NESTED_JSON_SQL = """'{"user": {"id": ' || user_id || ', "type": "' || event_type || '"}, "v": ' || value || '}'"""


def _nested_json():
    return F.concat(F.lit('{"user": {"id": '), F.col("user_id").cast("string"), F.lit(', "type": "'),
                    F.col("event_type"), F.lit('"}, "v": '), F.col("value").cast("string"), F.lit("}"))


@case("json_path", f"""
SELECT event_id, json_extract_string(props, '$.k') AS k,
       json_extract_string({NESTED_JSON_SQL}, '$.user.type') AS user_type FROM events""")
def json_path(spark, d):
    e = load(spark, d, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").alias("k"),
                    F.get_json_object(_nested_json(), "$.user.type").alias("user_type"))


@case("json_tuple", f"""
SELECT event_id, json_extract_string({NESTED_JSON_SQL}, '$.v') AS v, json_extract({NESTED_JSON_SQL}, '$.user')::VARCHAR
       IS NOT NULL AS has_user FROM events""")
def json_tuple(spark, d):
    e = load(spark, d, "events").select("event_id", _nested_json().alias("j"))
    t = e.select("event_id", F.json_tuple("j", "v", "user").alias("v", "user"))
    return t.select("event_id", "v", F.col("user").isNotNull().alias("has_user"))


@case("json_parse", f"""
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       CAST(json_extract({NESTED_JSON_SQL}, '$.user.id') AS BIGINT) AS uid FROM events""")
def json_parse(spark, d):
    e = load(spark, d, "events")
    p = e.select("event_id", F.from_json("props", "k INT").alias("p"),
                 F.from_json(_nested_json(), "user STRUCT<id: BIGINT, type: STRING>, v DOUBLE").alias("n"))
    return p.select("event_id", F.col("p.k").alias("k"), F.col("n.user.id").alias("uid"))


@case("json_write", """
SELECT event_id, CAST(to_json(struct_pack(event_id := event_id, event_type := event_type, user_id := user_id)) AS VARCHAR) AS j
FROM events""")
def json_write(spark, d):
    e = load(spark, d, "events")
    return e.select("event_id", F.to_json(F.struct("event_id", "event_type", "user_id")).alias("j"))


@case("json_schema", """
SELECT replace(replace(replace(json_group_structure(CAST(props AS JSON))::VARCHAR, '{"k":"', 'STRUCT<k: '), '"}', '>'),
       'UBIGINT', 'BIGINT') AS schema FROM events""")
def json_schema(spark, d):
    """Schema that fits every row's JSON: the per-row schemas merged by an aggregate (text that is no JSON counts as null)."""
    e = load(spark, d, "events")
    merged = F.schema_of_variant_agg(F.try_parse_json("props"))
    return e.agg(F.regexp_replace(merged, "OBJECT<", "STRUCT<").alias("schema"))


@case("json_flatten", "SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS product_id, l_quantity AS quantity, "
      "l_extendedprice AS price FROM lineitem")
def json_flatten(spark, d):
    li = load(spark, d, "lineitem")
    item = F.struct(F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("product_id"),
                    F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"))
    raw = li.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.to_json(F.struct(F.col("l_orderkey").alias("order_id"), F.collect_list(item).alias("items"))).alias("json"))
    return nested.flatten_order_items(raw, "json")


@case("variant_path", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def variant_path(spark, d):
    e = load(spark, d, "events")
    return e.select("event_id", F.expr("parse_json(props):k::int").alias("k"))


@case("variant_cast", f"""
SELECT event_id, json_extract_string({NESTED_JSON_SQL}, '$.user.type') AS user_type,
       CAST(json_extract({NESTED_JSON_SQL}, '$.user.id') AS BIGINT) AS uid FROM events""")
def variant_cast(spark, d):
    e = load(spark, d, "events").select("event_id", F.parse_json(_nested_json()).alias("v"))
    s = e.select("event_id", F.from_json(F.col("v").cast("string"), "user STRUCT<id: BIGINT, type: STRING>").alias("s"))
    return s.select("event_id", F.col("s.user.type").alias("user_type"), F.col("s.user.id").alias("uid"))
