"""Cases for string, date/time, math, cast and null functions.

All are built-in Spark expressions (JVM, code-generated). Oracle SQL uses
DuckDB spellings for the known dialect differences: ``||`` for NULL-propagating
concat, ``ln`` for natural log, 0- vs 1-based indexing, ``dayofweek`` offset,
epoch arithmetic for whole-unit differences.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwood.functions import masks
from driftwood.plans.registry import case
from driftwood.tables import load

# ------------------------------------------------------------------ 2.9 strings


@case("str_case", """
SELECT p_partkey, upper(p_name) AS up, lower(p_type) AS low,
       array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') AS cap
FROM part""")
def str_case(spark, d):
    p = load(spark, d, "part")
    return p.select("p_partkey", F.upper("p_name").alias("up"), F.lower("p_type").alias("low"),
                    F.initcap("p_name").alias("cap"))


@case("str_length", """
SELECT doc_id, CAST(length(text) AS INT) AS len, CAST(length(lang) AS INT) AS lang_len, n_chars FROM documents""")
def str_length(spark, d):
    docs = load(spark, d, "documents")
    return docs.select("doc_id", F.length("text").alias("len"), F.char_length("lang").cast("int").alias("lang_len"),
                       "n_chars")


@case("str_substring", """
SELECT c_custkey, substring(c_name, 1, 8) AS sub, left(c_name, 3) AS l3, right(c_name, 3) AS r3,
       substring(c_mktsegment, 2) AS tail FROM customer""")
def str_substring(spark, d):
    c = load(spark, d, "customer")
    return c.select("c_custkey", F.substring("c_name", 1, 8).alias("sub"),
                    F.left("c_name", F.lit(3)).alias("l3"), F.right("c_name", F.lit(3)).alias("r3"),
                    F.expr("substr(c_mktsegment, 2)").alias("tail"))


@case("str_trim", """
WITH x AS (SELECT c_custkey, '  ' || c_mktsegment || '  ' AS padded FROM customer)
SELECT c_custkey, trim(padded) AS t, ltrim(padded) AS lt, rtrim(padded) AS rt FROM x""")
def str_trim(spark, d):
    c = load(spark, d, "customer")
    x = c.select("c_custkey", F.concat(F.lit("  "), "c_mktsegment", F.lit("  ")).alias("padded"))
    return x.select("c_custkey", F.trim("padded").alias("t"), F.ltrim("padded").alias("lt"),
                    F.rtrim("padded").alias("rt"))


@case("str_pad", """
SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS padded_id, rpad(c_mktsegment, 12, '*') AS seg
FROM customer""")
def str_pad(spark, d):
    c = load(spark, d, "customer")
    return c.select("c_custkey", F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("padded_id"),
                    F.rpad("c_mktsegment", 12, "*").alias("seg"))


@case("str_replace", "SELECT c_custkey, replace(c_name, 'Customer#', 'C-') AS short_name FROM customer")
def str_replace(spark, d):
    c = load(spark, d, "customer")
    return c.select("c_custkey", F.replace("c_name", F.lit("Customer#"), F.lit("C-")).alias("short_name"))


@case("str_translate", "SELECT p_partkey, translate(p_type, 'AEIOU', 'aeiou') AS t FROM part")
def str_translate(spark, d):
    return load(spark, d, "part").select("p_partkey", F.translate("p_type", "AEIOU", "aeiou").alias("t"))


@case("str_split", """
SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word, CAST(len(string_split(p_name, ' ')) AS INT) AS n_words
FROM part""")
def str_split(spark, d):
    p = load(spark, d, "part")
    parts = F.split("p_name", " ")
    return p.select("p_partkey", parts.getItem(0).alias("first_word"), F.size(parts).alias("n_words"))


@case("str_concat", """
SELECT c_custkey, c_name || '-' || nullif(c_mktsegment, 'BUILDING') AS label FROM customer""")
def str_concat(spark, d):
    c = load(spark, d, "customer")
    return c.select("c_custkey", F.concat("c_name", F.lit("-"),
                                          F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))).alias("label"))


@case("str_concat_ws", """
SELECT c_custkey, concat_ws('|', c_name, nullif(c_mktsegment, 'BUILDING'), CAST(c_nationkey AS VARCHAR)) AS label
FROM customer""")
def str_concat_ws(spark, d):
    c = load(spark, d, "customer")
    return c.select("c_custkey", F.concat_ws("|", "c_name", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")),
                                             F.col("c_nationkey").cast("string")).alias("label"))


@case("str_position", """
SELECT p_partkey, CAST(instr(p_name, 'ring') AS INT) AS pos_ring,
       CAST(CASE WHEN instr(substr(p_name, 3), 'e') > 0 THEN instr(substr(p_name, 3), 'e') + 2 ELSE 0 END AS INT)
       AS pos_e_from3
FROM part""")
def str_position(spark, d):
    p = load(spark, d, "part")
    return p.select("p_partkey", F.instr("p_name", "ring").alias("pos_ring"),
                    F.locate("e", "p_name", 3).alias("pos_e_from3"))


@case("str_regexp_replace", """
SELECT doc_id, regexp_replace(text, '[0-9]+', '#', 'g') AS scrubbed FROM documents""")
def str_regexp_replace(spark, d):
    docs = load(spark, d, "documents")
    return docs.select("doc_id", F.regexp_replace("text", "[0-9]+", "#").alias("scrubbed"))


@case("str_regexp_extract", """
SELECT page_id, regexp_extract(url, '^https?://([^/]+)/', 1) AS host,
       regexp_extract(url, 'page=([0-9]+)', 1) AS page_no FROM pages""")
def str_regexp_extract(spark, d):
    p = load(spark, d, "pages")
    return p.select("page_id", F.regexp_extract("url", r"^https?://([^/]+)/", 1).alias("host"),
                    F.regexp_extract("url", r"page=([0-9]+)", 1).alias("page_no"))


@case("str_repeat", "SELECT n_nationkey, repeat(n_name, 2) AS twice, reverse(n_name) AS backwards FROM nation")
def str_repeat(spark, d):
    n = load(spark, d, "nation")
    return n.select("n_nationkey", F.repeat("n_name", 2).alias("twice"), F.reverse("n_name").alias("backwards"))


EMAIL_SQL = "'user' || CAST(c_custkey AS VARCHAR) || '@' || lower(c_mktsegment) || '.example.com'"


def _email():
    return F.concat(F.lit("user"), F.col("c_custkey").cast("string"), F.lit("@"), F.lower("c_mktsegment"),
                    F.lit(".example.com"))


@case("str_mask", f"""
WITH x AS (SELECT c_custkey, {EMAIL_SQL} AS email FROM customer)
SELECT c_custkey, left(email, 2) || '***@' || string_split(email, '@')[2] AS masked_email,
       '***-' || right(lpad(CAST(c_custkey AS VARCHAR), 10, '0'), 4) AS masked_id FROM x""")
def str_mask(spark, d):
    c = load(spark, d, "customer").select("c_custkey", _email().alias("email"))
    return c.select("c_custkey", masks.mask_email("email").alias("masked_email"),
                    masks.mask_last4(F.lpad(F.col("c_custkey").cast("string"), 10, "0")).alias("masked_id"))


@case("str_sha2", "SELECT doc_id, sha256(text) AS text_sha256 FROM documents")
def str_sha2(spark, d):
    return load(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("text_sha256"))


# ------------------------------------------------------------------ 2.10 date / time

@case("dt_now", check="A")
def dt_now(spark, d):
    e = load(spark, d, "events")
    return e.select("event_id", F.current_date().alias("today"), F.current_timestamp().alias("now"),
                    F.now().alias("now2"))


@case("dt_format", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS ymd, strftime(o_orderdate, '%Y/%m') AS ym FROM orders""")
def dt_format(spark, d):
    o = load(spark, d, "orders")
    return o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("ymd"),
                    F.date_format("o_orderdate", "yyyy/MM").alias("ym"))


@case("dt_to_date", """
WITH x AS (SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS s FROM orders)
SELECT o_orderkey, CAST(strptime(s, '%d/%m/%Y') AS DATE) AS d,
       CAST(try_strptime(s || 'x', '%d/%m/%Y') AS DATE) AS bad FROM x""")
def dt_to_date(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("s"))
    return o.select("o_orderkey", F.to_date("s", "dd/MM/yyyy").alias("d"),
                    F.try_to_date(F.concat("s", F.lit("x")), "dd/MM/yyyy").alias("bad"))


@case("dt_to_timestamp", """
SELECT event_id, strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS ts_sec FROM events""")
def dt_to_timestamp(spark, d):
    e = load(spark, d, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("s"))
    return e.select("event_id", F.to_timestamp_ntz("s", F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts_sec"))


@case("dt_datediff", """
SELECT event_id, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INT) AS days_since FROM events""")
def dt_datediff(spark, d):
    e = load(spark, d, "events")
    return e.select("event_id", F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).alias("days_since"))


@case("dt_add", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) + 30 AS due, CAST(o_orderdate AS DATE) - 7 AS week_before FROM orders""")
def dt_add(spark, d):
    o = load(spark, d, "orders")
    return o.select("o_orderkey", F.date_add(F.to_date("o_orderdate"), 30).alias("due"),
                    F.date_sub(F.to_date("o_orderdate"), 7).alias("week_before"))


@case("dt_months", """
WITH x AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dd FROM orders)
SELECT o_orderkey, CAST(dd + INTERVAL 3 MONTH AS DATE) AS plus3,
       round((year(dd) - 1995) * 12 + (month(dd) - 1) +
             CASE WHEN dd = last_day(dd) AND FALSE THEN 0 ELSE (day(dd) - 1) / 31.0 END, 6) AS months_since
FROM x""")
def dt_months(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("dd"))
    return o.select("o_orderkey", F.add_months("dd", 3).alias("plus3"),
                    F.round(F.months_between("dd", F.lit("1995-01-01").cast("date")), 6).alias("months_since"))


@case("dt_parts", """
SELECT event_id, CAST(year(ts) AS INT) AS y, CAST(month(ts) AS INT) AS m, CAST(day(ts) AS INT) AS dd,
       CAST(hour(ts) AS INT) AS h, CAST(minute(ts) AS INT) AS mi, CAST(second(ts) AS INT) AS s FROM events""")
def dt_parts(spark, d):
    e = load(spark, d, "events")
    return e.select("event_id", F.year("ts").alias("y"), F.month("ts").alias("m"), F.dayofmonth("ts").alias("dd"),
                    F.hour("ts").alias("h"), F.minute("ts").alias("mi"), F.second("ts").alias("s"))


@case("dt_calendar", """
SELECT o_orderkey, CAST(dayofweek(o_orderdate) + 1 AS INT) AS dow, CAST(dayofyear(o_orderdate) AS INT) AS doy,
       CAST(weekofyear(o_orderdate) AS INT) AS woy, CAST(quarter(o_orderdate) AS INT) AS q FROM orders""")
def dt_calendar(spark, d):
    o = load(spark, d, "orders")
    return o.select("o_orderkey", F.dayofweek("o_orderdate").alias("dow"), F.dayofyear("o_orderdate").alias("doy"),
                    F.weekofyear("o_orderdate").alias("woy"), F.quarter("o_orderdate").alias("q"))


@case("dt_trunc", """
SELECT event_id, date_trunc('month', ts) AS month_start, date_trunc('hour', ts) AS hour_start,
       CAST(date_trunc('month', CAST(ts AS DATE)) AS DATE) AS month_date FROM events""")
def dt_trunc(spark, d):
    e = load(spark, d, "events")
    return e.select("event_id", F.date_trunc("month", "ts").cast("timestamp_ntz").alias("month_start"),
                    F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_start"),
                    F.trunc(F.to_date("ts"), "MM").alias("month_date"))


@case("dt_unix", """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s,
       strftime(make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS back FROM events""")
def dt_unix(spark, d):
    e = load(spark, d, "events").select("event_id", F.unix_timestamp("ts").alias("epoch_s"))
    return e.select("event_id", "epoch_s", F.from_unixtime("epoch_s").alias("back"))


@case("dt_last_next", """
WITH x AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dd FROM orders)
SELECT o_orderkey, last_day(dd) AS month_end,
       dd + CAST(CASE WHEN (8 - isodow(dd)) % 7 = 0 THEN 7 ELSE (8 - isodow(dd)) % 7 END AS INTEGER) AS next_monday
FROM x""")
def dt_last_next(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("dd"))
    return o.select("o_orderkey", F.last_day("dd").alias("month_end"), F.next_day("dd", "Mon").alias("next_monday"))


@case("dt_diff_unit", """
SELECT event_id, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 1000000 AS secs,
       (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 60000000 AS mins,
       (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 3600000000 AS hrs FROM events""")
def dt_diff_unit(spark, d):
    e = load(spark, d, "events")
    t0 = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return e.select("event_id", F.timestamp_diff("SECOND", t0, F.col("ts")).alias("secs"),
                    F.timestamp_diff("MINUTE", t0, F.col("ts")).alias("mins"),
                    F.timestamp_diff("HOUR", t0, F.col("ts")).alias("hrs"))


@case("dt_millis", "SELECT event_id, epoch_ms(epoch_us(ts) // 1000) AS ts_ms FROM events")
def dt_millis(spark, d):
    e = load(spark, d, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return e.select("event_id", F.timestamp_millis("ms").cast("timestamp_ntz").alias("ts_ms"))


@case("dt_interval", """
SELECT event_id, ts + INTERVAL 7 DAY AS week_later, ts - INTERVAL 1 HOUR AS hour_before,
       ts + INTERVAL 90 MINUTE AS later_90m FROM events""")
def dt_interval(spark, d):
    e = load(spark, d, "events")
    return e.select("event_id", (F.col("ts") + F.expr("INTERVAL 7 DAYS")).alias("week_later"),
                    (F.col("ts") - F.expr("INTERVAL 1 HOUR")).alias("hour_before"),
                    (F.col("ts") + F.make_dt_interval(mins=F.lit(90))).alias("later_90m"))


# ------------------------------------------------------------------ 2.11 math, cast, null

@case("math_basic", """
SELECT event_id, abs(value - 50) AS dist, sqrt(value) AS root, pow(value, 2) AS sq, round(exp(value / 100), 6) AS e
FROM events""")
def math_basic(spark, d):
    e = load(spark, d, "events")
    return e.select("event_id", F.abs(F.col("value") - 50).alias("dist"), F.sqrt("value").alias("root"),
                    F.pow("value", 2).alias("sq"), F.round(F.exp(F.col("value") / 100), 6).alias("e"))


@case("math_round", """
SELECT l_orderkey, l_linenumber,
       CAST(round(CAST(CAST(l_extendedprice * l_discount AS VARCHAR) AS DECIMAL(38, 16)), 2) AS DOUBLE) AS disc_amt,
       CAST(round(CAST(l_extendedprice AS DECIMAL(18, 2)), -2) AS DOUBLE) AS hundreds FROM lineitem""")
def math_round(spark, d):
    li = load(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") * F.col("l_discount"), 2).alias("disc_amt"),
                     F.round("l_extendedprice", -2).alias("hundreds"))


@case("math_ceil_floor", """
SELECT event_id, CAST(ceil(value) AS BIGINT) AS up, CAST(floor(value) AS BIGINT) AS down FROM events""")
def math_ceil_floor(spark, d):
    e = load(spark, d, "events")
    return e.select("event_id", F.ceil("value").alias("up"), F.floor("value").alias("down"))


@case("math_log", "SELECT event_id, round(ln(value + 1), 6) AS ln_value, round(log10(value + 1), 6) AS log10_value FROM events")
def math_log(spark, d):
    e = load(spark, d, "events")
    return e.select("event_id", F.round(F.log(F.col("value") + 1), 6).alias("ln_value"),
                    F.round(F.log10(F.col("value") + 1), 6).alias("log10_value"))


@case("math_extremes", """
SELECT l_orderkey, l_linenumber, greatest(l_tax, nullif(l_discount, 0.0)) AS hi, least(l_tax, nullif(l_discount, 0.0)) AS lo
FROM lineitem""")
def math_extremes(spark, d):
    li = load(spark, d, "lineitem")
    disc = F.nullif(F.col("l_discount"), F.lit(0.0))
    return li.select("l_orderkey", "l_linenumber", F.greatest("l_tax", disc).alias("hi"),
                     F.least("l_tax", disc).alias("lo"))


@case("cast_numeric", """
SELECT c_custkey, CAST(trunc(c_acctbal) AS INTEGER) AS bal_int, CAST(c_nationkey AS DOUBLE) AS nation_dbl,
       CAST(c_acctbal AS VARCHAR) AS bal_str, TRY_CAST(c_mktsegment AS INTEGER) AS seg_int FROM customer""")
def cast_numeric(spark, d):
    c = load(spark, d, "customer")
    return c.select("c_custkey", F.col("c_acctbal").cast("int").alias("bal_int"),
                    F.col("c_nationkey").cast("double").alias("nation_dbl"),
                    F.col("c_acctbal").cast("string").alias("bal_str"),
                    F.col("c_mktsegment").try_cast("int").alias("seg_int"))


@case("cast_temporal", """
SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS d,
       CAST(strftime(o_orderdate, '%Y-%m-%d') || ' 12:30:00' AS TIMESTAMP) AS noon FROM orders""")
def cast_temporal(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("s"))
    return o.select("o_orderkey", F.col("s").cast("date").alias("d"),
                    F.concat("s", F.lit(" 12:30:00")).cast("timestamp_ntz").alias("noon"))


@case("cast_decimal", """
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(10, 2)) AS VARCHAR) AS price_dec,
       CAST(o_custkey AS BIGINT) AS cust_long FROM orders""")
def cast_decimal(spark, d):
    o = load(spark, d, "orders")
    return o.select("o_orderkey", F.col("o_totalprice").cast("decimal(10,2)").cast("string").alias("price_dec"),
                    F.col("o_custkey").cast("long").alias("cust_long"))


NULLY_SQL = """SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS seg,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS bal, c_name FROM customer"""


def _nully(spark, d):
    c = load(spark, d, "customer")
    return c.select("c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("seg"),
                    F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("bal"), "c_name")


@case("null_coalesce", f"""
WITH x AS ({NULLY_SQL}) SELECT c_custkey, coalesce(seg, 'UNKNOWN') AS seg, coalesce(bal, 0.0) AS bal FROM x""")
def null_coalesce(spark, d):
    x = _nully(spark, d)
    return x.select("c_custkey", F.coalesce("seg", F.lit("UNKNOWN")).alias("seg"),
                    F.coalesce("bal", F.lit(0.0)).alias("bal"))


@case("null_branches", f"""
WITH x AS ({NULLY_SQL})
SELECT c_custkey, coalesce(seg, 'NONE') AS nvl_seg, CASE WHEN bal IS NOT NULL THEN 'has' ELSE 'none' END AS nvl2_bal,
       nullif(c_custkey % 3, 0) AS nullif_mod FROM x""")
def null_branches(spark, d):
    x = _nully(spark, d)
    return x.select("c_custkey", F.nvl("seg", F.lit("NONE")).alias("nvl_seg"),
                    F.nvl2("bal", F.lit("has"), F.lit("none")).alias("nvl2_bal"),
                    F.nullif(F.col("c_custkey") % 3, F.lit(0)).alias("nullif_mod"))


@case("null_drop", f"""
WITH x AS ({NULLY_SQL}) SELECT * FROM x WHERE seg IS NOT NULL AND bal IS NOT NULL""")
def null_drop(spark, d):
    x = _nully(spark, d)
    return x.dropna(subset=["seg", "bal"]).dropna(how="all")


@case("null_fill", f"""
WITH x AS ({NULLY_SQL}) SELECT c_custkey, coalesce(seg, 'UNKNOWN') AS seg, coalesce(bal, 0.0) AS bal, c_name FROM x""")
def null_fill(spark, d):
    x = _nully(spark, d)
    return x.fillna({"seg": "UNKNOWN", "bal": 0.0})


@case("literal", """
SELECT c_custkey, 'v1' AS source_system, 1 AS batch_no, true AS is_active, NULL::VARCHAR AS note FROM customer""")
def literal(spark, d):
    c = load(spark, d, "customer")
    return c.select("c_custkey", F.lit("v1").alias("source_system"), F.lit(1).alias("batch_no"),
                    F.lit(True).alias("is_active"), F.lit(None).cast("string").alias("note"))


@case("provenance", check="A")
def provenance(spark, d):
    o = load(spark, d, "orders")
    return o.select("o_orderkey", F.spark_partition_id().alias("partition_id"),
                    F.col("_metadata.file_path").alias("file_path"), F.input_file_name().alias("input_file"))


@case("rand", check="A")
def rand(spark, d):
    o = load(spark, d, "orders")
    return o.select("o_orderkey", (F.rand(seed=7) * 10).cast("int").alias("salt"))
