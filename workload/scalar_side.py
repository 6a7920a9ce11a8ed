"""Queries over the scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railloom.functions import clock, coerce, measures, text
from railloom.operators import columns, predicates
from workload.catalogue import register, rounded
from workload.views import Tables


@register(
    """SELECT event_id, CAST(regexp_extract(props, '(\\d+\\.?\\d*)', 1) AS DOUBLE) AS first_number,
      CASE event_id % 5 WHEN 0 THEN value WHEN 1 THEN CAST(user_id AS DOUBLE) WHEN 2 THEN NULL WHEN 3 THEN NULL
        ELSE -value END AS number,
      CASE event_id % 5 WHEN 1 THEN CAST(user_id AS INTEGER) WHEN 0 THEN CASE WHEN value = floor(value) THEN CAST(value AS INTEGER) END
        WHEN 4 THEN CASE WHEN value = floor(value) THEN CAST(-value AS INTEGER) END END AS whole,
      TRY_CAST(nullif(regexp_extract(event_type, '(\\d+\\.?\\d*)', 1), '') AS DOUBLE) AS no_number
    FROM events"""
)
def numeric_coercion(t: Tables) -> DataFrame:
    """Good numbers, '12.0', numbers with a letter, 'NaN', negatives."""
    v, k = F.col("value"), F.col("event_id") % 5
    raw = (
        F.when(k == 0, F.concat(F.lit(" \t"), v.cast("string"), F.lit(" ")))
        .when(k == 1, F.concat(F.col("user_id").cast("string"), F.lit(".0")))
        .when(k == 2, F.concat(v.cast("string"), F.lit("d")))
        .when(k == 3, F.lit("NaN"))
        .otherwise(F.concat(F.lit("-"), v.cast("string")))
    )
    return t.events.select(
        "event_id",
        coerce.first_number(F.col("props")).alias("first_number"),
        coerce.to_double(raw).alias("number"),
        coerce.to_int(raw).alias("whole"),
        coerce.first_number(F.col("event_type")).alias("no_number"),
    )


@register(
    """SELECT o_orderkey, o_orderkey % 7 IN (0, 1) AS truthy, o_orderkey % 4 = 1 AS one, o_orderkey % 3 = 0 AS letter
    FROM orders"""
)
def text_flags(t: Tables) -> DataFrame:
    """C8-C10."""
    k = F.col("o_orderkey")
    word = F.when(k % 7 == 0, F.lit(" OUI ")).when(k % 7 == 1, F.lit("True")).when(k % 7 == 2, F.lit("non"))
    number = F.when(k % 4 == 0, F.lit("2")).when(k % 4 == 1, F.lit(" 1.0")).when(k % 4 == 2, F.lit("x"))
    letter = F.when(k % 3 == 0, F.lit("t")).when(k % 3 == 1, F.lit("T"))
    return t.orders.select(
        "o_orderkey",
        coerce.is_truthy(word).alias("truthy"),
        coerce.is_one(number).alias("one"),
        coerce.is_letter_t(letter).alias("letter"),
    )


@register(
    """SELECT p_partkey, p_brand AS first, p_type AS last, p_name AS only FROM part"""
)
def list_ends(t: Tables) -> DataFrame:
    """C6."""
    joined = F.concat(F.lit(" "), "p_brand", F.lit(" ,"), "p_name", F.lit(", "), "p_type", F.lit(" "))
    return t.part.select(
        "p_partkey",
        text.first_of_list(joined).alias("first"),
        text.last_of_list(joined).alias("last"),
        text.first_of_list(F.col("p_name")).alias("only"),
    )


CLOCK_SQL = """WITH x AS (SELECT event_id, event_id % 40 AS h, event_id % 60 AS m,
  lpad('' || (event_id % 40), 2, '0') || ':' || lpad('' || (event_id % 60), 2, '0') AS hm FROM events)
SELECT event_id, strftime(ts, '%H:%M:%S') AS clock, CASE WHEN h < 24 THEN hm || ':00' END AS day_clock,
  CASE WHEN event_id % 2 = 0 AND h < 24 THEN hm || ':00' END AS strict_clock,
  CAST(h * 60 + m AS DOUBLE) AS minutes, CAST(event_id % 3 * 1440 + h * 60 + m AS DOUBLE) + 0.5 AS long_minutes,
  CASE h // 24 WHEN 0 THEN '' ELSE '1 day, ' END || (h % 24) || ':' || lpad('' || m, 2, '0') || ':00' AS shown
FROM x JOIN events USING (event_id)"""


@register(CLOCK_SQL)
def time_and_duration(t: Tables) -> DataFrame:
    """C11-C14, C25."""
    k = F.col("event_id")
    hm = F.concat(F.lpad((k % 40).cast("string"), 2, "0"), F.lit(":"), F.lpad((k % 60).cast("string"), 2, "0"))
    strict = F.when(k % 2 == 0, hm).otherwise(F.concat(hm, F.lit(":00")))
    long = F.concat((k % 3).cast("string"), F.lit(" days "), hm, F.lit(":30"))
    return t.events.select(
        "event_id",
        clock.time_of_day(F.date_format("ts", "HH:mm:ss")).alias("clock"),
        clock.time_of_day(hm).alias("day_clock"),
        clock.hour_minute(strict).alias("strict_clock"),
        clock.duration_minutes(hm).alias("minutes"),
        clock.duration_minutes(long).alias("long_minutes"),
        clock.interval_text(clock.duration_interval(hm)).alias("shown"),
    )


@register(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 4 THEN CAST(o_orderdate AS DATE)
      WHEN o_orderkey % 6 = 4 THEN CAST(o_orderdate AS DATE) + 1 END::DATE AS day FROM orders"""
)
def date_from_text(t: Tables) -> DataFrame:
    """Day, compact day, time stamp with and without zone, and text that is no date."""
    k, d = F.col("o_orderkey") % 6, F.col("o_orderdate")
    raw = (
        F.when(k == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(k == 1, F.date_format(d, "yyyyMMdd"))
        .when(k == 2, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
        .when(k == 3, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T23:59:59Z ")))
        .when(k == 4, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T22:00:00-03:00")))
        .otherwise(F.lit("08:30"))
    )
    return t.orders.select("o_orderkey", clock.date_from_text(raw).alias("day"))


@register(
    """SELECT s_suppkey, 'OP_' || left(md5(s_name), 8) AS operator_id, s_name || ' - ' || n AS pair,
      CASE WHEN n IS NOT NULL THEN 'OP_' || left(md5(n), 8) END AS maybe_id,
      'TR_' || left(md5(length(s_name) || ':' || s_name || '|' || coalesce(length(n) || ':' || n, '-')), 16) AS trip_id
    FROM (SELECT *, CASE WHEN s_suppkey % 2 = 0 THEN 'N' || s_nationkey END AS n FROM supplier)"""
)
def stable_ids(t: Tables) -> DataFrame:
    """C15, C18, C19, W5."""
    n = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("N"), F.col("s_nationkey").cast("string")))
    name = F.col("s_name")
    return t.supplier.select(
        "s_suppkey",
        text.stable_id(name, "OP_").alias("operator_id"),
        text.labelled_pair(name, n).alias("pair"),
        text.stable_id(n, "OP_").alias("maybe_id"),
        text.natural_key_id(name, n, prefix="TR_").alias("trip_id"),
    )


@register(
    f"""WITH x AS (SELECT c_custkey, CAST(c_nationkey AS DOUBLE) + 35.5 AS lat1, CAST(c_custkey % 90 AS DOUBLE) - 9.25 AS lon1,
        CASE WHEN c_custkey % 10 <> 9 THEN CAST(c_custkey % 45 AS DOUBLE) + 0.125 END AS lat2,
        CASE WHEN c_custkey % 10 <> 9 THEN 2.35 END AS lon2 FROM customer),
    y AS (SELECT *, pow(sin(radians(lat2 - lat1) / 2), 2)
        + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2) AS a FROM x)
    SELECT c_custkey, lat1, lon1, lat2, CAST(lon2 AS DOUBLE) AS lon2,
      {rounded('2 * 6371.0 * atan2(sqrt(a), sqrt(1 - a))', 2)} AS km FROM y"""
)
def coords_and_haversine(t: Tables) -> DataFrame:
    """Text to two doubles, then the great-circle distance; a bad half makes both NULL."""
    k = F.col("c_custkey")
    here = F.concat_ws(
        ", ",
        (F.col("c_nationkey").cast("double") + 35.5).cast("string"),
        ((k % 90).cast("double") - 9.25).cast("string"),
    )
    there = F.when(k % 10 == 9, F.lit("?, 2.35")).otherwise(
        F.concat(((k % 45).cast("double") + 0.125).cast("string"), F.lit(" ,2.35"))
    )
    points = t.customer.select(
        "c_custkey", measures.coordinates(here).alias("a"), measures.coordinates(there).alias("b")
    ).select(
        "c_custkey",
        F.col("a.lat").alias("lat1"),
        F.col("a.lon").alias("lon1"),
        F.col("b.lat").alias("lat2"),
        F.col("b.lon").alias("lon2"),
    )
    return points.withColumn(
        "km", measures.haversine_km(*[F.col(c) for c in ("lat1", "lon1", "lat2", "lon2")])
    )


@register(
    f"""WITH x AS (SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'Tgv INOUI' WHEN 1 THEN 'International ' || p_type
        WHEN 2 THEN 'INTERCITÉS de nuit' WHEN 3 THEN 'ter ' || p_brand WHEN 4 THEN p_type END AS carrier,
        CASE WHEN p_partkey % 20 = 7 THEN NULL WHEN p_partkey % 20 = 8 THEN 0 ELSE p_retailprice END AS km FROM part)
    SELECT p_partkey, carrier, CASE WHEN km > 0 THEN {rounded('''km / (CASE
        WHEN lower(carrier) LIKE '%tgv%' THEN 280.0::DOUBLE WHEN lower(carrier) LIKE '%international%' THEN 200.0::DOUBLE
        WHEN lower(carrier) LIKE '%intercités%' THEN 140.0::DOUBLE WHEN lower(carrier) LIKE '%ter%' THEN 90.0::DOUBLE
        ELSE 150.0::DOUBLE END) * 60''', 1)} END AS minutes FROM x"""
)
def estimated_duration(t: Tables) -> DataFrame:
    """The order of the words matters, NULL and non-positive distances have no duration."""
    s, k = F.col("p_size") % 6, F.col("p_partkey") % 20
    carrier = (
        F.when(s == 0, F.lit("Tgv INOUI"))
        .when(s == 1, F.concat(F.lit("International "), "p_type"))
        .when(s == 2, F.lit("INTERCITÉS de nuit"))
        .when(s == 3, F.concat(F.lit("ter "), "p_brand"))
        .when(s == 4, F.col("p_type"))
    )
    km = F.when(k == 7, F.lit(None)).when(k == 8, F.lit(0.0)).otherwise(F.col("p_retailprice"))
    rows = t.part.select("p_partkey", carrier.alias("carrier"), km.alias("km"))
    return rows.select(
        "p_partkey", "carrier", measures.estimated_minutes(F.col("carrier"), F.col("km")).alias("minutes")
    )


@register(
    f"""SELECT l_partkey, {rounded('sum(l_quantity * 10 * 0.014)', 3)} AS kg, count(*) AS n FROM lineitem GROUP BY 1"""
)
def emission_estimate(t: Tables) -> DataFrame:
    """C22, C23."""
    kg = measures.estimated_emissions(F.col("l_quantity") * 10)
    return t.lineitem.groupBy("l_partkey").agg(
        measures.round_half_up(F.sum(kg), 3).alias("kg"), F.count(F.lit(1)).alias("n")
    )


@register(
    """SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END, c_name) AS city,
      CAST(NULL AS VARCHAR) AS lang, 'fr' AS region, CASE WHEN c_custkey % 4 > 0 THEN c_acctbal END AS balance
    FROM customer WHERE c_custkey % 5 > 0 AND c_custkey % 6 > 0 AND c_custkey % 7 > 0"""
)
def fallback_and_nulls(t: Tables) -> DataFrame:
    """C20, C27, P4, P6, L1, L3, L5, L6."""
    k = F.col("c_custkey")
    entries = {
        "segment": F.when(k % 3 > 0, F.col("c_mktsegment")).otherwise(""),
        "name": F.when(k % 5 > 0, F.col("c_name")).otherwise(""),
        "short": F.when(k % 6 > 0, F.lit("x")).otherwise(" = "),
        "blank": F.when(k % 7 > 0, F.lit(" y")).otherwise("  "),
    }
    row = F.create_map(*[c for name, value in entries.items() for c in (F.lit(name), value)])
    balance = F.when(k % 4 > 0, F.col("c_acctbal")).otherwise(F.lit(float("nan")))
    maps = predicates.drop_empty_rows(
        t.customer.select("c_custkey", row.alias("row"), balance.alias("balance")), "row"
    )
    raw = maps.select("c_custkey", "balance", *[F.try_element_at("row", F.lit(c)).alias(c) for c in entries])
    rows = predicates.require(raw, ["name", "not_there"]).where(
        predicates.differs(F.col("short"), " = ") & predicates.not_blank(F.col("blank"))
    )
    return rows.select(
        "c_custkey",
        F.coalesce("segment", "name").alias("city"),
        columns.optional(rows, "agency_lang", "string").alias("lang"),
        columns.optional(rows, "region", "string", "fr").alias("region"),
        coerce.nan_to_null(F.col("balance")).alias("balance"),
    )


@register(
    f"""SELECT o_custkey, {rounded('coalesce(sum(CASE WHEN o_orderstatus = $$F$$ THEN o_totalprice END), 0)', 2)} AS total,
      {rounded('coalesce(avg(o_totalprice), 0)', 1)} AS mean FROM orders GROUP BY 1"""
)
def rounding_stats(t: Tables) -> DataFrame:
    """A11, C24."""
    return t.orders.groupBy("o_custkey").agg(
        measures.rounded_or_zero(
            F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))), 2
        ).alias("total"),
        measures.rounded_or_zero(F.avg("o_totalprice"), 1).alias("mean"),
    )


@register(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN '' ELSE (o_orderkey % 9) || ',' || (o_custkey % 9) END AS ids
    FROM orders"""
)
def id_lists(t: Tables) -> DataFrame:
    """An array written as text, and texts that are none."""
    k = F.col("o_orderkey")
    literal = F.concat(
        F.lit("{"), (k % 9).cast("string"), F.lit(", "), (F.col("o_custkey") % 9).cast("string"), F.lit("}")
    )
    raw = F.when(k % 3 < 2, literal).when(k % 2 == 0, F.lit("none"))
    ids = text.never_null_ids(text.id_list(raw))
    return t.orders.select("o_orderkey", F.array_join(ids, ",").alias("ids"))
