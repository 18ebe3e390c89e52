"""Feeds derived by Spark from the driver tables.

The driver's star schema stands in for the flight feed: supplier = airline,
its nation = origin airport, the customer's nation = destination airport,
part = aircraft, one lineitem = one flight snapshot. Every view below is a
plain DataFrame plan over the whole tables, so its work grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.timefmt import epoch_seconds
from contrail.operators.dims import bounded_broadcast, is_bounded, planned_bytes
from contrail.session import table_path

# Latest snapshot first, then enough attributes to make the order total:
# a few ids repeat even on the same extraction time.
FLIGHT_TIE_BREAK = ("aircraft_model", "airline_name", "historical_flighttime", "on_ground",
                    "destination_airport_iata", "status_text")


def flight_dedup_order() -> list[Column]:
    # Flight times order as numbers, also where a feed holds them as text.
    tie = [F.col(c).try_cast("bigint") if c == "historical_flighttime" else F.col(c) for c in FLIGHT_TIE_BREAK]
    return [F.col("extract_ts").desc_nulls_last()] + [c.asc_nulls_last() for c in tie]


# Declared schemas of the driver tables: reading under them skips Parquet
# footer inference on every query plan and pins the types (timestamps are NTZ).
TABLE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
                "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    r = spark.read.schema(TABLE_SCHEMAS[name]) if name in TABLE_SCHEMAS else spark.read
    return r.parquet(table_path(sf_dir, name))


def spread(df: DataFrame) -> DataFrame:
    """A table no larger than one scan split, dealt over the cores: the test tables are single row groups, which
    one task would read and derive the whole feed from. Larger tables are left as they are."""
    split = df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if planned_bytes(df) <= split else df


# The columns of a line item that the feeds are derived from.
LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
# Bytes of a table whose rows one task derives a feed from: under a million line items, which sort in memory.
TASK_BYTES = 16 << 20


def dealt(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Narrow ``rows`` made from ``table``, one for one, dealt over tasks in number as the table is large, whatever the
    scan's splits and the shuffles before it: what is derived from them and sorted is then of one size in any task. Rows
    go by all their values, so no key is hot. A table no larger than one scan split is left as it is."""
    size = planned_bytes(table)
    if size <= table.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes():
        return rows
    return rows.repartition(max(-(-size // TASK_BYTES), rows.sparkSession.sparkContext.defaultParallelism), *rows.columns)


def _s(c: Column) -> Column:
    return c.cast("string")


def _airport(nation: DataFrame, prefix: str, blank_lat_nation: int | None = None, hub_nation: int | None = None
             ) -> DataFrame:
    """Airport attributes per nation key (one airport per country; flights of
    ``hub_nation`` use an airport of their own, which then has one side only)."""
    nk = F.col("n_nationkey")
    code = F.concat(F.lit("AP"), _s(nk))
    if hub_nation is not None:
        code = F.when(nk == hub_nation, F.lit("HUB")).otherwise(code)
    lat = _s((nk * 7) % 120 - 60)
    if blank_lat_nation is not None:
        lat = F.when(nk == blank_lat_nation, F.lit("")).otherwise(lat)
    return nation.select(
        nk.alias(f"{prefix}_nationkey"),
        F.col("n_name").alias(f"{prefix}_airport_country_name"),
        F.concat(F.lit("C"), _s(nk)).alias(f"{prefix}_airport_country_code"),
        code.alias(f"{prefix}_airport_iata"),
        F.concat(F.lit("Airport "), F.col("n_name")).alias(f"{prefix}_airport_name"),
        lat.alias(f"{prefix}_airport_latitude"),
        _s((nk * 37) % 360 - 180).alias(f"{prefix}_airport_longitude"),
    )


def flight_view(spark: SparkSession, sf_dir: str, for_sort: bool = False) -> DataFrame:
    """One row per flight snapshot, shaped like the detail feed, with its dirt: 'N/A',
    blank and NULL airline codes, NULL destinations, models, flight times and
    scheduled arrivals, and airports that only flights in or only flights out use.
    A snapshot is taken ninety and a half days before arrival.

    Plan shape: lineitem joins orders (with the customer's nation), supplier and part
    on their keys, with the few numbers it needs. Only then do nation's attributes (25 rows,
    checked) and everything derived join, so no shuffle below carries them. ``for_sort`` deals the
    narrow rows over tasks by size before, so that a sort of the wide ones stays in memory; a reader
    that streams them needs no shuffle for that. The supplier, part and customer dimensions carry a
    broadcast hint only when a bounded count proves them small, so the fact
    side always streams: without the hint the planner may broadcast the
    *fact* (its static size estimate can look small) and stream a one-task
    dimension scan, serialising all row work into one task. Past the bound
    the joins are shuffle joins chosen by Catalyst + AQE.
    """
    nation = read(spark, sf_dir, "nation")
    origin = bounded_broadcast(_airport(nation, "origin", hub_nation=3), bound_by=nation)
    dest = bounded_broadcast(_airport(nation, "destination", blank_lat_nation=13), bound_by=nation)

    supplier = read(spark, sf_dir, "supplier")
    airline = bounded_broadcast(supplier.select("s_suppkey", "s_name", "s_nationkey"), bound_by=supplier)
    cust = read(spark, sf_dir, "customer")
    customer = bounded_broadcast(cust.select("c_custkey", "c_nationkey"), bound_by=cust)
    orders = (read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
              .join(customer, F.col("o_custkey") == F.col("c_custkey")))
    parts = read(spark, sf_dir, "part")
    part = bounded_broadcast(parts.select(
        "p_partkey", F.when(F.col("p_partkey") % 101 != 0, F.concat("p_type", F.lit(" "), "p_name")).alias("aircraft_model")),
        bound_by=parts)
    table = read(spark, sf_dir, "lineitem")
    li = spread(table).select(*LINE_COLUMNS)

    suppkey, unknown = F.col("s_suppkey"), F.col("c_custkey") % 97 == 0
    j = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey", "o_custkey")
    # A dimension that is not broadcast shuffles the rows: those come first.
    sides = [(supplier, airline, F.col("l_suppkey") == suppkey), (parts, part, F.col("l_partkey") == F.col("p_partkey"))]
    for bound_by, side, on in sides:
        j = j if is_bounded(bound_by) else j.join(side, on)
    j = dealt(j, table) if for_sort else j
    for bound_by, side, on in sides:
        j = j.join(side, on) if is_bounded(bound_by) else j
    j = (j.join(origin, F.col("s_nationkey") == F.col("origin_nationkey"))
         .join(dest, F.col("c_nationkey") == F.col("destination_nationkey"))
         .withColumns({
             "airline_icao": F.when(suppkey % 17 == 0, F.lit("N/A"))
                              .when(suppkey % 19 == 0, F.lit(None).cast("string"))
                              .when(suppkey % 23 == 0, F.lit(""))
                              .otherwise(F.concat(F.lit("S"), _s(suppkey))),
             "airline_name": F.col("s_name"),
             "airline_iata": F.concat(F.lit("A"), _s(suppkey % 36)),
             "destination_airport_iata": F.when(~unknown, F.col("destination_airport_iata"))}))

    ln = F.col("l_linenumber")
    ship = F.col("l_shipdate")
    return j.select(
        F.concat(_s(F.col("l_orderkey")), F.lit("-"), _s(ln)).alias("id"),
        "airline_icao", "airline_name", "airline_iata",
        "origin_airport_country_name", "origin_airport_country_code", "origin_airport_iata",
        "origin_airport_name", "origin_airport_latitude", "origin_airport_longitude",
        "destination_airport_country_name", "destination_airport_country_code", "destination_airport_iata",
        "destination_airport_name", "destination_airport_latitude", "destination_airport_longitude",
        "aircraft_model",
        _s((F.col("l_partkey") * 7) % 120 - 60).alias("latitude"),
        _s((F.col("l_partkey") * 37) % 360 - 180).alias("longitude"),
        F.when(F.col("l_linestatus") == "F", F.lit("1")).otherwise(F.lit("0")).alias("on_ground"),
        F.when(F.col("l_returnflag") == "R", F.lit("Landed 10:00"))
         .when(F.col("l_returnflag") == "A", F.lit("Estimated 11:00"))
         .when(ln == 7, F.lit(None).cast("string"))
         .otherwise(F.lit("Scheduled")).alias("status_text"),
        F.when(F.col("l_orderkey") % 59 != 0, (F.col("l_quantity") * 3600).cast("bigint")).alias("historical_flighttime"),
        F.when(F.col("l_orderkey") % 53 != 0, ship).alias("scheduled_time_arrival"),
        F.when(ln % 3 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(ship + F.expr("INTERVAL 2 HOURS")).alias("estimated_arrival"),
        (ship - F.expr("INTERVAL 90 DAYS") - F.expr("INTERVAL 12 HOURS")).alias("extract_ts"),
    )


# The eight leaves lifted out of ``time_details`` and their names.
TIME_DETAIL_LEAVES = {
    "scheduled.departure": "scheduled_time_departure",
    "real.departure": "real_time_departure",
    "scheduled.arrival": "scheduled_time_arrival",
    "estimated.arrival": "estimated_arrival",
    "historical.flighttime": "historical_flighttime",
    "historical.delay": "historical_delay",
    "other.updated": "time_updated",
    "other.eta": "time_eta",
}
# The columns holding epoch seconds as text after the lift.
EPOCH_TEXT_COLUMNS = ["estimated_arrival", "time_updated", "time_eta", "real_time_departure",
                      "scheduled_time_arrival", "scheduled_time_departure", "time"]


# A number no calendar holds, as a broken record would have it.
HUGE_EPOCH = "99999999999999999"


def detail_view(spark: SparkSession, sf_dir: str, for_sort: bool = False) -> DataFrame:
    """The raw detail feed: times as epoch text inside a nested ``time_details``
    struct, a ``time`` column, a sparse ``squawk`` and a bounded
    ``aircraft_history`` array (0-3 past legs, NULL for line 7).

    Every value is derived per row, so no grouping is needed to build it.
    """
    f = flight_view(spark, sf_dir, for_sort).withColumns({
        "_ln": F.split("id", "-")[1].cast("int"), "_arr_s": epoch_seconds("scheduled_time_arrival")})
    arr_s = F.col("_arr_s")
    dep_s = arr_s - F.col("historical_flighttime")
    upd_s = epoch_seconds("extract_ts")
    est_s = epoch_seconds("estimated_arrival")
    blank_every_7 = F.col("_ln") == 7
    time_details = F.struct(
        F.struct(_s(est_s).alias("arrival"), _s(est_s - F.col("historical_flighttime")).alias("departure"))
         .alias("estimated"),
        F.struct(_s(F.col("historical_flighttime")).alias("flighttime"),
                 _s(F.when(F.col("estimated_arrival").isNull(), F.lit(0)).otherwise(F.lit(7200))).alias("delay"))
         .alias("historical"),
        F.struct(_s(upd_s).alias("updated"), _s(F.coalesce(est_s, arr_s)).alias("eta")).alias("other"),
        F.struct(F.lit(None).cast("string").alias("arrival"),
                 F.when(blank_every_7, F.lit("")).when(F.col("_ln") == 6, F.lit(HUGE_EPOCH)).otherwise(_s(dep_s))
                  .alias("departure")).alias("real"),
        F.struct(_s(arr_s).alias("arrival"), _s(dep_s).alias("departure")).alias("scheduled"),
    )
    return f.select(
        *[c for c in f.columns if c not in ("scheduled_time_arrival", "estimated_arrival", "historical_flighttime",
                                            "extract_ts") and not c.startswith("_")],
        F.when(blank_every_7, F.lit("x")).otherwise(F.lit(None).cast("string")).alias("squawk"),
        _s(upd_s).alias("time"),
        time_details.alias("time_details"),
        history_array().alias("aircraft_history"),
        "extract_ts",
    )


def detail_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail feed as landed: ``detail_view`` with a time zone for the origin and a trail of two fixes on even lines.
    Declared fields that a record lacks are simply not in its JSON."""
    zone = bounded_broadcast(nation_zones(spark, sf_dir).select(
        F.col("country").alias("origin_airport_country_name"), F.col("zone").alias("origin_airport_timezone_name")))
    fix = [F.struct(F.col("longitude").alias("lng"), F.lit(str(k)).alias("alt"), F.col("latitude").alias("lat"),
                    F.col("time").alias("ts")) for k in (1, 2)]
    even = F.split("id", "-")[1].cast("int") % 2 == 0
    return (detail_view(spark, sf_dir).drop("extract_ts").join(zone, "origin_airport_country_name", "left")
            .withColumn("trail", F.when(even, F.array(*fix))))


def nation_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """country -> time zone: named after the region, for every fifth nation below 'America/'; one nation has none."""
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    home = F.concat(F.initcap("r_name"), F.lit("/"), F.col("n_name"))
    zone = F.when(F.col("n_nationkey") % 5 == 0, F.concat(F.lit("America/"), home)).otherwise(home)
    return (nation.join(bounded_broadcast(region), nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_name").alias("country"), F.when(F.col("n_nationkey") != 9, zone).alias("zone")))


def zone_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """prefix -> continent for ``nation_zones``: each region's own, and a longer one below 'America/'."""
    region = read(spark, sf_dir, "region")
    word = F.initcap("r_name")
    return region.select(F.explode(F.array(word, F.concat(F.lit("America/"), word))).alias("prefix"),
                         F.col("r_name").alias("continent"))


def _airport_sql(side: str, k: int) -> str:
    """One end of a past leg with the 19 leaves of the feed, as a SQL struct."""
    a = f"{side}_airport"
    return (f"named_struct('website', concat('https://', {a}_iata, '.example'), 'visible', 'true', "
            f"'code', named_struct('iata', {a}_iata, 'icao', concat('I', {a}_iata)), "
            f"'timezone', named_struct('offset', '{k * 3600}', 'offsetHours', '{k}:00', 'isDst', 'false', "
            f"'abbrName', 'Universal Time', 'name', 'UTC', 'abbr', 'UTC'), "
            f"'name', {a}_name, "
            f"'position', named_struct('country', named_struct('name', {a}_country_name, "
            f"'codeLong', concat('X', {a}_country_code), 'code', {a}_country_code, 'id', substring({a}_country_code, 2)), "
            f"'altitude', '{k * 100}', 'region', named_struct('city', concat('City ', {a}_iata)), "
            f"'latitude', {a}_latitude, 'longitude', {a}_longitude))")


def _leg_sql(k: int) -> str:
    """Past leg number ``k`` of a flight's aircraft, as one SQL struct expression."""
    # Legs alternate direction: odd legs fly the route backwards.
    first, second = ("destination", "origin") if k % 2 else ("origin", "destination")
    return (f"named_struct('identification', named_struct("
            f"'number', named_struct('default', concat(airline_iata, CAST(_ln * 100 + {k} AS STRING))), "
            f"'id', concat(id, '#{k}')), "
            f"'time', named_struct('real', named_struct('departure', CAST(_arr_s - {k * 86400} AS STRING))), "
            f"'airport', named_struct('destination', {_airport_sql(second, k)}, 'origin', {_airport_sql(first, k)}))")


def history_array() -> Column:
    """0-3 past legs per flight (NULL for line 7); needs ``_ln`` and ``_arr_s``."""
    # Legs past the slice are not built, and whether there is a history shows without building any.
    legs = ", ".join(f"IF(_ln % 4 >= {k}, {_leg_sql(k)}, NULL)" for k in (1, 2, 3))
    return F.expr(f"CASE WHEN _ln = 7 OR _ln IS NULL THEN NULL ELSE slice(array({legs}), 1, coalesce(_ln % 4, 0)) END")


def airline_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The airline feed: suppliers under the feed's column names."""
    key = _s(F.col("s_suppkey"))
    return read(spark, sf_dir, "supplier").select(
        F.concat(F.lit("A"), key).alias("Code"), F.concat(F.lit("S"), key).alias("ICAO"), F.col("s_name").alias("Name"))


def airport_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The airport feed: one airport per customer city, under the feed's column names."""
    key = F.col("c_custkey")
    return read(spark, sf_dir, "customer").select(
        _s(key % 3000).alias("altitude"), _s(F.col("c_nationkey")).alias("country"), F.concat(F.lit("AP"), _s(key)).alias("iata"),
        F.concat(F.lit("IAP"), _s(key)).alias("icao"), _s(key * 7 % 120 - 60).alias("latitude"),
        _s(key * 37 % 360 - 180).alias("longitude"), F.col("c_name").alias("name"))


def position_feed(spark: SparkSession, sf_dir: str, for_sort: bool = False) -> DataFrame:
    """The flight position feed: one fix per line item, under the feed's 19 columns. ``for_sort`` deals the narrow
    line items over tasks first, so that a sort of the wide fixes stays in memory."""
    order, line, part, supp = (F.col(f"l_{c}") for c in ("orderkey", "linenumber", "partkey", "suppkey"))
    air = _s(supp)
    table = read(spark, sf_dir, "lineitem")
    lines = dealt(spread(table).select(*LINE_COLUMNS), table) if for_sort else table
    return lines.select(
        F.concat(F.lit("T"), _s(part % 90)).alias("aircraft_code"), F.concat(F.lit("A"), _s(supp % 36)).alias("airline_iata"),
        F.concat(F.lit("S"), air).alias("airline_icao"), (F.col("l_quantity") * 100).cast("int").alias("altitude"),
        F.concat(F.lit("S"), air, F.lit("-"), _s(line)).alias("callsign"), F.concat(F.lit("AP"), _s(part % 25)).alias("destination_airport_iata"),
        (part % 500).cast("int").alias("ground_speed"), (part % 360).cast("int").alias("heading"), _s(part).alias("icao_24bit"),
        F.concat(_s(order), F.lit("-"), _s(line)).alias("id"), ((part * 7) % 120 - 60).cast("double").alias("latitude"),
        ((part * 37) % 360 - 180).cast("double").alias("longitude"), _s(order).alias("number"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("on_ground"), F.concat(F.lit("AP"), _s(supp % 25)).alias("origin_airport_iata"),
        F.concat(F.lit("R"), _s(part)).alias("registration"), F.when(line == 7, F.lit("x")).alias("squawk"),
        epoch_seconds("l_shipdate").cast("int").alias("time"), F.lit(0).alias("vertical_speed"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events")
