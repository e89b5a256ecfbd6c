"""The operators' inputs, derived from the star-schema test tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from skytally.operators.recommend import latest_ratings


class Tables:
    """The parquet tables of one folder, read when used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        """The table as a file stream. The pattern matches one file or one folder of files."""
        schema = getattr(self, name).schema
        return self.spark.readStream.schema(schema).parquet(f"{self.folder}/{name}.parque[t]")


_LINE_FIELDS = {
    "arr_delayed": "CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
    "dep_delayed": "CASE WHEN l_suppkey % 13 = 0 THEN NULL WHEN l_linestatus = 'O' THEN 1 ELSE 0 END",
    "arr_delay_minutes": "CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE CAST(l_quantity AS INT) END",
    "flight_date": "CAST(l_shipdate AS DATE)",
    "day_of_week": "weekday(l_shipdate) + 1",
    "dep_time": "CAST((l_partkey % 24) * 100 + (l_orderkey % 60) AS INT)",
    "arr_time": "CAST(((l_partkey + l_suppkey) % 24) * 100 + (l_orderkey % 60) AS INT)",
    "flight_id": "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)",
}
FLIGHT_FIELDS = ("origin", "dest", "airline_id", *_LINE_FIELDS)


def _with_nation(rows: DataFrame, tables: Tables, table: str, key: str, nation_key: str, by: str, name: str) -> DataFrame:
    """``rows`` with the nation ``name`` of the dimension row that their column ``by`` refers to.

    Dimension and nation are joined one after the other: the planner then knows the size of each from its files and
    broadcasts what is small, which it cannot tell of the two joined.
    """
    dimension = getattr(tables, table).select(F.col(key).alias(by), F.col(nation_key).alias("_nation"))
    nation = tables.nation.select(F.col("n_nationkey").alias("_nation"), F.col("n_name").alias(name))
    return rows.join(dimension, by).join(nation, "_nation").drop("_nation")


def flights(tables: Tables, fields: Iterable[str] = FLIGHT_FIELDS, lines: DataFrame | None = None) -> DataFrame:
    """Order lines seen as flights: from the supplier's to the customer's nation, the brand being the airline.

    Only the dimensions that the wanted fields come from are joined. ``lines`` may be a stream of order lines.
    """
    fields = list(fields)
    rows = tables.lineitem if lines is None else lines
    if "dest" in fields:
        orders = tables.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        rows = _with_nation(rows.join(orders, "l_orderkey"), tables, "customer", "c_custkey", "c_nationkey", "o_custkey", "dest")
    if "origin" in fields:
        rows = _with_nation(rows, tables, "supplier", "s_suppkey", "s_nationkey", "l_suppkey", "origin")
    if "airline_id" in fields:
        parts = tables.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("airline_id"))
        rows = rows.join(parts, "l_partkey")
    return rows.select(*[F.expr(_LINE_FIELDS[f]).alias(f) if f in _LINE_FIELDS else F.col(f) for f in fields])


def airport_list(tables: Tables) -> DataFrame:
    """Parameter list: the airports of the regions AFRICA and ASIA."""
    regions = tables.region.where(F.col("r_name").isin("AFRICA", "ASIA"))
    return tables.nation.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("origin"))


def pair_list(tables: Tables) -> DataFrame:
    """Parameter list: the airport pairs within one region."""
    first = tables.nation.select(F.col("n_name").alias("origin"), "n_regionkey")
    second = tables.nation.select(F.col("n_name").alias("dest"), "n_regionkey")
    return first.join(second, "n_regionkey").select("origin", "dest")


def one_word(rows: DataFrame, *names: str) -> DataFrame:
    """``rows`` with the airport names in these columns written without spaces, as parameter files need them."""
    return rows.withColumns({name: F.translate(name, " ", "_") for name in names})


def trip_requests(tables: Tables) -> DataFrame:
    """One request per flight: its route and date, then on to the airport that the part's number names."""
    lines = tables.lineitem.select(
        "l_orderkey", "l_suppkey", F.expr(_LINE_FIELDS["flight_date"]).alias("date1"), F.expr("l_partkey % 25").alias("_next"))
    orders = tables.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    rows = _with_nation(lines.join(orders, "l_orderkey"), tables, "customer", "c_custkey", "c_nationkey", "o_custkey", "y")
    rows = _with_nation(rows, tables, "supplier", "s_suppkey", "s_nationkey", "l_suppkey", "x")
    onward = tables.nation.select(F.col("n_nationkey").cast("bigint").alias("_next"), F.col("n_name").alias("z"))
    return rows.join(onward, "_next").select("x", "y", "z", "date1")


def links(tables: Tables) -> DataFrame:
    """Page links: each customer to the suppliers of their orders."""
    lines = tables.lineitem.select("l_orderkey", F.col("l_suppkey").alias("dst"))
    orders = tables.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("src"))
    return lines.join(orders, "l_orderkey").select("src", "dst").distinct()


def league(tables: Tables) -> DataFrame:
    """Listed pages: all customer ids, of which those without an order do not occur in the links."""
    return tables.customer.select(F.col("c_custkey").alias("id"))


def adjacency_lines(tables: Tables) -> DataFrame:
    """``order: part supplier`` lines, one per order line."""
    return tables.lineitem.select(F.format_string("%d: %d %d", "l_orderkey", "l_partkey", "l_suppkey").alias("value"))


def _node(kind: int, column: str):
    return F.col(column).cast("bigint") * 5 + kind


def territory_edges(tables: Tables) -> DataFrame:
    """Orders -> customers -> nations -> regions, and suppliers -> nations, with ids that do not overlap."""
    edge = lambda df, src, dst: df.select(src.alias("src"), dst.alias("dst"))
    return (
        edge(tables.orders, _node(4, "o_orderkey"), _node(3, "o_custkey"))
        .union(edge(tables.customer, _node(3, "c_custkey"), _node(1, "c_nationkey")))
        .union(edge(tables.supplier, _node(2, "s_suppkey"), _node(1, "s_nationkey")))
        .union(edge(tables.nation, _node(1, "n_nationkey"), _node(0, "n_regionkey")))
    )


def part_tree(tables: Tables) -> DataFrame:
    """Directed edges from each part to the parts with twice its number."""
    return tables.part.select(F.expr("p_partkey div 2").alias("src"), F.col("p_partkey").alias("dst"))


def raw_ratings(tables: Tables) -> DataFrame:
    lines = tables.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", F.col("l_partkey").alias("movie_id"),
        F.expr("1 + CAST(l_quantity AS INT) % 5").alias("rating"))
    orders = tables.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id"))
    return lines.join(orders, "l_orderkey")


def ratings(tables: Tables) -> DataFrame:
    """The last rating of each customer for each part ordered."""
    rows = raw_ratings(tables)
    return latest_ratings(rows, "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "rating")


def movies(tables: Tables) -> DataFrame:
    return tables.part.select(
        F.col("p_partkey").alias("movie_id"), F.col("p_name").alias("title"), F.col("p_type").alias("genres"))


def document_lines(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("text").alias("value"))


def stop_words(tables: Tables) -> DataFrame:
    """Parameter list: the words of all benchmark items."""
    return tables.benchmark.select(F.explode(F.split(F.lower("text"), r"[\s.,]+")).alias("word")).where("word <> ''")


def sensor_lines(events: DataFrame) -> DataFrame:
    """``time sensor value`` lines; values run from -150 to 340."""
    ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    value = (F.floor("value").cast("int") - 150).cast("string")
    return events.select(F.concat_ws(" ", ts, "event_type", value, F.lit("")).alias("value"))


def change_log(tables: Tables, events: DataFrame | None = None) -> DataFrame:
    op = F.expr("CASE event_type WHEN 'signup' THEN 'CREATE' WHEN 'error' THEN 'DELETE' WHEN 'view' THEN 'READ' "
                "ELSE 'UPDATE' END")
    return (tables.events if events is None else events).select(
        F.col("user_id").alias("key"), F.col("event_id").alias("seq"), op.alias("op"), "value")


def replicas(tables: Tables) -> DataFrame:
    """Three copies per customer; some are altered and some missing (NULL)."""
    copies = tables.customer.select(
        F.col("c_custkey").alias("key"), "c_acctbal", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("r"))
    value = F.expr("CASE WHEN (key + r) % 7 = 0 THEN NULL WHEN (key + r) % 5 = 0 THEN c_acctbal + 1 + r "
                   "ELSE c_acctbal END")
    return copies.select("key", "r", value.alias("value"))


def _hours(ts: str):
    """Hours since 1970 by the wall clock, whatever the session's time zone."""
    return (F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")) * 24 + F.hour(ts)).cast("bigint")


def heartbeats(events: DataFrame) -> DataFrame:
    """One heartbeat per event; a tick is an hour."""
    hour = _hours("ts")
    return events.select(F.col("user_id").alias("member"), F.col("event_id").alias("heartbeat"), hour.alias("tick"))


def membership_lines(tables: Tables) -> DataFrame:
    """Log lines of users about the nodes that their event properties name."""
    hour = _hours("ts")
    node = F.get_json_object("props", "$.k")
    own = F.concat(F.col("user_id"), F.lit(".0.0.0:0 ["), hour, F.lit("] Node "))
    other = lambda action: F.concat(own, node, F.lit(f".0.0.0:0 {action} at time "), hour)
    line = (
        F.when(F.col("event_type") == "signup", F.concat(own, F.lit("failed at time = "), hour))
        .when(F.col("event_type") == "error", other("removed"))
        .when(F.col("event_type") == "view", F.concat(F.col("user_id"), F.lit(".0.0.0:0 [1] Trying to join...")))
        .otherwise(other("joined"))
    )
    return tables.events.select(line.alias("value"))


def ring_nodes(tables: Tables) -> DataFrame:
    return tables.nation.select(F.col("n_name").alias("node"))


def ring_keys(tables: Tables) -> DataFrame:
    return tables.customer.select(F.col("c_custkey").alias("key"))


def cells(tables: Tables) -> DataFrame:
    """Two cells per event: its user's row, its type's family, qualifiers ``k`` and ``value``."""
    events = tables.events
    cell = lambda name, value: F.struct(F.lit(name).alias("qualifier"), value.cast("string").alias("value"))
    both = F.array(cell("k", F.get_json_object("props", "$.k")), cell("value", F.floor("value")))
    return events.select(
        F.format_string("row%05d", "user_id").alias("row_key"), F.col("event_type").alias("family"),
        F.col("event_id").alias("seq"), F.inline(both))


def part_features(tables: Tables) -> DataFrame:
    """Per part: its size and price, and the mean quantity and discount it is ordered with."""
    orders = tables.lineitem.groupBy("l_partkey").agg(
        F.avg("l_quantity").alias("quantity"), F.avg("l_discount").alias("discount"))
    return tables.part.join(orders, F.col("p_partkey") == F.col("l_partkey")).select(
        F.col("p_partkey").alias("part"), F.col("p_name").alias("title"), F.col("p_size").cast("double").alias("size"),
        F.col("p_retailprice").alias("price"), "quantity", "discount",
        (F.col("p_size") > 25).cast("double").alias("label"))
