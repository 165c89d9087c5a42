"""Registered queries of the nested-event engine, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import collections as C
from .functions import physics, sql
from .operators import histogram as H
from .operators import joins as J
from .plans import codegen, layout, passes
from .session import scratch
from .sources.datasource import entry_counts, read_trees
from .sources.events import order_events, read_events, table, write_events
from .sources.treewriter import write_trees
from .streaming import windows as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Particles of an event in SQL, and the leading pairs in the order that the structs' fields give.
_PARTICLES = """particles AS (
  SELECT l_orderkey AS event_id, l_extendedprice / 1000 AS pt, (l_discount - 0.05) * 40 AS eta, l_quantity * 0.1 AS phi,
         l_linenumber, l_partkey FROM lineitem)"""
_RANKED = f"""{_PARTICLES}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY pt DESC, eta DESC, phi DESC, l_linenumber DESC, l_partkey DESC) AS r
  FROM particles)"""
_MASSES = f"""{_RANKED}, vectors AS (
  SELECT event_id, abs(pt) * cos(phi) AS px, abs(pt) * sin(phi) AS py, abs(pt) / tan(2 * atan(exp(-eta))) AS pz FROM ranked WHERE r <= 2),
sums AS (
  SELECT event_id, count(*) AS n, sum(px) AS px, sum(py) AS py, sum(pz) AS pz,
         sum(sqrt(px * px + py * py + pz * pz + pow(0.10565836727619171, 2))) AS e FROM vectors GROUP BY event_id),
masses AS (
  SELECT event_id, sqrt(greatest(e * e - px * px - py * py - pz * pz, 0)) AS mass FROM sums WHERE n = 2)"""


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


# --- scans, projections, filters -------------------------------------------------------------------------------------


@query("SELECT count(*) AS n FROM lineitem")
def entry_count(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS n FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) = 2)")
def where_multiplicity_eq2(spark: SparkSession, d: str) -> DataFrame:
    sizes = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lep_n"))
    return sizes.where("lep_n == 2").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, count(l_orderkey) AS n_items FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey")
def nonempty_collection(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "orders").select("o_orderkey").join(order_events(spark, d), F.col("o_orderkey") == F.col("event_id"), "left")
    return events.where(C.multiplicity(F.col("muons")) != 0).select("o_orderkey", F.size("muons").cast("long").alias("n_items"))


@query("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_returnflag IN ('A', 'R') AND l_linestatus LIKE 'F%' AND l_tax IS NOT NULL")
def project_flat(spark: SparkSession, d: str) -> DataFrame:
    kept = F.col("l_quantity").between(10, 20) & F.col("l_returnflag").isin("A", "R") & F.col("l_linestatus").like("F%") & F.col("l_tax").isNotNull()
    return table(spark, d, "lineitem").where(kept).select("l_orderkey", "l_partkey", "l_quantity")


@query(f"WITH {_PARTICLES} SELECT event_id, pt FROM particles")
def project_nested(spark: SparkSession, d: str) -> DataFrame:
    return order_events(spark, d).select("event_id", F.explode("muons.pt_").alias("pt"))


@query("SELECT p_partkey, p_name FROM part WHERE p_size <= 20 UNION ALL SELECT p_partkey, p_name FROM part WHERE p_size > 20 UNION ALL SELECT p_partkey, p_name FROM part WHERE p_size <= 20")
def union_paths(spark: SparkSession, d: str) -> DataFrame:
    """Two folders of files at different depths, one of them twice."""
    top = scratch(spark)
    table(spark, d, "part").where("p_size <= 20").write.parquet(f"{top}/small/deep/er")
    table(spark, d, "part").where("p_size > 20").write.parquet(f"{top}/large")
    return read_events(spark, f"{top}/small", f"{top}/large", f"{top}/small", columns=["p_partkey", "p_name"])


@query("SELECT event_id, ts, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type <> 'click'")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, d, "events").where("event_type <> 'click'").select("event_id", "ts", "event_type", k.alias("k"))


@query("SELECT p_partkey, p_name, p_size, p_retailprice, 3 AS kinds FROM part")
def file_kinds(spark: SparkSession, d: str) -> DataFrame:
    """A table written and read as ORC, JSON and CSV: rows that all three give alike."""
    top, own = scratch(spark), table(spark, d, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    parts = []
    for kind in ("orc", "json", "csv"):
        write_events(own, f"{top}/{kind}", kind=kind)
        parts.append(read_events(spark, f"{top}/{kind}", kind=kind, schema=None if kind == "orc" else own.schema))
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.groupBy(*own.columns).agg(F.count(F.lit(1)).cast("int").alias("kinds"))


@query("SELECT o_orderstatus, count(*) AS n, max(o_totalprice) AS largest FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY o_orderstatus")
def partition_columns(spark: SparkSession, d: str) -> DataFrame:
    """Events in a folder for each value of a column: the filter on it lists those folders alone."""
    top = scratch(spark)
    write_events(table(spark, d, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice"), f"{top}/o", partition_by=["o_orderstatus"])
    got = spark.read.parquet(f"{top}/o").where("o_orderstatus in ('F', 'P')")
    return got.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("largest"))


# --- aggregations ----------------------------------------------------------------------------------------------------


@query(f"""WITH {_PARTICLES}
SELECT max(pt) AS max_pt, min(pt) AS min_pt, round(sum(pt), 3) AS sum_pt, max(eta) AS max_eta, min(eta) AS min_eta, round(sum(eta), 3) AS sum_eta,
       max(phi) AS max_phi, min(phi) AS min_phi, round(sum(phi), 3) AS sum_phi FROM particles""")
def reduce_pt_eta_phi(spark: SparkSession, d: str) -> DataFrame:
    inner, outer = [], []
    for q in ("pt", "eta", "phi"):
        x = F.col(f"muons.{q}_")
        inner += [F.array_max(x).alias(f"max_{q}"), F.array_min(x).alias(f"min_{q}"), C.total(x).alias(f"sum_{q}")]
        outer += [F.max(f"max_{q}").alias(f"max_{q}"), F.min(f"min_{q}").alias(f"min_{q}"), F.round(F.sum(f"sum_{q}"), 3).alias(f"sum_{q}")]
    return order_events(spark, d).select(*inner).agg(*outer)


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(avg(l_quantity), 6) AS avg_qty,
       round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY l_returnflag, l_linestatus""")
def pricing_summary(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return df.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.round(F.sum("l_extendedprice"), 2).alias("sum_base_price"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc_price"),
        F.round(F.avg("l_quantity"), 6).alias("avg_qty"),
        F.round(F.avg("l_discount"), 6).alias("avg_disc"),
        F.count(F.lit(1)).alias("count_order"),
    )


@query("""SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer
JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY n_name""")
def local_supplier_volume(spark: SparkSession, d: str) -> DataFrame:
    t = {n: table(spark, d, n) for n in ("customer", "orders", "lineitem", "supplier", "nation", "region")}
    df = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")).join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
    df = df.join(t["supplier"], (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
    df = df.join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey")).join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    return df.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT event_id) AS ids FROM events GROUP BY event_type")
def distinct_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(F.countDistinct("user_id").alias("users"), F.countDistinct("event_id").alias("ids"))


@query("SELECT event_type, count(DISTINCT user_id) AS users, true AS near FROM events GROUP BY event_type")
def approx_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Sketched counts beside the exact ones: within three times their standard error."""
    both = table(spark, d, "events").groupBy("event_type").agg(F.countDistinct("user_id").alias("users"), F.approx_count_distinct("user_id", 0.02).alias("about"))
    return both.select("event_type", "users", (F.abs(F.col("about") - F.col("users")) <= 0.06 * F.col("users")).alias("near"))


@query("SELECT event_type, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.9), 6) AS p90 FROM events GROUP BY event_type")
def percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Exact, and so with every different value of a group in one buffer; percentile_approx bounds that (see approx_percentiles)."""
    return table(spark, d, "events").groupBy("event_type").agg(F.round(F.percentile("value", 0.5), 6).alias("median"), F.round(F.percentile("value", 0.9), 6).alias("p90"))


@query("""SELECT event_type, true AS near FROM events GROUP BY event_type""")
def approx_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """A sketch of bounded size: the median found has about half of the group's values below it."""
    e = table(spark, d, "events")
    medians = e.groupBy("event_type").agg(F.percentile_approx("value", 0.5, 1000).alias("median"))
    ranks = e.join(medians, "event_type").groupBy("event_type").agg(F.avg((F.col("value") < F.col("median")).cast("double")).alias("below"), F.avg((F.col("value") <= F.col("median")).cast("double")).alias("upto"))
    return ranks.select("event_type", ((F.col("below") <= 0.505) & (F.col("upto") >= 0.495)).alias("near"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(grouping(l_returnflag) AS INTEGER) AS g1, CAST(grouping(l_linestatus) AS INTEGER) AS g2 FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def rollup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.grouping("l_returnflag").cast("int").alias("g1"), F.grouping("l_linestatus").cast("int").alias("g2"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def cube(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")
def grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    s, p = F.col("o_orderstatus"), F.col("o_orderpriority")
    return table(spark, d, "orders").groupingSets([[s], [p], []], s, p).agg(F.count(F.lit(1)).alias("n")).select("o_orderstatus", "o_orderpriority", "n")


@query("SELECT l_linestatus, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS n, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY l_linestatus")
def pivot(spark: SparkSession, d: str) -> DataFrame:
    got = table(spark, d, "lineitem").groupBy("l_linestatus").pivot("l_returnflag", ["A", "N", "R"]).count()
    return got.select("l_linestatus", *(F.coalesce(k, F.lit(0)).alias(k.lower()) for k in "ANR"))


# --- events: leading particles, masses, histograms ---------------------------------------------------------------------


@query(f"WITH {_RANKED} SELECT event_id, CAST(r AS INTEGER) AS place, pt, l_linenumber, l_partkey FROM ranked WHERE r <= 2")
def leading_two(spark: SparkSession, d: str) -> DataFrame:
    fields = ("pt_", "eta_", "phi_", "l_linenumber", "l_partkey")
    top = C.leading(F.col("muons"), 2, *((lambda m, f=f: m[f]) for f in fields))
    rows = order_events(spark, d).select("event_id", F.posexplode(top).alias("place", "m"))
    return rows.select("event_id", (F.col("place") + 1).alias("place"), F.col("m.pt_").alias("pt"), "m.l_linenumber", "m.l_partkey")


def dimuon_masses(events: DataFrame) -> DataFrame:
    """event_id, mass of the two particles that lead in signed transverse momentum; events with fewer have no row."""
    top = events.where(F.size("muons") >= 2).select("event_id", F.slice(F.sort_array("muons", asc=False), 1, 2).alias("m"))
    return top.select("event_id", physics.invariant_mass(F.col("m")[0], F.col("m")[1]).alias("mass"))


@query(f"WITH {_MASSES} SELECT event_id, round(mass, 6) AS mass FROM masses")
def dimuon_mass(spark: SparkSession, d: str) -> DataFrame:
    return dimuon_masses(order_events(spark, d)).select("event_id", F.round("mass", 6).alias("mass"))


@query(f"""WITH {_MASSES}, counted AS (
  SELECT CASE WHEN mass < 0 THEN 0 WHEN mass >= 200 THEN 101 ELSE CAST(floor(100 * mass / 200) AS BIGINT) + 1 END AS bin, count(*) AS n FROM masses GROUP BY 1)
SELECT CAST(b.bin AS BIGINT) AS bin, coalesce(n, 0) AS n FROM range(102) AS b(bin) LEFT JOIN counted USING (bin)""")
def dimuon_hist(spark: SparkSession, d: str) -> DataFrame:
    return H.histogram(dimuon_masses(order_events(spark, d)), F.col("mass"), 100, 0.0, 200.0).select("bin", "n")


@query("""WITH x AS (SELECT CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings), counted AS (
  SELECT CASE WHEN x < -0.5 THEN 0 WHEN x >= 0.5 THEN 101 ELSE CAST(floor(100 * (x + 0.5)) AS BIGINT) + 1 END AS bin, count(*) AS n FROM x GROUP BY 1)
SELECT CAST(b.bin AS BIGINT) AS bin, coalesce(n, 0) AS n FROM range(102) AS b(bin) LEFT JOIN counted USING (bin)""")
def flatten_hist(spark: SparkSession, d: str) -> DataFrame:
    flat = table(spark, d, "embeddings").select(F.explode("embedding").alias("x"))
    return H.histogram(flat, F.col("x"), 100, -0.5, 0.5).select("bin", "n")


@query("""SELECT CAST(least(floor(l_quantity / 5), 9) + 1 AS BIGINT) AS bin, count(*) AS n, round(avg(l_extendedprice), 4) AS mean, round(stddev_pop(l_extendedprice), 4) AS spread
FROM lineitem WHERE l_quantity < 50 GROUP BY 1""")
def profile_hist(spark: SparkSession, d: str) -> DataFrame:
    got = H.profile(table(spark, d, "lineitem"), F.col("l_quantity"), F.col("l_extendedprice"), 10, 0.0, 50.0)
    return got.where("bin between 1 and 10").select("bin", "n", F.round("mean", 4).alias("mean"), F.round("spread", 4).alias("spread"))


# --- nested types ----------------------------------------------------------------------------------------------------


@query("SELECT l_orderkey AS event_id, l_partkey AS part, l_quantity AS quantity FROM lineitem")
def array_transpose(spark: SparkSession, d: str) -> DataFrame:
    split = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("event_id")).agg(F.collect_list(F.struct("l_partkey", "l_quantity")).alias("x"))
    split = split.select("event_id", F.col("x.l_partkey").alias("part"), F.col("x.l_quantity").alias("quantity"))  # an array a field
    rows = split.select("event_id", F.explode(C.transposed("part", "quantity")).alias("x"))
    return rows.select("event_id", "x.part", "x.quantity")


@query("""SELECT vec_id, embedding[1] AS first, embedding[64] AS last, round(list_sum(list_transform(embedding[9:16], lambda x: CAST(x AS DOUBLE))), 6) AS second_row, 64 AS n FROM embeddings""")
def array_nd(spark: SparkSession, d: str) -> DataFrame:
    cube = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.transform(F.sequence(F.lit(0), F.lit(1)), lambda j: F.slice("embedding", i * 16 + j * 8 + 1, 8)))
    nested = table(spark, d, "embeddings").select("vec_id", cube.alias("c"))
    return nested.select("vec_id", F.col("c")[0][0][0].alias("first"), F.col("c")[3][1][7].alias("last"), F.round(C.total(F.col("c")[0][1]), 6).alias("second_row"), F.size(F.flatten(F.flatten("c"))).alias("n"))


def _entries(spark: SparkSession, d: str) -> DataFrame:
    item = F.struct("l_partkey", "l_extendedprice", F.col("l_linenumber").alias("key"), F.col("l_extendedprice").alias("value"))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("e"))


@query("""SELECT l_orderkey, l_linenumber AS key, l_extendedprice AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_extendedprice DESC) AS r FROM lineitem) WHERE r = 1""")
def map_last_wins(spark: SparkSession, d: str) -> DataFrame:
    return _entries(spark, d).select("l_orderkey", F.explode(C.map_last_wins(F.col("e"))).alias("key", "value"))


@query("SELECT l_orderkey, l_linenumber AS key, count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY ALL")
def multimap_group(spark: SparkSession, d: str) -> DataFrame:
    rows = _entries(spark, d).select("l_orderkey", F.explode(C.multimap(F.col("e"))).alias("key", "values"))
    return rows.select("l_orderkey", "key", F.size("values").cast("long").alias("n"), F.round(C.total(F.col("values")), 2).alias("total"))


# --- schema passes ---------------------------------------------------------------------------------------------------


def _layered(spark: SparkSession, d: str) -> tuple[DataFrame, layout.Root]:
    """Orders as records with a base class, an empty member and an undecodable one, and the layout that says so."""
    o = table(spark, d, "orders")
    base = F.struct("o_custkey", F.col("o_totalprice").alias("price"))
    record = F.struct(base.alias("Base"), "o_orderstatus", F.struct().alias("empty"), F.lit(None).alias("lost"))
    df = o.select("o_orderkey", record.alias("rec"))
    leaf = layout.Leaf
    root = layout.Root(
        (
            leaf("o_orderkey", "long"),
            layout.Struct(
                "rec",
                (
                    layout.Struct("Base", (leaf("o_custkey", "long"), leaf("price", "double")), split=True, base=True),
                    leaf("o_orderstatus", "string"),
                    layout.Struct("empty", (), split=True),
                    layout.Unknown("lost"),
                ),
                split=True,
                top=True,
            ),
        )
    )
    return df, root


@query("SELECT o_orderkey, o_custkey, o_totalprice AS price, o_orderstatus FROM orders")
def flatten_base(spark: SparkSession, d: str) -> DataFrame:
    df, root = _layered(spark, d)
    return passes.applied(df, root, passes.run(root)).select("o_orderkey", "rec.o_custkey", "rec.price", "rec.o_orderstatus")


@query("SELECT o_orderkey, 'Base,o_orderstatus' AS members, o_custkey, o_totalprice AS price FROM orders")
def drop_null(spark: SparkSession, d: str) -> DataFrame:
    """What is left of each record without its undecodable and empty members, by the names that its rows hold."""
    df, root = _layered(spark, d)
    got = passes.applied(df, root, passes.run(root, {"flattenoutbasepass": "off", "removeemptyrowpass": "on"}))
    return got.select("o_orderkey", F.array_join(F.json_object_keys(F.to_json("rec")), ",").alias("members"), "rec.Base.o_custkey", "rec.Base.price")


@query("SELECT o_orderkey, 'o_custkey,price,o_orderstatus,empty' AS softly, 'empty,lost' AS without_empty FROM orders")
def drop_empty(spark: SparkSession, d: str) -> DataFrame:
    """The passes one by one: undecodable members alone gone, and empty records there or gone."""
    df, root = _layered(spark, d)
    names = lambda options: ",".join(passes.applied(df, root, passes.run(root, options)).schema["rec"].dataType.names)
    soft = passes.applied(df, root, passes.run(root, {"softremovenulltypepass": "on", "removeemptyrowpass": "off"}))
    gone = set(names({"hardremovenulltypepass": "off", "removeemptyrowpass": "off"}).split(",")) - set(names({}).split(","))
    return soft.select("o_orderkey", F.lit(",".join(soft.schema["rec"].dataType.names)).alias("softly"), F.lit(",".join(sorted(gone))).alias("without_empty"))


@query("SELECT o_orderkey, o_totalprice AS price FROM orders")
def prune_schema(spark: SparkSession, d: str) -> DataFrame:
    df, root = _layered(spark, d)
    pruned = passes.prune(passes.run(root), "o_orderkey long, rec struct<price: double>")
    return passes.applied(df, root, pruned).select("o_orderkey", "rec.price")


@query("""SELECT place, replace(source, ';', chr(10)) AS source FROM (VALUES
(0, '@dataclass;class Record0:;    pt_: float;    eta_: float;    phi_: float;    l_linenumber: int;    l_partkey: int'),
(1, '@dataclass;class Event:;    event_id: int;    muons: list[Record0]')) AS x(place, source)""")
def codegen_schema(spark: SparkSession, d: str) -> DataFrame:
    code = codegen.dataclasses(order_events(spark, d).schema, "Event")
    return spark.createDataFrame(list(enumerate(code)), "place int, source string")


# --- joins -----------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 200000")
def join_left(spark: SparkSession, d: str) -> DataFrame:
    big = table(spark, d, "orders").where("o_totalprice > 200000")
    return table(spark, d, "customer").join(big, F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey", "o_orderkey")


@query("SELECT s_suppkey, c_custkey FROM (SELECT * FROM supplier WHERE s_acctbal > 0) RIGHT JOIN (SELECT * FROM customer WHERE c_acctbal < 0) ON s_suppkey = c_custkey")
def join_right(spark: SparkSession, d: str) -> DataFrame:
    s, c = table(spark, d, "supplier").where("s_acctbal > 0"), table(spark, d, "customer").where("c_acctbal < 0")
    return s.join(c, F.col("s_suppkey") == F.col("c_custkey"), "right").select("s_suppkey", "c_custkey")


@query("SELECT s_suppkey, c_custkey FROM (SELECT * FROM supplier WHERE s_acctbal > 0) FULL JOIN (SELECT * FROM customer WHERE c_acctbal < 0) ON s_suppkey = c_custkey")
def join_full(spark: SparkSession, d: str) -> DataFrame:
    s, c = table(spark, d, "supplier").where("s_acctbal > 0"), table(spark, d, "customer").where("c_acctbal < 0")
    return s.join(c, F.col("s_suppkey") == F.col("c_custkey"), "full").select("s_suppkey", "c_custkey")


@query("SELECT how, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey, (VALUES ('broadcast'), ('merge'), ('shuffle_hash')) AS x(how) GROUP BY how")
def join_hints(spark: SparkSession, d: str) -> DataFrame:
    """One join by each strategy that a hint can ask for."""
    o, c = table(spark, d, "orders").select("o_custkey"), table(spark, d, "customer").select("c_custkey")
    out = None
    for how in ("broadcast", "merge", "shuffle_hash"):
        part = o.join(c.hint(how), F.col("o_custkey") == F.col("c_custkey")).agg(F.lit(how).alias("how"), F.count(F.lit(1)).alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def join_semi(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").join(table(spark, d, "orders").where("o_orderstatus = 'F'"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND o_orderpriority LIKE '1%')")
def join_anti(spark: SparkSession, d: str) -> DataFrame:
    urgent = table(spark, d, "orders").where("o_orderstatus = 'F' and o_orderpriority like '1%'")
    return table(spark, d, "customer").join(urgent, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@query("SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM nation a JOIN nation b ON a.n_regionkey < b.n_regionkey")
def join_theta(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "nation").alias("a"), table(spark, d, "nation").alias("b")
    return a.join(b, F.col("a.n_regionkey") < F.col("b.n_regionkey")).select(F.col("a.n_nationkey").alias("a"), F.col("b.n_nationkey").alias("b"))


@query("SELECT l_orderkey, l_extendedprice, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def join_friends(spark: SparkSession, d: str) -> DataFrame:
    """Two tables of one event's parts, matched by the event's id."""
    return table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_extendedprice", "o_orderdate")


@query("""WITH p AS (SELECT user_id, ts, max(value) AS paid FROM events WHERE event_type = 'purchase' GROUP BY ALL)
SELECT e.event_id, e.ts, p.paid FROM (SELECT * FROM events WHERE event_type = 'click') e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.ts >= p.ts""")
def join_asof(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    bought = e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("bought_at"), F.col("value").alias("paid"))
    clicks = e.where("event_type = 'click'").select("event_id", "user_id", "ts")
    return J.asof_join(clicks, bought, "user_id", "ts", "bought_at", ["paid"], lambda t: F.date_trunc("day", t)).select("event_id", "ts", "paid")


@query("""SELECT p_partkey, s_suppkey FROM part JOIN (SELECT s_suppkey, 900 + s_suppkey * 10 AS low, 930 + s_suppkey * 10 AS high FROM supplier) ON p_retailprice >= low AND p_retailprice < high""")
def join_range(spark: SparkSession, d: str) -> DataFrame:
    ranges = table(spark, d, "supplier").select("s_suppkey")
    low = F.col("s_suppkey") * 10 + 900
    return J.range_join(table(spark, d, "part").select("p_partkey", "p_retailprice"), ranges, F.col("p_retailprice"), low.cast("double"), (low + 30).cast("double"), 30.0).select("p_partkey", "s_suppkey")


@query("SELECT l_orderkey, l_partkey, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey")
def join_salted(spark: SparkSession, d: str) -> DataFrame:
    left = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", F.col("l_suppkey").alias("s_suppkey"))
    return J.salted_join(left, table(spark, d, "supplier").select("s_suppkey", "s_name"), "s_suppkey", 8).select("l_orderkey", "l_partkey", "s_name")


# --- windows, top-k, set operations ------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, row_number() OVER w AS rn, rank() OVER p AS rk, dense_rank() OVER p AS dr, ntile(4) OVER w AS quarter,
lag(o_totalprice) OVER w AS before, lead(o_totalprice) OVER w AS after FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), p AS (PARTITION BY o_custkey ORDER BY o_orderpriority)""")
def window_ranks(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    p = Window.partitionBy("o_custkey").orderBy("o_orderpriority")
    ranks = {"rn": F.row_number().over(w), "rk": F.rank().over(p), "dr": F.dense_rank().over(p), "quarter": F.ntile(4).over(w)}
    values = {"before": F.lag("o_totalprice").over(w), "after": F.lead("o_totalprice").over(w)}
    return table(spark, d, "orders").select("o_orderkey", *(c.cast("long").alias(k) for k, c in ranks.items()), *(c.alias(k) for k, c in values.items()))


@query("""SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS moving,
first_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS first_order,
last_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_order,
count(*) OVER (PARTITION BY o_custkey ORDER BY epoch(o_orderdate) RANGE BETWEEN 7776000 PRECEDING AND CURRENT ROW) AS of_90_days FROM orders""")
def window_frames(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    all_of, days = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), Window.partitionBy("o_custkey").orderBy("second").rangeBetween(-90 * 86_400, 0)
    o = table(spark, d, "orders").withColumn("second", F.unix_timestamp(F.col("o_orderdate").cast("timestamp")))
    moving = F.round(F.sum("o_totalprice").over(w.rowsBetween(-2, 0)), 2).alias("moving")
    return o.select("o_orderkey", moving, F.first("o_orderkey").over(w).alias("first_order"), F.last("o_orderkey").over(all_of).alias("last_order"), F.count(F.lit(1)).over(days).alias("of_90_days"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def topk(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100).select("o_orderkey", "o_totalprice")


@query("SELECT DISTINCT o_orderpriority FROM orders")
def distinct_values(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderpriority").distinct()


@query("""SELECT 'union' AS kind, count(*) AS n FROM (SELECT c_nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'intersect', count(*) FROM (SELECT c_custkey FROM customer INTERSECT SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'intersect_all', count(*) FROM (SELECT c_nationkey FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'except', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'except_all', count(*) FROM (SELECT c_nationkey FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier)""")
def set_operations(spark: SparkSession, d: str) -> DataFrame:
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    cn, sn, ck, sk = c.select("c_nationkey"), s.select("s_nationkey"), c.select("c_custkey"), s.select("s_suppkey")
    kinds = {"union": cn.union(sn), "intersect": ck.intersect(sk), "intersect_all": cn.intersectAll(sn), "except": ck.subtract(sk), "except_all": cn.exceptAll(sn)}
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("kind"), "n") for k, df in kinds.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- scalar functions ------------------------------------------------------------------------------------------------


@query("""SELECT p_partkey, upper(p_brand) AS brand, length(p_name) AS chars, replace(replace(p_type, '.', '_'), '::', '__') AS kind,
regexp_extract(p_brand, '([0-9]+)', 1) AS number, round(pow(p_size, 2) + sqrt(p_retailprice) + abs(-p_size), 6) AS mixed FROM part""")
def scalar_functions(spark: SparkSession, d: str) -> DataFrame:
    mixed = F.pow("p_size", F.lit(2)) + F.sqrt("p_retailprice") + F.abs(-F.col("p_size"))
    kind = F.replace(F.replace("p_type", F.lit("."), F.lit("_")), F.lit("::"), F.lit("__"))
    return table(spark, d, "part").select("p_partkey", F.upper("p_brand").alias("brand"), F.length("p_name").cast("long").alias("chars"), kind.alias("kind"), F.regexp_extract("p_brand", "([0-9]+)", 1).alias("number"), F.round(mixed, 6).alias("mixed"))


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, count(*) AS n FROM orders GROUP BY ALL")
def calendar(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).agg(F.count(F.lit(1)).alias("n"))


# --- streaming -------------------------------------------------------------------------------------------------------


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    return stream.windowed_counts(spark, f"{d}/events.parquet")


@query("""WITH marked AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM marked)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM numbered GROUP BY user_id, s""")
def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    return stream.drained(stream.sessions(stream.event_stream(spark, f"{d}/events.parquet")), "complete")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_distinct(spark: SparkSession, d: str) -> DataFrame:
    return stream.drained(stream.first_seen(stream.event_stream(spark, f"{d}/events.parquet")), "append")


# --- functions in SQL text -------------------------------------------------------------------------------------------


@query(f"""WITH {_PARTICLES} SELECT event_id, l_partkey, round(2 * atan(exp(-eta)), 6) AS theta,
round(sqrt(pt * pt + pow(pt / tan(2 * atan(exp(-eta))), 2) + pow(0.10565836727619171, 2)), 6) AS e, CAST(least(floor(pt / 2) + 1, 50) AS BIGINT) AS bin FROM particles WHERE pt < 100""")
def sql_functions(spark: SparkSession, d: str) -> DataFrame:
    sql.register(spark)
    rows = order_events(spark, d).select("event_id", F.inline("muons")).where("pt_ < 100")
    return rows.selectExpr("event_id", "l_partkey", "round(polar_angle(eta_), 6) AS theta", "round(energy(pt_, eta_, muon_mass()), 6) AS e", "bin_index(pt_, 50, 0, 100) AS bin")


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AND o_totalprice > (SELECT avg(o_totalprice) FROM orders)")
def subqueries(spark: SparkSession, d: str) -> DataFrame:
    views = {n: table(spark, d, n) for n in ("orders", "customer")}
    return spark.sql("SELECT o_orderkey FROM {orders} WHERE o_custkey IN (SELECT c_custkey FROM {customer} WHERE c_mktsegment = 'BUILDING') AND o_totalprice > (SELECT avg(o_totalprice) FROM {orders})", **views)


@query("SELECT p_partkey, f AS field, v AS amount FROM (SELECT p_partkey, CAST(p_size AS DOUBLE) AS size, p_retailprice AS price FROM part) UNPIVOT (v FOR f IN (size, price))")
def unpivot(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price")).unpivot("p_partkey", ["size", "price"], "field", "amount")


# --- tree files --------------------------------------------------------------------------------------------------------


@query("SELECT p_partkey, p_name, p_size, p_retailprice FROM part WHERE p_size > 10")
def tree_scan(spark: SparkSession, d: str) -> DataFrame:
    """A table written as tree files and read again, a column less."""
    folder = scratch(spark)
    write_trees(table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"), folder)
    return read_trees(spark, folder, tree="Events", columns=["p_partkey", "p_name", "p_size", "p_retailprice"]).where("p_size > 10")


@query(f"WITH {_PARTICLES} SELECT event_id, pt, l_partkey FROM particles")
def tree_split_collection(spark: SparkSession, d: str) -> DataFrame:
    """Events with collections of records, stored a member at a time; two members of five are read."""
    folder = scratch(spark)
    write_trees(order_events(spark, d), folder)
    got = read_trees(spark, folder, columns=["event_id", "muons.pt_", "muons.l_partkey"], entries="10000")
    return got.select("event_id", F.inline("muons").alias("pt", "l_partkey"))


@query(f"WITH {_MASSES} SELECT round(max(mass), 6) AS largest, count(*) AS n FROM masses")
def tree_dimuon_mass(spark: SparkSession, d: str) -> DataFrame:
    """The dimuon analysis from tree files to its figures."""
    folder = scratch(spark)
    write_trees(order_events(spark, d), folder)
    masses = dimuon_masses(read_trees(spark, folder, columns=["event_id", "muons.pt_", "muons.eta_", "muons.phi_"]))
    return masses.agg(F.round(F.max("mass"), 6).alias("largest"), F.count(F.lit(1)).alias("n"))


def _tree_events(spark: SparkSession, d: str, folder: str, *columns: str) -> None:
    """Orders and their items as events, of columns of every kind that a tree stores those named."""
    hit = F.struct(F.struct("l_extendedprice", "l_quantity").alias("Base"), "l_linenumber", "l_returnflag", F.array("l_tax", "l_discount").alias("rates"))
    by_line = F.struct(F.col("l_linenumber").alias("key"), F.col("l_partkey").alias("value"))
    items = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_extendedprice", hit.alias("hit"), by_line.alias("pair")))).alias("x"))
    whole = F.struct(F.col("l_orderkey").alias("id"), F.lit("order").alias("label"), F.col("x.l_partkey").alias("parts"), F.transform("x.hit", lambda h: F.struct(h["l_returnflag"].alias("flag"), h["rates"].alias("rates"))).alias("lines"))
    grid = F.transform(F.sequence(F.lit(0), F.lit(1)), lambda i: F.transform(F.sequence(F.lit(0), F.lit(2)), lambda j: (F.col("l_orderkey") * 10 + i * 3 + j).cast("double")))
    df = items.select("l_orderkey", F.size("x").alias("n"), F.col("x.l_extendedprice").alias("prices"), grid.alias("grid"), C.map_last_wins(F.col("x.pair")).alias("by_line"), whole.alias("whole"), F.col("x.hit").alias("hits"))
    write_trees(df.select(*columns), folder, arrays={k: v for k, v in {"prices": "n", "grid": (2, 3)}.items() if k in columns})


@query("""SELECT l_orderkey, count(*) AS n, 'order' AS label, sum(l_partkey)::BIGINT AS parts, round(sum(l_tax + l_discount), 6) AS rates,
count(*) FILTER (l_returnflag = 'R') AS returned FROM lineitem GROUP BY l_orderkey""")
def tree_unsplit_records(spark: SparkSession, d: str) -> DataFrame:
    """Records stored in one piece that hold a string, a vector, and a vector of records with vectors of their own."""
    folder = scratch(spark)
    _tree_events(spark, d, folder, "whole")
    w = F.col("whole")
    rates = F.flatten(F.transform(w["lines"], lambda x: x["rates"]))
    got = read_trees(spark, folder, columns=["whole"])
    returned = F.size(F.filter(w["lines"], lambda x: x["flag"] == "R")).cast("long")
    return got.select(w["id"].alias("l_orderkey"), F.size(w["lines"]).cast("long").alias("n"), w["label"].alias("label"), C.total(w["parts"]).cast("long").alias("parts"), F.round(C.total(rates), 6).alias("rates"), returned.alias("returned"))


@query("""SELECT l_orderkey, l_linenumber AS key, l_partkey AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC) AS r FROM lineitem) WHERE r = 1""")
def tree_maps(spark: SparkSession, d: str) -> DataFrame:
    folder = scratch(spark)
    _tree_events(spark, d, folder, "l_orderkey", "by_line")
    return read_trees(spark, folder, columns=["l_orderkey", "by_line"], entries="5000").select("l_orderkey", F.explode("by_line").alias("key", "value"))


@query("SELECT l_orderkey, l_returnflag AS key, count(*) AS n, sum(l_partkey)::BIGINT AS total FROM lineitem GROUP BY ALL")
def tree_multimaps(spark: SparkSession, d: str) -> DataFrame:
    """Maps with several values a key, by strings."""
    folder = scratch(spark)
    entry = F.struct(F.col("l_returnflag").alias("key"), F.col("l_partkey").alias("value"))
    own = table(spark, d, "lineitem").groupBy("l_orderkey").agg(C.multimap(F.collect_list(entry)).alias("parts"))
    write_trees(own, folder, multimaps=("parts",))
    rows = read_trees(spark, folder).select("l_orderkey", F.explode("parts").alias("key", "values"))
    return rows.select("l_orderkey", "key", F.size("values").cast("long").alias("n"), C.total(F.col("values")).cast("long").alias("total"))


@query("""SELECT l_orderkey, count(*)::INTEGER AS n, round(sum(l_extendedprice), 2) AS total, l_orderkey * 10.0 + 5 AS corner, l_orderkey * 10.0 + 1 AS beside FROM lineitem GROUP BY l_orderkey""")
def tree_nd_arrays(spark: SparkSession, d: str) -> DataFrame:
    """Leaf arrays: one whose length another column counts, and one of fixed dimensions."""
    folder = scratch(spark)
    _tree_events(spark, d, folder, "l_orderkey", "n", "prices", "grid")
    got = read_trees(spark, folder, columns=["l_orderkey", "n", "prices", "grid"])
    return got.select("l_orderkey", "n", F.round(C.total(F.col("prices")), 2).alias("total"), F.col("grid")[1][2].alias("corner"), F.col("grid")[0][1].alias("beside"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_returnflag, l_tax AS rate, true AS same FROM lineitem")
def tree_flatten_base(spark: SparkSession, d: str) -> DataFrame:
    """A split collection with a base class, strings and vectors: flattened, and with the base as a record of its own."""
    folder = scratch(spark)
    _tree_events(spark, d, folder, "l_orderkey", "hits")
    flat = read_trees(spark, folder, columns=["l_orderkey", "hits"]).select("l_orderkey", F.inline("hits"))
    nested = read_trees(spark, folder, columns=["l_orderkey", "hits.Base"], flattenoutbasepass="off")
    sums = nested.select("l_orderkey", F.expr("aggregate(hits.Base.l_quantity, 0D, (s, x) -> s + x)").alias("whole"))
    w = Window.partitionBy("l_orderkey")
    same = F.abs(F.sum("l_quantity").over(w) - F.col("whole")) < 1e-9
    return flat.join(sums, "l_orderkey").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_returnflag", F.col("rates")[0].alias("rate"), same.alias("same"))


@query("SELECT count(DISTINCT l_orderkey) AS n FROM lineitem")
def tree_count(spark: SparkSession, d: str) -> DataFrame:
    """Events by the files' headers alone."""
    folder = scratch(spark)
    write_trees(order_events(spark, d), folder)
    return entry_counts(spark, folder).agg(F.sum("entries").alias("n"))


@query("SELECT p_partkey, p_size FROM part WHERE p_size = 7 OR p_size > 48")
def tree_ignore_corrupt(spark: SparkSession, d: str) -> DataFrame:
    """Files that can't be read among those that can: they give no rows."""
    folder = scratch(spark)
    write_trees(table(spark, d, "part").select("p_partkey", "p_size"), folder)
    spark.createDataFrame([("no tree",)], "value string").coalesce(1).write.text(f"{folder}/z")
    got = read_trees(spark, folder, suffix="", ignorecorrupt="on", columns=["p_partkey", "p_size"])
    return got.where("p_size = 7 or p_size > 48")
