"""Warehouse-shaped and extract-shaped views over the given tables.

Orders and line items stand for events, nations for countries and regions for
geographies.  ``FIXTURES.md`` gives the same views as SQL.
"""

from __future__ import annotations

from functools import cache, cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from statmart import codes
from statmart.functions import all_present, div, quarter_of

GEO = "ASIA"
AS_OF = 2001
CENSUS_YEARS = (1995, 2000)
FIRST_ASYLUM_YEAR = 1998

STREAMS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
STREAM_OF_FLAG = {"A": "study", "N": "work", "R": "asylum"}
STATUS_OF_ORDER = {"F": "canadian_born", "O": "naturalized", "P": "permanent_resident"}
CITIZENSHIP_OF_ORDER = {
    "F": codes.CITIZEN_BY_BIRTH,
    "O": codes.CITIZEN_NATURALIZED,
    "P": codes.NOT_CITIZEN,
}

# Two spellings of one nation, and one nation that is an aggregate row.
PLACES = codes.PlaceRules(
    aliases=(("NATION_21", "NATION_20"), ("NATION_22", "NATION_2")),
    aggregates=("NATION_24",),
)


@cache
def _schema(spark: SparkSession, path: str) -> StructType:
    """Schema of a table, looked up in its files once per session."""
    return spark.read.parquet(path).schema


class Fixtures:
    """Lazy views over the parquet tables in one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            path = f"{self.folder}/{name}.parquet"
            self._read[name] = self.spark.read.schema(_schema(self.spark, path)).parquet(path)
        return self._read[name]

    # -- joins ---------------------------------------------------------------

    @cached_property
    def nations(self) -> DataFrame:
        regions = self.table("region")
        return self.table("nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))

    @cached_property
    def customers(self) -> DataFrame:
        """Customers with place names: joined before the orders, so only two names travel on."""
        joined = self.table("customer").join(self.nations, F.col("c_nationkey") == F.col("n_nationkey"))
        return joined.select("c_custkey", "c_mktsegment", "n_name", "r_name")

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders").join(self.customers, F.col("o_custkey") == F.col("c_custkey"))

    @cached_property
    def suppliers(self) -> DataFrame:
        joined = self.table("supplier").join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        return joined.select("s_suppkey", "s_nationkey", "n_name")

    @cached_property
    def shipments(self) -> DataFrame:
        return self.table("lineitem").join(self.suppliers, F.col("l_suppkey") == F.col("s_suppkey"))

    # -- warehouse shapes ----------------------------------------------------

    @staticmethod
    def _price() -> Column:
        return F.sum(F.floor("o_totalprice").cast("bigint"))

    @staticmethod
    def _quantity() -> Column:
        return F.sum(F.col("l_quantity").cast("bigint"))

    @cached_property
    def population(self) -> DataFrame:
        keys = [quarter_of("o_orderdate").alias("ref_date"), F.col("r_name").alias("geo")]
        return self.orders.groupBy(*keys).agg(self._price().alias("population"))

    @cached_property
    def npr(self) -> DataFrame:
        keys = [
            quarter_of("o_orderdate").alias("ref_date"),
            F.col("r_name").alias("geo"),
            F.col("o_orderpriority").alias("npr_type"),
        ]
        return self.orders.filter(F.col("o_orderstatus") == "P").groupBy(*keys).agg(self._price().alias("count"))

    @staticmethod
    def _in_census(date: str) -> Column:
        # Ranges instead of year(date) reach the file statistics.
        tests = [
            (F.col(date) >= F.lit(f"{y}-01-01").cast("timestamp_ntz"))
            & (F.col(date) < F.lit(f"{y + 1}-01-01").cast("timestamp_ntz"))
            for y in CENSUS_YEARS
        ]
        return tests[0] | tests[1]

    @cached_property
    def census(self) -> DataFrame:
        status = F.coalesce(*[
            F.when(F.col("o_orderstatus") == flag, status) for flag, status in STATUS_OF_ORDER.items()
        ])
        keys = [F.year("o_orderdate").alias("census_year"), F.col("r_name").alias("geo"), status.alias("status")]
        return self.orders.filter(self._in_census("o_orderdate")).groupBy(*keys).agg(F.count("*").alias("count"))

    @cached_property
    def permits(self) -> DataFrame:
        """Study, work and asylum facts in one pass, tagged by stream."""
        stream = F.coalesce(*[F.when(F.col("l_returnflag") == flag, s) for flag, s in STREAM_OF_FLAG.items()])
        early = (F.col("l_returnflag") == "R") & (F.year("l_shipdate") < FIRST_ASYLUM_YEAR)
        keys = [stream.alias("stream"), F.year("l_shipdate").alias("ref_year"), F.col("n_name").alias("country")]
        known = self.shipments.filter(F.col("l_returnflag").isin(*STREAM_OF_FLAG) & ~early)
        return known.groupBy(*keys).agg(self._quantity().alias("count"))

    @cached_property
    def permanent(self) -> DataFrame:
        keys = [F.year("o_orderdate").alias("ref_year"), F.col("n_name").alias("country")]
        return self.orders.groupBy(*keys).agg(F.count("*").alias("count"))

    @cached_property
    def naturalized(self) -> DataFrame:
        orders = self.orders.filter(self._in_census("o_orderdate"))
        # Lines are summed per order first: the shuffle is the one the join needs
        # anyway, and an order with very many lines becomes one row.
        per_order = self.table("lineitem").groupBy("l_orderkey").agg(self._quantity().alias("quantity"))
        keys = [F.year("o_orderdate").alias("census_year"), F.col("n_name").alias("country")]
        joined = per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        return joined.groupBy(*keys).agg(F.sum("quantity").alias("count"))

    # -- extract shapes ------------------------------------------------------

    @staticmethod
    def _dirty_total() -> Column:
        whole = F.col("l_quantity").cast("int").cast("string")
        return (
            F.when(F.col("l_quantity") < 3, "--")
            .when(F.col("l_quantity") > 45, F.concat(F.lit("1,"), F.lpad(whole, 3, "0")))
            .otherwise(whole)
        )

    @cached_property
    def country_raw(self) -> DataFrame:
        """Permit extract: suppressed cells, commas, list numbers, missing countries."""
        listed = F.concat(F.lit("("), F.col("s_nationkey").cast("string"), F.lit(") "), F.col("n_name"))
        country = F.when(F.col("s_nationkey") % 10 == 3, listed).when(F.col("s_nationkey") != 7, F.col("n_name"))
        return self.shipments.select(
            F.year("l_shipdate").cast("string").alias("EN_YEAR"),
            country.alias("EN_COUNTRY_OF_CITIZENSHIP"),
            self._dirty_total().alias("TOTAL"),
        )

    @cached_property
    def programs_raw(self) -> DataFrame:
        """Program extract: free-text program names by part size, some empty."""
        kind = F.col("p_size") % 8
        text = (
            F.when(kind == 0, "  Temporary  Foreign Worker Program ")
            .when(kind == 1, "International Mobility Program")
            .when(kind == 2, "TFWP low wage")
            .when(kind == 3, "IMP")
            .when(kind == 4, "Seasonal Agricultural\tWorker")
            .when(kind == 5, "Open Work Permit")
            .when(kind == 6, "")
            .otherwise(F.concat_ws(" ", "p_type", "p_name"))
        )
        lines = self.table("lineitem").join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        return lines.select(
            F.year("l_shipdate").cast("string").alias("EN_YEAR"),
            text.alias("EN_PROGRAM"),
            self._dirty_total().alias("TOTAL"),
        )

    @cached_property
    def population_raw(self) -> DataFrame:
        """Population extract: many rows per quarter, in order-key order."""
        return self.orders.select(
            F.date_format("o_orderdate", "yyyy-MM").alias("REF_DATE"),
            F.col("r_name").alias("GEO"),
            F.floor("o_totalprice").cast("string").alias("VALUE"),
            F.col("o_orderpriority").alias("TYPE"),
            F.col("o_orderkey").alias("_row"),
        )

    @cached_property
    def census_raw(self) -> DataFrame:
        """Wide census extract: totals, regions and countries as birth places."""
        status = F.col("o_orderstatus")
        in_census = self.orders.filter(self._in_census("o_orderdate"))
        # Sums by nation first; totals and regions are added up from those.
        by_nation = in_census.groupBy(
            F.year("o_orderdate").cast("string").alias("year"), "r_name", "n_name", status.alias("status")
        ).agg(
            F.count("*").alias("total"),
            F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("immigrant"),
            F.count_if(F.col("o_orderpriority") == "2-HIGH").alias("temporary"),
        )
        birthplaces = F.array(
            F.lit("Total - Place of birth"),
            F.initcap("r_name"),
            F.concat(F.lit("South "), F.initcap("r_name")),
            F.col("n_name"),
        )
        places = by_nation.withColumn("place", F.explode(birthplaces))
        rows = places.groupBy("year", "r_name", "status", "place").agg(
            *[F.sum(c).alias(c) for c in ("total", "immigrant", "temporary")]
        )
        citizenship = F.coalesce(*[F.when(F.col("status") == s, c) for s, c in CITIZENSHIP_OF_ORDER.items()])
        prefix = codes.CENSUS_STATUS_PREFIX
        return rows.select(
            F.concat("year", F.lit("-05")).alias("REF_DATE"),
            F.col("r_name").alias("GEO"),
            citizenship.alias(codes.CENSUS_CITIZENSHIP),
            *[F.lit(member).alias(column) for column, member in codes.CENSUS_MEMBERS.items()],
            F.col("place").alias(codes.CENSUS_BIRTHPLACE),
            F.col("total").cast("string").alias(f"{prefix} (11):Total[1]"),
            F.nullif(F.col("immigrant"), F.lit(0)).cast("string").alias(f"{prefix} (11):Immigrants[3]"),
            F.nullif(F.col("temporary"), F.lit(0)).cast("string").alias(f"{prefix} (11):Non-permanent residents[11]"),
        )

    @cached_property
    def sheet_cells(self) -> DataFrame:
        """One pivoted worksheet per market segment: a title, a blank row, a header,
        the year marks, one more preamble row, then a row per customer. It has a
        column for every year there is."""
        # A handful of values.
        years = sorted(r[0] for r in self.table("orders").select(F.year("o_orderdate")).distinct().collect() if r[0])
        notes = 2 + len(years)
        spent = self.table("orders").groupBy("o_custkey").agg(*[
            F.sum(F.when(F.year("o_orderdate") == y, F.floor("o_totalprice").cast("bigint"))).alias(f"y{y}")
            for y in years
        ])
        people = self.customers.join(spent, F.col("c_custkey") == F.col("o_custkey"), "left")
        cells = [
            (0, F.when(F.col("c_custkey") % 7 == 0, " ").otherwise(F.col("n_name"))),
            (1, F.when(F.col("c_custkey") % 5 == 0, "sub")),
            *[(2 + i, F.coalesce(F.format_number(f"y{y}", 0), F.lit("--"))) for i, y in enumerate(years)],
            (notes, F.col("c_custkey").cast("string")),
        ]

        def cell(row: Column, col: int, value: Column, is_text: Column) -> Column:
            return F.struct(row.alias("row_idx"), F.lit(col).alias("col_idx"), value.alias("value"),
                            is_text.alias("is_text"))

        body = people.select(
            F.col("c_mktsegment").alias("sheet"),
            F.inline(F.array(*[cell(F.col("c_custkey") + 5, i, v, F.lit(i < notes)) for i, v in cells])),
        )
        preamble = [
            (0, ["Claimants by country", *[None] * notes], True),
            (2, ["Country", "Category", *map(str, years), "Notes"], True),
            (3, [None, None, *[f"{y} Total" for y in years], f"{years[-1] + 1} YTD"], True),
            (4, ["All countries", None, *[str(i + 1) for i in range(len(years) + 1)]], False),
        ]
        top = self.customers.select(F.col("c_mktsegment").alias("sheet")).distinct().select(
            "sheet",
            F.inline(F.array(*[
                cell(F.lit(r).cast("bigint"), i, F.lit(v).cast("string"), F.lit(text))
                for r, values, text in preamble
                for i, v in enumerate(values)
            ])),
        )
        return top.unionByName(body).filter(F.col("value").isNotNull())

    @cached_property
    def asylum_cells(self) -> DataFrame:
        """A pivoted worksheet with a row per nation: admissions by year, every fifth count suppressed."""
        years = sorted(r[0] for r in self.permanent.select("ref_year").distinct().collect())
        counts = self.permanent.join(self.table("nation"), F.col("country") == F.col("n_name")).select(
            (F.col("n_nationkey") + 5).cast("bigint").alias("row_idx"),
            (F.col("ref_year") - F.lit(years[0] if years else 0) + 2).cast("int").alias("col_idx"),
            F.when(F.col("count") % 5 == 0, "--").otherwise(F.format_number("count", 0)).alias("value"),
        )
        names = self.table("nation").select(
            (F.col("n_nationkey") + 5).cast("bigint").alias("row_idx"), F.lit(0).alias("col_idx"), F.col("n_name").alias("value")
        )
        preamble = [(0, 0, "Claimants by country"), (2, 0, "Country"), (2, 1, "Category"), (4, 0, "All countries")]
        preamble += [(2, y - years[0] + 2, str(y)) for y in years] + [(3, y - years[0] + 2, f"{y} Total") for y in years]
        top = self.spark.createDataFrame(preamble, "row_idx bigint, col_idx int, value string")
        return top.unionByName(names).unionByName(counts).select(
            F.lit("claimants").alias("sheet"), "row_idx", "col_idx", "value", F.lit(True).alias("is_text")
        )

    @cached_property
    def country_lines(self) -> DataFrame:
        """The permit extract as lines of text; some have a field too many."""
        columns = ["EN_YEAR", "EN_COUNTRY_OF_CITIZENSHIP", "TOTAL"]
        country = F.when(F.col("s_nationkey") != 7, F.col("n_name"))
        rows = self.shipments.select(F.year("l_shipdate").cast("string").alias(columns[0]), country.alias(columns[1]),
                                     self._dirty_total().alias(columns[2]), "l_orderkey")
        line = F.concat_ws("\t", *[F.coalesce(c, F.lit("")) for c in columns])
        return rows.select(
            F.pmod(F.xxhash64("l_orderkey"), F.lit(8)).alias("file"), F.lit(1).alias("place"),
            F.when(F.col("l_orderkey") % 97 == 0, F.concat(line, F.lit("\tsurplus"))).otherwise(line).alias("value"),
        ).unionByName(self.spark.range(8).select(F.col("id").alias("file"), F.lit(0).alias("place"), F.lit("\t".join(columns)).alias("value")))

    @cached_property
    def packages(self) -> DataFrame:
        """Package responses as JSON lines, of twenty resources each: with fields nobody knows, without fields
        one might expect, with failed requests, and with lines cut off."""
        number = F.call_function("div", F.col("p_partkey"), F.lit(20))
        resource = F.struct(
            F.concat(F.lit("r"), F.lpad(F.col("p_partkey").cast("string"), 12, "0")).alias("id"), F.col("p_name").alias("name"),
            F.when(F.col("p_size") % 3 > 0, F.col("p_type")).alias("description"),
            F.when(F.col("p_size") % 2 == 0, "CSV").when(F.col("p_size") % 5 > 0, "xlsx").alias("format"),
            F.lpad(F.col("p_size").cast("string"), 3, "0").alias("last_modified"),
            F.struct(F.col("p_retailprice").alias("price")).alias("extras"),
        )
        whole = self.table("part").groupBy(number.alias("number")).agg(F.collect_list(resource).alias("resources")).select(
            "number",
            F.to_json(F.struct(
                (F.col("number") % 11 != 3).alias("success"), F.lit("x").alias("help"),
                F.struct(F.concat(F.lit("set "), F.col("number").cast("string")).alias("id"), "resources").alias("result"),
            )).alias("value"),
        )
        return whole.select(F.when(F.col("number") % 13 == 5, F.substring("value", 1, 100)).otherwise(F.col("value")).alias("value"))

    @cached_property
    def source_loads(self) -> DataFrame:
        failed = F.col("value") < 3
        return self.table("events").select(
            F.col("event_id").alias("load_id"),
            F.col("user_id").alias("run_id"),
            F.col("event_type").alias("dataset_key"),
            F.when(failed, "failed").otherwise("success").alias("status"),
            F.when(~failed, F.col("props")).alias("reference_period"),
            F.col("ts").alias("loaded_at"),
        )

    @cached_property
    def dataset_loads(self) -> DataFrame:
        """The load log with the names of three warehouse tables for three kinds of events."""
        names = {"click": "population_quarterly", "error": "npr_by_type_quarterly", "view": "status_breakdown_census"}
        known = F.coalesce(*[F.when(F.col("dataset_key") == kind, name) for kind, name in names.items()])
        return self.source_loads.withColumn("dataset_key", known)

    @cached_property
    def catalog(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_brand").alias("dataset_id"),
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("description"),
            F.when(F.col("p_size") % 2 == 0, "csv").otherwise("xlsx").alias("format"),
            F.col("p_size").alias("last_modified"),
        )

    # -- targets for apportionment --------------------------------------------

    @cached_property
    def category_weights(self) -> DataFrame:
        """Countries of the latest census and of the latest complete admission year."""
        latest = F.lit(max(CENSUS_YEARS))
        nat = self.naturalized.filter(F.col("census_year") == latest).select(
            F.lit("naturalized").alias("category"), "country", "count"
        )
        per = self.permanent.filter(F.col("ref_year") == AS_OF - 1).select(
            F.lit("permanent_resident").alias("category"), "country", "count"
        )
        return nat.unionByName(per)

    @cached_property
    def part_weights(self) -> DataFrame:
        """Line items by flag and part: many keys, most of them with equal weights."""
        key = F.concat(F.lit("Part#"), F.lpad(F.col("l_partkey").cast("string"), 9, "0"))
        return (
            self.table("lineitem")
            .filter(all_present("l_returnflag", "l_partkey"))
            .groupBy(F.col("l_returnflag").alias("category"), "l_partkey")
            .agg(F.count("*").alias("count"))
            .select("category", key.alias("part"), "count")
        )


def thirds(weights: DataFrame) -> DataFrame:
    """A target per category that its weights do not divide evenly."""
    total = F.sum("count")
    return weights.groupBy("category").agg((div(total * 7, F.lit(3)) + 1).alias("target"))
