"""Domain tables derived from the test tables.

Each function derives one input table of the library from whole test tables.
The same rules stand as SQL in ``catalogue.sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.harness import with_shared_folder
from tarmac.plans.mapping import latest_exposure, renamed_exposure, with_policy_features
from tarmac.sources.session import adaptive, freeze

# Logged requests of an address, by its id modulo 12: retry, step, status. Without
# a status no answer came.
GEOCODE_REQUESTS = [
    [(1, 0, 200)],
    [(1, 0, 200)],
    [(1, 0, 200)],
    [(1, 0, 429), (2, 0, 200)],
    [(1, 0, 400), (1, 1, 400), (1, 2, 200)],
    [(1, 0, 503), (2, 0, 503), (3, 0, 503)],
    [(1, 0, 429), (2, 0, 429), (3, 0, 429)],
    [(1, 0, 503), (2, 0, 200)],
    [(1, 0, 400), (1, 1, 400), (1, 2, 400), (2, 0, 503), (3, 0, 400), (3, 1, 200)],
    [(1, 0, None), (2, 0, None), (3, 0, None)],
    [(1, 0, 503), (2, 0, None), (3, 0, 200)],
    [(retry, step, 400) for retry in (1, 2, 3) for step in (0, 1, 2)],
]
REWARD_MONTH = "202401"
RUN_TS = "2024-02-03 06:00:00"
FIXED_CENTERS = [0.33, 0.59, 0.71]
FIXED_BANDWIDTH = 0.07
#: Customers that one task turns into logs and answers, which are many times their size.
CUSTOMER_ROWS = 20_000
#: Order lines beyond which the mapping stores the exposure before it ranks its rows.
MANY_LINES = 1_000_000


def run_ts() -> Column:
    return F.lit(RUN_TS).cast("timestamp")


class Testbed:
    """Domain tables of one scale factor."""

    __test__ = False  # not a test class, whatever its name

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = adaptive(with_shared_folder(spark))
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}
        self._frozen: dict[str, DataFrame] = {}

    def frozen(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table that several steps of one query read: written once."""
        if name not in self._frozen:
            self._frozen[name] = freeze(build(), name)
        return self._frozen[name]

    def known(self, name: str) -> DataFrame | None:
        return self._frozen.get(name)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def customers(self) -> DataFrame:
        """Customers for tables that hold far more for each: dealt over as many tasks as
        their number asks for. As they are stored, one task may read them all."""
        if "dealt customers" not in self._tables:
            customers = self.table("customer")
            tasks = -(-customers.count() // CUSTOMER_ROWS)
            self._tables["dealt customers"] = customers.repartition(tasks) if tasks > 1 else customers
        return self._tables["dealt customers"]

    def many_lines(self) -> bool:
        return self.table("lineitem").count() > MANY_LINES

    def insured_lines(self) -> DataFrame:
        return with_policy(
            self.table("lineitem").join(
                self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")
            )
        )

    def mi_exposure(self) -> DataFrame:
        """Monthly insured-item exposure under its raw column names."""
        c = F.col
        # customers meet orders, of which there are fewer than lines
        orders = self.table("orders").join(
            self.table("customer"), c("o_custkey") == c("c_custkey")
        )
        lines = with_policy(
            self.table("lineitem")
            .join(orders, c("l_orderkey") == c("o_orderkey"))
            .join(self.table("part"), c("l_partkey") == c("p_partkey"))
        )
        number = c("l_linenumber")
        slash = F.when(c("l_orderkey") % 97 == 0, "").otherwise(
            F.concat(F.lit("/"), number.cast("string"))
        )
        month = (
            F.when(c("l_suppkey") % 4 == 0, "202311")
            .when(c("l_suppkey") % 4 == 1, "202312")
            .when(c("l_suppkey") % 4 == 2, "202401")
            .otherwise("202402")
        )
        paid = (
            F.when(c("l_orderkey") % 89 == 0, F.lit(None).cast("double"))
            .when(c("l_orderkey") % 101 == 0, F.lit(-5.0))
            .when((c("l_returnflag") == "N") & number.isin(1, 7), F.lit(0.0))
            .otherwise(c("l_quantity") * 10)
        )
        status = (
            F.when(number.isin(4, 5) & (c("l_linestatus") == "F"), " Policy ")
            .when((number == 3) & (c("l_linestatus") == "O"), "Cancelled")
            .otherwise("Policy")
        )
        cancelled = F.when(number == 6, "2024-03-15 00:00:00").when(
            number == 7, "2024-06-30 00:00:00"
        )
        year = F.substring(month, 1, 4).cast("int")
        month_number = F.substring(month, 5, 2).cast("int")
        quarter = F.floor((month_number + 2) / 3).cast("int")
        return lines.select(
            F.lit("core").alias("SourceData"),
            F.concat(F.substring("c_mktsegment", 1, 3), F.lit("-"), "policy", slash).alias(
                "PolicyNo"
            ),
            c("policy").alias("PolicyNumber"),
            c("o_orderdate").alias("PolicyInceptionDate"),
            c("l_shipdate").alias("ItemInceptionDate"),
            F.when(c("o_orderstatus") == "F", c("l_shipdate")).alias("CancelledDate"),
            c("o_orderdate").alias("EFF_FROM_DATE"),
            c("l_shipdate").alias("EFF_TO_DATE"),
            c("o_orderpriority").alias("SectionCode"),
            c("p_type").alias("CoverCode"),
            c("p_name").alias("ItemDescription"),
            c("p_brand").alias("VehMake"),
            c("p_type").alias("VehModel"),
            F.concat(F.lit("REG"), c("l_partkey").cast("string")).alias("Registration"),
            F.concat_ws(
                "-", F.concat(F.lit("VIN"), "l_partkey"), c("l_suppkey").cast("string")
            ).alias("VinNumber"),
            c("imei").alias("IMEINumber"),
            c("l_extendedprice").cast("decimal(18,2)").alias("CoverPremium"),
            c("p_retailprice").alias("CoverSumInsured"),
            c("p_size").cast("string").alias("CoverDescription"),
            status.alias("PolicyStatus"),
            status.alias("CoverStatus"),
            c("asset").alias("LOB_ASSET_ID"),
            F.concat(F.lit("raw-"), c("l_partkey").cast("string")).alias("ItemNo"),
            c("l_returnflag").alias("PolicyCancellationReasonCode"),
            c("l_shipdate").alias("enddate"),
            c("o_orderdate").alias("effectivefromdate"),
            c("l_shipdate").alias("effectivetodate"),
            month.alias("EffectiveYearMonth"),
            year.alias("EffectiveYear"),
            quarter.alias("EffectiveQuarter"),
            month_number.alias("EffectiveMonth"),
            F.concat(year.cast("string"), F.lit("Q"), quarter.cast("string")).alias(
                "EffectiveYearQuarter"
            ),
            cancelled.cast("timestamp_ntz").alias("ItemCancelledDate"),
            paid.cast("decimal(18,2)").alias("PremiumPaid"),
            c("asset").alias("ACTIVE_LOB_ASSET_ID"),
        )

    def exposure(self) -> DataFrame:
        """Exposure as the mapping stores it, as far as the rewards read it."""
        latest = latest_exposure(with_policy_features(renamed_exposure(self.mi_exposure())))
        return latest.select(
            "policy_number",
            F.col("lob_asset_id").alias("item_no"),
            "imei_number",
            "effective_year_month",
            "policy_status",
            "cover_status",
            F.col("item_cancelled_date").alias("item_cancellation_date"),
            F.col("cover_premium").alias("premium"),
            "premium_collected",
            "item_description",
            F.col("item_no_raw").alias("original_lob_asset_id"),
            F.timestamp_add("DAY", loaded_days(), run_ts()).alias("inserted_timestamp"),
        )

    def devices(self) -> DataFrame:
        """Device rows per policy and item."""
        installed = F.when(
            F.col("l_linenumber") != 1,
            F.timestamp_add(
                "DAY", (F.col("l_orderkey") % 30).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")
            ),
        )
        return self.insured_lines().select(
            F.col("policy").alias("policy_number"),
            F.col("asset").alias("item_no"),
            F.col("l_shipdate").alias("inserted_datetime"),
            F.col("imei").alias("imei_number"),
            installed.alias("installation_datetime"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"),
        )

    def user_imei(self) -> DataFrame:
        """Retrievals of device users."""
        return self.table("events").select(
            F.col("user_id").cast("string").alias("imei_number"),
            F.col("ts").alias("retrieved_datetime"),
            user_text().alias("sentiance_id"),
        )

    def trips(self) -> DataFrame:
        """Trips; some users drove only in earlier or only in later months."""
        c = F.col
        shift = (
            F.when(c("user_id") % 10 == 0, -1)
            .when(c("user_id") % 10 == 1, -3)
            .when(c("user_id") % 10 == 2, 1)
            .otherwise(0)
        )
        minutes = F.floor("value").cast("int") + F.when(
            c("event_id") % 40 == 0, 15 * 24 * 60
        ).otherwise(0)
        start = F.timestamp_add("MONTH", shift, c("ts"))
        end = F.timestamp_add("MINUTE", minutes, start)
        late = F.when((F.hour(start) >= 23) | (F.hour(start) < 4), 1).otherwise(0)
        skill = c("user_id") % 5

        def fraction(step, level):
            return ((c("event_id") * step) % 101 * 6 + level * 100) / F.lit(1000.0)

        measures = [
            ("hard_accel", fraction(37, 4 - skill)),
            ("hard_brake", fraction(53, 4 - skill)),
            ("legal", fraction(71, skill)),
            ("overall_score", fraction(29, skill)),
            ("distance", c("value")),
            ("trip_duration", c("value") * 60),
            ("late_drive_duration", late * c("value") * 30),
            ("late_drive", late),
        ]
        written = "yyyy-MM-dd HH:mm:ss"
        return self.table("events").select(
            user_text().alias("sentiance_id"),
            F.date_format(start, written).alias("start_ts"),
            F.date_format(end, written).alias("end_ts"),
            *[
                F.when((c("event_id") % 13 != r) & (c("user_id") != 7), value).alias(name)
                for r, (name, value) in enumerate(measures)
            ],
        )

    def addresses(self) -> DataFrame:
        """Addresses; some ids come a second time, empty or with an older address."""
        named = self.customers().join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        key, whole = F.col("c_custkey"), F.concat_ws(", ", "c_name", "n_name")
        first = F.when(key % 50 == 0, "").otherwise(whole)
        more = (
            F.when(key % 25 == 3, F.array(first, F.lit("")))
            .when(key % 25 == 7, F.array(first, F.concat(whole, F.lit(" (old)"))))
            .otherwise(F.array(first))
        )
        return named.select(key.alias("id"), F.explode(more).alias("address"))

    def geocode_log(self) -> DataFrame:
        """Requests per address: retry and step, status, reason and response body."""
        lists = F.array(
            *[
                F.array(*[F.struct(F.lit(r), F.lit(s), F.lit(status)) for r, s, status in requests])
                for requests in GEOCODE_REQUESTS
            ]
        ).cast("array<array<struct<retry:int,step:int,status:int>>>")
        key = F.col("id")
        tried = (
            self.addresses()
            .filter(F.col("address") != "")
            .select("id", "address", F.inline(F.get(lists, (key % 12).cast("int"))))
        )
        # one in ten is asked once more, long after
        late = self.addresses().filter((F.col("address") != "") & (key % 10 == 9))
        tried = tried.union(
            late.select("id", "address", F.lit(9), F.lit(0), F.lit(200))
        )
        garbled = (F.col("status") == 200) & (F.col("retry") == 1) & (key % 5 == 4)
        reason = (
            F.when(F.col("status") == 200, "OK")
            .when(F.col("status") == 400, "Bad Request")
            .when(F.col("status") == 429, "Too Many Requests")
            .when(F.col("status").isNull(), "Connection refused")
            .otherwise("Service Unavailable")
        )
        count = (key % 6).cast("int")

        def candidate(rank):
            text = rank.cast("string")
            return F.concat(
                F.lit('{"type":"'),
                F.when(rank % 2 == 1, "Point Address").otherwise("Street"),
                F.lit('","score":'),
                (F.lit(10) - rank).cast("string"),
                F.lit('.5,"address":{"freeformAddress":"'),
                F.col("address"),
                F.lit(" #"),
                text,
                F.lit('","countryCode":"ZA","municipality":"M'),
                (key % 40).cast("string"),
                F.lit('","streetName":"Street '),
                text,
                F.lit('","postalCode":"'),
                (key % 9000 + 1000).cast("string"),
                F.lit('"},"position":{"lat":'),
                ((key % 1000 - 3500) / 100).cast("decimal(8,2)").cast("string"),
                F.lit(',"lon":'),
                ((key % 1300 + 1800) / 100).cast("decimal(8,2)").cast("string"),
                F.lit("}}"),
            )

        ranks = F.filter(F.sequence(F.lit(1), F.lit(5)), lambda r: r <= count)
        found = F.concat(
            F.lit('{"results":['), F.array_join(F.transform(ranks, candidate), ","), F.lit("]}")
        )
        refused = F.concat(F.lit("refused "), key.cast("string"), F.lit(" "), F.repeat(F.lit("x"), 320))
        return tried.select(
            "id",
            "address",
            "retry",
            "step",
            "status",
            reason.alias("reason"),
            F.when(garbled, F.when(key % 4 == 0, '{"results":[{"type":"Poi').otherwise("<html>busy</html>"))
            .when(F.col("status") == 200, found)
            .when(F.col("status").isNotNull(), refused)
            .alias("body"),
        )

    def _flood_items(self, delivered: Column, item: Column) -> DataFrame:
        """Response bodies with ten customers each, some answered twice."""
        key = F.col("c_custkey")
        twice = F.when(F.col("c_acctbal") > 9000, 2).otherwise(1)
        answers = self.customers().filter(delivered).select(
            F.floor(key / 10).alias("batch_id"),
            key,
            F.explode(F.sequence(F.lit(1), twice)).alias("copy"),
            item.alias("item"),
        )
        return answers.groupBy("batch_id").agg(
            F.concat(
                F.lit("["),
                F.array_join(
                    F.transform(
                        F.sort_array(F.collect_list(F.struct("c_custkey", "copy", "item"))),
                        lambda x: x["item"],
                    ),
                    ",",
                ),
                F.lit("]"),
            ).alias("body")
        )

    def flood_requests(self) -> DataFrame:
        """The request batches that flood answers belong to."""
        return self.table("customer").select(F.floor(F.col("c_custkey") / 10).alias("batch_id")).distinct()

    def flood_log(self) -> DataFrame:
        """Logged requests of each batch; batches in seven have none."""
        lists = F.array(
            F.array(F.lit(200)),
            F.array(F.lit(503), F.lit(200)),
            F.array(F.lit(429), F.lit(None).cast("int"), F.lit(200)),
            F.array(F.lit(503), F.lit(503), F.lit(503), F.lit(500)),
            F.array(F.lit(None).cast("int"), F.lit(None).cast("int")),
        )
        batch, status = F.col("batch_id"), F.col("status")
        return (
            self.flood_requests()
            .filter(batch % 7 != 6)
            .select("batch_id", F.posexplode(F.get(lists, (batch % 5).cast("int"))).alias("pos", "status"))
            .select(
                "batch_id",
                (F.col("pos") + 1).alias("retry"),
                "status",
                F.when(status == 200, "OK").when(status.isNull(), "Timed out").otherwise("Down").alias("reason"),
                F.when((status == 200) & (batch % 10 == 5), '[{"id":"7"},{')
                .when(status == 200, "[]")
                .when(status.isNotNull(), "try later").alias("body"),
            )
        )

    def flood_scores(self) -> DataFrame:
        key = F.col("c_custkey")
        names = [
            "River_Floodscore_Def", "River_Floodscore_UD", "Surfacewater_Floodscore_UD",
            "FloodScore_Def", "FloodScore_UD", "Floodability_Def", "Floodability_UD",
        ]
        parts = [F.concat(F.lit('{"id":"'), key.cast("string"), F.lit('"'))]
        for i, name in enumerate(names):
            value = ((key * (i + 3)) % 100).cast("string")
            parts.append(F.concat(F.lit(f',"{name}":'), value))
        return self._flood_items(F.col("c_acctbal") >= 0, F.concat(*parts, F.lit("}")))

    def flood_depths(self) -> DataFrame:
        key = F.col("c_custkey")
        level = (key % 10).cast("int")

        def hundredths(value):
            return (value / 100).cast("decimal(12,2)").cast("string")

        def peril(name, factor, last):
            parts = [F.lit(f'"{name}":{{')]
            for n, period in enumerate((20, 50, 100, 200, 500, 1500)):
                depth = level * (period * factor)
                parts += [
                    F.lit(f'{"," if n else ""}"rp_{period}":{{"ppa{period}":'),
                    (key % 100).cast("string"),
                    F.lit(f',"min{period}":'),
                    hundredths(depth),
                    F.lit(f',"max{period}":'),
                    hundredths(depth + 100),
                    F.lit(',"mean":'),
                    hundredths(depth + 50),
                    F.lit(',"std_dev":0.25}'),
                ]
            return [*parts, last, F.lit("}")]

        protection = F.concat(F.lit(',"sop":'), (key % 200).cast("string"))
        item = F.concat(
            F.lit('{"id":"'),
            key.cast("string"),
            F.lit('","stats":{'),
            *peril("FLRF_U", 1, protection),
            F.lit(","),
            *peril("FLSW_U", 2, F.lit("")),
            F.lit("}}"),
        )
        # the depth service knows nothing about one market segment in debt
        known = ~((F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") < 4000))
        # a few bodies broke off on the way
        broken = self.table("customer").filter(key % 100 == 0).select(
            F.floor(key / 10).alias("batch_id"),
            F.concat(F.lit('[{"id":"'), key.cast("string"), F.lit('"},{"id":"')).alias("body"),
        )
        return self._flood_items(known, item).unionByName(broken)


DERIVED = (
    "mi_exposure", "exposure", "devices", "user_imei", "trips",
    "addresses", "geocode_log", "flood_requests", "flood_log", "flood_scores", "flood_depths",
)


class StoredTestbed(Testbed):
    """Domain tables as a job finds them: stored, not derived on every read."""

    def __init__(self, spark: SparkSession, folder: str, stored: dict[str, DataFrame]):
        super().__init__(spark, folder)
        for name in DERIVED:
            setattr(self, name, lambda table=stored[name]: table)


def stored_tables(tb: Testbed) -> dict[str, DataFrame]:
    return {name: freeze(getattr(tb, name)(), name) for name in DERIVED}


def loaded_days() -> Column:
    """Loads lie days apart; for some policies a later month was loaded first."""
    month = F.col("effective_year_month").cast("int") % 100
    early = (F.col("policy_number").cast("int") % 3 == 0) & (month == 2)
    return F.when(early, -9).otherwise(month % 3).cast("int")


def with_policy(lines: DataFrame) -> DataFrame:
    """Policy, asset and device of order lines; made last, as they travel as text."""
    return lines.withColumn("policy", F.col("o_custkey").cast("string")).withColumn(
        "asset", F.concat_ws("-", "policy", (F.col("l_partkey") % 3).cast("string"))
    ).withColumn("imei", device_of(F.col("o_custkey")))


def device_of(customer: Column) -> Column:
    """Ten customers share a device; one in eight has a device without users."""
    unknown = F.concat(F.lit("x"), customer.cast("string"))
    shared = F.floor(customer / 10).cast("string")
    return F.when(customer % 8 == 5, unknown).otherwise(shared)


def user_text() -> Column:
    return F.concat(F.lit("s"), F.col("user_id").cast("string"))
