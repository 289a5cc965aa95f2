"""The test tables seen as the engine's inputs.

Every view is deterministic arithmetic on keys of the given tables, over all of their rows, so that an
independent SQL engine can repeat it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfline.functions.dates import month_of, week_ending, week_of
from shelfline.functions.numbers import units
from shelfline.operators.scd2 import derive_customer, derive_product, drop_noop, rebuild_scd2, with_surrogate_key
from shelfline.operators.series import fx_daily
from shelfline.session import pin

# Fixed values of the adapters.
CURRENCIES = ("EUR", "PLN", "GBP", "CHF", "SEK")
BASE_RATES = {"PLN": 4.6, "GBP": 0.85, "CHF": 1.03, "SEK": 10.6}
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
CHANNELS = ("Modern trade", "Traditional trade", "E-commerce")
CUSTOMER_TYPES = ("Retail chain", "Wholesaler", "Online retailer")
TYPE_OF_CHANNEL = {"Modern trade": "Retail chain", "Traditional trade": "Wholesaler"}
CUSTOMER_FIELDS = ("customer_name", "channel", "key_account_manager", "credit_limit_eur")
PROFILE_FIELDS = ("signup", "view", "click")
PRODUCT_START = "1990-01-01 00:00:00"
BASE_YEAR = 1996
LAST_MONTH = 7


def text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def instant(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def plus_days(start: str, days: Column) -> Column:
    return instant(start) + F.make_dt_interval(days.cast("int"))


def from_cents(cents: Column) -> Column:
    return cents.cast("decimal(14,0)") * F.lit("0.01").cast("decimal(3,2)")


def net_amount() -> Column:
    """Price after discount, half up to cents."""
    paid = units(F.col("l_extendedprice"), 2) * (100 - units(F.col("l_discount"), 2))
    return from_cents(F.call_function("div", paid + 50, F.lit(100))).cast("decimal(14,2)")


def ean_of(number: Column) -> Column:
    """Barcode of an item number, by integer arithmetic: numbers count on from 7609 0000 0000."""
    body = number.cast("bigint") + 760_900_000_000
    digit = lambda place: F.call_function("div", body, F.lit(10**place)) % 10
    weighted = sum((digit(p) * (3 if p % 2 == 0 else 1) for p in range(12)), F.lit(0))
    return text(body * 10 + (10 - weighted % 10) % 10)


def entries(*rows: tuple[Column, dict[str, Column]]) -> Column:
    """Array of the audit entries whose condition holds."""
    made = [F.when(use, F.struct(*[v.alias(n) for n, v in fields.items()])) for use, fields in rows]
    return F.array_compact(F.array(*made))


class DriverViews:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._schemas: dict[str, StructType] = {}

    def table(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in self._schemas:
            self._schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[path]).parquet(path)

    # reference data ------------------------------------------------------------------------------------

    @cached_property
    def regions(self) -> DataFrame:
        """Country to region; nation and region are fixed-size lists."""
        region = F.broadcast(self.table("region"))
        joined = self.table("nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        return joined.select(text("n_nationkey").alias("country_code"), F.col("r_name").alias("region"))

    @cached_property
    def countries(self) -> DataFrame:
        return self.table("nation").select(
            text("n_nationkey").alias("country_code"),
            F.col("n_name").alias("country_name"),
            pick(CURRENCIES, F.col("n_nationkey") % 5).alias("currency"),
        )

    @cached_property
    def aliases(self) -> DataFrame:
        nation = self.table("nation")
        code = text("n_nationkey").alias("country_code")
        return nation.select(F.upper("n_name").alias("alias"), code).unionByName(
            nation.select(F.concat(F.lit("N"), text("n_nationkey")).alias("alias"), code)
        )

    @cached_property
    def distributors(self) -> DataFrame:
        number = (F.col("s_suppkey") % 20).alias("n")
        return self.table("supplier").select(number).distinct().select(
            F.concat(F.lit("C"), F.lpad(text("n"), 6, "0")).alias("distributor_id"),
            F.concat(F.lit("Distributor "), text("n")).alias("distributor_name"),
            text("n").alias("country_code"),
        )

    # customers and products: histories are stored once before facts are joined to them -----------------------------------------------------------------------------

    @cached_property
    def customers(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").select(
            text(k).alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            text("c_nationkey").alias("country_code"),
            pick(CHANNELS, k % 3).alias("channel"),
            pick(CUSTOMER_TYPES, k % 3).alias("customer_type"),
            F.concat(F.lit("KAM "), text(k % 40)).alias("key_account_manager"),
            (1000 + (k % 50) * 100).cast("int").alias("credit_limit_eur"),
            F.concat(F.lit("Contact "), text(k)).alias("contact_name"),
            F.concat(F.lit("mail"), text(k), F.lit("@example.com")).alias("contact_email"),
            F.when(k % 8 != 0, F.concat(F.lit("+00 "), text(k))).alias("contact_phone"),
            F.concat(F.lit("VAT"), text(k)).alias("vat_number"),
            plus_days("1994-01-01", k % 200).alias("created_at"),
            (k % 25 == 1).alias("is_distributor"),
        )

    @cached_property
    def customer_changes(self) -> DataFrame:
        k = F.col("c_custkey")
        kam, none = F.concat(F.lit("KAM "), text(k % 40)), F.lit(None).cast("string")
        channel, credit = pick(CHANNELS, k % 3), text(1000 + (k % 50) * 100)

        def entry(number, use, field, old, new, at):
            old, new = (v if isinstance(v, Column) else F.lit(v) for v in (old, new))
            at = at if isinstance(at, Column) else instant(at)
            values = {"change_id": k * 16 + number, "field_name": F.lit(field), "old_value": old, "new_value": new, "changed_at": at}
            return use, values

        name = F.col("c_name")
        made = entries(
            entry(1, k % 7 == 0, "channel", "Traditional trade", channel, "1997-06-15 14:00:00"),
            entry(2, k % 5 == 0, "key_account_manager", "KAM 99", kam, plus_days("1998-01-10 09:00:00", k % 100)),
            entry(3, k % 10 == 0, "credit_limit_eur", "500", "750", "1996-03-01 08:00:00"),
            entry(4, k % 10 == 0, "credit_limit_eur", "750", credit, "1999-03-01 08:00:00"),
            entry(5, k % 35 == 0, "customer_name", F.concat(F.lit("Old "), name), name, "1997-06-15 14:00:00"),
            entry(6, k % 14 == 0, "key_account_manager", "KAM 7", "KAM 99", "1993-06-01 00:00:00"),
            entry(7, k % 21 == 0, "key_account_manager", "KAM 5", none, "1995-12-01 10:00:00"),
            entry(8, k % 21 == 0, "key_account_manager", none, "KAM 99", "1996-02-01 10:00:00"),
            entry(9, k % 9 == 0, "vat_number", "x", "y", "1998-08-08 00:00:00"),
            entry(10, k % 50 == 3, "channel", channel, channel, "1999-09-09 00:00:00"),
        )
        return self.table("customer").select(text(k).alias("customer_id"), F.inline(made))

    @cached_property
    def customers_scd2(self) -> DataFrame:
        rebuilt = rebuild_scd2(
            self.customers, drop_noop(self.customer_changes), "customer_id", "created_at", CUSTOMER_FIELDS
        )
        return pin(with_surrogate_key(derive_customer(rebuilt, TYPE_OF_CHANNEL), "customer_id", "customer_sk"), "customers")

    @cached_property
    def products(self) -> DataFrame:
        k, size = F.col("p_partkey"), F.col("p_size")
        shrunk = k % 10 == 0
        pack = F.concat(text(size * F.when(shrunk, 9).otherwise(10)), F.lit(" g"))
        per_step = F.when(shrunk, F.lit("0.09")).otherwise(F.lit("0.10")).cast("decimal(3,2)")
        return self.table("part").select(
            k.alias("sku"),
            F.concat_ws(" ", "p_name", pack).alias("product_name"),
            F.col("p_brand").alias("brand"),
            F.col("p_type").alias("category"),
            F.concat(F.lit("size "), text(size % 5)).alias("subcategory"),
            pack.alias("pack_size"),
            (6 + (size % 4) * 6).alias("units_per_case"),
            ((10 + size) * per_step).cast("decimal(9,2)").alias("case_weight_kg"),
            ean_of(k).alias("ean"),
            F.when(k % 20 == 0, "Discontinued").otherwise("Active").alias("status"),
            F.date_add(F.lit("1990-01-01").cast("date"), (k % 1000).cast("int")).alias("launch_date"),
            F.when(k % 20 == 0, F.lit("2000-12-31").cast("date")).alias("discontinued_date"),
            instant(PRODUCT_START).alias("valid_start"),
        )

    @cached_property
    def product_changes(self) -> DataFrame:
        k, size = F.col("p_partkey"), F.col("p_size")
        grams = lambda factor: F.concat(text(size * factor), F.lit(" g"))
        made = entries(
            (
                k % 10 == 0,
                {"change_id": k * 2, "old_value": grams(10), "new_value": grams(9), "changed_at": instant("1998-03-01 00:00:00")},
            ),
            (
                k % 50 == 1,
                {"change_id": k * 2 + 1, "old_value": grams(10), "new_value": grams(10), "changed_at": instant("1999-01-01 00:00:00")},
            ),
        )
        return self.table("part").select(k.alias("sku"), F.lit("pack_size").alias("field_name"), F.inline(made))

    @cached_property
    def products_scd2(self) -> DataFrame:
        rebuilt = rebuild_scd2(self.products, drop_noop(self.product_changes), "sku", "valid_start", ["pack_size"])
        return pin(with_surrogate_key(derive_product(rebuilt), "sku", "product_sk"), "products")

    # event profiles: a log with few keys and many entries per key -----------------------------------------

    @cached_property
    def profile_changes(self) -> DataFrame:
        return self.table("events").filter(F.col("event_type").isin(*PROFILE_FIELDS)).select(
            F.col("event_id").alias("change_id"),
            "user_id",
            F.col("event_type").alias("field_name"),
            F.get_json_object("props", "$.k").alias("old_value"),
            text("value").alias("new_value"),
            F.col("ts").alias("changed_at"),
        )

    @cached_property
    def profiles(self) -> DataFrame:
        newest = [
            F.coalesce(
                F.max_by(text("value"), F.when(F.col("event_type") == f, F.struct("ts", "event_id"))), F.lit("none")
            ).alias(f)
            for f in PROFILE_FIELDS
        ]
        return self.table("events").groupBy("user_id").agg(F.min("ts").alias("first_seen"), *newest)

    @cached_property
    def profiles_scd2(self) -> DataFrame:
        rebuilt = rebuild_scd2(self.profiles, drop_noop(self.profile_changes), "user_id", "first_seen", PROFILE_FIELDS)
        return pin(rebuilt, "profiles")

    # orders ---------------------------------------------------------------------------------------------

    @cached_property
    def orders(self) -> DataFrame:
        """Headers; currency and channel come from the ordering customer."""
        k = F.col("o_orderkey")
        customer = self.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        joined = self.table("orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
        status = F.when(k % 125 == 0, "Cancelled").when(F.col("o_orderstatus") == "O", "Open").otherwise("Invoiced")
        return joined.select(
            k.alias("order_id"),
            text("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            pick(CURRENCIES, F.col("c_nationkey") % 5).alias("currency"),
            status.alias("order_status"),
            F.col("c_mktsegment").alias("sales_channel"),
            (k % 500 == 1).alias("is_deleted"),
        )

    @cached_property
    def order_lines(self) -> DataFrame:
        qty = F.col("l_quantity").cast("bigint")
        cents = units(F.col("l_extendedprice"), 2)
        # half-up division in whole cents
        unit_cents = F.call_function("div", 2 * cents + qty, 2 * qty)
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").alias("sku"),
            qty.cast("int").alias("qty_cases"),
            from_cents(unit_cents).cast("decimal(12,2)").alias("list_price_case"),
            F.col("l_discount").cast("decimal(6,4)").alias("discount_pct"),
            net_amount().alias("net_amount"),
            F.when(F.col("l_discount") >= 0.08, F.concat(F.lit("P"), text("l_orderkey"))).alias("promo_id"),
            F.concat(F.lit("C"), F.lpad(text(F.col("l_suppkey") % 20), 6, "0")).alias("distributor_id"),
        )

    @cached_property
    def returns(self) -> DataFrame:
        return self.table("lineitem").filter("l_returnflag = 'R'").select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("return_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_shipdate").cast("date").alias("return_date"),
            F.col("l_quantity").cast("int").alias("qty_cases"),
            F.concat(F.lit("R"), text(F.col("l_linenumber") % 3)).alias("reason_code"),
            net_amount().alias("credit_amount"),
        )

    @cached_property
    def promotions(self) -> DataFrame:
        """One promotion per order, run with its customer for one category; every 50th ends before it starts."""
        k = F.col("o_orderkey")
        start, weeks = week_of(F.col("o_orderdate").cast("date")), (1 + k % 3).cast("int")
        discount = (10 + 5 * (k % 5)).cast("decimal(5,0)") * F.lit("0.01").cast("decimal(3,2)")
        return self.table("orders").select(
            F.concat(F.lit("P"), text(k)).alias("promo_id"),
            text("o_custkey").alias("customer_id"),
            pick(CATEGORIES, k % 6).alias("category"),
            F.concat(F.lit("mechanic "), text(k % 3)).alias("mechanic"),
            discount.alias("discount_pct"),
            start.alias("start_date"),
            F.when(k % 50 == 0, F.date_sub(start, 8)).otherwise(F.date_add(start, 7 * weeks - 1)).alias("end_date"),
            weeks.alias("duration_weeks"),
            (discount * 400).alias("planned_uplift_pct"),
        )

    # public series and price tables --------------------------------------------------------------------------

    def published_rates(self, days: DataFrame) -> DataFrame:
        """Rates on the weekdays of ``day``; ``days`` is a distinct list of dates."""
        rate = F.lit(0.0)
        for currency, base in BASE_RATES.items():
            rate = F.when(F.col("currency") == currency, F.lit(base)).otherwise(rate)
        foreign = self.countries.select("currency").distinct().filter("currency <> 'EUR'")
        weekdays = days.filter(F.weekday("day") < 5)
        return weekdays.crossJoin(F.broadcast(foreign)).select(
            F.col("day").alias("rate_date"),
            "currency",
            F.round(rate + 0.01 * (F.dayofyear("day") % 7), 2).alias("rate_per_eur"),
        )

    @cached_property
    def order_days(self) -> DataFrame:
        """Stored: the calendar and everything that follows from it is read many times."""
        return pin(self.table("orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct(), "order-days")

    @cached_property
    def order_span(self) -> DataFrame:
        """First and last order day, one row."""
        return self.order_days.agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))

    @cached_property
    def fx(self) -> DataFrame:
        return pin(fx_daily(self.published_rates(self.order_days)), "rates")

    @cached_property
    def event_fx(self) -> DataFrame:
        days = self.table("events").select(F.col("ts").cast("date").alias("day")).distinct()
        return fx_daily(self.published_rates(days))

    @cached_property
    def standard_cost(self) -> DataFrame:
        span = self.order_span.select(F.trunc("first_day", "quarter").alias("a"), F.col("last_day").alias("b"))
        quarters = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 3 MONTHS"))).alias("q"))
        index = (500 + 5 * (4 * (F.year("q") - 1995) + F.quarter("q"))).cast("decimal(6,0)") * F.lit("0.001").cast("decimal(4,3)")
        quarters = quarters.select(
            F.concat(text(F.year("q")), F.lit("Q"), text(F.quarter("q"))).alias("fiscal_quarter"), index.alias("cost_index")
        )
        # quarters of the calendar, a few dozen rows
        return self.table("part").crossJoin(F.broadcast(quarters)).select(
            F.col("p_partkey").alias("sku"),
            "fiscal_quarter",
            (F.col("p_retailprice").cast("decimal(12,2)") * F.col("cost_index")).cast("decimal(12,2)").alias("std_cost_eur_case"),
        )

    @cached_property
    def price_list(self) -> DataFrame:
        """Half-yearly prices; SKUs ending in 7 have a gap, SKUs ending in 8 an overlap."""
        halves = F.transform(F.sequence(F.lit(0), F.lit(13)), lambda k: k.cast("int"))
        start = F.add_months(F.lit("1995-01-01").cast("date"), F.col("k") * 6)
        last = F.date_sub(F.add_months(start, 6), 1)
        shift = F.when((F.col("p_partkey") % 10 == 7) & (F.col("k") == 3), -2).when(
            (F.col("p_partkey") % 10 == 8) & (F.col("k") == 5), 4
        ).otherwise(0)
        price = F.col("p_retailprice").cast("decimal(12,2)") * (100 + 2 * F.col("k")).cast("decimal(5,0)") * F.lit("0.01").cast("decimal(3,2)")
        return self.table("part").withColumn("k", F.explode(halves)).select(
            F.col("p_partkey").alias("sku"),
            price.cast("decimal(12,2)").alias("list_price_case"),
            start.alias("valid_from"),
            F.when(F.col("k") == 13, F.lit("9999-12-31").cast("date")).otherwise(F.date_add(last, shift)).alias("valid_to"),
        )

    @cached_property
    def weather_raw(self) -> DataFrame:
        """Daily text rows per country, as they come from a file."""
        days = self.order_span.select(F.explode(F.sequence("first_day", "last_day")).alias("d"))
        doy = F.dayofyear("d")
        mean = F.round(10 + 9 * F.cos(2 * F.pi() * (doy - 200) / 365) + F.col("n_nationkey") % 3, 2)
        return days.crossJoin(F.broadcast(self.table("nation").select("n_nationkey", "n_name"))).select(
            text("n_nationkey").alias("country_code"),
            F.col("n_name").alias("city"),
            text("d").alias("weather_date"),
            text(mean).alias("temperature_2m_mean"),
            text(F.round(mean + 4, 2)).alias("temperature_2m_max"),
            text(doy % 5).alias("precipitation_sum"),
        )

    @cached_property
    def inflation_raw(self) -> DataFrame:
        """Monthly text rows per country; country 7 misses one month."""
        span = self.order_span.select(month_of(F.col("first_day")).alias("a"), F.col("last_day").alias("b"))
        months = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("m"))
        number = (F.year("m") - 1995) * 12 + F.month("m")
        index = F.round(100 + 0.3 * number + F.col("n_nationkey") % 3, 1)
        rows = months.crossJoin(F.broadcast(self.table("nation").select("n_nationkey")))
        return rows.filter((F.col("n_nationkey") != 7) | (F.col("m") != F.lit("1997-05-01").cast("date"))).select(
            text("n_nationkey").alias("country_code"),
            F.date_format("m", "yyyy-MM").alias("month"),
            text(index).alias("index_value"),
            F.lit("statistics office").alias("source"),
        )

    # sell-out files -------------------------------------------------------------------------------------------

    @cached_property
    def sellout_raw(self) -> DataFrame:
        """All line items as dirty distributor rows under the common raw names (``layout`` tells the dialect);
        some orders were sent twice."""
        n, dirt = F.col("l_suppkey") % 20, F.col("l_orderkey") % 997
        layout = F.when(n < 14, "A").when(n < 18, "B").otherwise("JSON")
        week = week_ending(F.col("l_shipdate").cast("date"))
        number = F.lpad(text(n), 6, "0")
        qty = F.col("l_quantity").cast("int") * 100
        dotted = F.when(
            qty >= 1000, F.concat(text(F.call_function("div", qty, F.lit(1000))), F.lit("."), F.lpad(text(qty % 1000), 3, "0"))
        ).otherwise(text(qty))
        stock = text(F.col("l_quantity").cast("int") * 3)
        ean, line = F.col("_ean"), F.col("l_linenumber")
        used = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_shipdate".split()
        items = self.table("lineitem").select(*used).withColumn("_ean", ean_of(F.col("l_partkey")))
        rows = items.select(
            layout.alias("layout"),
            F.when(dirt == 10, "C999999")
            .when(layout == "B", F.concat(F.lit("c-"), number))
            .otherwise(F.concat(F.lit("C"), number))
            .alias("distributor_raw"),
            F.when(dirt.isin(0, 11), "")
            .when(layout == "A", F.date_format(week, "dd.MM.yyyy"))
            .when(layout == "B", F.date_format(week, "yyyy-MM-dd"))
            .otherwise(F.date_format(week, "MM/dd/yyyy"))
            .alias("week_raw"),
            F.when(dirt == 2, "7.60901E+12")
            .when(dirt == 4, "4000000123456")
            .when(dirt == 7, F.concat(F.substring(ean, 1, 4), F.lit(" "), F.substring(ean, 5, 9)))
            .otherwise(ean)
            .alias("ean_raw"),
            F.when(dirt.isin(1, 11), "n/a")
            .when(dirt == 3, F.concat(F.lit("-"), text(qty)))
            .when((dirt == 8) & (layout == "A"), "384,0")
            .when(layout == "A", dotted)
            .otherwise(text(qty))
            .alias("qty_raw"),
            F.when(dirt == 5, "BOX")
            .when(n % 3 == 0, pick(("EA", "pcs", "units"), line % 3))
            .otherwise(pick(("CS", " cases ", "CSE"), line % 3))
            .alias("uom_raw"),
            F.when(dirt == 9, "")
            .when(layout == "A", F.concat(stock, F.lit(",5")))
            .otherwise(F.concat(stock, F.lit(".5")))
            .alias("stock_raw"),
            F.when(dirt == 6, "Atlantis")
            .when(F.col("l_orderkey") % 2 == 0, F.concat(F.lit(" nation_"), text(n), F.lit(" ")))
            .otherwise(F.concat(F.lit("n"), text(n)))
            .alias("country_raw"),
            F.concat(F.lit("sellout_C"), number, F.lit("_"), F.date_format(week, "yyyy-MM")).alias("_source_file"),
            F.when(F.col("l_orderkey") % 211 == 0, 2).otherwise(1).alias("_copies"),
            F.col("l_orderkey").alias("_order"),
        )
        sent = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        return sent.drop("_copies", "_copy")

    # operations -----------------------------------------------------------------------------------------------

    @cached_property
    def pos_events(self) -> DataFrame:
        """Shop events with copies and late arrivals; ``file_date`` is the folder they arrive in."""
        k, day = F.col("event_id"), F.col("ts").cast("date")
        nation = F.col("user_id") % 25
        return self.table("events").select(
            F.concat(F.lit("e"), text(k)).alias("event_id"),
            "event_type",
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("event_ts"),
            F.concat(F.lit("R"), text(F.col("user_id") % 10)).alias("retailer_id"),
            text(nation).alias("country"),
            ean_of(k % 2200).alias("ean"),
            (1 + k % 4).cast("int").alias("quantity"),
            F.col("value").alias("unit_price"),
            F.when(k % 333 == 0, "XXX").otherwise(pick(CURRENCIES, nation % 5)).alias("currency"),
            F.when(day > F.lit("2024-01-15").cast("date"), pick(("ios", "android", "web"), k % 3)).alias("device"),
            F.when(k % 100 == 0, F.date_add(day, 1)).otherwise(day).alias("file_date"),
            F.explode(F.sequence(F.lit(1), F.when(k % 200 == 0, 2).otherwise(1))).alias("_copy"),
        ).drop("_copy")

    @cached_property
    def run_log(self) -> DataFrame:
        """Events read as pipeline steps: one run per day."""
        kind = F.col("event_type")
        layer = (
            F.when(kind.isin("signup", "error"), "bronze").when(kind == "view", "silver").when(kind == "click", "gold").otherwise("ops")
        )
        seconds = F.col("value")
        return self.table("events").select(
            F.date_format("ts", "yyyyMMdd").alias("run_id"),
            layer.alias("layer"),
            F.when(layer == "bronze", "snapshot").otherwise(F.concat(F.lit("build_"), layer)).alias("step"),
            F.concat(layer, F.lit(".t"), text(F.col("user_id") % 40)).alias("target_table"),
            F.get_json_object("props", "$.k").cast("bigint").alias("rows_written"),
            F.col("ts").alias("started_at"),
            (F.col("ts") + F.make_dt_interval(secs=F.floor(seconds))).alias("ended_at"),
            F.floor(seconds).cast("double").alias("duration_s"),
            F.when(kind == "error", "FAILED").otherwise("SUCCESS").alias("status"),
            F.col("event_id").alias("entry_id"),
        )

    @cached_property
    def check_log(self) -> DataFrame:
        """Events read as recorded checks of the runs."""
        failed = F.get_json_object("props", "$.k").cast("bigint") % 10
        return self.table("events").select(
            F.date_format("ts", "yyyyMMdd").alias("run_id"),
            F.concat(F.lit("level_"), text(F.col("user_id") % 3)).alias("check_level"),
            F.concat(F.lit("check_"), text(F.col("user_id") % 40)).alias("check_name"),
            failed.cast("double").alias("difference"),
            F.when(failed <= 7, "PASS").otherwise("FAIL").alias("status"),
            F.col("ts").alias("checked_at"),
        )

    @cached_property
    def country_access(self) -> DataFrame:
        """Which user may see which country; every tenth user sees all."""
        k = F.col("c_custkey")
        return self.table("customer").select(
            F.concat(F.lit("user"), text(k % 30)).alias("user_email"),
            F.when(k % 30 == 0, "ALL").otherwise(text("c_nationkey")).alias("country_code"),
        )

    @cached_property
    def pii_readers(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").filter(k % 6 == 0).select(F.concat(F.lit("user"), text(k % 30)).alias("user_email"))
