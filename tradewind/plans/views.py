"""Trade tables derived from a star schema of orders, so that every operator has data to run on.

``tradewind.plans.sql_views`` states the same views for the check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.periods import next_month
from tradewind.functions.text import pad2
from tradewind.sources.stage import stage

EUROPE = 3
NUMERALS = ("I", "II", "III", "IV", "V")

_SCHEMAS: dict[tuple[str, int], T.StructType] = {}    # a file's footer is read once while the file stays as it is


def _gate(key: str) -> Column:
    return F.concat(F.lit("P"), pad2(F.col(key) % 40))


def _item_code() -> Column:
    return F.concat(pad2(F.col("p_partkey") % 24 + 1), pad2(F.col("p_size")),
                    pad2(F.col("p_partkey") % 7), pad2(F.col("p_partkey") % 100))


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._base: DataFrame | None = None

    def keep_base(self) -> "Views":
        """Joins the line items once for several tables; they are written in between."""
        self._base = stage(self.flow_base(), "flow-base")
        return self

    def table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        version = path, place.getFileSystem(self.spark._jsc.hadoopConfiguration()).getFileStatus(place).getModificationTime()
        if version not in _SCHEMAS:
            _SCHEMAS[version] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[version]).parquet(path)

    # facts

    def flow_base(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """One row per line item with both partners; a month range reaches the scan as a date range."""
        lines = self.table("lineitem") if self._base is None else self._base
        if start is not None:
            lines = lines.where(F.col("l_shipdate") >= f"{start}-01")
        if end is not None:
            lines = lines.where(F.col("l_shipdate") < f"{next_month(end)}-01")
        if self._base is not None:
            return lines
        lines = lines.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus",
                             "l_shipdate", "l_extendedprice", "l_quantity")
        nation = self.table("nation")
        seller = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("s_reg"))
        buyer = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("c_reg"))
        supplier = self.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
        part = self.table("part").select(F.col("p_partkey").alias("l_partkey"), _item_code().alias("comcode"))
        # Line items meet stored tables one by one, whose sizes the optimizer knows from their files. Orders
        # find their customers first, so line items are shuffled once, by order.
        orders = (self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
                      .join(self.table("customer").select("c_custkey", "c_nationkey"), "c_custkey")
                      .join(buyer, "c_nationkey"))
        return (lines.join(supplier, "l_suppkey").join(seller, "s_nationkey").join(part, "l_partkey")
                     .join(orders, "l_orderkey")
                     .select("comcode", pad2(F.col("s_nationkey")).alias("s_code"), "s_reg",
                             pad2(F.col("c_nationkey")).alias("c_code"), "c_reg", "c_custkey", "l_orderkey",
                             "l_suppkey", "l_linenumber", "l_linestatus", "l_shipdate",
                             F.round("l_extendedprice").cast("bigint").alias("value"),
                             (F.col("l_quantity") - 1).cast("bigint").alias("quantity_1")))

    def is_import(self):
        return (F.col("l_linestatus") == "O") & (F.col("s_reg") != EUROPE)

    def import_rows(self, start=None, end=None) -> DataFrame:
        rows = self.flow_base(start, end).where(self.is_import())
        return rows.select(
            "l_orderkey", "l_linenumber", "comcode",
            F.when(F.col("l_linenumber") != 6, F.col("s_code")).alias("coo_alpha"),
            F.when(F.col("l_linenumber") == 7, "").otherwise(_gate("c_custkey")).alias("port_alpha"),
            F.date_format("l_shipdate", "MM/yyyy").alias("account_date"), "value", "quantity_1")

    def imports(self, start=None, end=None) -> DataFrame:
        return self.import_rows(start, end).drop("l_orderkey", "l_linenumber")

    def exports(self, start=None, end=None) -> DataFrame:
        rows = self.flow_base(start, end).where((F.col("l_linestatus") == "F") & (F.col("c_reg") != EUROPE))
        return rows.select(
            "comcode", F.col("c_code").alias("cod_alpha"),
            F.when(F.col("l_linenumber") == 7, "").otherwise(_gate("l_suppkey")).alias("port_alpha"),
            F.date_format("l_shipdate", "MM/yyyy").alias("account_date"), "value", "quantity_1")

    def _eu(self, rows: DataFrame, country: str) -> DataFrame:
        return rows.select(
            F.col("comcode").alias("smk_comcode"), F.col(country).alias("smk_cod_alpha"),
            F.concat(F.lit("0"), F.date_format("l_shipdate", "yyyyMM")).alias("smk_period_reference"),
            F.col("l_linenumber").cast("bigint").alias("smk_no_of_consignments"),
            F.col("value").alias("smk_stat_value"), F.col("quantity_1").alias("smk_nett_mass"))

    def arrivals(self, start=None, end=None) -> DataFrame:
        base = self.flow_base(start, end)
        return self._eu(base.where((F.col("l_linestatus") == "O") & (F.col("s_reg") == EUROPE)), "s_code")

    def dispatches(self, start=None, end=None) -> DataFrame:
        base = self.flow_base(start, end)
        return self._eu(base.where((F.col("l_linestatus") == "F") & (F.col("c_reg") == EUROPE)), "c_code")

    def fact(self, name: str, start=None, end=None) -> DataFrame:
        return getattr(self, name)(start, end)

    def flows(self) -> DataFrame:
        """All four facts as one table, from one scan: ``table_name, comcode, country, month, price, weight``."""
        inbound, eu = F.col("l_linestatus") == "O", F.when(F.col("l_linestatus") == "O", F.col("s_reg")).otherwise(F.col("c_reg")) == EUROPE
        name = (F.when(inbound & ~eu, "imports").when(inbound, "arrivals").when((F.col("l_linestatus") == "F") & ~eu, "exports")
                 .when(F.col("l_linestatus") == "F", "dispatches"))
        country = F.when(~inbound, F.col("c_code")).when(eu | (F.col("l_linenumber") != 6), F.col("s_code"))
        return self.flow_base().select(name.alias("table_name"), "comcode", country.alias("country"),
                                       F.date_format("l_shipdate", "yyyy-MM").alias("month"), F.col("value").alias("price"),
                                       F.col("quantity_1").alias("weight")).where("table_name IS NOT NULL")

    # lookups

    def country(self) -> DataFrame:
        return self.table("nation").select(F.col("n_name").alias("countryname"),
                                           pad2(F.col("n_nationkey")).alias("countrycode"))

    def port_raw(self) -> DataFrame:
        name = F.concat(F.lit("Port "), "s_name")
        return self.table("supplier").select(
            F.when(F.col("s_suppkey") % 3 == 0, F.upper(name)).otherwise(name).alias("portname"),
            _gate("s_suppkey").alias("portcode"),
            F.when(F.col("s_suppkey") % 2 == 0, "Airport").otherwise("Seaport").alias("type"))

    def port(self) -> DataFrame:
        number = pad2(F.col("c_custkey") % 40)
        return self.table("customer").select(
            F.concat(F.lit("Port "), number).alias("portname"), F.concat(F.lit("P"), number).alias("portcode"),
            F.when(F.col("c_custkey") % 2 == 0, "Airport").otherwise("Seaport").alias("type")).distinct()

    def leaf(self) -> DataFrame:
        return self.table("part").groupBy(_item_code().alias("commoditycode")).agg(F.min("p_name").alias("description"))

    def codes(self) -> DataFrame:
        """Ragged code table: some four- and six-digit levels are missing."""
        leaf = self.leaf()
        code = F.col("commoditycode")
        levels = F.array(F.substring(code, 1, 2),
                         F.when(F.substring(code, 4, 1) != "0", F.substring(code, 1, 4)),
                         F.when(F.substring(code, 5, 2) != "03", F.substring(code, 1, 6)))
        heads = (leaf.select(F.explode(levels).alias("commoditycode")).where(code.isNotNull()).distinct()
                     .withColumn("description", F.concat(F.lit("Heading "), code)))
        return leaf.unionByName(heads)

    def map_points(self) -> DataFrame:
        k = F.explode(F.array(*[F.lit(i) for i in (1, 2, 3, 4)])).alias("ord")
        return (self.table("nation").select("n_nationkey", "n_regionkey", k)
                    .select(pad2(F.col("n_nationkey")).alias("region"), F.col("n_nationkey").alias("grp"), "ord",
                            (F.col("n_nationkey") + F.when(F.col("ord").isin(2, 3), 0.5).otherwise(0.0)).alias("lng"),
                            (F.col("n_regionkey") + F.when(F.col("ord").isin(3, 4), 0.5).otherwise(0.0)).alias("lat")))

    # raw inputs of the lookup builds

    def nomen_raw(self) -> DataFrame:
        """Published nomenclature lines: spaced codes, section rows, lines without a code."""
        codes, code = self.codes(), F.col("commoditycode")
        section = F.element_at(F.array(*[F.lit(n) for n in NUMERALS]),
                               F.floor((F.substring(code, 1, 2).cast("int") - 1) / 5).cast("int") + 1)

        def place(c: Column) -> Column:
            return F.rpad(c, 8, "0").cast("bigint") * 10

        spaced = F.concat_ws(" ", F.substring(code, 1, 4),
                             *[F.when(F.length(code) >= n + 1, F.substring(code, n, 2)) for n in (5, 7)])
        rows = codes.where((F.length(code) < 8) | (F.right(code, F.lit(1)) != "7")).select(
            (place(code) + F.floor(F.length(code) / 2)).alias("line_no"), spaced.alias("code_1"),
            F.when(F.length(code) == 2, section)
             .when((F.length(code) == 8) & F.right(code, F.lit(1)).isin("0", "2", "4"), F.substring(code, 1, 6)).alias("parent_1"),
            "description")
        heads = (codes.where(F.length(code) == 2).groupBy(section.alias("code_1"))
                      .agg(F.min(code).alias("c"))
                      .select(place(F.col("c")).alias("line_no"), "code_1", F.lit(None).cast("string").alias("parent_1"),
                              F.concat(F.lit("Section "), "code_1").alias("description")))
        notes = self.table("region").select((-F.col("r_regionkey") - 1).cast("bigint").alias("line_no"),
                                            F.lit(None).cast("string").alias("code_1"),
                                            F.lit(None).cast("string").alias("parent_1"),
                                            F.col("r_name").alias("description"))
        return rows.unionByName(heads).unionByName(notes)

    def control(self) -> DataFrame:
        code = F.col("commoditycode")
        return self.leaf().where(F.right(code, F.lit(1)) != "3").select(
            code, F.concat(F.lit("Control "), "description").alias("description"))

    def locode_raw(self) -> DataFrame:
        """Headerless location rows; only the columns that are read are filled."""
        key = F.col("s_suppkey")
        position = F.concat(pad2(key % 10 + 50), pad2(key * 7 % 60), F.when(key % 11 == 0, "S").otherwise("N"), F.lit(" "),
                            F.lpad((key % 6).cast("string"), 3, "0"), pad2(key * 13 % 60),
                            F.when(key % 2 == 0, "W").otherwise("E"))
        return self.table("supplier").select(
            F.when(key % 4 == 3, "FR").otherwise("GB").alias("x2"), _gate("s_suppkey").alias("x3"),
            F.concat(F.lit("Port "), "s_name").alias("x5"),
            F.when(key % 9 != 0, position).alias("x11"))

    def extra_ports(self) -> DataFrame:
        """Hand-made positions, some for names the location list has too."""
        key = F.col("s_suppkey")
        named = self.table("supplier").select(
            F.concat(F.lit("Port "), "s_name").alias("portname_x"), _gate("s_suppkey").alias("portcode"),
            (F.lit(51.0) + key % 7 / 8).alias("lat"), F.when(key % 5 != 0, F.lit(-1.0) + key % 3 / 4).alias("long"))
        other = self.table("customer").select(
            F.concat(F.lit("Harbour "), "c_name").alias("portname_x"), _gate("c_custkey").alias("portcode"),
            (F.lit(52.0) + F.col("c_custkey") % 7 / 8).alias("lat"), (F.col("c_custkey") % 3 / 4).alias("long"))
        return named.unionByName(other)

    # raw inputs of the loads

    def fact_lines(self) -> DataFrame:
        """Imports as monthly text files with header and trailer; some records stop short. Line items are joined once: lines are staged."""
        rows = self.import_rows()
        date = F.col("account_date")
        file = F.concat(F.lit("SMKI19"), F.substring(date, 6, 2), F.substring(date, 1, 2))
        blank = F.lit("")
        filled = {0: F.concat("comcode", F.lit("99")), 6: F.coalesce("coo_alpha", blank), 7: date,
                  9: F.col("port_alpha"), 23: F.when(F.col("l_linenumber") == 3, F.concat("value", F.lit("x")))
                                              .otherwise(F.col("value").cast("string")),
                  24: F.col("quantity_1").cast("string")}
        full = F.concat_ws("|", *[filled.get(i, blank) for i in range(26)])
        short = F.concat_ws("|", *[filled.get(i, blank) for i in range(24)])
        body = stage(rows.select(file.alias("file"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"),
                                 F.when(F.col("l_linenumber") == 2, short).otherwise(full).alias("line")), "lines")
        ends = F.array(
            F.struct(F.lit(-1).cast("bigint").alias("pos"), F.concat(F.lit("000000000|HEADER|"), "file").alias("line")),
            F.struct(F.lit(2**62).alias("pos"), F.concat(F.lit("999999999|TRAILER|"), "file").alias("line")))
        added = body.select("file").distinct().select("file", F.explode(ends).alias("e")).select("file", "e.pos", "e.line")
        return body.unionByName(added)

    def control_lines(self) -> DataFrame:
        """Control files; some descriptions are split over two fields or carry a control character."""
        key, name = F.col("p_partkey"), F.col("p_name")
        head, tail = F.substring_index(name, " ", 1), F.expr("substring(p_name, instr(p_name, ' ') + 1)")
        text = F.when(key % 3 == 0, F.concat(head, F.lit("|"), tail)) \
                .when(key % 5 == 0, F.concat(name, F.lit("\x1a"))).otherwise(F.concat(F.lit("  "), name, F.lit(" ")))
        line = F.concat_ws("|", F.concat(_item_code(), F.lit("00")), *[F.lit(" ")] * 23,
                           F.concat(F.lit(" "), "p_brand"), F.lit(""), text)
        body = self.table("part").select(F.concat(F.lit("SMKA12"), pad2(F.col("p_size"))).alias("file"),
                                         key.alias("pos"), line.alias("line"))
        ends = F.array(F.struct(F.lit(-1).cast("bigint").alias("pos"), F.lit("HEAD").alias("line")),
                       F.struct(F.lit(2**62).alias("pos"), F.lit("TAIL").alias("line")))
        added = body.select("file").distinct().select("file", F.explode(ends).alias("e")).select("file", "e.pos", "e.line")
        return body.unionByName(added)

    def control_batches(self) -> DataFrame:
        """Control rows as they arrived month by month: the description and another field change."""
        rows = self.import_rows()
        month = F.concat(F.substring("account_date", 4, 4), F.substring("account_date", 1, 2))
        return rows.groupBy(F.col("comcode").alias("mk_comcode"), month.alias("batch")).agg(
            F.min("port_alpha").alias("mk_sitc_no"),
            F.concat(F.lit("Item at "), F.max("value").cast("string")).alias("mk_commodity_alpha_1"))
