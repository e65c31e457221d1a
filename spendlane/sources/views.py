"""The report's 21 warehouse views, derived from the base tables.

The report reads facts, conformed dimensions and master data from a warehouse.
Here each of those views is a lazy DataFrame derived from the TPC-H-style base
tables by a fixed, deterministic rule (documented in FIXTURES.md), so the
whole report runs on, and grows with, the given tables.  On a real deployment
the views are read by name (:class:`spendlane.sources.named.TableViews`).

Each view is built once per :class:`Views` object and reused, so a view read by
two legs of the report is the same logical plan and Spark can reuse its
exchanges.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlane.functions.rules import lookup
from spendlane.sources.tables import read_table

VIEW_NAMES = (
    "customer_invoice_fact", "date_dimension", "client_dimension", "branch_dimension",
    "billing_dimension", "currency_dimension", "currency_exchange_dimension",
    "import_shipment_fact", "shipment_fact", "shipment_fact_events_timeline",
    "invoice_movement", "shipment_reference_fact", "event", "reference",
    "container_shipment_fact", "port_dimension", "service_level_dimension",
    "service_type_dimension", "move_type_dimension", "container_type_dimension",
    "ship_mode_dimension",
)

DEC_AMOUNT = "decimal(18,2)"
DEC_RATE = "decimal(9,4)"

# Orders are split between the two legs by the last digit of the order key:
# import only, export only, both (8) and neither (9).
IMPORT_DIGITS = (0, 1, 2, 3, 8)
EXPORT_DIGITS = (4, 5, 6, 7, 8)


def ref_code(key: Column) -> Column:
    """Reference text of a numeric key: a prefix character plus the key.

    The prefix makes every ship-mode branch occur; distinct keys give distinct
    references.
    """
    prefix = (F.when(key % 11 == 0, F.lit("J"))
              .when(key % 13 == 0, F.lit("H"))
              .when(key % 17 == 0, F.lit("X"))
              .otherwise((F.lit(1) + key % 9).cast("string")))
    return F.concat(prefix, key.cast("string"))


def _date_key(ts: Column) -> Column:
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("bigint")


def _month_key(ts: Column) -> Column:
    return (F.year(ts) * 100 + F.month(ts)).cast("bigint")


def _days_after(ts: Column, days: int) -> Column:
    return ts + F.expr(f"INTERVAL '{days}' DAY")


def _unless(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def _shipment_key() -> Column:
    return F.when(F.col("_copy") == 1, -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))


def _container_type_key(p_type: Column) -> Column:
    return (F.when(p_type == "ECONOMY", 1).when(p_type == "LARGE", 2)
            .when(p_type == "MEDIUM", 3).when(p_type == "PROMO", 4)
            .when(p_type == "SMALL", 5).otherwise(6))


class Views:
    """Lazily derived warehouse views over one directory of base tables."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark = spark
        self.base_dir = base_dir

    def _t(self, name: str) -> DataFrame:
        return read_table(self.spark, self.base_dir, name)

    def get(self, name: str) -> DataFrame:
        if name not in VIEW_NAMES:
            raise KeyError(name)
        return getattr(self, name)

    # ---------------------------------------------------------------- facts
    @cached_property
    def customer_invoice_fact(self) -> DataFrame:
        li = self._t("lineitem")
        o = self._t("orders").select("o_orderkey", "o_orderdate", "o_custkey")
        s = self._t("supplier").select("s_suppkey", "s_nationkey")
        d = F.col("o_orderdate")
        ln = F.col("l_linenumber")
        return (
            li.join(o, li.l_orderkey == o.o_orderkey)
            .join(s, li.l_suppkey == s.s_suppkey)
            .select(
                d.alias("dt_invoice_date"),
                _date_key(d).alias("dt_invoice_date_key"),
                _month_key(d).alias("dt_revenue_month_key"),
                F.col("o_custkey").alias("billing_client_key"),
                F.col("l_partkey").alias("billing_key"),
                F.col("s_nationkey").alias("billing_branch_key"),
                (F.col("s_nationkey") % 5).alias("billing_currency_key"),
                F.concat(F.lit("E"), F.col("l_orderkey").cast("string")).alias("invoice_number"),
                ln.alias("invoice_line_number"),
                F.col("l_extendedprice").cast(DEC_AMOUNT).alias("billing_amount"),
                (F.when(ln == 1, "K84").when(ln == 2, 'FEE, F2F "X"')
                 .when(ln == 3, "FOREIGN TO FOREIGN").when(ln == 4, F.lit(None))
                 .otherwise('LINE, "A"')).alias("billing_line_description"),
                F.col("l_returnflag").alias("customer_invoice_type"),
                ref_code(F.col("l_orderkey")).alias("internal_reference"),
            )
        )

    def _orders_in(self, digits: tuple[int, ...]) -> DataFrame:
        o = self._t("orders")
        return o.filter((F.col("o_orderkey") % 10).isin(*digits))

    def _shipments(self) -> DataFrame:
        """Export orders, one row a shipment: orders whose key ends in 4, 24, 44, 64
        or 84 are moved in two shipments that share their movement id."""
        copies = F.when(F.col("o_orderkey") % 20 == 4, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return self._orders_in(EXPORT_DIGITS).withColumn("_copy", F.explode(copies))

    def _shipment_columns(self) -> list[Column]:
        ok, ck = F.col("o_orderkey"), F.col("o_custkey")
        return [
            (ck % 25).cast("int"),
            (ok % 25).cast("int"),
            (ok % 24).cast("int"),
            (ck % 23).cast("int"),
            F.substring("o_orderpriority", 1, 1).cast("int"),
            (ok % 6).cast("int"),
            F.col("o_totalprice").cast(DEC_AMOUNT),
            (ck % 977).cast(DEC_AMOUNT),
            (ck % 90).cast(DEC_AMOUNT),
            (ok % 40).cast("int"),
            F.when(F.col("o_orderstatus") == "P", "Y").otherwise("N"),
        ]

    @cached_property
    def import_shipment_fact(self) -> DataFrame:
        ok, ck = F.col("o_orderkey"), F.col("o_custkey")
        (b_orig, b_dest, p_orig, p_dest, sl, st, wch, wact, vol, qty, haz) = \
            self._shipment_columns()
        return self._orders_in(IMPORT_DIGITS).select(
            ref_code(ok).alias("invoice_number"),
            F.when(ok % 10 == 8, F.concat(F.lit("MV"), ok.cast("string")))
            .otherwise(F.concat(F.lit("HB"), ok.cast("string"))).alias("housebill_ref"),
            ck.alias("importer_key"),
            F.floor(ck / 2).cast("bigint").alias("shipper_key"),
            F.floor(ck / 3).cast("bigint").alias("consignee_key"),
            b_orig.alias("branch_origin_key"),
            b_dest.alias("branch_destination_key"),
            p_orig.alias("port_origin_key"),
            p_dest.alias("port_destination_key"),
            sl.alias("service_level_key"),
            st.alias("service_type_key"),
            wch.alias("weight_chargeable"),
            wact.alias("weight_actual"),
            vol.alias("volume"),
            qty.alias("quantity"),
            haz.alias("hazard_flag_yn"),
            _unless(ok % 8 == 0, _days_after(F.col("o_orderdate"), 2)).alias("dt_act_dep_event_time"),
        )

    @cached_property
    def shipment_fact(self) -> DataFrame:
        ok, ck = F.col("o_orderkey"), F.col("o_custkey")
        (b_orig, b_dest, p_orig, p_dest, sl, st, wch, wact, vol, pieces, haz) = \
            self._shipment_columns()
        return self._shipments().select(
            _shipment_key().alias("shipment_fact_key"),
            F.concat(F.lit("MV"), ok.cast("string")).alias("movement_id"),
            ck.alias("outbound_revenue_customer_key"),
            F.floor(ck / 2).cast("bigint").alias("outbound_shipper_key"),
            F.floor(ck / 3).cast("bigint").alias("outbound_consignee_key"),
            b_orig.alias("branch_origin_key"),
            b_dest.alias("branch_dest_key"),
            p_orig.alias("port_origin_key"),
            p_dest.alias("port_dest_key"),
            sl.alias("service_level_key"),
            st.alias("service_type_key"),
            F.when(ok % 3 == 0, 1).otherwise(2).alias("ship_mode_key"),
            wch.alias("weight_chargeable"),
            wact.alias("weight_actual"),
            vol.alias("volume"),
            (pieces + F.col("_copy")).alias("pieces"),
            haz.alias("hazard_flag_yn"),
        )

    @cached_property
    def shipment_fact_events_timeline(self) -> DataFrame:
        ok, d = F.col("o_orderkey"), F.col("o_orderdate")
        return self._shipments().select(
            _shipment_key().alias("shipment_fact_key"),
            _unless(ok % 4 == 0, _days_after(d, 3)).alias("cob_event_time_first"),
            _unless(ok % 8 == 0, _days_after(d, 2)).alias("cob_event_time_earliest"),
            _unless(ok % 5 == 0, _days_after(d, 1)).alias("frt_event_time_first"),
            _unless(ok % 2 == 0, _days_after(d, 9)).alias("adu_event_time_first"),
            _unless(ok % 6 == 0, _days_after(d, 10)).alias("afd_event_time_first"),
            _unless(ok % 7 == 0, _days_after(d, 12)).alias("dlv_event_time_first"),
            _unless(ok % 9 == 0, _days_after(d, 14)).alias("pod_event_time_latest"),
            _unless(ok % 3 == 0, _days_after(d, 0)).alias("bkd_event_time_first"),
        )

    @cached_property
    def invoice_movement(self) -> DataFrame:
        ok = F.col("o_orderkey")
        mv = F.concat(F.lit("MV"), ok.cast("string")).alias("movement_id")
        own = self._orders_in(EXPORT_DIGITS).select(mv, ref_code(ok).alias("invoice_number"))
        # movements ending in 6 also carry the previous order's invoice
        shared = self._orders_in((6,)).select(mv, ref_code(ok - 1).alias("invoice_number"))
        return own.unionByName(shared)

    @cached_property
    def shipment_reference_fact(self) -> DataFrame:
        ok = F.col("o_orderkey")
        base = self._orders_in(EXPORT_DIGITS).filter(ok % 9 != 0)

        def rows(n: int) -> DataFrame:
            return base.select(
                F.concat(F.lit("MV"), ok.cast("string")).alias("movement_id"),
                F.when(ok % 2 == 0, F.concat(F.lit("SO"), ok.cast("string"))).alias("so_references"),
                F.when(ok % 3 == 0, F.concat(F.lit("CI"), ok.cast("string"))).alias("ci_references"),
                F.when(ok % 5 == 0, F.concat(F.lit("EN"), ok.cast("string"))).alias("en_references"),
                _unless(ok % 4 == 0, F.concat(F.lit("PO"), ok.cast("string"), F.lit(f"-{n}")))
                .alias("po_references"),
            )

        # every reference row once, plus a second PO row for keys divisible by 23
        return rows(1).unionByName(rows(2).filter(ok % 23 == 0))

    @cached_property
    def event(self) -> DataFrame:
        eid = F.col("event_id")
        codes = ("FRT", "ADU", "COB", "FND", "ADD", "AFD", "DLV", "BKD", "EDA", "EDI",
                 "EDE", "EDS", "POD")
        code = None
        for i, c in enumerate(codes[:-1]):
            code = F.when(eid % 13 == i, c) if code is None else code.when(eid % 13 == i, c)
        code = code.otherwise(codes[-1])
        return self._t("events").select(
            ref_code(F.floor(eid / 3).cast("bigint")).alias("invoice_no"),
            code.alias("event_code"),
            F.col("ts").alias("event_time"),
            F.when(F.col("event_type") == "error", "Y").otherwise("N").alias("deleted_yn"),
        )

    @cached_property
    def reference(self) -> DataFrame:
        ln = F.col("l_linenumber")
        types = ("IC", "PO", "MB", "DP", "CI", "EN")
        rtype = None
        for i, t in enumerate(types, start=1):
            rtype = F.when(ln == i, t) if rtype is None else rtype.when(ln == i, t)
        return self._t("lineitem").select(
            ref_code(F.col("l_orderkey")).alias("invoice_no"),
            rtype.otherwise("SO").alias("reference_type"),
            F.concat(F.lit("R"), F.col("l_partkey").cast("string")).alias("reference_no"),
        )

    @cached_property
    def container_shipment_fact(self) -> DataFrame:
        li = self._t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
        p = self._t("part").select("p_partkey", "p_type")
        lp = li.join(p, li.l_partkey == p.p_partkey)
        per_line = lp.select(
            F.concat(F.lit("MV"), F.col("l_orderkey").cast("string")).alias("movement_id"),
            _unless(F.col("l_linenumber") == 7,
                    F.concat(F.lit("CN"), F.col("l_partkey").cast("string"))).alias("container_number"),
            _container_type_key(F.col("p_type")).alias("container_type_key"),
            (F.col("l_suppkey") % 4).cast("int").alias("move_type_key"),
        )
        # supplier consolidation movements: first lines of every order of a supplier
        per_supplier = lp.filter(F.col("l_linenumber") == 1).select(
            F.concat(F.lit("MV"), (F.col("l_suppkey") * 10 + 4).cast("string")).alias("movement_id"),
            F.concat(F.lit("CS"), F.col("l_partkey").cast("string")).alias("container_number"),
            _container_type_key(F.col("p_type")).alias("container_type_key"),
            F.lit(1).alias("move_type_key"),
        )
        return per_line.unionByName(per_supplier)

    # ----------------------------------------------------------- dimensions
    @cached_property
    def date_dimension(self) -> DataFrame:
        d = F.col("o_orderdate")
        names = ("January", "February", "March", "April", "May", "June", "July",
                 "August", "September", "October", "November", "December")
        return self._t("orders").select(
            _date_key(d).alias("date_key"),
            d.cast("date").alias("date"),
            F.year(d).cast("int").alias("date_year_key"),
            lookup(F.month(d), names).alias("date_month_name"),
        ).distinct()

    @cached_property
    def client_dimension(self) -> DataFrame:
        ck = F.col("c_custkey")
        return self._t("customer").select(
            ck.alias("client_key"),
            F.concat(F.lit("G"), ck.cast("string")).alias("gci"),
            F.concat(F.col("c_name"), F.lit(' "Co"')).alias("gci_name"),
            F.concat(F.lit("M"), (ck % 10).cast("string")).alias("master_client_number"),
            F.col("c_mktsegment").alias("master_client_name"),
            (F.when(ck % 7 == 0, "F2FC").when(ck % 7 == 1, "F2F")
             .when(ck % 7 == 2, F.lit(None)).otherwise("STD")).alias("usage_distinction_type"),
            F.concat(F.lit('"Unit, '), F.col("c_nationkey").cast("string"), F.lit('"'))
            .alias("gci_addr_line1"),
            _unless(ck % 3 == 0, F.col("c_mktsegment")).alias("gci_addr_line2"),
            F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("gci_state"),
            F.concat(F.lit("City, "), (ck % 50).cast("string")).alias("gci_city"),
        )

    @cached_property
    def branch_dimension(self) -> DataFrame:
        n, r = self._t("nation"), self._t("region")
        nk = F.col("n_nationkey")
        return n.join(r, n.n_regionkey == r.r_regionkey).select(
            nk.alias("branch_key"),
            F.concat(F.lit("B"), nk.cast("string")).alias("branch_code"),
            F.col("n_name").alias("country_name"),
            (F.when(nk == 3, "MX").when(nk == 4, F.lit(None))
             .otherwise(F.concat(F.lit("C"), nk.cast("string")))).alias("country_code"),
            F.col("r_name").alias("region_code_1"),
        )

    @cached_property
    def billing_dimension(self) -> DataFrame:
        pk = F.col("p_partkey")
        codes = ("2102", "2101", "2100", "4003", "0130", "2115", "2118", "2190", "2125",
                 "AMSA", "P/UT", "ZZZZ")
        return self._t("part").select(
            pk.alias("billing_key"),
            lookup(pk % 12, codes, start=0).alias("billing_code"),
        )

    @cached_property
    def currency_dimension(self) -> DataFrame:
        rk = F.col("r_regionkey")
        return self._t("region").select(
            rk.alias("currency_key"),
            (F.when(rk == 0, "USD").when(rk == 1, "EUR").when(rk == 2, "MXN")
             .when(rk == 3, "CAD").otherwise("JPY")).alias("currency_iso_code"),
        )

    @cached_property
    def currency_exchange_dimension(self) -> DataFrame:
        # a rate for every month and currency, whether or not a line uses it; the
        # currencies are the keys 0 to 4 of the regions there are
        d = F.col("o_orderdate")
        months = self._t("orders").select(
            _month_key(d).alias("date_month_key"), F.month(d).alias("_m")).distinct()
        currencies = self._t("region").select(F.col("r_regionkey").alias("currency_key"))
        grid = months.withColumn("currency_key", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(4).cast("bigint"))))
        return grid.join(currencies, "currency_key").select(
            "date_month_key", "currency_key",
            (F.lit(1) + F.col("currency_key") * F.lit(0.25).cast("decimal(3,2)")
             + F.col("_m") * F.lit(0.01).cast("decimal(3,2)")).cast(DEC_RATE)
            .alias("average_exchange_rate"),
        )

    @cached_property
    def port_dimension(self) -> DataFrame:
        nk = F.col("n_nationkey")
        return self._t("nation").select(
            nk.alias("port_key"),
            F.concat(F.lit("P"), nk.cast("string")).alias("port_code"),
            F.col("n_name").alias("country_name"),
        )

    @cached_property
    def service_level_dimension(self) -> DataFrame:
        return self._t("orders").select(
            F.substring("o_orderpriority", 1, 1).cast("int").alias("service_level_key"),
            F.substring("o_orderpriority", 3, 20).alias("service_level_description"),
        ).distinct()

    @cached_property
    def service_type_dimension(self) -> DataFrame:
        rk = F.col("r_regionkey")
        return self._t("region").select(
            rk.alias("service_type_key"),
            F.concat(F.lit("ST"), rk.cast("string")).alias("service_type_code"),
        )

    @cached_property
    def move_type_dimension(self) -> DataFrame:
        return (self._t("region").filter(F.col("r_regionkey") < 3)
                .select(F.col("r_regionkey").alias("move_type_key")))

    @cached_property
    def container_type_dimension(self) -> DataFrame:
        return self._t("part").select(
            _container_type_key(F.col("p_type")).alias("container_type_key"),
            F.col("p_type").alias("container_type"),
        ).distinct()

    @cached_property
    def ship_mode_dimension(self) -> DataFrame:
        rk = F.col("r_regionkey")
        return self._t("region").select(
            rk.alias("ship_mode_key"),
            (F.when(rk == 0, "Truck").when(rk == 1, "Air").when(rk == 2, "Ocean")
             .when(rk == 3, "Distribution").otherwise("Other")).alias("ship_mode_desc"),
        )
