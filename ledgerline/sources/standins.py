"""Stand-in views: the source systems' tables derived from the driver tables.

The source jobs read CRM, statistics, logistics and weighbridge tables that do not exist here. The
driver ships TPC-H-like tables instead; each method below derives one source table from them with
plain DataFrame operations, so every job reads data whose size grows with the driver tables. The
same derivations are written in SQL in ``ledgerline.plans.oracle_sql`` for the DuckDB oracle.

Mapping (driver table -> source table):
  nation   -> SalesDepartments (name, group = region), Companies_PartyA
  region   -> SalesDepartmentsGroup, ProjectRealManageSet
  supplier -> Salesman, Users, Stations
  customer -> Project, PotentialCustomersManage (prospects), ProjectCustomers (clues)
  orders   -> ProductionDailyReports, Opportunities, ProjApprove, receivables, plans, profit, targets;
              months of o_orderdate -> Periods (dense id = year * 12 + month - 1)
  lineitem -> ProductionDailyReportDetails (joined to its order for the project), payments, refunds,
              production and weighbridge records of the daily load
  events   -> assignments, daily tasks, to-dos, clue members (key in props.k), mapping history
  part     -> UserPlans, Plans
Small configuration tables (parameters, dictionary, product categories) are job configuration.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.exprs import category_group
from ledgerline.sources.late import Late

# Stand-in vocabulary used with the driver tables (the source system's own values are in
# ``ledgerline.functions.fixed``).
CATEGORY_GROUPS = {
    "HEAVY": ["AUTOMOBILE", "MACHINERY", "MARINE", "AEROSPACE"],
    "LIGHT": ["FURNITURE", "HOUSEHOLD"],
}
SIX_CATEGORIES = ["AUTOMOBILE", "MACHINERY", "MARINE", "FURNITURE", "HOUSEHOLD", "AEROSPACE"]
PAYMENT_KEEP = ["CASH", "OFFSET"]
PAYMENT_ELSE = "ADVANCE"
UNIT_TONNE = "T"
UNIT_M3 = "M3"
PARAMETERS = [
    ("NotCalcReturnCompanies", "NATION_3,NATION_7"),
    ("ProjectSalesTypeFilter", "A,N,, R"),
]
DICTIONARY = [
    ("MonthlyTargetCategory", "HEAVY"),
    ("MonthlyTargetCategory", "LIGHT"),
    ("MonthlyTargetCategory", "NEWMAT"),
    ("OtherGroup", "HEAVY"),
]
PRODUCT_CATEGORIES = [("C30", "T"), ("C40", "M3"), ("C50", "BAG")]
RETURN_RATIOS = [("HEAVY", "0.30"), ("LIGHT", "0.25")]

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "benchmark", "labels"]


def _dec(c):
    return c.cast("decimal(18,2)")


def _dx(sql: str):
    """An exact decimal expression (inputs cast to DECIMAL(18,2) first, products keep their scale),
    widened to DECIMAL(20,6) so no rounding happens anywhere."""
    return F.expr(sql).cast("decimal(20,6)")


def period_id(ts) -> "F.Column":
    """Dense period id of a month: year * 12 + month - 1."""
    return (F.year(ts) * 12 + F.month(ts) - 1).cast("bigint")


_INSTANCES: dict = {}


class StandIns:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._cache:
            from ledgerline.sources.schemas import DRIVER
            r = self.spark.read
            if name in DRIVER:
                r = r.schema(DRIVER[name])
            df = r.parquet(f"{self.sf_dir}/{name}.parquet")
            self._cache[name] = df
        return self._cache[name]

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "StandIns":
        """One instance per (session, folder): source frames are built and analysed once."""
        key = (id(spark), sf_dir.rstrip("/"))
        inst = _INSTANCES.get(key)
        if inst is None or inst.spark is not spark:
            inst = _INSTANCES[key] = cls(spark, sf_dir)
        return inst

    # ---- configuration tables -----------------------------------------------------------------
    def parameters(self) -> DataFrame:
        return self.spark.createDataFrame(PARAMETERS, "ParaName string, ParaValue string")

    def dictionary(self) -> DataFrame:
        return self.spark.createDataFrame(DICTIONARY, "DataTableName string, Value string")

    def product_categories(self) -> DataFrame:
        return self.spark.createDataFrame(PRODUCT_CATEGORIES, "CategoryName string, Unit string")

    # ---- statistics dimensions ----------------------------------------------------------------
    def departments(self) -> DataFrame:
        return self.raw("nation").select(F.col("n_name").alias("DepartmentName"),
                                         F.col("n_regionkey").cast("bigint").alias("GroupID"),
                                         F.lit(0).alias("isDeleted"))

    def department_groups(self) -> DataFrame:
        return self.raw("region").select(F.col("r_regionkey").cast("bigint").alias("ID"),
                                         F.col("r_regionkey").cast("bigint").alias("RegionID"))

    def manage_sets(self) -> DataFrame:
        r = F.col("r_regionkey")
        return self.raw("region").select(
            r.cast("bigint").alias("ID"),
            F.when(r == 4, F.lit(0)).when(r == 3, F.lit(None)).otherwise(F.lit(1)).cast("int")
            .alias("IsParticipateInReturnCalc"))

    def companies(self) -> DataFrame:
        return self.raw("nation").select(F.col("n_nationkey").cast("bigint").alias("ID"),
                                         F.col("n_name").alias("CompanyName"))

    def salesman(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("ID"), F.col("s_name").alias("UserName"),
            F.when(F.col("s_acctbal") < 0, 1).otherwise(0).alias("IsDeleted"))

    def users(self) -> DataFrame:
        return self.raw("supplier").select(F.col("s_suppkey").alias("ID"), F.col("s_name").alias("Username"),
                                           F.col("s_nationkey").cast("bigint").alias("DepartmentID"))

    def _customer_nation(self) -> DataFrame:
        n = F.broadcast(self.raw("nation").select("n_nationkey", "n_name", "n_regionkey"))
        return self.raw("customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))

    def projects(self) -> DataFrame:
        b = F.col("c_acctbal")
        return self._customer_nation().select(
            F.col("c_custkey").alias("ID"),
            F.col("n_name").alias("SalesDepartment"),
            F.col("c_nationkey").cast("bigint").alias("SalesmanID"),
            F.concat(F.lit("Supplier#"), F.lpad(F.col("c_nationkey").cast("string"), 9, "0")).alias("Salesman"),
            F.col("c_mktsegment").alias("ProductCategory"),
            F.when(b < 0, "CASH").when(b < 2000, "OFFSET").when(b < 9000, "CREDIT").alias("AccountingPaymentType"),
            F.when(b < 0, "CASH").when(b < 2000, "OFFSET").when(b < 9000, "CREDIT").alias("SalesPaymentType"),
            F.when(b > 9900, 1).otherwise(0).alias("isDeleted"),
            F.col("n_regionkey").cast("bigint").alias("ProjectRealManageSetID"),
            F.col("c_nationkey").cast("bigint").alias("SignCompanyID_PartyA"),
            F.col("c_nationkey").cast("bigint").alias("AgentID"),
        )

    def periods(self) -> DataFrame:
        m = F.date_trunc("month", F.col("o_orderdate")).cast("date")
        months = self.raw("orders").select(m.alias("StartDate")).distinct()
        return months.select(
            period_id(F.col("StartDate")).alias("ID"),
            F.date_format("StartDate", "yyyy-MM").alias("PeriodName"),
            F.col("StartDate"), F.last_day("StartDate").alias("EndDate"), F.lit(0).alias("isDeleted"))

    # ---- production facts ---------------------------------------------------------------------
    def reports(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("ID"), F.col("o_orderdate").cast("date").alias("ReportDate"),
            F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("isDeleted"),
            F.col("o_custkey").alias("StationID"))

    def _line_order(self) -> DataFrame:
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
        return self.raw("lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey"))

    def details(self) -> DataFrame:
        lo = self._line_order()
        return lo.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("ID"),
            F.col("l_orderkey").alias("DailyReportID"),
            F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("l_linenumber") == 1), F.lit(None))
            .otherwise(F.col("o_custkey")).alias("ProjectID"),
            F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
            .alias("OriginalID"),
            F.col("l_returnflag").alias("Type"),
            F.when(F.col("l_linestatus") == "F", F.lit(UNIT_TONNE)).otherwise(F.lit(UNIT_M3)).alias("Unit"),
            _dec(F.when(F.col("l_quantity") != 1, F.col("l_quantity"))).alias("FinalQty_T"),
            _dx("CAST(l_quantity AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))").alias("FinalQty_M3"),
            _dec(F.col("l_extendedprice")).alias("SalesTotalAmt1"),
            F.when(F.col("l_tax") == 0, F.lit("")).when(F.col("l_tax") == 0.01, F.lit(None))
            .otherwise(F.concat(F.lit("C"), F.col("l_linenumber").cast("string"))).alias("StrengthGrade"),
        )

    # ---- CRM ----------------------------------------------------------------------------------
    def prospects(self) -> DataFrame:
        b = F.col("c_acctbal")
        return self._customer_nation().select(
            F.col("c_custkey").alias("ID"), F.col("c_nationkey").cast("bigint").alias("AssignorID"),
            F.col("n_name").alias("DeptName"),
            F.when(b < 0, 1).when(b > 9000, F.lit(None)).otherwise(0).alias("IsDeleted"),
            F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"))
            .alias("StopFollowingUpTime"))

    def _events_k(self, kind: str) -> DataFrame:
        e = self.raw("events").filter(F.col("event_type") == kind)
        return e.withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))

    def prospect_assigns(self) -> DataFrame:
        return self._events_k("signup").select(F.col("k").alias("PotentialCustomersManageID"),
                                                F.col("user_id").alias("AssignorID"))

    def daily_tasks(self) -> DataFrame:
        return self._events_k("click").select(F.col("k").alias("PotentialCustomersManageID"),
                                               F.col("k").alias("ProjectCustomerID"),
                                               F.col("user_id").alias("UserID"))

    def prospect_todos(self) -> DataFrame:
        return self._events_k("purchase").select(F.col("k").alias("PotentialCustomersManageID"),
                                                  F.when(F.col("value") > 250, 1).otherwise(2).alias("Status"))

    def clues(self) -> DataFrame:
        b = F.col("c_acctbal")
        return self._customer_nation().select(
            (F.col("c_custkey") + 50).alias("ID"), (F.col("c_nationkey") + 1).cast("bigint").alias("ClueOwnerID"),
            F.col("n_name").alias("SalesDepartment"),
            F.when(b < 0, 1).when(b > 9000, F.lit(None)).otherwise(0).alias("isDeleted"),
            F.when(F.col("c_mktsegment").isin("HOUSEHOLD", "MACHINERY", "AUTOMOBILE"), F.lit("PROSPECT"))
            .otherwise(F.lit("DIRECT")).alias("Source"),
            F.when(b > 8000, F.lit(None)).otherwise(F.col("c_custkey")).alias("SourceID"),
            F.when(b < 1000, 2).otherwise(1).alias("FollowUpStatus"))

    def clue_members(self) -> DataFrame:
        seen = self._events_k("view").select(F.col("k").alias("ProjectCustomerID"), F.col("user_id").alias("MemberUserID"))
        own = self.raw("customer").filter(F.col("c_custkey") % 4 == 0).select(
            (F.col("c_custkey") + 50).alias("ProjectCustomerID"), F.col("c_nationkey").cast("bigint").alias("MemberUserID"))
        return seen.unionByName(own)

    def opportunities(self) -> DataFrame:
        o = self.raw("orders")
        cn = self._customer_nation().select("c_custkey", "c_nationkey", "n_name", "c_mktsegment")
        j = o.join(cn, F.col("o_custkey") == F.col("c_custkey"))
        return j.select(
            F.col("o_orderkey").alias("ID"), F.col("o_custkey").alias("ProjCustID"),
            F.col("c_nationkey").cast("bigint").alias("UserID"), F.col("n_name").alias("DeptName"),
            F.col("c_mktsegment").alias("ProdCateName"), _dec(F.col("o_totalprice")).alias("ESTDSupplyQty"),
            F.col("o_orderdate").alias("ApprovalTime"),
            F.expr("o_orderdate + INTERVAL 20 DAYS").alias("EndTime"),
            F.expr("o_orderdate + INTERVAL 10 DAYS").alias("SecondStageSubmitTime"),
            F.when(F.col("o_orderstatus") == "F", 9).otherwise(1).alias("Status"),
            F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"), 1)
            .otherwise(0).alias("isDeleted"))

    def proj_approve(self) -> DataFrame:
        o = self.raw("orders")
        pr = F.col("o_orderpriority")
        main = o.select(F.col("o_orderkey").alias("OppoID"), F.col("o_custkey").alias("CSEProjectID"),
                        F.when(pr == "2-HIGH", F.lit(None)).when(pr == "3-MEDIUM", F.col("o_custkey"))
                        .otherwise(F.col("o_custkey") + 1).alias("CSEProjectID_SJ"))
        extra = o.filter(pr == "1-URGENT").select(F.col("o_orderkey").alias("OppoID"),
                                                   (F.col("o_custkey") + 2).alias("CSEProjectID"),
                                                   F.lit(None).cast("bigint").alias("CSEProjectID_SJ"))
        return main.unionByName(extra)

    # ---- finance ------------------------------------------------------------------------------
    def sales_targets(self) -> DataFrame:
        o = self.raw("orders")
        cn = self._customer_nation().select("c_custkey", "c_nationkey", "n_name")
        pr = F.col("o_orderpriority")
        return o.join(cn, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("n_name").alias("SalesDepartment"), F.col("c_nationkey").cast("bigint").alias("SalesmanID"),
            period_id(F.col("o_orderdate")).alias("PeriodID"),
            F.when(pr.isin("1-URGENT", "2-HIGH"), "HEAVY").when(pr == "5-LOW", "NEWMAT").otherwise("LIGHT")
            .alias("ProductCategory"),
            _dx("CAST(o_totalprice AS DECIMAL(18,2)) * 0.001").alias("TargetQty"), _dec(F.col("o_totalprice")).alias("TargetAmt"),
            _dx("CAST(o_totalprice AS DECIMAL(18,2)) * 0.05").alias("ProfitTargetAmt"))

    def profit_month(self) -> DataFrame:
        return self.raw("orders").select(F.col("o_custkey").alias("ProjectID"),
                                         period_id(F.col("o_orderdate")).alias("PeriodID"),
                                         _dx("CAST(o_totalprice AS DECIMAL(18,2)) * 0.10").alias("MonthProfitAmt"))

    def return_targets(self) -> DataFrame:
        ratios = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(r).cast("decimal(18,2)").alias("r"))
                           for c, r in RETURN_RATIOS])
        p = self.periods().select("ID", F.explode(ratios).alias("x"))
        return p.select(F.col("x.c").alias("ProductCategoryType"), F.col("ID").alias("PeriodID"),
                        F.col("x.r").alias("TargetRatio"))

    def receivables(self) -> DataFrame:
        return self.raw("orders").select(
            period_id(F.col("o_orderdate")).alias("PeriodID"), F.col("o_custkey").alias("ProjectID"),
            _dec(F.col("o_totalprice")).alias("AR"), F.col("o_orderkey").alias("FinanceRptID"),
            F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", 1).otherwise(0).alias("isDeleted"))

    def finance_reports(self) -> DataFrame:
        return self.raw("orders").select(F.col("o_orderkey").alias("ID"),
                                         F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("isDeleted"))

    def payment_plans(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("ID"), period_id(F.col("o_orderdate")).alias("PeriodID"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"), 1).otherwise(2).alias("Type"),
            F.lit(0).alias("IsDeleted"))

    def payment_plan_details(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("SalesPaymentPlanID"), F.col("o_custkey").alias("ProjectID"),
            _dx("CAST(o_totalprice AS DECIMAL(18,2)) * 0.50").alias("ThisPaymentPromiseTarget"),
            F.when(F.col("o_orderstatus") == "O", 1).otherwise(0).alias("IsMerged"))

    def payments(self) -> DataFrame:
        lo = self._line_order()
        rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
        return lo.select(F.col("o_custkey").alias("ProjectID"), period_id(F.col("l_shipdate")).alias("PeriodID"),
                         _dx("CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))").alias("Amount"),
                         F.when((rf == "A") & (ls == "O"), F.lit(1)).when(rf == "R", F.lit(None))
                         .otherwise(F.lit(0)).alias("isDeleted"))

    def service_income(self) -> DataFrame:
        lo = self._line_order()
        return lo.select(F.col("o_custkey").alias("ProjectID"), period_id(F.col("l_shipdate")).alias("PeriodID"),
                         _dx("CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2))").alias("RefundAmt"),
                         F.when(F.col("l_returnflag") == "R", "EXPENSE").otherwise("INCOME").alias("ServiceType"),
                         F.lit(0).alias("isDeleted"))

    # ---- daily load (J2) ------------------------------------------------------------------------
    # production-system columns the load reads besides the ones derived below: the k-th is NULL on every fourth
    # line, else two letters of its name and a small number
    MT_TEXT = ["CompanyName", "DischargeType", "TerminalNo", "VehicleNo", "VehicleNum", "DriverName", "Type",
               "Creator", "ReceiptSigned", "Overtime", "Remark", "Slump", "VehiclePlate", "Grade1",
               "IsProvidePump", "Region", "TechnologyRequest", "PrintOperatorID", "PrintOperator",
               "OtherPumpType", "Code", "EgcbOrderCreator", "EgcbOrderCreatorPhone", "EGCBOrderID"]

    def _row_id(self):
        return F.concat_ws("-", *[F.col(c).cast("string") for c in ["l_orderkey", "l_linenumber", "l_partkey",
                                                                      "l_suppkey"]])

    def _site_time(self):
        return F.expr("timestampadd(HOUR, l_linenumber * 3, l_shipdate)")

    def _late_production_records(self) -> Late:
        """Production-system tickets: lineitem rows with return flag A or N."""
        lo = self._line_order().filter(F.col("l_returnflag").isin("A", "N"))
        ln, rf, ls = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus")
        d100 = F.expr("CAST(l_discount * 100 AS DECIMAL(18,2))")
        t100 = F.expr("CAST(l_tax * 100 AS DECIMAL(18,2))")
        cols = [
            self._row_id().alias("Id"),
            F.when(F.col("o_orderpriority") == "5-LOW", 2).otherwise(1).alias("TenantId"),
            F.col("l_suppkey").alias("SiteId"), self._site_time().alias("SiteDate"),
            F.col("o_custkey").alias("ProjectId"), F.col("l_partkey").alias("PlanId"),
            F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("ProjectName"),
            F.when(ln == 2, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("Department"),
            F.when(ln == 3, F.lit(None)).otherwise(F.lit("Clerk")).alias("PersonInCharge"),
            F.when(ln == 4, F.lit(None)).otherwise(F.lit("CASH")).alias("PaymentType"),
            F.when((rf == "A") & (ln == 7), F.lit("C60")).when(rf == "A", F.lit("C30"))
            .when(ls == "O", F.lit("C40")).when(ln == 1, F.lit(None)).otherwise(F.lit("C50")).alias("ConcreteCategory"),
            F.when((ls == "O") & (ln == 5), F.lit("OUTSOURCED")).alias("ProductionNature"),
            F.col("l_quantity").cast("decimal(18,2)").alias("ActQuantity"),
            (F.col("l_quantity") + 1).cast("decimal(18,2)").alias("FaceQuantity"),
            F.when(F.col("l_discount") == 0, F.lit(0).cast("decimal(18,2)"))
            .when(F.col("l_discount") == 0.01, F.lit(None))
            .otherwise(F.col("l_quantity").cast("decimal(18,2)")).alias("SignedQuantity"),
            F.when(F.col("l_tax") == 0, F.lit(None)).otherwise(t100).alias("TransferIn"),
            d100.alias("TransferOut"), ln.alias("SignedQtyDiffReason"),
            (t100 - 3).alias("DeliveryDistance"), d100.alias("HaulDistance"),
            F.when(F.col("l_discount") == 0.02, F.lit("")).when(F.col("l_discount") == 0.03, F.lit(None))
            .otherwise(F.concat(F.lit("F"), ln.cast("string"))).alias("Feature"),
            F.when(ln == 1, F.lit(None)).otherwise(F.lit("u")).alias("UpdateLogs"), F.lit("c").alias("Comment"),
            F.when(F.col("l_tax") == 0, F.lit(None)).otherwise(F.lit("p")).alias("PrintComment"),
            F.concat(F.lit("C"), ln.cast("string")).alias("Grade"),
            F.lit(None).cast("string").alias("Position"), F.col("o_custkey").alias("SourceId1"),
        ]
        cols += [F.when(ln % 4 != k % 4, F.concat(F.lit(c[:2]), ((F.col("l_suppkey") + k) % 9).cast("string"))).alias(c)
                 for k, c in enumerate(self.MT_TEXT)]
        at = self._site_time()
        cols += [(at - F.expr("INTERVAL 1 DAY")).alias("Date"), (at + F.expr("INTERVAL 1 HOUR")).alias("ProductionTime"),
                 F.when(ln != 5, at + F.expr("INTERVAL 2 HOUR")).alias("PrintTime"),
                 F.expr("CAST(l_quantity AS DECIMAL(18,2)) * 2").alias("AcumltQuantity"),
                 F.when(ln != 5, F.expr("CAST(l_tax * 100 AS DECIMAL(18,2))")).alias("Meters")]
        return self._late(lo, cols)

    def production_records(self) -> DataFrame:
        return self.late("production_records").frame()

    def stations(self) -> DataFrame:
        return self.raw("supplier").select(
            (F.col("s_suppkey") + 100000).alias("ID"),
            F.when(F.col("s_nationkey") < 5, F.lit("PARTNER")).alias("Type"),
            F.col("s_suppkey").alias("StationID_ProductionSys"), F.col("s_suppkey").alias("StationID_WeighbridgeSys"),
            F.when(F.col("s_acctbal") < 0, 1).otherwise(0).alias("isDeleted"))

    def station_reports(self) -> DataFrame:
        """One report per station and day with any lineitem shipped (id from station and day)."""
        days = self.raw("lineitem").select(F.col("l_suppkey"), F.to_date("l_shipdate").alias("ReportDate")).distinct()
        return days.select(
            (F.col("l_suppkey") * 100000 + F.datediff("ReportDate", F.lit("1990-01-01").cast("date"))).alias("ID"),
            (F.col("l_suppkey") + 100000).alias("StationID"), "ReportDate",
            F.when(F.dayofmonth("ReportDate") == 13, 1).otherwise(0).alias("isDeleted"))

    def _late_shipping(self) -> Late:
        lo = self._line_order().filter(F.col("l_returnflag") == "R")
        ln = F.col("l_linenumber")
        return self._late(lo, [
            F.concat(F.lit("WB"), F.lpad(F.col("l_orderkey").cast("string"), 10, "0"),
                     F.lpad(ln.cast("string"), 4, "0")).alias("Number"),
            F.when(ln == 6, F.lit(None)).otherwise(F.col("o_custkey")).alias("ProjectID"),
            F.col("o_custkey").alias("OriginalProjectID"),
            F.col("l_suppkey").alias("StationID"), self._row_id().alias("DeliveringID"),
            F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("ProjectName"),
            F.lit("consignee").alias("Consignee"), F.lit(None).cast("string").alias("Position"),
            F.when((F.col("o_orderstatus") == "P") & (ln == 2), 1).otherwise(0).alias("isDeleted")])

    def shipping(self) -> DataFrame:
        return self.late("shipping").frame()

    def _late_delivering(self) -> Late:
        li = self.raw("lineitem").filter(F.col("l_returnflag") == "R")
        ln = F.col("l_linenumber")
        net = F.expr("CAST(l_quantity AS DECIMAL(18,2)) * 1000 + l_linenumber")
        return self._late(li, [
            self._row_id().alias("ID"), F.col("l_partkey").alias("UserPlanID"), self._site_time().alias("GrossTime"),
            net.alias("Net"), (net - 5).alias("RealNet"),
            F.when(F.col("l_linestatus") == "O", F.lit(None)).otherwise(F.lit("M10")).alias("grade"),
            F.when(F.col("l_tax") == 0, F.lit(None)).otherwise(F.lit("DM")).alias("Item"),
            F.concat(F.lit("S"), ln.cast("string")).alias("Specification"), F.lit("g1").alias("grade1"),
            F.when(F.col("l_discount") == 0, F.lit("")).when(F.col("l_discount") == 0.01, F.lit(None))
            .otherwise(F.lit("x")).alias("feature"),
            F.lit("V").alias("Vehicle"), F.lit(0).alias("isDeleted")])

    def delivering(self) -> DataFrame:
        return self.late("delivering").frame()

    def _late_user_plans(self) -> Late:
        return self._late(self.raw("part"), [
            F.col("p_partkey").alias("id"), F.col("p_partkey").alias("PlanId"), F.col("p_type").alias("Type"),
            F.col("p_brand").alias("Creator"),
            F.when(F.col("p_size") > 40, F.lit(None)).otherwise(F.col("p_type")).alias("ConcreteCategory"),
            F.when(F.col("p_size") > 10, F.col("p_brand")).alias("EgcbOrderCreator"),
            F.concat(F.lit("+"), F.col("p_size").cast("string")).alias("EgcbOrderCreatorPhone"),
            F.when(F.col("p_size") < 30, F.col("p_partkey").cast("string")).alias("EGCBOrderID")])

    def user_plans(self) -> DataFrame:
        return self.late("user_plans").frame()

    def _late_plans(self) -> Late:
        return self._late(self.raw("part"), [F.col("p_partkey").alias("id"), F.col("p_size").cast("decimal(18,2)").alias("HaulDistance"),
                                             F.col("p_name").alias("Code")])

    def plans(self) -> DataFrame:
        return self.late("plans").frame()

    # ---- latest-effective mapping, local copy, summary ------------------------------------------
    def _material(self):
        return F.when(F.col("k") == 7, F.lit(None)).otherwise(F.col("k").cast("string"))

    def _events_kk(self, kinds: list[str]) -> DataFrame:
        e = self.raw("events").filter(F.col("event_type").isin(*kinds))
        return e.withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))

    def mappings(self) -> DataFrame:
        """MaterialMappingHistory: signup and view events are mapping versions."""
        e = self._events_kk(["signup", "view"])
        return e.select(F.col("event_id").alias("ID"), self._material().alias("RecipeMtrName"),
                        F.floor(F.col("value") / 100).cast("bigint").alias("StationID"),
                        F.when((F.col("event_type") == "view") & (F.col("value") > 400), 1).otherwise(0).alias("isDeleted"),
                        F.col("ts").alias("EffectiveTime"), (F.col("user_id") * 1000 + F.col("k")).alias("CSEMtrID"))

    def fact_amounts(self) -> DataFrame:
        """View_GetProductionFactAmt with its station: click, purchase and error events."""
        e = self._events_kk(["click", "purchase", "error"])
        return e.select(F.col("event_id").alias("ProductionDetailId"), self._material().alias("Material"),
                        F.floor(F.col("value") / 100).cast("bigint").alias("StationID"),
                        F.col("ts").alias("SiteProdTime"), F.col("value").cast("decimal(18,2)").alias("FactAmt"))

    def fact_source(self) -> DataFrame:
        """Remote fact rows with a modification time (source of the local copy)."""
        e = self._events_kk(["click", "purchase", "error", "signup", "view"])
        return e.select(F.col("k").alias("ProductionDetailId"), F.col("event_type").alias("Material"),
                        F.col("value").cast("decimal(18,2)").alias("FactAmt"), F.col("ts").alias("ModifyTime"))

    def fact_lines(self) -> DataFrame:
        """Per-material production amounts (input of the summary table)."""
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("ProductionDetailId"),
            F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("Material"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("FactAmt"))

    # ---- enrichment (J3) and stale-link reset (J4) ----------------------------------------------
    def known_names(self) -> DataFrame:
        """Names to look for and their new ones: every identifier of the benchmark texts."""
        from ledgerline.operators.analytics import IDENTIFIER
        w = F.explode(F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0)))
        return self.raw("benchmark").select(w.alias("old_name")).distinct() \
            .withColumn("new_name", F.concat(F.lit("N_"), F.upper("old_name")))

    def foreign_view(self) -> DataFrame:
        """View_GetProductionDetailsAndLPM of the foreign system: return flag N lines (ids repeat)."""
        li = self.raw("lineitem").filter(F.col("l_returnflag") == "N")
        return li.select(F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
                         .alias("Id"), F.col("l_partkey").alias("PlanId"),
                         F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("IsLubricatePumpMortar"))

    def pricing_sets(self) -> DataFrame:
        c = self.raw("customer")
        a = c.filter(F.col("c_mktsegment") == "BUILDING").select(F.lit("Project").alias("BusinessType"),
                                                                 F.col("c_custkey").alias("BusinessRelationID"))
        b = c.filter(F.col("c_acctbal") > 9000).select(F.lit("Order").alias("BusinessType"),
                                                       F.col("c_custkey").alias("BusinessRelationID"))
        d = c.filter(F.col("c_acctbal") > 9500).select(F.lit("Project").alias("BusinessType"),
                                                       F.col("c_custkey").alias("BusinessRelationID"))
        return a.unionByName(b).unionByName(d)

    def payment_types(self) -> DataFrame:
        return self.spark.createDataFrame([("CASH", "T1"), ("OFFSET", "T2"), ("CREDIT", "T3")],
                                          "PaymentType string, Type string")

    def wb_ins(self) -> DataFrame:
        return self.raw("lineitem").select(
            self._row_id().alias("Id"), F.when(F.col("l_returnflag") == "R", 2).otherwise(1).alias("TenantId"),
            F.col("l_shipdate").alias("SiteDate"), F.col("l_orderkey").alias("ReceivingDailyReportID"))

    def receiving_reports(self) -> DataFrame:
        return self.raw("orders").select(F.col("o_orderkey").alias("ID"),
                                         F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("isDeleted"))

    def receiving_details(self) -> DataFrame:
        li = self.raw("lineitem").filter(F.col("l_linestatus") == "F")
        return li.select(F.col("l_orderkey").alias("DailyReportID"), self._row_id().alias("OriginalID"))

    # ---- exported monitoring tables (K2-K7, K11, K12) ------------------------------------------
    def query_stats(self) -> DataFrame:
        """Per-statement execution statistics: events grouped by user are statements, the user's
        document is the batch text."""
        from ledgerline.operators.analytics import statement_text
        e = self._events_kk(["click", "purchase", "error", "signup", "view"])
        v = F.col("value").cast("decimal(18,2)")
        g = e.groupBy(F.col("user_id").alias("statement_id")).agg(
            F.count(F.lit(1)).alias("execution_count"), F.sum(v * 1000).cast("bigint").alias("total_worker_time"),
            F.sum(v * 1500).cast("bigint").alias("total_elapsed_time"), F.sum("k").alias("total_logical_reads"),
            F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)).cast("bigint").alias("total_physical_reads"),
            F.min("ts").alias("creation_time"), F.max("ts").alias("last_execution_time"))
        d = self.raw("documents").select(F.col("doc_id"), F.col("text"))
        j = g.join(d, F.col("statement_id") == F.col("doc_id"))
        # a batch's statement begins at an offset of its own; long-running ones also end inside the batch
        start = (F.col("statement_id") % 7 * 6).cast("int")
        end = F.when(F.col("execution_count") > 60, start + 200 + (F.col("statement_id") % 5 * 2).cast("int")) \
            .otherwise(F.lit(-1))
        return j.select("statement_id", statement_text(F.col("text"), start, end).alias("query_text"),
                        "execution_count", "total_worker_time", "total_elapsed_time", "total_logical_reads",
                        "total_physical_reads", "creation_time", "last_execution_time")

    def logged_statements(self) -> DataFrame:
        """The query log: a statement an event, by its type, and the documents' texts."""
        k = F.col("user_id").cast("string")
        kind = F.col("event_type")
        statement = (
            F.when(kind == "click", F.concat(F.lit("SELECT a FROM t"), k, F.lit(" WITH (NOLOCK)")))
            .when(kind == "purchase", F.concat(F.lit("SELECT a FROM [10.0.0."), (F.col("user_id") % 200).cast("string"),
                                               F.lit(",1433].db.dbo.t")))
            .when(kind == "error", F.lit("SELECT v FROM f_split('a,b', ',') x OUTER APPLY y"))
            .when(kind == "signup", F.concat(F.lit("INSERT INTO #tmp"), k, F.lit(" SELECT a FROM View_GetOrders")))
            .otherwise(F.concat(F.lit("SELECT 1 FROM a"), F.repeat(F.lit(" JOIN b ON 1 = 1"), (F.col("user_id") % 8).cast("int")))))
        return self.raw("events").select(statement.alias("text")).unionByName(self.raw("documents").select("text"))

    def wait_stats(self) -> DataFrame:
        e = self.raw("events")
        et = F.col("event_type")
        wt = F.when(et == "view", F.lit("SLEEP_TASK")).when(et == "signup", F.lit("WAITFOR")) \
            .otherwise(F.concat(F.upper(et), F.lit("_"), F.col("user_id").cast("string")))
        v = F.col("value").cast("decimal(18,2)")
        return e.groupBy(wt.alias("wait_type")).agg(F.sum(v * 100).cast("bigint").alias("wait_time_ms"),
                                                    F.sum(v * 10).cast("bigint").alias("signal_wait_time_ms"),
                                                    F.count(F.lit(1)).alias("waiting_tasks_count"))

    def _part_line_stats(self) -> DataFrame:
        return self.raw("lineitem").groupBy(F.col("l_partkey").alias("group_handle")).agg(
            F.count(F.lit(1)).alias("user_seeks"),
            F.max("l_quantity").cast("decimal(9,2)").alias("avg_total_user_cost"),
            (F.max("l_discount") * 1000).cast("decimal(9,2)").alias("avg_user_impact"),
            F.max("l_shipdate").alias("last_user_seek"))

    def index_groups(self) -> DataFrame:
        return self.raw("part").select(F.col("p_partkey").alias("index_group_handle"),
                                       F.col("p_partkey").alias("index_handle"))

    def index_group_stats(self) -> DataFrame:
        return self._part_line_stats()

    def index_details(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("index_handle"),
            F.concat(F.lit("[db].[dbo].["), F.col("p_type"), F.lit("]")).alias("statement"),
            F.concat(F.lit("["), F.col("p_brand"), F.lit("]")).alias("equality_columns"),
            F.when(F.col("p_size") > 25, F.lit("[p_size]")).alias("inequality_columns"),
            F.when(F.col("p_retailprice") > 1500, F.lit("[p_retailprice]")).alias("included_columns"))

    def index_physical(self) -> DataFrame:
        cnt = self.raw("lineitem").groupBy(F.col("l_partkey").alias("__pk")).agg(F.count(F.lit(1)).alias("__n"))
        p = self.raw("part").join(cnt, F.col("p_partkey") == F.col("__pk"))
        return p.select(F.col("p_name").alias("TableName"), F.col("p_brand").alias("IndexName"),
                        (F.col("p_size").cast("decimal(9,2)") * F.expr("0.8")).alias("avg_fragmentation_in_percent"),
                        (F.col("__n") * 50).alias("page_count"))

    def requests(self) -> DataFrame:
        return self.raw("events").select(
            F.col("event_id").alias("session_id"),
            # the first request of ten blocks those of the ten that failed
            F.when((F.col("event_type") == "error") & (F.col("event_id") % 10 != 0),
                   F.col("event_id") - F.col("event_id") % 10).otherwise(F.lit(0)).alias("blocking_session_id"),
            F.concat(F.col("event_type"), F.lit(":"), F.col("props")).alias("sql_text"))

    def waiting_tasks(self) -> DataFrame:
        return self.raw("events").filter(F.col("event_type") == "error").select(
            F.col("event_id").alias("session_id"), (F.col("value").cast("decimal(18,2)") * 1000).alias("wait_duration_ms"),
            F.lit("LCK_M_X").alias("wait_type"))

    def db_files(self) -> DataFrame:
        n = F.broadcast(self.raw("nation").join(F.broadcast(self.raw("region")),
                                                F.col("n_regionkey") == F.col("r_regionkey")))
        j = self.raw("supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
        return j.select(F.col("n_name").alias("database"), F.col("r_name").alias("group_name"),
                        F.when(F.col("n_regionkey").isin(0, 1), "SIMPLE").otherwise("FULL").alias("recovery_model"),
                        F.col("s_name").alias("file"),
                        ((F.col("s_acctbal").cast("decimal(18,2)") * 100).cast("bigint") + 100000).alias("size"))

    def runs(self) -> DataFrame:
        return self.raw("events").select(F.col("event_id").alias("run_id"),
                                         F.when(F.col("value") > 400, "FAILED").otherwise("OK").alias("status"),
                                         F.col("value").cast("decimal(18,2)").alias("duration"),
                                         F.concat_ws("_", "event_type", F.col("user_id").cast("string")).alias("name"),
                                         F.col("ts"))

    # ---- helpers used by several jobs ---------------------------------------------------------
    def category_group(self, c):
        return category_group(c, CATEGORY_GROUPS)

    def __call__(self, name: str) -> DataFrame:
        """Registry-style access: ``src("projects")``."""
        return getattr(self, name)()

    def late(self, name: str) -> Late:
        """``self(name)`` before its columns are worked out."""
        if hasattr(self, f"_late_{name}"):
            return getattr(self, f"_late_{name}")()
        df = self(name)
        return Late(df, {c: F.col(c) for c in df.columns})

    @staticmethod
    def _late(rows: DataFrame, cols: list[Column]) -> Late:
        return Late(rows, dict(zip(rows.select(*cols).columns, cols, strict=True)))


def _memoise(cls) -> None:
    """Build each stand-in frame once per instance (no-argument public methods)."""
    import functools
    import inspect

    for name, fn in list(vars(cls).items()):
        if name.startswith("_") or not inspect.isfunction(fn) or name in ("raw", "category_group"):
            continue
        if len(inspect.signature(fn).parameters) != 1:
            continue

        def wrap(f):
            @functools.wraps(f)
            def inner(self):
                memo = self.__dict__.setdefault("_memo", {})
                if f.__name__ not in memo:
                    memo[f.__name__] = f(self)
                return memo[f.__name__]
            return inner

        setattr(cls, name, wrap(fn))


_memoise(StandIns)
