"""The four workbench dashboard tables (leads and clues, opportunities, sales, returns).

``src(name)`` returns a source frame (``SourceRegistry`` or ``StandIns``); names used:
periods, prospects, prospect_assigns, prospect_todos, daily_tasks, users, clues, clue_members,
opportunities, proj_approve, salesman, departments, department_groups, projects, manage_sets,
companies, parameters, dictionary, sales_targets, details, reports, profit_month, return_targets,
receivables, finance_reports, payment_plans, payment_plan_details, payments, service_income.

Plan shape. The source builds temp tables and joins them with ``ON 1 = 1`` to every period and
type; here each fact is first reduced by (project, period) with partial aggregation, then joined
to the one-row-per-project attributes and reduced again, and the boards join per-scope sums. No
cross product of facts is formed; the only row multiplication left is by the bounded list of
material types (see ``left_on_true``).
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.config import KanbanConfig
from ledgerline.functions.exprs import (category_group, flag_or_true, live_or_null, live_strict, name_key, same_text,
                                        payment_group, unit_qty)
from ledgerline.functions.timefilters import date_lit, in_month, in_year
from ledgerline.operators.joins import attach_period, left_on_true, not_in_list, sum_by_either
from ledgerline.operators.params import in_param_list, split_param
from ledgerline.operators.sets import keyed_measures
from ledgerline.sources.collated import CollatedSources, plain

def _zero() -> "F.Column":
    return F.lit(0).cast("decimal(18,2)")


def _cnt() -> "F.Column":
    return F.count(F.lit(1))


def _z(c) -> "F.Column":
    """``ISNULL(x, 0)`` for decimal measures."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, _zero())


def _zi(c) -> "F.Column":
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0))


# ------------------------------------------------------------------------------------------------
# Stage 0: this year's periods
# ------------------------------------------------------------------------------------------------
def query_periods(src, cfg: KanbanConfig) -> DataFrame:
    """Stage 0: strict-live periods whose name starts with yesterday's year."""
    p = src("periods")
    year = F.expr("try_cast(left(PeriodName, 4) AS INT)")
    return p.filter(live_strict("isDeleted") & (year == F.lit(cfg.yday.year))).select("ID", "StartDate", "EndDate")


# ------------------------------------------------------------------------------------------------
# 1a: leads and clues
# ------------------------------------------------------------------------------------------------
def _users(src) -> DataFrame:
    return src("users").select(F.col("ID").alias("__uid"), "Username")


def leads_wait_assign(src, cfg: KanbanConfig) -> DataFrame:
    """Live-or-null prospects with no assignment row, counted by assignor and department."""
    pcm = src("prospects").filter(live_or_null("IsDeleted"))
    asg = src("prospect_assigns").select(F.col("PotentialCustomersManageID").alias("__pid"))
    pcm = pcm.join(asg, F.col("ID") == F.col("__pid"), "left_anti")
    j = pcm.join(_users(src), F.col("AssignorID") == F.col("__uid"), "left")
    return j.groupBy("Username", F.col("DeptName").alias("SalesDepartment")).agg(_cnt().alias("Qty"))


def leads_wait_follow_up(src, cfg: KanbanConfig) -> DataFrame:
    """Each prospect x each assignment; counts 1 when the assignee has no daily task on it, following
    was not stopped and no open to-do exists. Grouped by the *assignee*; zero groups are kept."""
    pcm = src("prospects").filter(live_or_null("IsDeleted")).select("ID", "DeptName", "StopFollowingUpTime")
    asg = src("prospect_assigns").select(F.col("PotentialCustomersManageID").alias("__aid"),
                                         F.col("AssignorID").alias("__assignee"))
    todo = src("prospect_todos").filter(F.col("Status") == F.lit(cfg.todo_open)) \
        .groupBy(F.col("PotentialCustomersManageID").alias("__tid")).agg(_cnt().alias("__todo"))
    task = src("daily_tasks").groupBy(F.col("PotentialCustomersManageID").alias("__kid"),
                                      F.col("UserID").alias("__kuser")).agg(_cnt().alias("__task"))
    j = pcm.join(asg, F.col("ID") == F.col("__aid"), "left") \
        .join(_users(src), F.col("__assignee") == F.col("__uid"), "left") \
        .join(todo, F.col("__tid") == F.col("ID"), "left") \
        .join(task, (F.col("ID") == F.col("__kid")) & (F.col("__assignee") == F.col("__kuser")), "left")
    flag = F.when((_zi("__task") == 0) & F.col("StopFollowingUpTime").isNull() & (_zi("__todo") == 0), 1).otherwise(0)
    return j.groupBy("Username", F.col("DeptName").alias("SalesDepartment")).agg(F.sum(flag).alias("Qty"))


def _prospect_clues(src, cfg: KanbanConfig) -> DataFrame:
    return src("clues").filter(live_or_null("isDeleted") & (F.col("Source") == F.lit(cfg.prospect_source))
                               & F.col("SourceID").isNotNull())


def clues_wait_assign(src, cfg: KanbanConfig) -> DataFrame:
    """Live-or-null clues converted from prospects, with no member rows; by owner and department."""
    pc = _prospect_clues(src, cfg)
    mem = src("clue_members").select(F.col("ProjectCustomerID").alias("__cid"))
    pc = pc.join(mem, F.col("ID") == F.col("__cid"), "left_anti")
    j = pc.join(_users(src), F.col("ClueOwnerID") == F.col("__uid"), "left")
    return j.groupBy("Username", "SalesDepartment").agg(_cnt().alias("Qty"))


def clues_wait_follow_up(src, cfg: KanbanConfig) -> DataFrame:
    """Clue x member with no task by that member, follow-up not stopped and no opportunity."""
    pc = _prospect_clues(src, cfg).select("ID", "SalesDepartment", "FollowUpStatus")
    mem = src("clue_members").select(F.col("ProjectCustomerID").alias("__cid"), F.col("MemberUserID").alias("__mid"))
    oppo = src("opportunities").groupBy(F.col("ProjCustID").alias("__oid")).agg(_cnt().alias("__oppo"))
    task = src("daily_tasks").groupBy(F.col("ProjectCustomerID").alias("__kid"),
                                      F.col("UserID").alias("__kuser")).agg(_cnt().alias("__task"))
    j = pc.join(mem, F.col("ID") == F.col("__cid"), "left") \
        .join(_users(src), F.col("__mid") == F.col("__uid"), "left") \
        .join(oppo, F.col("ID") == F.col("__oid"), "left") \
        .join(task, (F.col("ID") == F.col("__kid")) & (F.col("__mid") == F.col("__kuser")), "left")
    j = j.filter((_zi("__task") == 0) & (F.col("FollowUpStatus") != F.lit(cfg.follow_up_stopped)) & (_zi("__oppo") == 0))
    return j.groupBy("Username", "SalesDepartment").agg(_cnt().alias("Qty"))


def _attach_org(keys: DataFrame, src, dept_col: str, ci: bool = True) -> DataFrame:
    """Left join live salesman by name, live department by name (names compared as the source
    collation does), and the department's group (region)."""
    sm = src("salesman").filter(live_strict("IsDeleted")).select(F.col("ID").alias("SalesmanID"),
                                                                 name_key("UserName", ci).alias("__sname"))
    sd = src("departments").filter(live_strict("isDeleted")).select(name_key("DepartmentName", ci).alias("__dname"),
                                                                     F.col("GroupID").alias("__gid"))
    g = src("department_groups").select(F.col("ID").alias("__grp"), "RegionID")
    return keys.join(sm, name_key("Username", ci) == F.col("__sname"), "left") \
        .join(sd, name_key(dept_col, ci) == F.col("__dname"), "left") \
        .join(g, F.col("__gid") == F.col("__grp"), "left")


def board_leads(src, cfg: KanbanConfig) -> DataFrame:
    """Output 1 (``WorkbenchKanbanPCMAndClue``): the user set with the four counts, 0 by default.

    The counts attach on (department, user) equality, so a NULL user keeps zeros; same-named
    salesmen multiply rows (no DISTINCT after the salesman join). Each count is computed once
    (``keyed_measures``)."""
    frames = [(leads_wait_assign(src, cfg).withColumnRenamed("Qty", "PCMWaitAssignQty"), ["PCMWaitAssignQty"]),
              (leads_wait_follow_up(src, cfg).withColumnRenamed("Qty", "PCMWaitFollowUpQty"), ["PCMWaitFollowUpQty"]),
              (clues_wait_assign(src, cfg).withColumnRenamed("Qty", "ClueWaitAssignQty"), ["ClueWaitAssignQty"]),
              (clues_wait_follow_up(src, cfg).withColumnRenamed("Qty", "ClueWaitFollowUpQty"), ["ClueWaitFollowUpQty"])]
    keyed = keyed_measures(frames, ["SalesDepartment", "Username"])
    out = _attach_org(keyed, src, "SalesDepartment", cfg.ci_names)
    return out.select("RegionID", "SalesDepartment", F.col("Username").alias("UserName"),
                      *[_zi(c).alias(c) for c in ["PCMWaitAssignQty", "PCMWaitFollowUpQty", "ClueWaitAssignQty",
                                                  "ClueWaitFollowUpQty"]], "SalesmanID")


# ------------------------------------------------------------------------------------------------
# 1b: opportunities
# ------------------------------------------------------------------------------------------------
def _oppo_base(src, cfg: KanbanConfig) -> DataFrame:
    o = src("opportunities").filter(live_or_null("isDeleted") & F.col("ProdCateName").isin(list(cfg.six_categories)))
    o = o.withColumn("ProductCategory", category_group("ProdCateName", cfg.category_groups))
    return o.join(_users(src), F.col("UserID") == F.col("__uid"), "left")


def _approvals(src) -> DataFrame:
    return src("proj_approve").select(F.col("OppoID").alias("__oppo"), "CSEProjectID", "CSEProjectID_SJ")


def oppo_reported(src, cfg: KanbanConfig) -> DataFrame:
    o = _oppo_base(src, cfg).filter(in_month("ApprovalTime", cfg.as_of))
    return o.groupBy("Username", "DeptName", "ProductCategory").agg(
        _cnt().alias("OppoReportedQty"), F.sum(_z("ESTDSupplyQty")).alias("OppoEstimatedSupplyQty"))


def year_production(src, year: int, cfg: KanbanConfig) -> DataFrame:
    """Detail rows of live reports dated in ``year`` with the unit-dependent quantity."""
    d = src("details").select("DailyReportID", "ProjectID", "Unit", "FinalQty_T", "FinalQty_M3")
    r = src("reports").filter(live_strict("isDeleted") & in_year(F.col("ReportDate").cast("timestamp_ntz"), year)) \
        .select(F.col("ID").alias("__rid"))
    return d.join(r, F.col("DailyReportID") == F.col("__rid")) \
        .select("ProjectID", unit_qty("Unit", "FinalQty_T", "FinalQty_M3", cfg.unit_tonne).alias("__q"))


def oppo_won(src, cfg: KanbanConfig) -> DataFrame:
    """Won opportunities ending this month: count over opportunity x approval rows, and the whole
    current year's production of either approved project (J-16)."""
    o = _oppo_base(src, cfg).filter((F.col("Status") == F.lit(cfg.won_status)) & in_month("EndTime", cfg.as_of))
    o = o.join(_approvals(src), F.col("ID") == F.col("__oppo"), "left")
    prod = year_production(src, cfg.as_of.year, cfg)
    o = sum_by_either(o, "CSEProjectID", "CSEProjectID_SJ", prod, "ProjectID", F.col("__q"), "__supply")
    return o.groupBy("Username", "DeptName", "ProductCategory").agg(
        _cnt().alias("MonthWinOppoQty"), F.sum(_z("__supply")).alias("MonthWinOppoSupplyQty"))


def oppo_effective(src, cfg: KanbanConfig) -> DataFrame:
    o = _oppo_base(src, cfg).filter(in_month("SecondStageSubmitTime", cfg.as_of))
    o = o.join(_approvals(src), F.col("ID") == F.col("__oppo"), "left")
    return o.groupBy("Username", "DeptName", "ProductCategory").agg(_cnt().alias("MonthEffectiveOppoQty"))


def board_oppo(src, cfg: KanbanConfig) -> DataFrame:
    """Output 2 (``WorkbenchKanbanOppo``): distinct (region, department, salesman, user, category)
    rows of the three key sets with their measures, each measure frame computed once."""
    rep, won, eff = oppo_reported(src, cfg), oppo_won(src, cfg), oppo_effective(src, cfg)
    keys = ["DeptName", "Username", "ProductCategory"]
    keyed = keyed_measures([(rep, ["OppoReportedQty", "OppoEstimatedSupplyQty"]),
                            (won, ["MonthWinOppoQty", "MonthWinOppoSupplyQty"]), (eff, ["MonthEffectiveOppoQty"])], keys)
    out = _attach_org(keyed, src, "DeptName", cfg.ci_names)
    return out.select("RegionID", F.col("DeptName").alias("SalesDepartment"), F.col("Username").alias("UserName"),
                      F.col("ProductCategory").alias("TypeName"),
                      _zi("OppoReportedQty").alias("OppoReportedQty"),
                      _z("OppoEstimatedSupplyQty").alias("OppoEstimatedSupplyQty"),
                      _zi("MonthWinOppoQty").alias("MonthWinOppoQty"),
                      _z("MonthWinOppoSupplyQty").alias("MonthWinOppoSupplyQty"), "SalesmanID",
                      _zi("MonthEffectiveOppoQty").alias("OppoEffectiveQty")).distinct()


# ------------------------------------------------------------------------------------------------
# 1c: base sets
# ------------------------------------------------------------------------------------------------
def base_projects(src, cfg: KanbanConfig) -> DataFrame:
    """``#TempProj``: distinct live projects with a live salesman, taking part in the return
    calculation, contract company not excluded (NULL-aware NOT IN), category among the six."""
    p = src("projects").filter(live_strict("isDeleted") & F.col("ProductCategory").isin(list(cfg.six_categories)))
    sm = src("salesman").filter(live_strict("IsDeleted")).select(F.col("ID").alias("__sid"), "UserName")
    sd = src("departments").select(name_key("DepartmentName", cfg.ci_names).alias("__dname"),
                                   F.col("GroupID").alias("__gid"))
    g = src("department_groups").select(F.col("ID").alias("__grp"), "RegionID")
    ms = src("manage_sets").select(F.col("ID").alias("__msid"), "IsParticipateInReturnCalc")
    co = src("companies").select(F.col("ID").alias("__coid"), "CompanyName")
    j = p.join(sm, F.col("SalesmanID") == F.col("__sid")) \
        .join(sd, name_key("SalesDepartment", cfg.ci_names) == F.col("__dname"), "left") \
        .join(g, F.col("__gid") == F.col("__grp"), "left") \
        .join(ms, F.col("ProjectRealManageSetID") == F.col("__msid"), "left") \
        .join(co, F.col("SignCompanyID_PartyA") == F.col("__coid"), "left") \
        .filter(flag_or_true("IsParticipateInReturnCalc"))
    excluded = split_param(src("parameters"), cfg.excluded_companies_param)
    j = not_in_list(j, F.coalesce(F.col("CompanyName"), F.lit("")), excluded)
    return j.select("RegionID", "SalesDepartment", F.col("ID").alias("ProjectID"), "SalesmanID", "UserName",
                    category_group("ProductCategory", cfg.category_groups).alias("ProductCategory"),
                    payment_group("AccountingPaymentType", list(cfg.payment_keep), cfg.payment_else)
                    .alias("AccountingPaymentType")).distinct()


def base_sales(proj: DataFrame) -> DataFrame:
    """``#TempSales``: distinct salesman keys of the base projects."""
    return proj.select("RegionID", "SalesDepartment", "SalesmanID", "UserName", "AccountingPaymentType").distinct()


def material_types(src, cfg: KanbanConfig) -> DataFrame:
    """Dictionary values of the monthly-target group minus the excluded value (``!=`` drops NULL)."""
    d = src("dictionary")
    return d.filter((F.col("DataTableName") == F.lit(cfg.target_type_group))
                    & (F.col("Value") != F.lit(cfg.target_type_exclude))).select(F.col("Value").alias("TypeName"))


# ------------------------------------------------------------------------------------------------
# 1d: stages by (department, user, period, ...)
# ------------------------------------------------------------------------------------------------
PK = ["SalesDepartment", "UserName"]
PKP = PK + ["AccountingPaymentType"]


def _in_periods(df: DataFrame, col: str, periods: DataFrame) -> DataFrame:
    """``col IN (SELECT ID FROM #QueryPeriod)``: one year's period ids (a calendar year holds at most a few dozen) as an array, a
    scalar subquery. Unlike a semi join, the filter is moved below the facts' own joins, so other years' rows aren't shuffled."""
    return df.filter(F.array_contains(periods.agg(F.collect_set("ID")).scalar(), F.col(col)))


def _by_project(facts: DataFrame, proj: DataFrame, keys: list[str], aggs: dict, how: str = "inner") -> DataFrame:
    """Join facts pre-reduced by (ProjectID, PeriodID) to project attributes and reduce again."""
    p = proj.select(F.col("ProjectID").alias("__pj"), *[c for c in proj.columns if c != "ProjectID"])
    j = facts.join(p, F.col("ProjectID") == F.col("__pj"), how)
    return j.groupBy(*keys).agg(*[F.sum(_z(c)).alias(c) for c in aggs])


def stage_targets(src, cfg: KanbanConfig, periods: DataFrame) -> DataFrame:
    t = _in_periods(src("sales_targets"), "PeriodID", periods) \
        .filter(F.col("ProductCategory") != F.lit(cfg.target_type_exclude))
    sm = src("salesman").select(F.col("ID").alias("__sid"), "UserName")
    t = t.join(sm, F.col("SalesmanID") == F.col("__sid"), "left")
    return t.groupBy("SalesDepartment", "UserName", "PeriodID", "ProductCategory").agg(
        F.sum(_z("TargetQty")).alias("TargetFinalQty"), F.sum(_z("TargetAmt")).alias("TargetSalesAmt"),
        F.sum(_z("ProfitTargetAmt")).alias("ProfitTargetAmt"))


def production_by_project_period(src, cfg: KanbanConfig, periods: DataFrame) -> DataFrame:
    """Details of live reports, type in the parameter list, report date inside a period; reduced to
    (ProjectID, PeriodID). The range join runs as an equi join on the day (J-10)."""
    d = in_param_list(src("details"), "Type", src("parameters"), cfg.sales_type_param)
    d = d.select("DailyReportID", "ProjectID",
                 unit_qty("Unit", "FinalQty_T", "FinalQty_M3", cfg.unit_tonne).alias("FinalQty"),
                 _z("SalesTotalAmt1").alias("SalesAmt"))
    r = src("reports").filter(live_strict("isDeleted")).select(F.col("ID").alias("__rid"), "ReportDate")
    r = attach_period(r, "ReportDate", periods)
    j = d.join(r, F.col("DailyReportID") == F.col("__rid"))
    return j.groupBy("ProjectID", "PeriodID").agg(F.sum("FinalQty").alias("FinalQty"), F.sum("SalesAmt").alias("SalesAmt"))


def stage_production(src, cfg: KanbanConfig, periods: DataFrame, proj: DataFrame) -> DataFrame:
    """``#TempProd``: the project join is LEFT, so unmatched details form NULL groups."""
    facts = production_by_project_period(src, cfg, periods)
    return _by_project(facts, proj, PK + ["PeriodID", "ProductCategory", "AccountingPaymentType"],
                       {"FinalQty": 1, "SalesAmt": 1}, how="left")


def stage_profit(src, cfg: KanbanConfig, periods: DataFrame, proj: DataFrame) -> DataFrame:
    spp = _in_periods(src("profit_month"), "PeriodID", periods) \
        .groupBy("ProjectID", "PeriodID").agg(F.sum(_z("MonthProfitAmt")).alias("ProfitAmt"))
    return _by_project(spp, proj, PK + ["PeriodID", "ProductCategory", "AccountingPaymentType"], {"ProfitAmt": 1})


def stage_return_targets(src, cfg: KanbanConfig, periods: DataFrame, proj: DataFrame) -> DataFrame:
    """Receivable of period ``id - 1`` x the category's ratio of period ``id`` (J-11); only live
    receivables of live finance reports, target periods of this year."""
    fr = src("finance_reports").filter(live_strict("isDeleted")).select(F.col("ID").alias("__frid"))
    ar = src("receivables").filter(live_strict("isDeleted")).join(fr, F.col("FinanceRptID") == F.col("__frid"))
    ar = ar.groupBy("ProjectID", F.col("PeriodID").alias("__arp")).agg(F.sum(_z("AR")).alias("__ar"))
    t = _in_periods(src("return_targets"), "PeriodID", periods)
    p = proj.select(F.col("ProjectID").alias("__pj"), *PKP, F.col("ProductCategory").alias("__cat"))
    j = ar.join(p, F.col("ProjectID") == F.col("__pj")) \
        .join(t, same_text(t, "ProductCategoryType", p, "__cat") & (F.col("PeriodID") - 1 == F.col("__arp")))
    return j.groupBy(*PK, "PeriodID", "AccountingPaymentType").agg(
        F.sum(F.col("__ar") * _z("TargetRatio")).alias("TargetReturnAmt"))


def stage_return_plans(src, cfg: KanbanConfig, periods: DataFrame, proj: DataFrame) -> DataFrame:
    plans = _in_periods(src("payment_plans"), "PeriodID", periods) \
        .filter(live_strict("IsDeleted") & (F.col("Type") == 1)).select(F.col("ID").alias("__plid"), "PeriodID")
    det = src("payment_plan_details").filter(F.col("IsMerged") == 0)
    facts = det.join(plans, F.col("SalesPaymentPlanID") == F.col("__plid")) \
        .groupBy("ProjectID", "PeriodID").agg(F.sum(_z("ThisPaymentPromiseTarget")).alias("PlanReturnAmt"))
    return _by_project(facts, proj, PKP + ["PeriodID"], {"PlanReturnAmt": 1})


def stage_returns(src, cfg: KanbanConfig, periods: DataFrame, proj: DataFrame) -> DataFrame:
    """Payments minus expense refunds per (project, period), each cast to DECIMAL(18,2) after the
    sum. The source forms every project x every period; (project, period) pairs without money
    only add zeros to the boards, so they are not formed here."""
    pay = _in_periods(src("payments").filter(live_or_null("isDeleted")), "PeriodID", periods) \
        .groupBy("ProjectID", "PeriodID").agg(F.sum(_z("Amount")).cast("decimal(18,2)").alias("__v"))
    ref = _in_periods(src("service_income").filter(live_or_null("isDeleted")
                                                    & (F.col("ServiceType") == F.lit(cfg.refund_service_type))),
                      "PeriodID", periods) \
        .groupBy("ProjectID", "PeriodID").agg((-F.sum(_z("RefundAmt")).cast("decimal(18,2)")).alias("__v"))
    facts = pay.unionByName(ref).withColumnRenamed("__v", "ReturnAmt")
    return _by_project(facts, proj, PKP + ["PeriodID"], {"ReturnAmt": 1})


# ------------------------------------------------------------------------------------------------
# 1e / 1f: boards
# ------------------------------------------------------------------------------------------------
def _scope_sums(stage: DataFrame, current: Column, keys: list[str], measures: list[str], previous: tuple = ()) -> DataFrame:
    """A stage read once, each measure summed over every time scope (A10): ``now_`` over the periods that hold yesterday (ids
    in ``current``), ``year_`` over all periods, and for ``previous`` ones ``last_`` over the period before (J-11)."""
    now = F.array_contains(current, F.col("PeriodID"))
    before = F.array_contains(current, F.col("PeriodID") + F.lit(1))
    sums = [F.sum(F.when(now, F.col(m))).alias(f"now_{m}") for m in measures] + [F.sum(m).alias(f"year_{m}") for m in measures]
    return stage.groupBy(*keys).agg(*sums, *[F.sum(F.when(before, F.col(m))).alias(f"last_{m}") for m in previous])


def _join_keys(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    r = right
    cond = []
    for lcol, rcol in pairs:
        r = r.withColumnRenamed(rcol, f"__r_{rcol}")
        cond.append(same_text(left, lcol, r, f"__r_{rcol}"))
    out = left.join(r, reduce(lambda a, b: a & b, cond), "left")
    return out.drop(*[f"__r_{rcol}" for _, rcol in pairs])


def _current(periods: DataFrame, cfg: KanbanConfig) -> tuple[Column, Column]:
    """The ids of the periods that hold yesterday (an array, a scalar subquery over a year's periods), and whether there is one:
    TimeType 1 rows exist only then (the source's WHERE)."""
    now = periods.filter(date_lit(cfg.yday).between(F.col("StartDate"), F.col("EndDate"))).select("ID")
    return now.agg(F.collect_set("ID")).scalar(), now.exists()


def _by_scope(sums: DataFrame, keys: list[str], measures: list[str], extra: dict[str, tuple[Column, Column]], any_now: Column) -> DataFrame:
    """A row per time scope from one row with all scopes' sums; ``extra``: columns with a value for each scope."""
    def scope(k: int, prefix: str) -> Column:
        return F.struct(F.lit(k + 1).alias("TimeType"), *[F.col(f"{prefix}_{m}").alias(m) for m in measures],
                        *[v[k].alias(n) for n, v in extra.items()])
    both = F.array(scope(0, "now"), scope(1, "year"))
    return sums.select(*keys, F.explode(both).alias("__s")).select(*keys, "__s.*").filter((F.col("TimeType") == 2) | any_now)


def board_sales(src, cfg: KanbanConfig, stages: dict | None = None) -> DataFrame:
    """Output 3 (``WorkbenchKanbanSales``): TimeType 1 = the period holding yesterday, TimeType 2 =
    all this year's periods. Target quantity counts only on the advance payment type; target amount
    and profit target repeat on every payment type; LastFinalQty is the previous period's quantity
    among this year's production (so 0 in the first period) and NULL for TimeType 2.

    Each stage is read and summed once for all scopes and joined once."""
    st = stages or build_stages(src, cfg)
    current, any_now = _current(st["periods"], cfg)
    targets = ["TargetFinalQty", "TargetSalesAmt", "ProfitTargetAmt"]
    org = [("TypeName", "ProductCategory"), ("SalesDepartment", "SalesDepartment"), ("UserName", "UserName")]
    paid = org + [("AccountingPaymentType", "AccountingPaymentType")]
    b = left_on_true(st["sales"], st["types"])
    b = _join_keys(b, _scope_sums(st["targets"], current, PK + ["ProductCategory"], targets), org)
    b = _join_keys(b, _scope_sums(st["prod"], current, PKP + ["ProductCategory"], ["FinalQty", "SalesAmt"], ("FinalQty",)), paid)
    b = _join_keys(b, _scope_sums(st["profit"], current, PKP + ["ProductCategory"], ["ProfitAmt"]), paid)
    advance = F.col("AccountingPaymentType") == F.lit(cfg.payment_else)
    keys = ["RegionID", "SalesDepartment", "UserName", "TypeName", "SalesmanID", "AccountingPaymentType"]
    measures = ["TargetFinalQty", "FinalQty", "TargetSalesAmt", "SalesAmt", "ProfitTargetAmt", "ProfitAmt"]

    def total(c: str) -> Column:
        # a NULL payment type keeps its target, as in the source's CASE
        value = F.when(~advance, _zero()).otherwise(F.col(c)) if c.endswith("_TargetFinalQty") else F.col(c)
        return F.sum(_z(value)).alias(c)

    sums = b.groupBy(*keys).agg(*[total(f"{p}_{m}") for p in ("now", "year") for m in measures], total("last_FinalQty"))
    last = F.col("last_FinalQty").cast("decimal(38,6)")
    out = _by_scope(sums, keys, measures, {"LastFinalQty": (last, F.lit(None).cast("decimal(38,6)"))}, any_now)
    return out.select("RegionID", "SalesDepartment", "UserName", "TypeName", "TimeType", *measures, "SalesmanID",
                      "AccountingPaymentType", "LastFinalQty")


def board_returns(src, cfg: KanbanConfig, stages: dict | None = None) -> DataFrame:
    """Output 4 (``WorkbenchKanbanReturn``): target, plan and net return per time scope; each stage is read once."""
    st = stages or build_stages(src, cfg)
    current, any_now = _current(st["periods"], cfg)
    b = st["sales"]
    measures = {"return_targets": "TargetReturnAmt", "return_plans": "PlanReturnAmt", "returns": "ReturnAmt"}
    for stage, m in measures.items():
        b = _join_keys(b, _scope_sums(st[stage], current, PKP, [m]), [(k, k) for k in PKP])
    keys = ["RegionID", "SalesDepartment", "UserName", "SalesmanID", "AccountingPaymentType"]
    sums = b.groupBy(*keys).agg(*[F.sum(_z(f"{p}_{m}")).alias(f"{p}_{m}") for p in ("now", "year") for m in measures.values()])
    out = _by_scope(sums, keys, list(measures.values()), {}, any_now)
    return out.select("RegionID", "SalesDepartment", "UserName", "TimeType", *measures.values(), "SalesmanID", "AccountingPaymentType")


def _keep(df: DataFrame, store) -> DataFrame:
    """Keep a re-read frame: ``"persist"`` (or True) caches it at MEMORY_AND_DISK, recomputed from
    lineage if an executor is lost; ``"checkpoint"`` writes it to the shared folder named by
    ``spark.checkpoint.dir`` and cuts the lineage; False/None keeps nothing."""
    if store == "checkpoint":
        from ledgerline.session import checkpoint_dir, runtime_filters
        checkpoint_dir(df.sparkSession)
        with runtime_filters(df.sparkSession):
            return df.checkpoint(eager=True)
    if store:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    return df


class _Stages(dict):
    """Stages built on first use: a board analyses only the stage plans it reads. Each stage is a
    small aggregate (department x user x period x category) read by both time scopes and the
    previous-period lookup; keeping it (``_keep``) means the facts under it are scanned and shuffled
    once instead of once per reader."""

    def __init__(self, factories: dict, store=False):
        super().__init__()
        self._factories = factories
        self._store = store

    def __missing__(self, key):
        value = self._factories[key]()
        if key not in ("types",):
            value = _keep(value, self._store)
        self[key] = value
        return value


def build_stages(src, cfg: KanbanConfig, persist=True) -> dict:
    """All 1c/1d stages, built lazily. ``persist`` is how re-read frames are kept (see ``_keep``):
    True / "persist" caches them, "checkpoint" writes them to the shared checkpoint folder.
    Projects are read by six stages and the year's periods by all of them."""
    periods = _keep(query_periods(src, cfg), persist)
    proj = _keep(base_projects(src, cfg), persist)
    st = _Stages({
        "sales": lambda: base_sales(proj), "types": lambda: material_types(src, cfg),
        "targets": lambda: stage_targets(src, cfg, periods),
        "prod": lambda: stage_production(src, cfg, periods, proj),
        "profit": lambda: stage_profit(src, cfg, periods, proj),
        "return_targets": lambda: stage_return_targets(src, cfg, periods, proj),
        "return_plans": lambda: stage_return_plans(src, cfg, periods, proj),
        "returns": lambda: stage_returns(src, cfg, periods, proj),
    }, store=persist)
    st["periods"], st["proj"] = periods, proj
    return st


def with_audit(df: DataFrame, run_ts) -> DataFrame:
    """Creation and modification time of the refresh (one value for the whole run)."""
    from ledgerline.functions.timefilters import ts_lit
    return df.select(ts_lit(run_ts).alias("FGC_CreateDate"), ts_lit(run_ts).alias("FGC_LastModifyDate"), "*")


def run_kanban(src, cfg: KanbanConfig, persist=None) -> dict[str, DataFrame]:
    """the procedure as one job; returns the four outputs with audit columns (write them
    together with ``sources.sinks.refresh_all``). Names compare by ``cfg.name_collation``; outputs are plain text."""
    if persist is None:
        # a cluster names a shared checkpoint folder: stages survive executor loss without
        # rescanning their facts; without one (local runs, tests) they are cached
        spark = src("periods").sparkSession
        persist = "checkpoint" if spark.conf.get("spark.checkpoint.dir", None) else "persist"
    if cfg.name_collation:
        src = CollatedSources(src, cfg.name_collation)
    st = build_stages(src, cfg, persist=persist)
    outs = {
        "WorkbenchKanbanPCMAndClue": board_leads(src, cfg),
        "WorkbenchKanbanOppo": board_oppo(src, cfg),
        "WorkbenchKanbanSales": board_sales(src, cfg, st),
        "WorkbenchKanbanReturn": board_returns(src, cfg, st),
    }
    return {k: with_audit(plain(v), cfg.as_of) for k, v in outs.items()}
