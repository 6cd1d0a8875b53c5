"""Job parameters. Every "now" in the reference becomes the explicit ``as_of`` here."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from ledgerline.functions import fixed


@dataclass(frozen=True)
class KanbanConfig:
    as_of: dt.datetime
    # name -> comma list, as held by the reference's parameter table
    parameters: dict = field(default_factory=dict)
    # dictionary group holding the monthly-target material types, and the value it excludes
    target_type_group: str = fixed.TARGET_TYPE_GROUP_SOURCE
    target_type_exclude: str = fixed.TARGET_TYPE_EXCLUDE_SOURCE
    # parameter names read by the procedure
    excluded_companies_param: str = "NotCalcReturnCompanies"
    sales_type_param: str = "ProjectSalesTypeFilter"
    # service type whose refunds count against returns
    refund_service_type: str = fixed.REFUND_SERVICE_SOURCE
    # CRM source marker of clues converted from prospects
    prospect_source: str = fixed.PROSPECT_SOURCE
    # opportunity status meaning "won"
    won_status: int = fixed.WON_STATUS
    # vocabulary (defaults are the source system's fixed values)
    category_groups: dict = field(default_factory=lambda: dict(fixed.CATEGORY_GROUPS_SOURCE))
    six_categories: tuple = tuple(fixed.SIX_CATEGORIES_SOURCE)
    payment_keep: tuple = tuple(fixed.PAYMENT_KEEP_SOURCE)
    payment_else: str = fixed.PAYMENT_ELSE_SOURCE
    unit_tonne: str = fixed.UNIT_TONNE_SOURCE
    todo_open: int = fixed.TODO_OPEN
    follow_up_stopped: int = fixed.FOLLOW_UP_STOPPED
    # name lookups compare like the source collation (case-insensitive, trailing blanks ignored)
    ci_names: bool = True
    # a collation for all name columns of a run (``sources.collated``), so groups and DISTINCT follow it, too; None: as read
    name_collation: str | None = fixed.COLLATION

    @property
    def yday(self) -> dt.date:
        return self.as_of.date() - dt.timedelta(days=1)


@dataclass(frozen=True)
class LoadConfig:
    """Daily detail load parameters (named as the reference's ``@`` variables)."""
    creator: str = "loader"
    tenant_id: int | None = None
    default_department: str = "UNASSIGNED"
    default_payment_type: str = "ADVANCE"
    default_category: str = "STANDARD"
    default_unit: str = "M3"
    default_weighbridge_unit: str = fixed.UNIT_TONNE_SOURCE
    default_weighbridge_category: str = fixed.WEIGHBRIDGE_CATEGORY_SOURCE
    pro_coeff: float = fixed.PRO_COEFF
    financial_hours: int = fixed.FINANCIAL_HOURS
    unfilled_salesman: str = fixed.UNFILLED_SALESMAN_SOURCE
    default_type: str = fixed.OWN_PRODUCTION_SOURCE
    unit_tonne: str = fixed.UNIT_TONNE_SOURCE
    unit_m3: str = fixed.UNIT_M3_SOURCE
    remark_labels: tuple = fixed.REMARK_LABELS_SOURCE
    ci_names: bool = True
    name_collation: str | None = fixed.COLLATION
