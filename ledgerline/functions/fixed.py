"""Fixed values that must equal the source system's for right results.

Fixed values (as written in the source system, natural order):
  category group "concrete" (砼): 普混, 陶粒, 透水, 泡沫混凝土
  category group "mortar" (砂浆): 砂浆, 干混砂浆
  the six reported category names: 普混, 陶粒, 透水, 砂浆, 干混砂浆, 泡沫混凝土
  payment types kept as is: 现金 (cash), 站点抵款 (station offset); any other value or NULL -> 垫资 (advance)
  unit "tonne": 吨; unit "cubic metre": 方
  clue source of converted prospects: 潜客
  refund service type counted against returns: 支出
  dictionary group of monthly target types: 销售月度目标品类, excluding 新材料
  parameter names: NotCalcReturnCompanies, ProjectSalesTypeFilter
  opportunity status "won": 9; follow-up status "stopped": 2; to-do status "open": 1
  reason codes: 2 -> scale difference; 3, 4, 5 -> loss
  production coefficient 2.4; financial day starts 6 hours after midnight
  weighbridge weights are in kilograms: divide by 1000
  original id of a weighbridge row: last 12 characters of the ticket number
  salesman when unfilled: 未填; production nature by default: 自产; weighbridge category by default: 干混砂浆
  production remark format: 更新日志：<logs>；报表备注：<comment>；小票备注：<ticket comment>
"""

CATEGORY_GROUPS_SOURCE = {
    "砼": ["普混", "陶粒", "透水", "泡沫混凝土"],
    "砂浆": ["砂浆", "干混砂浆"],
}
SIX_CATEGORIES_SOURCE = ["普混", "陶粒", "透水", "砂浆", "干混砂浆", "泡沫混凝土"]
PAYMENT_KEEP_SOURCE = ["现金", "站点抵款"]
PAYMENT_ELSE_SOURCE = "垫资"
UNIT_TONNE_SOURCE = "吨"
UNIT_M3_SOURCE = "方"
PROSPECT_SOURCE = "潜客"
REFUND_SERVICE_SOURCE = "支出"
TARGET_TYPE_GROUP_SOURCE = "销售月度目标品类"
TARGET_TYPE_EXCLUDE_SOURCE = "新材料"
WON_STATUS = 9
FOLLOW_UP_STOPPED = 2
TODO_OPEN = 1
SCALE_DIFF_REASONS = [2]
LOSS_REASONS = [3, 4, 5]
PRO_COEFF = 2.4
FINANCIAL_HOURS = 6
WEIGHT_DIVISOR = 1000
ORIGINAL_ID_CHARS = 12
UNFILLED_SALESMAN_SOURCE = "未填"
OWN_PRODUCTION_SOURCE = "自产"
WEIGHBRIDGE_CATEGORY_SOURCE = "干混砂浆"
REMARK_LABELS_SOURCE = ("更新日志：", "；报表备注：", "；小票备注：")

# Table-level analytics (fixed values, as in the source's query-log census and monitoring queries):
#   census patterns: remote server name (IPv4 address, optionally bracketed with a port),
#     dirty-read hint WITH (NOLOCK), split function f_split / STRING_SPLIT, OUTER / CROSS APPLY,
#     view prefix View_Get, temp table #name, and statements with 5 or more JOINs
#   candidate index threshold 1000; fragmentation: > 30 REBUILD, > 10 REORGANIZE, else OK,
#     considered only above 10 percent and 1000 pages; wait statistics skip the benign wait types below
CENSUS_PATTERNS = [
    ("remote_server", r"\[?\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(,\d+)?\]?"),
    ("nolock_hint", r"(?i)with\s*\(\s*nolock\s*\)"),
    ("split_function", r"(?i)\b(f_split|string_split)\b"),
    ("apply", r"(?i)\b(outer|cross)\s+apply\b"),
    ("view_prefix", r"(?i)\bview_get\w*"),
    ("temp_table", r"#\w+"),
]
CENSUS_JOIN_PATTERN = r"(?i)\bjoin\b"
CENSUS_MIN_JOINS = 5
INDEX_ADVANTAGE_MIN = 1000
FRAG_REBUILD = 30
FRAG_REORGANIZE = 10
FRAG_MIN_PAGES = 1000
BENIGN_WAITS = [
    "CLR_SEMAPHORE", "LAZYWRITER_SLEEP", "RESOURCE_QUEUE", "SLEEP_TASK", "SLEEP_SYSTEMTASK",
    "SQLTRACE_BUFFER_FLUSH", "WAITFOR", "LOGMGR_QUEUE", "CHECKPOINT_QUEUE", "REQUEST_FOR_DEADLOCK_SEARCH",
    "XE_TIMER_EVENT", "BROKER_TO_FLUSH", "BROKER_TASK_STOP", "CLR_MANUAL_EVENT", "CLR_AUTO_EVENT",
    "DISPATCHER_QUEUE_SEMAPHORE", "FT_IFTS_SCHEDULER_IDLE_WAIT", "XE_DISPATCHER_WAIT", "XE_DISPATCHER_JOIN",
    "SQLTRACE_INCREMENTAL_FLUSH_SLEEP",
]
# how the source's databases compare text: case-insensitive, trailing blanks ignored
COLLATION = "UTF8_LCASE_RTRIM"
