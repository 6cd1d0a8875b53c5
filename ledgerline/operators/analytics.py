"""Table-level analytics re-aimed from the source's monitoring queries.

The source runs these against a live server's internal views; here each one is a DataFrame
function over exported tables with the same column names, so it runs on any size of export.
Shares of runs by status use a window over one row per status; ranks and shares over databases use none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import fixed
from ledgerline.operators.ranks import global_rank

__all__ = ["pattern_census", "names_census", "rename_refs", "rename_names", "statement_text", "cost_topk", "wait_share", "candidate_rank",
           "frag_class", "block_pairs", "size_rollup", "inventory_rollup", "run_summary", "compare_runs"]


def _dbl(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def pattern_census(texts: DataFrame, text_col: str = "text", patterns: list | None = None,
                   join_pattern: str | None = None, min_joins: int | None = None) -> DataFrame:
    """K1: per pattern, the number of texts matching it, all matches, and the share of texts.

    One pass over whole texts: every pattern becomes two conditional sums of one global aggregate
    (partial aggregation per task), then the single result row is unpivoted."""
    patterns = patterns if patterns is not None else fixed.CENSUS_PATTERNS
    join_pattern = join_pattern or fixed.CENSUS_JOIN_PATTERN
    min_joins = min_joins if min_joins is not None else fixed.CENSUS_MIN_JOINS
    t = F.col(text_col)
    aggs = [F.count(F.lit(1)).alias("__total")]
    names = []
    for name, pat in patterns:
        hits = F.regexp_count(t, F.lit(pat))  # one regex pass per pattern; a text matches iff hits > 0
        aggs += [F.sum(F.when(hits > 0, 1).otherwise(0)).alias(f"{name}__docs"),
                 F.sum(hits).alias(f"{name}__hits")]
        names.append(name)
    jn = "joins_5_plus"
    joins = F.regexp_count(t, F.lit(join_pattern))
    aggs += [F.sum(F.when(joins >= min_joins, 1).otherwise(0)).alias(f"{jn}__docs"),
             F.sum(F.when(joins >= min_joins, joins).otherwise(0)).alias(f"{jn}__hits")]
    names.append(jn)
    one = texts.agg(*aggs)
    stack = "stack({n}, {items}) AS (pattern, n_docs, n_hits)".format(
        n=len(names), items=", ".join(f"'{n}', `{n}__docs`, `{n}__hits`" for n in names))
    out = one.selectExpr("__total", stack)
    return out.select("pattern", F.coalesce("n_docs", F.lit(0)).cast("bigint").alias("n_docs"),
                      F.coalesce("n_hits", F.lit(0)).cast("bigint").alias("n_hits"),
                      F.try_divide(_dbl(F.coalesce("n_docs", F.lit(0))), _dbl("__total")).alias("share"))


def rename_refs(texts: DataFrame, id_col: str, text_col: str, names: list[tuple[str, str]]) -> DataFrame:
    """Corrected whole texts, by a name map of (pattern, new name) applied in order, and the number of
    replacements per text."""
    t = F.col(text_col)
    n = F.lit(0)
    for pattern, new_name in names:
        n = n + F.regexp_count(t, F.lit(pattern))
        t = F.regexp_replace(t, pattern, new_name)
    return texts.select(id_col, n.alias("n_replaced"), t.alias("new_text"))


#: An identifier of a statement.
IDENTIFIER = "[A-Za-z_][A-Za-z0-9_]*"
_SHELVES = 1024


def _shelved(names: DataFrame, name_col: str, value: Column) -> Column:
    """A dictionary as one value: an array of 1,024 shelves by the name's hash, so a lookup reads one shelf. It is a scalar
    subquery, so its size is bounded by what a driver may hold: some 100,000 names."""
    shelves = names.filter(F.col(name_col).isNotNull()).groupBy(F.col(name_col).alias("__n")).agg(F.max(value).alias("__v")) \
        .groupBy(F.pmod(F.xxhash64("__n"), F.lit(_SHELVES)).cast("int").alias("__s")) \
        .agg(F.map_from_entries(F.collect_list(F.struct("__n", "__v"))).alias("__m"))
    by_number = shelves.agg(F.map_from_entries(F.collect_list(F.struct("__s", "__m"))).alias("__all"))
    return by_number.select(F.transform(F.sequence(F.lit(0), F.lit(_SHELVES - 1)), lambda k: F.element_at("__all", k))).scalar()


def names_census(texts: DataFrame, text_col: str, names: DataFrame, name_col: str) -> DataFrame:
    """K1 for names: per name, the number of texts that hold it as an identifier, all its occurrences and the share of
    texts; names that no text holds have zeros. A name counts by its characters; NULL and repeated names don't add rows.

    One pass of each text whatever the number of names: its identifiers are counted per task before they are shuffled, and
    meet the names in an equi join, so the names may be any number."""
    ids = F.regexp_extract_all(F.col(text_col), F.lit(IDENTIFIER), F.lit(0))
    mark = lambda words, doc, hit: F.transform(words, lambda w: F.struct(w.alias("w"), F.lit(doc).alias("d"), F.lit(hit).alias("h")))
    words = texts.select(ids.alias("__i")).select(F.explode(F.concat(mark(F.array_distinct("__i"), 1, 0), mark(F.col("__i"), 0, 1))).alias("__e"))
    per_word = words.groupBy(F.col("__e.w").alias("__w")).agg(F.sum("__e.d").alias("n_docs"), F.sum("__e.h").alias("n_hits"))
    asked = names.select(F.col(name_col).alias("name")).filter(F.col("name").isNotNull()).distinct()
    total = texts.agg(F.count(F.lit(1))).scalar()
    out = asked.join(per_word, F.col("name") == F.col("__w"), "left")
    counted = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_docs", "n_hits")]
    return out.select("name", *counted).withColumn("share", F.try_divide(_dbl("n_docs"), _dbl(total)))


def rename_names(texts: DataFrame, id_col: str, text_col: str, names: DataFrame, old: str, new: str) -> DataFrame:
    """K10 for many names: whole texts in which every identifier that is an ``old`` name is replaced by its ``new`` one, and
    the number of replacements. Replaced text isn't looked at again; of several new names of one old name the greatest counts;
    a NULL text has no identifiers and stays NULL.

    One pass of each text whatever the number of names: it is cut at its identifiers once, and each is looked up."""
    t = F.col(text_col)
    book = _shelved(names, old, F.col(new))
    # what stands between identifiers and the identifiers, in turn
    gaps, found = F.split(t, IDENTIFIER), F.regexp_extract_all(t, F.lit(IDENTIFIER), F.lit(0))
    lookup = lambda w: F.element_at(F.get("__book", F.pmod(F.xxhash64(w), F.lit(_SHELVES)).cast("int")), w)
    out = texts.select(F.col(id_col), gaps.alias("__g"), found.alias("__f"), book.alias("__book")).withColumn("__n", F.transform("__f", lookup))
    pairs = F.zip_with(F.col("__f"), F.col("__n"), lambda f, n: F.coalesce(n, f))
    text = F.concat_ws("", F.flatten(F.zip_with(F.col("__g"), pairs, lambda g, p: F.array(g, F.coalesce(p, F.lit(""))))))
    n = F.size(F.filter("__n", lambda x: x.isNotNull()))
    return out.select(id_col, F.when(F.col("__f").isNull(), 0).otherwise(n).alias("n_replaced"),
                      F.when(F.col("__f").isNotNull(), text).alias("new_text"))


def statement_text(text: Column, start_offset: Column, end_offset: Column) -> Column:
    """The statement inside a batch text from byte offsets of an NVARCHAR buffer (2 bytes per
    character); ``end = -1`` means the end of the text (X12)."""
    start = (start_offset / 2 + 1).cast("int")
    return F.when(end_offset == -1, text.substr(start, F.length(text))) \
        .otherwise(text.substr(start, ((end_offset - start_offset) / 2 + 1).cast("int")))


def cost_topk(stats: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` statements with the largest total CPU, with per-call averages.

    ``stats``: statement_id, query_text, execution_count, total_worker_time (us), total_elapsed_time (us),
    total_logical_reads, total_physical_reads, creation_time, last_execution_time."""
    out = stats.select(
        "statement_id", "query_text", "execution_count",
        (_dbl("total_worker_time") / 1000000.0).alias("total_cpu_sec"),
        # whole microseconds a call first: the source divides integers
        (_dbl(F.expr("total_worker_time DIV nullif(execution_count, 0)")) / 1000.0).alias("avg_cpu_ms"),
        (_dbl("total_elapsed_time") / 1000000.0).alias("total_elapsed_sec"),
        "total_logical_reads", "total_physical_reads", "creation_time", "last_execution_time",
        F.col("total_worker_time").alias("__order"))
    return out.orderBy(F.col("__order").desc(), F.col("statement_id")).limit(k).drop("__order")


def wait_share(waits: DataFrame, exclude: list | None = None) -> DataFrame:
    """K3: wait statistics without benign waits: seconds, resource wait = total - signal, whole
    milliseconds per task with a zero guard, share of all kept wait time; positive waits only, largest first."""
    exclude = exclude if exclude is not None else fixed.BENIGN_WAITS
    w = waits.filter(~F.col("wait_type").isin(list(exclude)) & (F.col("wait_time_ms") > 0))
    total = w.agg(F.sum("wait_time_ms")).scalar()  # one row, aggregated in every task first
    out = w.select(
        "wait_type", (_dbl("wait_time_ms") / 1000.0).alias("wait_time_sec"),
        (_dbl(F.col("wait_time_ms") - F.col("signal_wait_time_ms")) / 1000.0).alias("resource_wait_sec"),
        (_dbl("signal_wait_time_ms") / 1000.0).alias("signal_wait_sec"), "waiting_tasks_count",
        F.expr("wait_time_ms DIV nullif(waiting_tasks_count, 0)").alias("avg_wait_ms"),
        (_dbl("wait_time_ms") / _dbl(total)).alias("share"), F.col("wait_time_ms").alias("__o"))
    return out.orderBy(F.col("__o").desc(), "wait_type").drop("__o")


def candidate_rank(groups: DataFrame, stats: DataFrame, details: DataFrame,
                   threshold: float | None = None) -> DataFrame:
    """K4: index candidates: advantage = seeks x cost x impact%, three-table equi join, above the
    threshold, with the generated CREATE INDEX text, best first."""
    threshold = threshold if threshold is not None else fixed.INDEX_ADVANTAGE_MIN
    j = groups.join(stats, groups["index_group_handle"] == stats["group_handle"]) \
        .join(details, groups["index_handle"] == details["index_handle"])
    adv = (F.col("user_seeks").cast("decimal(19,0)") * F.col("avg_total_user_cost")
           * (F.col("avg_user_impact") * F.expr("0.01"))).cast("decimal(18,2)")
    stmt = F.col("statement")
    name = F.regexp_replace(F.regexp_replace(F.regexp_replace(stmt, r"\[", ""), r"\]", ""), r"\.", "_")
    text = F.concat(
        F.lit("CREATE INDEX IX_"), name, F.lit(" ON "), stmt, F.lit(" ("),
        F.coalesce(F.col("equality_columns"), F.lit("")),
        F.when(F.col("inequality_columns").isNotNull(), F.concat(F.lit(","), F.col("inequality_columns")))
        .otherwise(F.lit("")),
        F.lit(")"),
        F.when(F.col("included_columns").isNotNull(), F.concat(F.lit(" INCLUDE ("), F.col("included_columns"), F.lit(")")))
        .otherwise(F.lit("")))
    out = j.select(adv.alias("index_advantage"), "last_user_seek", stmt.alias("table_name"), "equality_columns",
                   "inequality_columns", "included_columns", text.alias("create_index_statement"))
    return out.filter(F.col("index_advantage") > F.lit(threshold)).orderBy(F.col("index_advantage").desc(),
                                                                          "create_index_statement")


def frag_class(stats: DataFrame, rebuild: float | None = None, reorganize: float | None = None,
               min_pages: int | None = None) -> DataFrame:
    """K5: fragmented indexes above the thresholds with a REBUILD / REORGANIZE / OK label."""
    rebuild = rebuild if rebuild is not None else fixed.FRAG_REBUILD
    reorganize = reorganize if reorganize is not None else fixed.FRAG_REORGANIZE
    min_pages = min_pages if min_pages is not None else fixed.FRAG_MIN_PAGES
    f = F.col("avg_fragmentation_in_percent")
    label = F.when(f > rebuild, "REBUILD").when(f > reorganize, "REORGANIZE").otherwise("OK")
    out = stats.filter((f > reorganize) & (F.col("page_count") > min_pages)).select(
        "TableName", "IndexName", f.alias("avg_fragmentation_in_percent"), "page_count", label.alias("Recommendation"))
    return out.orderBy(F.col("avg_fragmentation_in_percent").desc(), "TableName", "IndexName")


def block_pairs(requests: DataFrame, waits: DataFrame) -> DataFrame:
    """K6: each blocked request paired with its blocker (self equi join on the session id) and its
    current wait."""
    blocked = requests.filter(F.col("blocking_session_id") != 0).select(
        F.col("session_id").alias("blocked_session_id"), F.col("blocking_session_id"),
        F.col("sql_text").alias("blocked_query"))
    blocking = requests.select(F.col("session_id").alias("__bs"), F.col("sql_text").alias("blocking_query"))
    w = waits.select(F.col("session_id").alias("__ws"), "wait_duration_ms", "wait_type")
    return blocked.join(blocking, F.col("blocking_session_id") == F.col("__bs")) \
        .join(w, F.col("__ws") == F.col("blocked_session_id")) \
        .select("blocking_session_id", "blocked_session_id", "blocked_query", "blocking_query", "wait_duration_ms",
                "wait_type")


def size_rollup(files: DataFrame, top: int = 5) -> DataFrame:
    """Size per database in MB (``CAST(SUM(size) * 8.0 / 1024 AS DECIMAL(10,2))``, here 20 digits),
    its group, share of the total, rank, size bucket, and top-N-or-other label.

    ``files``: database, group_name, recovery_model, size (8 KB pages). The total is a scalar subquery, the rank comes from
    counts per range of sizes (``ranks.global_rank``), so no task holds all databases."""
    per_db = files.groupBy("database", "group_name", "recovery_model").agg(
        (F.sum("size") * F.expr("8.0") / F.lit(1024)).cast("decimal(20,2)").alias("size_mb"),
        F.count(F.lit(1)).alias("files"))
    gb = _dbl("size_mb") / 1024.0
    bucket = F.when(gb > 50, "XL (>50GB)").when(gb >= 10, "L (10-50GB)").when(gb >= 1, "M (1-10GB)") \
        .otherwise("S (<1GB)")
    total = per_db.agg(F.sum("size_mb")).scalar()
    out = global_rank(per_db, "size_mb").select(
        "database", "group_name", "recovery_model", "files", "size_mb", gb.alias("size_gb"),
        (_dbl("size_mb") / _dbl(total)).alias("share"), "rank", bucket.alias("bucket"))
    return out.withColumn("top_label", F.when(F.col("rank") <= top, F.col("database")).otherwise(F.lit("other")))


def run_summary(runs: DataFrame, threshold_sec: float = 1.0) -> DataFrame:
    """Runs by status with share, mean time, slowest run and runs above a threshold.

    ``runs``: run_id, status, duration (seconds, decimal). The slowest run is ``max(struct(duration,
    run_id))``: ties go to the largest id, deterministically."""
    g = runs.groupBy("status").agg(
        F.count(F.lit(1)).alias("runs"),
        (_dbl(F.sum("duration")) / F.count(F.lit(1))).alias("mean_sec"),
        F.max(F.struct("duration", "run_id")).alias("__slow"),
        F.sum(F.when(F.col("duration") > threshold_sec, 1).otherwise(0)).cast("bigint").alias("over_threshold"))
    return g.select("status", "runs", (_dbl("runs") / _dbl(F.sum("runs").over(Window.partitionBy()))).alias("share"),
                    "mean_sec", F.col("__slow.run_id").alias("slowest_run"),
                    _dbl("__slow.duration").alias("slowest_sec"), "over_threshold")


def compare_runs(before: DataFrame, after: DataFrame, key: str = "name") -> DataFrame:
    """Per name, mean time before and after, time saved, percent saved and speed-up (zero
    guards), and the share of rows in each run. A name that only one run has keeps its row, with 0 rows and no
    times for the other run. ``before``/``after``: name, duration."""
    def agg(df, tag):
        return df.groupBy(key).agg(F.count(F.lit(1)).alias(f"rows_{tag}"),
                                   (_dbl(F.sum("duration")) / F.count(F.lit(1))).alias(f"mean_{tag}"))
    j = agg(before, "before").join(agg(after, "after"), key, "full").fillna(0, ["rows_before", "rows_after"])
    b, a = F.col("mean_before"), F.col("mean_after")
    return j.select(key, "rows_before", "rows_after", "mean_before", "mean_after", (b - a).alias("saved_sec"),
                    ((b - a) / F.nullif(b, F.lit(0.0)) * 100.0).alias("saved_pct"),
                    (b / F.nullif(a, F.lit(0.0))).alias("speedup"),
                    (_dbl("rows_before") / _dbl(F.col("rows_before") + F.col("rows_after"))).alias("share_before"))


def inventory_rollup(per_db: DataFrame) -> DataFrame:
    """K7: the database inventory rolled up by group and by recovery mode: number of databases,
    size in MB and share of the total, one row per (dimension, value). ``per_db`` is the output of
    ``size_rollup`` (one row per database, so the global window is bounded by the databases)."""
    parts = []
    for dim, col in (("group", "group_name"), ("recovery_model", "recovery_model")):
        parts.append(per_db.groupBy(F.col(col).alias("value")).agg(
            F.count(F.lit(1)).alias("databases"), F.sum("size_mb").alias("size_mb"))
            .withColumn("dimension", F.lit(dim)))
    out = parts[0].unionByName(parts[1])
    w = Window.partitionBy("dimension")
    return out.select("dimension", "value", "databases", _dbl("size_mb").alias("size_mb"),
                      (_dbl("size_mb") / _dbl(F.sum("size_mb").over(w))).alias("share"))
