"""Every operator as a named query over the driver tables, with its SQL counterpart.

The tables hold no nulls, copies or untidy labels, so the queries add them with the
same expressions on both sides. Results are rounded half-even on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tallyloom as tl
from tallyloom.learning.features import (
    CategoryLevels,
    FeatureVector,
    NumericPrep,
    feature_stages,
    feature_table,
    vector_places,
    with_class_weight,
)
from tallyloom.sources.tables import staging_path
from tallyloom.spec import TableSpec, rounded

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---------------------------------------------------------------- inputs with gaps

GAPS = {
    "flag": "CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_returnflag END",
    "status": "CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE l_linestatus END",
    "label": "CASE WHEN l_linenumber % 3 = 0 THEN concat(' ', l_linestatus, '..') ELSE l_linestatus END",
    "quantity": "CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_quantity END",
    "discount": "CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE l_discount END",
}
GAPS_SQL = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in GAPS.items()) + " FROM lineitem"
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in GAPS.items()])


def union_all(template: str, names: list[str]) -> str:
    return " UNION ALL ".join(
        template.replace("{i}", str(i)).replace("{c}", c) for i, c in enumerate(names)
    )


# ---------------------------------------------------------------- profiles

GROUP_STATS_SQL = """
SELECT l_returnflag, l_linestatus, count(*) AS count,
       round_even(avg(l_quantity), 6) AS avg_quantity,
       round_even(avg(l_discount), 6) AS avg_discount
FROM lineitem GROUP BY l_returnflag, l_linestatus
"""


@query("group_stats", GROUP_STATS_SQL)
def group_stats(spark, sf):
    grouped = tl.group_summary(
        table(spark, sf, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        {"avg_quantity": "l_quantity", "avg_discount": "l_discount"},
    )
    return rounded(grouped, 6)


@query(
    "group_stats_with_gaps",
    f"""SELECT flag, status, count(*) AS count, round_even(avg(quantity), 1) AS avg_quantity,
               round_even(avg(discount), 3) AS avg_discount
        FROM ({GAPS_SQL}) WHERE flag IS NOT NULL AND status IS NOT NULL
        GROUP BY flag, status ORDER BY count DESC, flag, status""",
)
def group_stats_with_gaps(spark, sf):
    means = {"avg_quantity": "quantity", "avg_discount": "discount"}
    grouped = tl.group_summary(with_gaps(spark, sf), ["flag", "status"], means)
    shown = grouped.select(
        "flag", "status", "count",
        F.bround("avg_quantity", 1).alias("avg_quantity"),
        F.bround("avg_discount", 3).alias("avg_discount"),
    )
    return tl.by_count(shown, ["flag", "status"])


@query("shape", "SELECT count(*) AS n_rows, 6 AS n_cols FROM orders".replace("6 AS", "CAST(6 AS BIGINT) AS"))
def shape(spark, sf):
    return tl.shape(table(spark, sf, "orders"))


@query(
    "null_profile",
    f"WITH raw AS ({GAPS_SQL}) SELECT * FROM ("
    + union_all(
        """SELECT '{c}' AS "column", count(*) - count({c}) AS n_null,
                  round_even((count(*) - count({c})) * 100.0::DOUBLE / count(*), 6) AS null_pct FROM raw""",
        list(GAPS),
    )
    + ") WHERE n_null > 0",
)
def null_profile(spark, sf):
    return rounded(tl.null_profile(with_gaps(spark, sf)), 6)


@query(
    "total_nulls",
    f"SELECT CAST({' + '.join(f'(count(*) - count({c}))' for c in GAPS)} AS BIGINT) AS n_null FROM ({GAPS_SQL})",
)
def total_nulls(spark, sf):
    return tl.total_nulls(with_gaps(spark, sf))


@query(
    "dup_count",
    f"""SELECT CAST((SELECT count(*) FROM ({GAPS_SQL})) -
               (SELECT count(*) FROM (SELECT DISTINCT * FROM ({GAPS_SQL}))) AS BIGINT) AS n_duplicates""",
)
def dup_count(spark, sf):
    return tl.duplicate_count(with_gaps(spark, sf))


@query(
    "describe_numeric",
    union_all(
        """SELECT {i} AS "position", '{c}' AS "column", count({c}) AS "count",
             round_even(avg({c}), 6) AS mean, round_even(stddev_samp({c}), 6) AS std, min({c}) AS min,
             round_even(quantile_cont({c}, 0.25), 6) AS q1, round_even(quantile_cont({c}, 0.5), 6) AS median,
             round_even(quantile_cont({c}, 0.75), 6) AS q3, max({c}) AS max FROM lineitem""",
        MEASURES,
    ),
)
def describe_numeric(spark, sf):
    return rounded(tl.describe_numeric(table(spark, sf, "lineitem"), MEASURES), 6)


@query(
    "describe_with_gaps",
    f"WITH raw AS ({GAPS_SQL}) "
    + union_all(
        """SELECT {i} AS "position", '{c}' AS "column", count({c}) AS "count",
             round_even(avg({c}), 2) AS mean, round_even(stddev_samp({c}), 2) AS std, min({c}) AS min,
             round_even(quantile_cont({c}, 0.25), 2) AS q1, round_even(quantile_cont({c}, 0.5), 2) AS median,
             round_even(quantile_cont({c}, 0.75), 2) AS q3, max({c}) AS max FROM raw""",
        ["quantity", "discount"],
    ),
)
def describe_with_gaps(spark, sf):
    return rounded(tl.describe_numeric(with_gaps(spark, sf)), 2)


@query(
    "quantiles_narrowed",
    union_all(
        """SELECT '{c}' AS "column", round_even(quantile_cont({c}, 0.01), 6) AS p1,
             round_even(quantile_cont({c}, 0.5), 6) AS p50, round_even(quantile_cont({c}, 0.999), 6) AS p99_9
           FROM orders""",
        ["o_totalprice", "o_custkey"],
    ),
)
def quantiles_narrowed(spark, sf):
    found = tl.quantiles(
        table(spark, sf, "orders"), ["o_totalprice", "o_custkey"], [0.01, 0.5, 0.999], names=["p1", "p50", "p99_9"]
    )
    return rounded(found, 6)


@query(
    "quantiles_by_group",
    union_all(
        """SELECT event_type, '{c}' AS "column", round_even(quantile_cont({c}, 0.1), 6) AS p10,
             round_even(quantile_cont({c}, 0.9), 6) AS p90 FROM events GROUP BY event_type""",
        ["value", "user_id"],
    ),
)
def quantiles_by_group(spark, sf):
    found = tl.quantiles(table(spark, sf, "events"), ["value", "user_id"], [0.1, 0.9], by=["event_type"])
    return rounded(found, 6)


@query(
    "quantiles_many_groups",
    """SELECT CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS customer, 'o_totalprice' AS "column",
         round_even(quantile_cont(o_totalprice, 0.25), 6) AS p25, round_even(quantile_cont(o_totalprice, 0.5), 6) AS p50
       FROM orders GROUP BY 1""",
)
def quantiles_many_groups(spark, sf):
    """As many groups as customers, one of which holds a third of the rows."""
    rows = table(spark, sf, "orders").withColumn(
        "customer", F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(F.col("o_custkey"))
    )
    return rounded(tl.quantiles(rows, ["o_totalprice"], [0.25, 0.5], by=["customer"]), 6)


@query(
    "describe_text_only",
    """SELECT 0 AS "position", '' AS "column", 0::BIGINT AS "count", 0.0 AS mean, 0.0 AS std, 0.0 AS min, 0.0 AS q1,
         0.0 AS median, 0.0 AS q3, 0.0 AS max FROM customer WHERE c_custkey IS NULL""",
)
def describe_text_only(spark, sf):
    return tl.describe_numeric(table(spark, sf, "customer").select("c_name", "c_mktsegment"))


@query(
    "eda_text_only",
    """WITH c AS (SELECT c_mktsegment AS s, nullif(c_mktsegment, 'BUILDING') AS g FROM customer), k AS (SELECT count(*) AS n FROM c)
    SELECT 'shape' AS section, 'table' AS item, 'n_rows' AS metric, n::DOUBLE AS value_num, NULL AS value_str FROM k
    UNION ALL SELECT 'shape', 'table', 'n_cols', 2, NULL
    UNION ALL SELECT 'duplicates', 'table', 'n_duplicates', n - (SELECT count(*) FROM (SELECT DISTINCT s, g FROM c)), NULL FROM k
    UNION ALL SELECT 'dtypes', x, 'dtype', NULL, 'string' FROM (VALUES ('s'), ('g')) v(x)
    UNION ALL SELECT 'nulls', 'g', 'n_null', count(*), NULL FROM c WHERE g IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'nulls', 'g', 'null_pct', round_even(100.0 * count(*) / (SELECT n FROM k), 6), NULL FROM c WHERE g IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'target', s, 'n', count(*), NULL FROM c GROUP BY s
    UNION ALL SELECT 'target', s, 'pct', round_even(count(*) * 100.0::DOUBLE / (SELECT n FROM k), 6), NULL FROM c GROUP BY s""",
)
def eda_text_only(spark, sf):
    rows = table(spark, sf, "customer").selectExpr("c_mktsegment AS s", "nullif(c_mktsegment, 'BUILDING') AS g")
    return rounded(tl.eda_summary(rows, "s"), 6)


@query(
    "categories_numbers_only",
    """SELECT 0 AS position, '' AS "column", 0::BIGINT AS n_unique, 0 AS rank, '' AS value, 0::BIGINT AS n, 0.0 AS pct
       FROM orders WHERE o_orderkey IS NULL""",
)
def categories_numbers_only(spark, sf):
    return tl.categorical_profile(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"))


PROFILE_SQL = """
WITH v AS ({values}),
t AS (SELECT "column", sum(n) AS total, count(*) AS n_unique FROM v GROUP BY "column"),
r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank FROM v)
SELECT r.position, r."column", t.n_unique, CAST(r.rank AS INTEGER) AS rank, r.value, r.n,
       round_even(r.n * 100.0::DOUBLE / t.total, 6) AS pct
FROM r JOIN t USING ("column") WHERE r.rank <= {top}
"""


@query(
    "categorical_profile",
    PROFILE_SQL.format(
        values=union_all(
            """SELECT {i} AS position, '{c}' AS "column", {c} AS value, count(*) AS n
               FROM part WHERE {c} IS NOT NULL GROUP BY {c}""",
            ["p_name", "p_brand", "p_type"],
        ),
        top=3,
    ),
)
def categorical_profile(spark, sf):
    return rounded(tl.categorical_profile(table(spark, sf, "part")), 6)


@query(
    "categorical_profile_with_gaps",
    f"WITH raw AS ({GAPS_SQL}) "
    + PROFILE_SQL.format(
        values=union_all(
            """SELECT {i} AS position, '{c}' AS "column", {c} AS value, count(*) AS n
               FROM raw WHERE {c} IS NOT NULL GROUP BY {c}""",
            ["flag", "status", "label"],
        ),
        top=2,
    ).replace("\nWITH v", ", v", 1),
)
def categorical_profile_with_gaps(spark, sf):
    return rounded(tl.categorical_profile(with_gaps(spark, sf), top_n=2), 6)


@query(
    "value_counts",
    union_all(
        """SELECT '{c}' AS "column", {c} AS value, count(*) AS n FROM customer GROUP BY {c}""",
        ["c_name", "c_mktsegment"],
    ),
)
def value_counts(spark, sf):
    return tl.value_counts(table(spark, sf, "customer"))


@query(
    "target_share",
    """SELECT o_orderpriority AS label, count(*) AS n,
              round_even(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM orders), 6) AS pct
       FROM orders GROUP BY o_orderpriority""",
)
def target_share(spark, sf):
    return rounded(tl.target_share(table(spark, sf, "orders"), "o_orderpriority"), 6)


@query(
    "majority_share",
    """SELECT round_even(max(n) / sum(n), 6) AS majority_share
       FROM (SELECT count(*)::DOUBLE AS n FROM events GROUP BY event_type)""",
)
def majority_share(spark, sf):
    return rounded(tl.majority_share(table(spark, sf, "events"), "event_type"), 6)


def _eda_row(section: str, item: str, metric: str, value: str, source: str) -> str:
    return (
        f"SELECT '{section}' AS section, {item} AS item, '{metric}' AS metric, "
        f"round_even(CAST({value} AS DOUBLE), 6) AS value_num, CAST(NULL AS VARCHAR) AS value_str FROM {source}"
    )


def _eda_sql() -> str:
    parts = [
        _eda_row("shape", "'table'", "n_rows", "count(*)", "raw"),
        _eda_row("shape", "'table'", "n_cols", "5", "(SELECT 1)"),
        _eda_row(
            "duplicates", "'table'", "n_duplicates",
            "(SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw))", "(SELECT 1)",
        ),
        _eda_row("target", "label", "n", "count(*)", "raw GROUP BY label"),
        _eda_row("target", "label", "pct", "count(*) * 100.0::DOUBLE / (SELECT count(*) FROM raw)", "raw GROUP BY label"),
    ]
    for name in ("flag", "status", "label", "quantity", "discount"):
        dtype = "double" if name in ("quantity", "discount") else "string"
        parts.append(f"SELECT 'dtypes', '{name}', 'dtype', CAST(NULL AS DOUBLE), '{dtype}'")
    for name in ("flag", "status", "quantity", "discount"):
        nulls = f"count(*) - count({name})"
        parts.append(_eda_row("nulls", f"'{name}'", "n_null", nulls, "raw"))
        parts.append(_eda_row("nulls", f"'{name}'", "null_pct", f"({nulls}) * 100.0::DOUBLE / count(*)", "raw"))
    for name in ("quantity", "discount"):
        for metric, value in {
            "count": "count({c})", "mean": "avg({c})", "std": "stddev_samp({c})", "min": "min({c})",
            "q1": "quantile_cont({c}, 0.25)", "median": "quantile_cont({c}, 0.5)",
            "q3": "quantile_cont({c}, 0.75)", "max": "max({c})",
        }.items():
            parts.append(_eda_row("describe", f"'{name}'", metric, value.replace("{c}", name), "raw"))
    return f"WITH raw AS ({GAPS_SQL}) " + " UNION ALL ".join(parts)


@query("eda_summary", _eda_sql())
def eda_summary(spark, sf):
    return rounded(tl.eda_summary(with_gaps(spark, sf), "label"), 6)


# ---------------------------------------------------------------- cleaning


@query("dedupe", f"SELECT DISTINCT * FROM ({GAPS_SQL})")
def dedupe(spark, sf):
    return tl.dedupe(with_gaps(spark, sf))


def _mode_sql(c: str, source: str) -> str:
    return (
        f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
    )


CLEAN_CTE = f"""WITH raw AS ({GAPS_SQL}), d AS (SELECT DISTINCT * FROM raw),
cleaned AS (SELECT coalesce(flag, {_mode_sql('flag', 'd')}) AS flag,
  coalesce(status, {_mode_sql('status', 'd')}) AS status,
  regexp_replace(trim(label), '\\.+$', '') AS label,
  coalesce(quantity, (SELECT quantile_cont(quantity, 0.5) FROM d)) AS quantity,
  coalesce(discount, (SELECT quantile_cont(discount, 0.5) FROM d)) AS discount FROM d)
"""


@query(
    "clean_table",
    CLEAN_CTE
    + """SELECT flag, status, label, round_even(quantity, 6) AS quantity,
                round_even(discount, 6) AS discount FROM cleaned""",
)
def clean_table(spark, sf):
    return rounded(tl.clean(with_gaps(spark, sf), "label").table, 6)


@query(
    "clean_history",
    CLEAN_CTE
    + """SELECT CAST((SELECT count(*) FROM raw) - (SELECT count(*) FROM d) AS BIGINT) AS dropped_duplicates,
         (SELECT 2 * count(*) - count(flag) - count(status) FROM d)::BIGINT AS filled_categorical,
         (SELECT 2 * count(*) - count(quantity) - count(discount) FROM d)::BIGINT AS filled_numeric""",
)
def clean_history(spark, sf):
    return tl.clean(with_gaps(spark, sf), "label").history


IMPACT_SQL = CLEAN_CTE + ", impact AS (" + union_all(
    """SELECT {i} AS position, '{c}' AS "column", m AS mode, n_filled,
         round_even(before_pct, 6) AS before_pct, round_even(after_pct, 6) AS after_pct,
         round_even(after_pct - before_pct, 6) AS delta_pp
       FROM (SELECT max(m) AS m, count(*) - count({c}) AS n_filled,
               count(*) FILTER ({c} = m) * 100.0::DOUBLE / count({c}) AS before_pct,
               (SELECT count(*) FILTER ({c} = m2) * 100.0::DOUBLE / count(*)
                FROM cleaned, (SELECT MODE_OF_{c} AS m2)) AS after_pct
             FROM raw, (SELECT MODE_OF_{c} AS m))""",
    ["flag", "status"],
).replace("MODE_OF_flag", _mode_sql("flag", "raw")).replace("MODE_OF_status", _mode_sql("status", "raw")) + ") "


@query("imputation_impact", IMPACT_SQL + "SELECT * FROM impact")
def imputation_impact(spark, sf):
    raw = with_gaps(spark, sf)
    return rounded(tl.imputation_impact(raw, tl.clean(raw, "label").table), 6)


@query("worst_impact", IMPACT_SQL + "SELECT * FROM impact ORDER BY round_even(delta_pp, 2) DESC, position LIMIT 1")
def worst_impact(spark, sf):
    raw = with_gaps(spark, sf)
    return rounded(tl.worst_impact(tl.imputation_impact(raw, tl.clean(raw, "label").table)), 6)


DIRTY = {
    "event_id": "event_id",
    "kind": "CASE WHEN event_id % 5 = 0 THEN concat(' ', event_type, '.. ') "
    "WHEN event_id % 5 = 2 THEN concat(chr(9), event_type, chr(160), chr(9)) WHEN event_id % 5 = 1 THEN ' ? ' ELSE event_type END",
    "note": "CASE WHEN user_id % 3 = 0 THEN '?' WHEN user_id % 3 = 1 THEN concat(props, '  ') ELSE props END",
}
WHITE = "' ' || chr(9) || chr(160)"
DIRTY_SQL = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in DIRTY.items()) + " FROM events"


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(*[f"{e} AS {n}" for n, e in DIRTY.items()])


@query("strip_strings", f"SELECT event_id, trim(kind, {WHITE}) AS kind, trim(note, {WHITE}) AS note FROM ({DIRTY_SQL})")
def strip_strings(spark, sf):
    return tl.strip_strings(dirty(spark, sf))


@query(
    "sentinel_null",
    f"SELECT event_id, nullif(trim(kind, {WHITE}), '?') AS kind, nullif(trim(note, {WHITE}), '?') AS note FROM ({DIRTY_SQL})",
)
def sentinel_null(spark, sf):
    return tl.tokens_to_null(tl.strip_strings(dirty(spark, sf)), ["?"])


@query(
    "drop_empty_rows",
    f"""SELECT kind, note FROM (SELECT nullif(trim(kind, {WHITE}), '?') AS kind, nullif(trim(note, {WHITE}), '?') AS note
        FROM ({DIRTY_SQL})) WHERE kind IS NOT NULL OR note IS NOT NULL""",
)
def drop_empty_rows(spark, sf):
    return tl.drop_empty_rows(tl.tokens_to_null(tl.strip_strings(dirty(spark, sf)), ["?"]).drop("event_id"))


@query("label_clean", f"SELECT event_id, regexp_replace(trim(kind, {WHITE}), '\\.+$', '') AS kind FROM ({DIRTY_SQL})")
def label_clean(spark, sf):
    return dirty(spark, sf).select("event_id", tl.clean_label(F.col("kind")).alias("kind"))


@query("positional_names", "SELECT r_regionkey AS id, r_name AS label FROM region")
def positional_names(spark, sf):
    return tl.column_names(table(spark, sf, "region"), ["id", "label"])


@query("feature_view", "SELECT o_totalprice, o_orderpriority, o_orderstatus FROM orders")
def features_only(spark, sf):
    return tl.feature_view(table(spark, sf, "orders"), ORDERS)


@query("select_numeric", "SELECT p_partkey, p_size, p_retailprice FROM part")
def select_numeric(spark, sf):
    return tl.select_class(table(spark, sf, "part"), "numeric")


@query("select_categorical", "SELECT p_name, p_brand, p_type FROM part")
def select_categorical(spark, sf):
    return tl.select_class(table(spark, sf, "part"), "categorical")


# ---------------------------------------------------------------- reshape and rank

CROSSTAB_SQL = "SELECT o_orderpriority, " + ", ".join(
    f"""count(*) FILTER (o_orderstatus = '{s}') AS "{s}" """ for s in "FOP"
) + " FROM orders GROUP BY o_orderpriority"


@query("crosstab", CROSSTAB_SQL)
def crosstab(spark, sf):
    return tl.crosstab(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus")


@query(
    "crosstab_pct",
    "SELECT o_orderpriority, s AS o_orderstatus, round_even(100.0::DOUBLE * n / total, 6) AS pct FROM ("
    + union_all(
        """SELECT o_orderpriority, '{c}' AS s, count(*) FILTER (o_orderstatus = '{c}') AS n, count(*) AS total
           FROM orders GROUP BY o_orderpriority""",
        ["F", "O", "P"],
    )
    + ")",
)
def crosstab_pct(spark, sf):
    return rounded(tl.crosstab_pct(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus"), 6)


@query(
    "crosstab_long",
    f"""SELECT flag, status, count(*) AS n FROM ({GAPS_SQL})
        WHERE flag IS NOT NULL AND status IS NOT NULL GROUP BY flag, status""",
)
def crosstab_long(spark, sf):
    return tl.crosstab_long(with_gaps(spark, sf), "flag", "status")


@query(
    "melt",
    union_all(
        """SELECT c_custkey, '{c}' AS variable, CAST({c} AS DOUBLE) AS value FROM customer""",
        ["c_nationkey", "c_acctbal"],
    ),
)
def melt(spark, sf):
    wide = table(spark, sf, "customer").withColumn("c_nationkey", F.col("c_nationkey").cast("double"))
    return tl.melt(wide, ["c_custkey"], ["c_nationkey", "c_acctbal"], "variable", "value")


@query("first_rows", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def first_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return tl.first_rows(orders, ["o_orderkey"], 5)


@query(
    "top_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def top_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return tl.top_rows(orders, F.col("o_totalprice"), ["o_orderkey"], 10)


@query(
    "top_per_group",
    """SELECT c_mktsegment, c_custkey, c_acctbal, CAST(rank AS INTEGER) AS rank FROM (
         SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rank
         FROM customer) WHERE rank <= 4""",
)
def top_per_group(spark, sf):
    customers = table(spark, sf, "customer").select("c_mktsegment", "c_custkey", "c_acctbal")
    return tl.top_per_group(customers, ["c_mktsegment"], "c_acctbal", ["c_custkey"], 4)


# ---------------------------------------------------------------- statistics

PAIRS = [(i, j) for i in range(4) for j in range(4)]


def _corr_sql(columns: list[str], source: str, pairs: list[tuple[int, int]], digits: int) -> str:
    return " UNION ALL ".join(
        f"""SELECT {i} AS i, {j} AS j, '{columns[i]}' AS column_a, '{columns[j]}' AS column_b,
            round_even(corr({columns[i]}, {columns[j]}), {digits}) AS r FROM {source}"""
        for i, j in pairs
    )


@query("corr_matrix", _corr_sql(MEASURES, "lineitem", PAIRS, 6))
def corr_matrix(spark, sf):
    return rounded(tl.correlation_matrix(table(spark, sf, "lineitem"), MEASURES), 6)


@query(
    "corr_with_gaps",
    f"WITH raw AS ({GAPS_SQL}) " + _corr_sql(["quantity", "discount"], "raw", [(0, 1)], 6),
)
def corr_with_gaps(spark, sf):
    return rounded(tl.correlations(with_gaps(spark, sf)), 6)


# Fourteen columns: offsets, and gaps that follow another column, huge where it is missing.
WIDE = {
    f"w{k}": f"CASE WHEN l_partkey % 5 = {k % 5} THEN NULL WHEN l_partkey % 5 = {(k + 1) % 5} THEN 1e7 + l_orderkey "
    f"ELSE {MEASURES[k % 4]} * {k + 1} + {10**k % 999_983} END"
    for k in range(14)
}
WIDE_SQL = "SELECT " + ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in WIDE.items()) + " FROM lineitem"


@query(
    "corr_wide",
    f"WITH raw AS ({WIDE_SQL}) " + _corr_sql(list(WIDE), "raw", [(i, j) for i in range(14) for j in range(i + 1, 14)], 6),
)
def corr_wide(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr(*[f"CAST({e} AS DOUBLE) AS {n}" for n, e in WIDE.items()])
    return rounded(tl.correlations(rows), 6)


@query(
    "top_corr",
    "SELECT * FROM ("
    + _corr_sql(MEASURES, "lineitem", [(i, j) for i, j in PAIRS if i < j], 3)
    + ") ORDER BY abs(r) DESC, i, j LIMIT 5",
)
def top_corr(spark, sf):
    return rounded(tl.top_correlations(tl.correlations(table(spark, sf, "lineitem"), MEASURES)), 3)


@query(
    "group_moments",
    """SELECT l_returnflag, count(l_quantity) AS n, round_even(avg(l_quantity), 6) AS mean,
              round_even(var_samp(l_quantity), 6) AS var FROM lineitem GROUP BY l_returnflag""",
)
def group_moments(spark, sf):
    return rounded(tl.group_moments(table(spark, sf, "lineitem"), "l_quantity", "l_returnflag"), 6)


WELCH = ["group_a", "group_b", "mean_a", "mean_b", "n_a", "n_b", "t_stat", "df"]
WELCH_SQL = """
SELECT {by} a.status AS group_a, b.status AS group_b, round_even(a.m, 6) AS mean_a, round_even(b.m, 6) AS mean_b,
  a.n AS n_a, b.n AS n_b, round_even((a.m - b.m) / sqrt(a.v / a.n + b.v / b.n), 6) AS t_stat,
  round_even(pow(a.v / a.n + b.v / b.n, 2) /
    (pow(a.v / a.n, 2) / (a.n - 1) + pow(b.v / b.n, 2) / (b.n - 1)), 4) AS df
FROM m a JOIN m b ON {on} a.status < b.status
"""


def _moments_sql(by: str) -> str:
    return f"""WITH raw AS ({GAPS_SQL}), m AS (SELECT {by} status, count(quantity) AS n,
      avg(quantity) AS m, var_samp(quantity) AS v FROM raw WHERE status IS NOT NULL GROUP BY {by} status) """


def _welch_shown(tested: DataFrame, by: list[str]) -> DataFrame:
    shown = tested.withColumn("df", F.bround("df", 4))
    digits = {c: F.bround(c, 6).alias(c) for c in ("mean_a", "mean_b", "t_stat")}
    return shown.select(*by, *[digits.get(c, F.col(c)) for c in WELCH])


@query("welch_t", _moments_sql("") + WELCH_SQL.format(by="", on=""))
def welch_t(spark, sf):
    return _welch_shown(tl.welch_t(with_gaps(spark, sf), "quantity", "status"), [])


@query("welch_t_by", _moments_sql("flag,") + WELCH_SQL.format(by="a.flag,", on="a.flag IS NOT DISTINCT FROM b.flag AND"))
def welch_t_by(spark, sf):
    return _welch_shown(tl.welch_t(with_gaps(spark, sf), "quantity", "status", by=["flag"]), ["flag"])


VERDICT = """p_value < 0.05 AS significant, round_even(p_value, 8) AS p_value, p_text,
  'p=' || p_text || CASE WHEN p_value < 0.05 THEN ' < 0.05: H0 rejected, '
    ELSE ' >= 0.05: H0 kept, no evidence that ' END || {claim} AS interpretation"""
WELCH_CLAIM = "'the mean of l_extendedprice differs between ''F'' and ''O'' '"
# The t tail by Simpson's rule over the density.
T_TAIL_SQL = """WITH m AS (SELECT l_returnflag, l_linestatus AS g, count(*) AS n, avg(l_extendedprice) AS m,
  var_samp(l_extendedprice) / count(*) AS e FROM lineitem GROUP BY l_returnflag, l_linestatus),
t AS (SELECT a.l_returnflag, a.n AS n_a, b.n AS n_b, abs(a.m - b.m) / sqrt(a.e + b.e) AS t,
        pow(a.e + b.e, 2) / (pow(a.e, 2) / (a.n - 1) + pow(b.e, 2) / (b.n - 1)) AS df
      FROM m a JOIN m b ON a.l_returnflag = b.l_returnflag AND a.g < b.g),
d AS (SELECT l_returnflag, n_a, n_b, t, df, CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
        * pow(1 + pow(i * t / 2000, 2) / df, -(df + 1) / 2) AS y FROM t, range(2001) r(i)),
s AS (SELECT l_returnflag, n_a, n_b, 1 - 2 * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi())
        * t / 6000 * sum(y) AS p_value FROM d GROUP BY l_returnflag, n_a, n_b, t, df),
p AS (SELECT *, format('{:.4g}', p_value) AS p_text FROM s)
SELECT l_returnflag, n_a, n_b, """
T_TAIL_SQL += VERDICT.format(claim=f"trim({WELCH_CLAIM})") + " FROM p"


@query("welch_t_verdict", T_TAIL_SQL)
def welch_t_verdict(spark, sf):
    """The p-value of the test, as number, text and sentence."""
    rows = table(spark, sf, "lineitem")
    tested = tl.welch_t(rows, "l_extendedprice", "l_linestatus", by=["l_returnflag"])
    shown = ["l_returnflag", "n_a", "n_b", "significant", "p_value", "p_text", "interpretation"]
    return rounded(tested.select(*shown), 8)


CHI2_SQL = """
WITH o AS ({cells}), r AS (SELECT a, sum(o) AS rn FROM o GROUP BY a), c AS (SELECT b, sum(o) AS cn FROM o GROUP BY b),
g AS (SELECT r.a, c.b, coalesce(o.o, 0)::DOUBLE AS o,
        r.rn::DOUBLE * c.cn::DOUBLE / (SELECT sum(o) FROM o)::DOUBLE AS e
      FROM r CROSS JOIN c LEFT JOIN o ON o.a = r.a AND o.b = c.b),
d AS (SELECT (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS dof FROM g)
SELECT '{a}' AS col_a, '{b}' AS col_b,
  round_even(sum(CASE WHEN dof = 1 THEN pow(greatest(abs(o - e) - 0.5, 0), 2) / e ELSE pow(o - e, 2) / e END), {digits}) AS chi2,
  CAST(max(dof) AS BIGINT) AS dof FROM g, d
"""


def _chi2_sql(source: str, a: str, b: str, digits: int = 4) -> str:
    cells = f"SELECT {a} AS a, {b} AS b, count(*) AS o FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY {a}, {b}"
    return CHI2_SQL.format(cells=cells, a=a, b=b, digits=digits)


def _chi2(df: DataFrame, a: str, b: str) -> DataFrame:
    return tl.chi2_independence(df, a, b).select("col_a", "col_b", F.bround("chi2", 4).alias("chi2"), "dof")


@query("chi2_yates", _chi2_sql("labels", "quality", "toxic"))
def chi2_yates(spark, sf):
    return _chi2(table(spark, sf, "labels"), "quality", "toxic")


@query("chi2_rxc", _chi2_sql("orders", "o_orderpriority", "o_orderstatus"))
def chi2_rxc(spark, sf):
    return _chi2(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus")


@query("chi2_sparse", _chi2_sql("orders", "o_custkey", "o_orderdate"))
def chi2_sparse(spark, sf):
    """Most pairs of a customer and a day hold no row."""
    return _chi2(table(spark, sf, "orders"), "o_custkey", "o_orderdate")


# With eight degrees of freedom the tail is a finite sum.
CHI2_TAIL_SQL = "WITH x AS (" + _chi2_sql("orders", "o_orderpriority", "o_orderstatus", digits=15) + """),
p AS (SELECT *, exp(-chi2 / 2) * (1 + chi2 / 2 + pow(chi2 / 2, 2) / 2 + pow(chi2 / 2, 3) / 6) AS p_value FROM x),
q AS (SELECT *, format('{:.4g}', p_value) AS p_text FROM p)
SELECT col_a, col_b, dof, """
CHI2_TAIL_SQL += VERDICT.format(claim="'o_orderpriority and o_orderstatus are related'") + " FROM q"


@query("chi2_verdict", CHI2_TAIL_SQL)
def chi2_verdict(spark, sf):
    """The p-value of the test, as number, text and sentence."""
    tested = tl.chi2_independence(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus")
    shown = ["col_a", "col_b", "dof", "significant", "p_value", "p_text", "interpretation"]
    return rounded(tested.select(*shown), 8)


# ---------------------------------------------------------------- chart data


@query(
    "histogram",
    """WITH s AS (SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 30 AS w FROM events),
    e AS (SELECT i, CASE WHEN i = 30 THEN hi ELSE lo + i * w END AS a FROM range(31) t(i), s),
    b AS (SELECT x.i AS bin, x.a AS bin_start, y.a AS bin_end FROM e x JOIN e y ON y.i = x.i + 1),
    g AS (SELECT DISTINCT event_type FROM events)
    SELECT g.event_type, CAST(b.bin AS INTEGER) AS bin, round_even(b.bin_start, 6) AS bin_start,
      round_even(b.bin_end, 6) AS bin_end, count(v.value) AS n
    FROM g CROSS JOIN b LEFT JOIN events v ON v.event_type = g.event_type
      AND v.value >= b.bin_start AND (v.value < b.bin_end OR (b.bin = 29 AND v.value <= b.bin_end))
    GROUP BY g.event_type, b.bin, b.bin_start, b.bin_end""",
)
def histogram(spark, sf):
    return rounded(tl.histogram(table(spark, sf, "events"), "value", "event_type"), 6)


@query(
    "kde",
    """WITH v AS (SELECT event_type, value, count(*) AS n FROM events GROUP BY event_type, value),
    s AS (SELECT event_type, count(*) AS total, min(value) AS lo, (max(value) - min(value)) / 199 AS w,
            stddev_samp(value) * pow(count(*)::DOUBLE, -0.2::DOUBLE) AS h FROM events GROUP BY event_type),
    g AS (SELECT s.*, i, lo + i * w AS x FROM s, range(200) t(i))
    SELECT g.event_type, CAST(g.i AS INTEGER) AS point, round_even(max(g.x), 6) AS x,
      round_even(sum(v.n * exp(-pow((g.x - v.value) / g.h, 2) / 2)) / max(total * h * sqrt(2 * pi())), 8) AS density
    FROM g JOIN v ON v.event_type = g.event_type GROUP BY g.event_type, g.i""",
)
def kde(spark, sf):
    curve = tl.density_curve(table(spark, sf, "events"), "value", "event_type")
    return curve.select(
        "event_type", "point", F.bround("x", 6).alias("x"), F.bround("density", 8).alias("density")
    )


BOX_CTE = """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type),
f AS (SELECT e.event_type, value, q1, median, q3, q1 - (q3 - q1) * 1.5::DOUBLE AS lo, q3 + (q3 - q1) * 1.5::DOUBLE AS hi
      FROM events e JOIN q ON q.event_type = e.event_type),
b AS (SELECT event_type, count(*) AS n, least(min(value) FILTER (value >= lo), q1) AS whisker_low, q1, median, q3,
        greatest(max(value) FILTER (value <= hi), q3) AS whisker_high,
        CAST(count(*) FILTER (value < lo) AS BIGINT) AS n_below, CAST(count(*) FILTER (value > hi) AS BIGINT) AS n_above
      FROM f GROUP BY event_type, q1, median, q3)
"""


@query(
    "boxplot",
    BOX_CTE
    + """SELECT event_type, n, round_even(whisker_low, 6) AS whisker_low, round_even(q1, 6) AS q1,
         round_even(median, 6) AS median, round_even(q3, 6) AS q3, round_even(whisker_high, 6) AS whisker_high,
         n_below, n_above FROM b""",
)
def boxplot(spark, sf):
    return rounded(tl.box_plot(table(spark, sf, "events"), "value", "event_type"), 6)


@query(
    "outliers",
    BOX_CTE
    + """SELECT e.event_type, e.value AS x, count(*) AS n FROM events e JOIN b ON b.event_type = e.event_type
         WHERE e.value < whisker_low OR e.value > whisker_high GROUP BY e.event_type, e.value""",
)
def outliers(spark, sf):
    return tl.outliers(table(spark, sf, "events"), "value", "event_type")


# ---------------------------------------------------------------- evaluation

GUESS = {
    "actual": "l_linestatus",
    "predicted": "CASE WHEN l_quantity * 2 + l_linenumber + CASE WHEN l_linestatus = 'F' THEN 17 ELSE 0 END > 60 "
    "THEN 'F' ELSE 'O' END",
    "score": "l_extendedprice / 1000 + CASE WHEN l_linestatus = 'F' THEN 7 ELSE 0 END",
}
GUESS_SQL = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in GUESS.items()) + " FROM lineitem"


def guesses(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in GUESS.items()])


THREE = {
    "actual": "l_returnflag",
    "predicted": "CASE WHEN l_partkey % 3 = 0 THEN l_returnflag WHEN l_suppkey % 2 = 0 THEN 'A' ELSE 'X' END",
}
THREE_SQL = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in THREE.items()) + " FROM lineitem"


def three_way(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in THREE.items()])


CLASS_CTE = """WITH g AS ({source}), l AS (SELECT DISTINCT actual AS label FROM g UNION SELECT DISTINCT predicted FROM g),
s AS (SELECT label, (SELECT count(*) FROM g WHERE actual = label AND predicted = label)::DOUBLE AS tp,
  (SELECT count(*) FROM g WHERE actual = label) AS support, (SELECT count(*) FROM g WHERE predicted = label) AS guessed
  FROM l),
p AS (SELECT label, CASE WHEN guessed = 0 THEN 0 ELSE tp / guessed END AS precision,
  CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall, 2 * tp / (support + guessed) AS f1,
  CAST(support AS BIGINT) AS support, tp FROM s)
"""


@query(
    "confusion",
    f"""WITH g AS ({THREE_SQL}), l AS (SELECT DISTINCT actual AS v FROM g UNION SELECT DISTINCT predicted FROM g)
    SELECT a.v AS actual, p.v AS predicted,
      (SELECT count(*) FROM g WHERE g.actual = a.v AND g.predicted = p.v) AS n FROM l a CROSS JOIN l p""",
)
def confusion(spark, sf):
    return tl.confusion(three_way(spark, sf), "actual", "predicted")


@query(
    "class_report",
    CLASS_CTE.format(source=THREE_SQL)
    + """SELECT 0 AS position, label, round_even(precision, 6) AS precision, round_even(recall, 6) AS recall,
           round_even(f1, 6) AS f1, support FROM p
         UNION ALL SELECT 1, 'accuracy', NULL, NULL, round_even(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM p
         UNION ALL SELECT 2, 'macro avg', round_even(avg(precision), 6), round_even(avg(recall), 6),
           round_even(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM p
         UNION ALL SELECT 3, 'weighted avg', round_even(sum(precision * support) / sum(support), 6),
           round_even(sum(recall * support) / sum(support), 6), round_even(sum(f1 * support) / sum(support), 6),
           CAST(sum(support) AS BIGINT) FROM p""",
)
def class_report(spark, sf):
    cells = tl.confusion(three_way(spark, sf), "actual", "predicted")
    return rounded(tl.classification_report(cells), 6)


@query(
    "f1_scores",
    CLASS_CTE.format(source=GUESS_SQL)
    + """SELECT round_even(sum(tp) / sum(support), 6) AS accuracy, round_even(avg(f1), 6) AS f1_macro,
           round_even(max(f1) FILTER (label = 'F'), 6) AS f1_positive FROM p""",
)
def f1_scores(spark, sf):
    return rounded(tl.scores(tl.confusion(guesses(spark, sf), "actual", "predicted"), "F"), 6)


AUC_SQL = """WITH c AS (SELECT score, count(*) FILTER (actual = 'F') AS pos, count(*) FILTER (actual <> 'F') AS neg
  FROM ({source}) GROUP BY score),
w AS (SELECT pos, neg, sum(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) - neg / 2.0::DOUBLE AS below FROM c)
SELECT round_even(sum(pos * below) / (sum(pos)::DOUBLE * sum(neg)::DOUBLE), 6) AS roc_auc,
  CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM w"""


@query("roc_auc", AUC_SQL.format(source=GUESS_SQL))
def roc_auc(spark, sf):
    return rounded(tl.roc_auc(guesses(spark, sf), "score", F.col("actual") == "F"), 6)


TIED_SQL = GUESS_SQL.replace("l_extendedprice / 1000", "l_linenumber * 2")


@query("roc_auc_ties", AUC_SQL.format(source=TIED_SQL))
def roc_auc_ties(spark, sf):
    tied = {**GUESS, "score": GUESS["score"].replace("l_extendedprice / 1000", "l_linenumber * 2")}
    rows = table(spark, sf, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in tied.items()])
    return rounded(tl.roc_auc(rows, "score", F.col("actual") == "F"), 6)


# ---------------------------------------------------------------- split and features

QUOTA_CTE = """WITH c AS (SELECT o_orderstatus AS label, count(*) AS n FROM orders GROUP BY o_orderstatus),
t AS (SELECT sum(n)::BIGINT AS total, (sum(n) - ceil(0.2 * sum(n)))::BIGINT AS n_train FROM c),
s AS (SELECT label, n, (n * n_train) // total AS whole, (n * n_train) % total AS rest, n_train FROM c, t),
u AS (SELECT *, row_number() OVER (ORDER BY rest DESC, label) AS pick, n_train - sum(whole) OVER () AS spare FROM s),
quota AS (SELECT label, n, n - whole - CASE WHEN pick <= spare THEN 1 ELSE 0 END AS n_test FROM u)
"""


def _by_md5() -> F.Column:
    digits = F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


@query(
    "strat_split",
    QUOTA_CTE
    + """SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus
           ORDER BY ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 15))::BIGINT) <= n_test AS is_test
         FROM orders JOIN quota ON label = o_orderstatus""",
)
def strat_split(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return tl.stratified_split(orders, "o_orderstatus", key=["o_orderkey"], order=_by_md5())


@query(
    "strat_split_counts",
    QUOTA_CTE
    + "SELECT label, CAST(n - n_test AS BIGINT) AS n_train, CAST(n_test AS BIGINT) AS n_test FROM quota",
)
def strat_split_counts(spark, sf):
    """No key is given: rows are numbered first, and copies part."""
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority")
    split = tl.stratified_split(orders, "o_orderstatus")
    return split.groupBy(F.col("o_orderstatus").alias("label")).agg(
        F.count_if(~F.col("is_test")).alias("n_train"), F.count_if(F.col("is_test")).alias("n_test")
    )


PARTS = {
    "p_partkey": "p_partkey",
    "size": "CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_size END",
    "price": "p_retailprice",
    "kind": "CASE WHEN p_partkey % 8 = 0 THEN NULL WHEN p_partkey % 60 = 7 THEN concat(p_brand, p_type) ELSE p_type END",
    "brand": "p_brand",
    "train": "p_partkey % 5 <> 0 AND p_brand <> 'Brand#7'",
}
PARTS_SQL = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in PARTS.items()) + " FROM part"


def parts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(*[f"{e} AS {n}" for n, e in PARTS.items()])


@query(
    "scaled",
    f"""WITH p AS ({PARTS_SQL}), m AS (SELECT quantile_cont(size, 0.5) AS sm, quantile_cont(price, 0.5) AS pm FROM p WHERE train),
    f AS (SELECT p_partkey, train, coalesce(size::DOUBLE, sm) AS size, coalesce(price, pm) AS price FROM p, m),
    s AS (SELECT avg(size) AS sa, stddev_pop(size) AS ss, avg(price) AS pa, stddev_pop(price) AS ps FROM f WHERE train)
    SELECT p_partkey, round_even((size - sa) / ss, 6) AS num__size, round_even((price - pa) / ps, 6) AS num__price FROM f, s""",
)
def scaled(spark, sf):
    rows = parts(spark, sf)
    prep = NumericPrep(inputCols=["size", "price"], outputCols=["num__size", "num__price"])
    fitted = prep.fit(rows.where("train"))
    return rounded(fitted.transform(rows).select("p_partkey", "num__size", "num__price"), 6)


ONEHOT_SQL = f"""WITH p AS ({PARTS_SQL}),
f AS (SELECT train, coalesce(kind, (SELECT kind FROM p WHERE train AND kind IS NOT NULL GROUP BY kind
        ORDER BY count(*) DESC, kind LIMIT 1)) AS kind, brand FROM p),
v AS (SELECT train, 'cat__kind' AS c, kind AS v FROM f UNION ALL SELECT train, 'cat__brand', brand FROM f),
l AS (SELECT c, v, count(*) AS n FROM v WHERE train GROUP BY c, v),
s AS (SELECT c, v, CASE WHEN n >= 10 THEN c || '_' || v ELSE c || '_infrequent' END AS feature FROM l)
SELECT s.feature, CAST(count(*) AS BIGINT) AS n FROM v JOIN s ON s.c = v.c AND s.v = v.v GROUP BY s.feature"""


@query("onehot_counts", ONEHOT_SQL)
def onehot_counts(spark, sf):
    """Rows per encoded level: rare levels pooled, unseen ones nowhere."""
    rows = parts(spark, sf)
    stages = feature_stages(["size", "price"], ["kind", "brand"])
    encoded = Pipeline(stages=stages).fit(rows.where("train")).transform(rows)
    counts = encoded.select(F.explode(vector_places(F.col("features"))).alias("position")).groupBy("position").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(feature_table(encoded), "position").where(F.col("feature").startswith("cat__")).select("feature", "n")


MANY_LEVELS = {
    "line": "concat(l_orderkey, '-', l_linenumber % 3)",
    "order": "cast(l_orderkey AS string)",
    "price": "cast(cast(round(l_extendedprice * 100) AS bigint) AS string)",
    "part": "concat(l_partkey, '/', l_suppkey % 5)",
}


@query(
    "onehot_many_levels",
    f"""WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey % 5 <> 0 AS train, {", ".join(f"{e} AS v{i}" for i, e in enumerate(MANY_LEVELS.values()))} FROM lineitem),
    v AS ({" UNION ALL ".join(f"SELECT l_orderkey, l_linenumber, train, {i} AS c, v{i} AS v FROM r" for i in range(len(MANY_LEVELS)))}),
    l AS (SELECT c, v, count(*) AS n FROM v WHERE train GROUP BY c, v),
    f AS (SELECT c, v, row_number() OVER (PARTITION BY c ORDER BY v) - 1 AS slot FROM l WHERE n >= 2),
    k AS (SELECT c, count(*) FILTER (WHERE n >= 2) AS f, max(CASE WHEN n < 2 THEN 1 ELSE 0 END) AS rare FROM l GROUP BY c),
    o AS (SELECT c, f, sum(f + rare) OVER (ORDER BY c) - (f + rare) AS low FROM k)
    SELECT v.l_orderkey, CAST(count(l.v) AS BIGINT) AS n_places,
      CAST(coalesce(sum(CASE WHEN l.v IS NOT NULL THEN o.low + coalesce(f.slot, o.f) END), 0) AS BIGINT) AS places
    FROM v JOIN o ON o.c = v.c LEFT JOIN l ON l.c = v.c AND l.v = v.v LEFT JOIN f ON f.c = v.c AND f.v = v.v
    GROUP BY v.l_orderkey""",
)
def onehot_many_levels(spark, sf):
    """Four columns of more levels than lines, all but the most frequent 1,000 met in one shuffle."""
    rows = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey % 5 <> 0 AS train", *[f"{e} AS {n}" for n, e in MANY_LEVELS.items()]
    )
    slots = [f"slot__{c}" for c in MANY_LEVELS]
    levels = CategoryLevels(inputCols=list(MANY_LEVELS), outputCols=slots, minFrequency=2, headLevels=1000)
    encoded = Pipeline(stages=[levels, FeatureVector(slots=slots, outputCol="features")]).fit(rows.where("train")).transform(rows)
    places = vector_places(F.col("features"))
    total = F.aggregate("places", F.lit(0).cast("long"), lambda a, x: a + x)
    each = encoded.select("l_orderkey", places.alias("places")).select("l_orderkey", F.size("places").alias("n"), total.alias("places"))
    return each.groupBy("l_orderkey").agg(F.sum("n").alias("n_places"), F.sum("places").alias("places"))


@query(
    "category_slots",
    f"""WITH p AS ({PARTS_SQL}), l AS (SELECT brand, count(*) AS n FROM p WHERE train GROUP BY brand),
    s AS (SELECT brand, row_number() OVER (ORDER BY brand) - 1 AS slot FROM l WHERE n >= 10),
    k AS (SELECT (SELECT count(*) FROM s) AS f, (SELECT count(*) FROM l WHERE n < 10) AS rare)
    SELECT p_partkey, CAST(CASE WHEN s.slot IS NOT NULL THEN s.slot
      WHEN l.brand IS NOT NULL THEN f ELSE f + CASE WHEN rare > 0 THEN 1 ELSE 0 END END AS DOUBLE) AS slot
    FROM p LEFT JOIN s ON s.brand = p.brand LEFT JOIN l ON l.brand = p.brand, k""",
)
def category_slots(spark, sf):
    rows = parts(spark, sf)
    fitted = CategoryLevels(inputCols=["brand"], outputCols=["slot"]).fit(rows.where("train"))
    return fitted.transform(rows).select("p_partkey", "slot")


@query(
    "class_weights",
    """SELECT event_type, count(*) AS n, round_even((SELECT count(*) FROM events)::DOUBLE /
         ((SELECT count(DISTINCT event_type) FROM events) * count(*)), 6) AS weight FROM events GROUP BY event_type""",
)
def class_weights(spark, sf):
    weighted = with_class_weight(table(spark, sf, "events").select("event_type"), "event_type")
    return rounded(
        weighted.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight")), 6
    )


# ---------------------------------------------------------------- sources and sinks

ORDER_TEXT = {
    "o_orderkey": "cast(o_orderkey AS string)",
    "o_orderstatus": "CASE WHEN o_custkey % 6 = 0 THEN '?' WHEN o_custkey % 6 = 1 THEN concat('  ', o_orderstatus) "
    "WHEN o_custkey % 6 = 2 THEN concat(chr(9), o_orderstatus, chr(160)) WHEN o_custkey % 6 = 3 THEN '   ' ELSE o_orderstatus END",
    "o_totalprice": "CASE WHEN o_orderkey % 10 = 0 THEN '?' ELSE cast(o_totalprice AS string) END",
    "o_orderpriority": "CASE WHEN o_custkey % 4 = 0 THEN concat(o_orderpriority, ' ') ELSE o_orderpriority END",
}
ORDER_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)
SCAN_SQL = """SELECT o_orderkey, CASE WHEN o_custkey % 6 IN (0, 3) THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice, o_orderpriority FROM orders"""


_ORDER_FILES: dict[tuple[str, str], str] = {}


def order_file(spark: SparkSession, sf: str) -> str:
    """The orders as untidy delimited text, written once by Spark to the shared folder."""
    known = (spark.sparkContext.applicationId, sf)
    if known in _ORDER_FILES and _exists(spark, _ORDER_FILES[known]):
        return _ORDER_FILES[known]
    texts = table(spark, sf, "orders").selectExpr(*[f"{e} AS {n}" for n, e in ORDER_TEXT.items()])
    path = staging_path(spark, "orders-text")
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "quoteAll": True}
    texts.write.options(**keep).csv(path)
    _ORDER_FILES[known] = path
    return path


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


@query("scan_delimited", SCAN_SQL)
def scan_delimited(spark, sf):
    return tl.read_delimited(spark, order_file(spark, sf), ORDER_SCHEMA)


@query("scan_tolerant", SCAN_SQL)
def scan_tolerant(spark, sf):
    return tl.read_tolerant(spark, order_file(spark, sf), ORDER_SCHEMA)


@query(
    "reconcile",
    f"""WITH o AS ({SCAN_SQL}), f AS (SELECT count(*) AS n, count(*) - count(o_orderkey) AS k,
      count(*) - count(o_orderstatus) AS s, count(*) - count(o_totalprice) AS t,
      count(*) - count(o_orderpriority) AS p FROM o)
    SELECT metric, position, v AS left_value, v AS right_value, true AS equal FROM (
      SELECT 0 AS position, 'n_rows' AS metric, n AS v FROM f UNION ALL SELECT 1, 'n_cols', 4::BIGINT
      UNION ALL SELECT 2, 'n_null', k + s + t + p FROM f UNION ALL SELECT 3, 'fingerprint', NULL
      UNION ALL SELECT 4, 'n_null:o_orderkey', k FROM f UNION ALL SELECT 5, 'n_null:o_orderstatus', s FROM f
      UNION ALL SELECT 6, 'n_null:o_totalprice', t FROM f UNION ALL SELECT 7, 'n_null:o_orderpriority', p FROM f)""",
)
def reconcile(spark, sf):
    """Both readers on one file; the hash itself is left blank, only its verdict is kept."""
    path = order_file(spark, sf)
    left, right = (read(spark, path, ORDER_SCHEMA) for read in (tl.read_delimited, tl.read_tolerant))
    facts = tl.reconcile(left, right)
    shown = [
        F.when(F.col("metric") != "fingerprint", F.col(c)).cast("long").alias(c)
        for c in ("left_value", "right_value")
    ]
    return facts.select("metric", "position", *shown, "equal")


@query(
    "reconcile_unequal",
    """SELECT metric, position, left_value, right_value, left_value = right_value AS equal FROM (
      SELECT 'n_rows' AS metric, 0 AS position, count(*) AS left_value, count(*) AS right_value FROM orders
      UNION ALL SELECT 'n_cols', 1, 2, 2
      UNION ALL SELECT 'n_null', 2, 0, count(*) FILTER (WHERE o_orderkey = (SELECT min(o_orderkey) FROM orders)) FROM orders
      UNION ALL SELECT 'n_null:o_orderkey', 4, 0, 0
      UNION ALL SELECT 'n_null:o_totalprice', 5, 0, count(*) FILTER (WHERE o_orderkey = (SELECT min(o_orderkey) FROM orders)) FROM orders)
    UNION ALL SELECT 'fingerprint', 3, NULL, NULL, false""",
)
def reconcile_unequal(spark, sf):
    """One value of one row is missing on the right."""
    left = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    first = left.agg(F.min("o_orderkey")).scalar()
    right = left.withColumn("o_totalprice", F.when(F.col("o_orderkey") != first, F.col("o_totalprice")))
    facts = tl.reconcile(left, right)
    shown = [F.when(F.col("metric") != "fingerprint", F.col(c)).cast("long").alias(c) for c in ("left_value", "right_value")]
    return facts.select("metric", "position", *shown, "equal")


@query("parquet_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def parquet_roundtrip(spark, sf):
    path = staging_path(spark, "customer")
    tl.write_table(table(spark, sf, "customer"), path, ("c_mktsegment",))
    back = spark.read.parquet(path)
    return back.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


# ---------------------------------------------------------------- model and whole run

SMALL = tl.ForestSize(trees=10, depth=5)

LINES = TableSpec(
    schema=T.StructType([]),
    target="l_linestatus",
    positive_label="O",
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    categorical=("l_returnflag",),
    ttest_value="l_quantity",
    chi2_column="l_returnflag",
    histogram_column="l_quantity",
    bar_column="l_returnflag",
    bar_means={"avg_quantity": "l_quantity"},
)
ORDERS = TableSpec(
    schema=ORDER_SCHEMA,
    target="o_orderstatus",
    positive_label="F",
    numeric=("o_totalprice",),
    categorical=("o_orderpriority",),
    ttest_value="o_totalprice",
    chi2_column="o_orderpriority",
    histogram_column="o_totalprice",
    bar_column="o_orderpriority",
    bar_means={"avg_price": "o_totalprice"},
)


LEARNABLE = "CASE WHEN l_quantity + CASE WHEN l_returnflag = 'A' THEN 15 ELSE 0 END > 35 THEN 'O' ELSE 'F' END"


@query(
    "rf_quality",
    """SELECT CAST(count(*) - ceil(0.2 * count(*)) AS BIGINT) AS n_train, CAST(ceil(0.2 * count(*)) AS BIGINT) AS n_test,
       true AS accurate, true AS ranked FROM lineitem""",
)
def rf_quality(spark, sf):
    """Train and evaluate on a label that follows from the features: exact sizes, high scores."""
    rows = table(spark, sf, "lineitem").withColumn("l_linestatus", F.expr(LEARNABLE))
    found = tl.train_and_evaluate(rows, LINES, size=SMALL)
    row = found.scores.first()
    return found.sizes.withColumns(
        {"accurate": F.lit(row["accuracy"] > 0.85), "ranked": F.lit(row["roc_auc"] > 0.9)}
    )


# Test rows per class by largest remainder, as the split gives them.
QUOTA_SQL = """WITH c AS (SELECT {label} AS label, count(*) AS n FROM {source} GROUP BY 1),
t AS (SELECT sum(n)::BIGINT AS total, (sum(n) - ceil(0.2 * sum(n)))::BIGINT AS train FROM c),
s AS (SELECT label, n, n * train // total AS whole, n * train % total AS rest, train FROM c, t),
q AS (SELECT label, n - whole - CASE WHEN row_number() OVER (ORDER BY rest DESC, label)
        <= train - (SELECT sum(whole) FROM s) THEN 1 ELSE 0 END AS n_test FROM s)"""


@query(
    "rf_report",
    QUOTA_SQL.format(label="o_orderstatus", source="orders")
    + """ SELECT 0 AS position, label, n_test::BIGINT AS support, true AS in_range, true AS agrees FROM q
    UNION ALL SELECT p, l, (SELECT sum(n_test) FROM q)::BIGINT, true, true
      FROM (VALUES (1, 'accuracy'), (2, 'macro avg'), (3, 'weighted avg')) v(p, l)""",
)
def rf_report(spark, sf):
    """Rows, exact supports, and whether the measures agree with the confusion cells."""
    found = tl.train_and_evaluate(table(spark, sf, "orders"), ORDERS, size=SMALL, key=["o_orderkey"])
    report = tl.stage(found.report, "report")
    cells = found.confusion.agg(
        (F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy")
    ).scalar()
    measures = [F.col(m).isNull() | F.col(m).between(0.0, 1.0) for m in ("precision", "recall", "f1")]
    macro = report.where("position = 0").agg(F.avg("f1")).scalar()
    agrees = (
        F.when(F.col("label") == "accuracy", F.abs(F.col("f1") - cells) < 1e-12)
        .when(F.col("label") == "macro avg", F.abs(F.col("f1") - macro) < 1e-12)
        .otherwise(True)
    )
    return report.select("position", "label", "support", (measures[0] & measures[1] & measures[2]).alias("in_range"), agrees.alias("agrees"))


@query(
    "feature_importance",
    """SELECT feature, true AS positive, true AS adds_up, feature = 'num__l_quantity' AS first FROM (
      SELECT unnest(['num__l_quantity', 'num__l_extendedprice', 'num__l_discount', 'num__l_tax']) AS feature
      UNION ALL SELECT 'cat__l_returnflag_' || l_returnflag FROM lineitem GROUP BY l_returnflag HAVING count(*) >= 10)""",
)
def feature_importance(spark, sf):
    """On a label that follows from the quantity: names, order and sum of the importances."""
    rows = table(spark, sf, "lineitem").withColumn("l_linestatus", F.expr(LEARNABLE))
    found = tl.feature_importance(tl.fit_model(rows, LINES, SMALL), rows, top_n=100)
    total, most = found.agg(F.sum("importance"), F.max("importance")).first()
    return found.select(
        "feature", (F.col("importance") >= 0).alias("positive"), F.lit(abs(total - 1) < 1e-9).alias("adds_up"),
        (F.col("importance") == most).alias("first"),
    )


@query(
    "validation",
    """SELECT * FROM (VALUES
      ('t-test groups', 'a t-test takes two groups, found ' || (SELECT count(DISTINCT o_orderstatus) FROM orders)),
      ('chi-square column', 'nothing'), ('features', 'nothing'), ('target', 'target column not found'),
      ('missing labels', 'o_orderstatus contains missing values')) v(call, message)""",
)
def validation(spark, sf):
    """Bad calls on the orders, and what each says."""
    orders = table(spark, sf, "orders")
    gaps = orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")))
    calls = {
        "t-test groups": lambda: tl.welch_t(orders, "o_totalprice", "o_orderstatus").collect(),
        "chi-square column": lambda: tl.chi2_independence(orders, "o_orderstatus", "nothing").collect(),
        "features": lambda: tl.select_class(orders, "nothing").collect(),
        "target": lambda: tl.train_and_evaluate(orders.drop("o_orderstatus"), ORDERS, size=SMALL),
        "missing labels": lambda: tl.train_and_evaluate(gaps, ORDERS, size=SMALL),
    }
    known = ("a t-test takes two groups, found %d" % orders.select("o_orderstatus").distinct().count(),
             "target column not found", "o_orderstatus contains missing values", "nothing")
    rows = []
    for name, call in calls.items():
        try:
            call()
            said = "no error"
        except Exception as e:  # noqa: BLE001 - the messages are what is looked at
            said = next((k for k in known if k in str(e)), str(e)[:80])
        rows.append((name, said))
    return spark.createDataFrame(rows, "call string, message string")


@query(
    "many_classes",
    """SELECT CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS customer, count(*) AS n,
         round_even((SELECT count(*) FROM orders)::DOUBLE / ((SELECT count(DISTINCT CASE WHEN o_orderkey % 3 = 0 THEN 0
           ELSE o_custkey END) FROM orders) * count(*)), 6) AS weight FROM orders GROUP BY 1""",
)
def many_classes(spark, sf):
    """Class weights of as many classes as customers, one of which has a third of the rows."""
    rows = table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(F.col("o_custkey")).alias("customer")
    )
    weighted = with_class_weight(rows, "customer").groupBy("customer")
    return rounded(weighted.agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight")), 6)


@query(
    "outliers_many_groups",
    """WITH r AS (SELECT l_orderkey // 2 AS pair, l_quantity AS x FROM lineitem),
    q AS (SELECT pair, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM r GROUP BY pair),
    b AS (SELECT pair, least(min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) THEN x END), any_value(q1)) AS low,
            greatest(max(CASE WHEN x <= q3 + 1.5 * (q3 - q1) THEN x END), any_value(q3)) AS high FROM r JOIN q USING (pair) GROUP BY pair)
    SELECT pair, x, count(*) AS n FROM r JOIN b USING (pair) WHERE x < low OR x > high GROUP BY pair, x""",
)
def outliers_many_groups(spark, sf):
    rows = table(spark, sf, "lineitem").select((F.floor(F.col("l_orderkey") / 2)).alias("pair"), "l_quantity")
    return tl.outliers(rows, "l_quantity", "pair")


@query("reload_check", "SELECT count(*) AS n_rows, true AS reload_ok FROM orders")
def reload_check(spark, sf):
    rows = table(spark, sf, "orders")
    model = tl.fit_model(rows, ORDERS, SMALL)
    path = tl.save_model(model, staging_path(spark, "model"))
    same = tl.verify_reload(path, model, rows, ORDERS.positive_label)
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("reload_ok", F.lit(same))


_DESCRIBED = " UNION ALL ".join(
    f"SELECT 'describe' AS s, 'count' AS m, count({c})::DOUBLE AS v FROM {t} UNION ALL SELECT 'describe', 'mean', avg({c}) FROM {t} "
    f"UNION ALL SELECT 'describe', 'median', quantile_cont({c}, 0.5) FROM {t} UNION ALL SELECT 'describe', 'max', max({c}) FROM {t}"
    for c in MEASURES
    for t in ("raw", "c")
)
REPORTED = {
    "shape": ("n_rows", "n_cols"), "duplicates": ("n_duplicates",), "target": ("n", "pct"), "describe": ("count", "mean", "median", "max"),
    "majority": ("majority_share",), "history": ("dropped_duplicates", "filled_categorical", "filled_numeric"),
    "contingency": ("n",), "ratio": ("pct",), "bars": ("count", "avg_quantity"), "correlation": ("r",), "split": ("n_train", "n_test"),
}


@query(
    "report_table",
    f"""WITH raw AS (SELECT {', '.join(MEASURES)}, l_returnflag, l_linestatus FROM lineitem), c AS (SELECT DISTINCT * FROM raw),
    k AS (SELECT count(*)::DOUBLE AS n FROM raw), kc AS (SELECT count(*)::DOUBLE AS n FROM c), x AS (
      SELECT 'shape' AS s, 'n_rows' AS m, n AS v FROM k UNION ALL SELECT 'shape', 'n_cols', 6
      UNION ALL SELECT 'duplicates', 'n_duplicates', k.n - kc.n FROM k, kc
      UNION ALL SELECT 'target', 'n', count(*) FROM raw GROUP BY l_linestatus
      UNION ALL SELECT 'target', 'pct', count(*) * 100 / (SELECT n FROM k) FROM raw GROUP BY l_linestatus
      UNION ALL {_DESCRIBED}
      UNION ALL SELECT 'majority', 'majority_share', max(n) FROM (SELECT count(*) / (SELECT n FROM k) AS n FROM raw GROUP BY l_linestatus)
      UNION ALL SELECT 'history', 'dropped_duplicates', k.n - kc.n FROM k, kc
      UNION ALL SELECT 'history', m, 0 FROM (VALUES ('filled_categorical'), ('filled_numeric')) h(m)
      UNION ALL SELECT 'contingency', 'n', count(*) FROM c GROUP BY l_returnflag, l_linestatus
      UNION ALL SELECT 'ratio', 'pct', 100.0 * count(*) / sum(count(*)) OVER (PARTITION BY l_returnflag) FROM c GROUP BY l_returnflag, l_linestatus
      UNION ALL SELECT 'bars', 'count', count(*) FROM c GROUP BY l_returnflag, l_linestatus
      UNION ALL SELECT 'bars', 'avg_quantity', avg(l_quantity) FROM c GROUP BY l_returnflag, l_linestatus
      UNION ALL SELECT 'correlation', 'r', r FROM ({_corr_sql(MEASURES, "c", PAIRS, 9)})
      UNION ALL SELECT 'split', 'n_train', n - ceil(0.2 * n) FROM kc UNION ALL SELECT 'split', 'n_test', ceil(0.2 * n) FROM kc)
    SELECT s AS section, m AS metric, count(*) AS items, round_even(sum(v), 3) AS total FROM x GROUP BY s, m
    UNION ALL SELECT 'model', 'reload_ok', 1, 1""",
)
def all_results(spark, sf):
    """Every stage on lineitem, small forest, read back from the report it wrote: items and
    totals of each metric that has SQL, and whether the saved model answers as before."""
    done = tl.run(
        spark, LINES, table(spark, sf, "lineitem").select(*LINES.features, LINES.target),
        staging_path(spark, "run"), size=SMALL,
    )
    report = spark.read.parquet(done.report_path)
    wanted = F.lit(False)
    for section, metrics in REPORTED.items():
        wanted = wanted | (F.col("section") == section) & F.col("metric").isin(*metrics)
    totals = report.where(wanted).groupBy("section", "metric").agg(F.count(F.lit(1)).alias("items"), F.sum("value_num").alias("total"))
    saved = report.where("section = 'model' AND metric = 'reload_ok'").select(
        "section", "metric", F.lit(1).cast("long").alias("items"), F.when(F.col("value_str") == "true", 1.0).otherwise(0.0).alias("total")
    )
    return rounded(totals.unionByName(saved), 3)
