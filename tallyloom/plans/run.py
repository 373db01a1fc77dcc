"""The whole run: load, reconcile, profile, clean, chart data, tests, model, report table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.learning.model import (
    Evaluation,
    ForestSize,
    save_model,
    train_and_evaluate,
    verify_reload,
)
from tallyloom.operators.charts import box_plot, density_curve, histogram
from tallyloom.operators.clean import clean, imputation_impact, worst_impact
from tallyloom.operators.profile import (
    categorical_profile,
    describe_numeric,
    eda_summary,
    group_summary,
    long_rows,
    majority_share,
)
from tallyloom.operators.rank import first_rows
from tallyloom.operators.reconcile import reconcile
from tallyloom.operators.reshape import crosstab_long, crosstab_pct
from tallyloom.operators.stats import chi2_independence, correlation_matrix, top_correlations, welch_t
from tallyloom.sources.delimited import read_delimited, read_tolerant
from tallyloom.sources.tables import stage, write_table
from tallyloom.spec import TableSpec, col


@dataclass
class Run:
    """Results of the stages; the tables stay lazy until someone reads them."""

    raw: DataFrame
    cleaned: DataFrame
    results: dict[str, DataFrame] = field(default_factory=dict)
    evaluation: Evaluation | None = None
    model_path: str | None = None
    reload_ok: bool | None = None
    report_path: str | None = None


def item(*names: str) -> Column:
    return F.concat_ws(" | ", *[col(n).cast("string") for n in names])


def analyse(run: Run, spec: TableSpec) -> None:
    """Profile, clean, chart and test stages."""
    raw, cleaned, out = run.raw, run.cleaned, run.results
    out["eda"] = eda_summary(raw, spec.target)
    out["categorical_profile"] = categorical_profile(raw)
    out["majority"] = majority_share(raw, spec.target)
    out["impact"] = imputation_impact(raw, cleaned)
    out["worst_impact"] = worst_impact(out["impact"])
    out["histogram"] = histogram(cleaned, spec.histogram_column, spec.target)
    out["density"] = density_curve(cleaned, spec.histogram_column, spec.target)
    out["box_plot"] = box_plot(cleaned, spec.ttest_value, spec.target)
    out["ratio"] = crosstab_pct(cleaned, spec.chi2_column, spec.target)
    out["bars"] = group_summary(cleaned, [spec.bar_column, spec.target], spec.bar_means)
    out["describe"] = describe_numeric(cleaned)
    out["correlation"] = correlation_matrix(cleaned)
    pairs = out["correlation"].where(F.col("i") < F.col("j"))
    out["top_correlations"] = top_correlations(pairs)
    out["welch_t"] = welch_t(cleaned, spec.ttest_value, spec.target)
    out["chi2"] = chi2_independence(cleaned, spec.chi2_column, spec.target)
    out["contingency"] = crosstab_long(cleaned, spec.chi2_column, spec.target)


def report_table(run: Run, spec: TableSpec) -> DataFrame:
    """All stage results in one long table ``(section, item, metric, value_num, value_str)``."""
    out, parts = run.results, []

    def add(name: str, label: Column, metrics: Sequence[str], table: DataFrame | None = None) -> None:
        parts.append(long_rows(out[name] if table is None else table, name, label, metrics))

    if "reconcile" in out:
        add("reconcile", item("metric"), ["left_value", "right_value", "equal"])
    parts.append(out["eda"])
    add("categorical_profile", item("column", "rank"), ["n_unique", "value", "pct"])
    add("majority", F.lit(spec.target), ["majority_share"])
    add("history", F.lit("table"), out["history"].columns)
    impact = ["mode", "n_filled", "before_pct", "after_pct", "delta_pp"]
    add("impact", item("column"), impact)
    add("worst_impact", item("column"), impact)
    add("histogram", item(spec.target, "bin"), ["bin_start", "bin_end", "n"])
    add("density", item(spec.target, "point"), ["x", "density"])
    add("box_plot", item(spec.target), [c for c in out["box_plot"].columns if c != spec.target])
    add("ratio", item(spec.chi2_column, spec.target), ["pct"])
    add("bars", item(spec.bar_column, spec.target), ["count", *spec.bar_means])
    add("describe", item("column"), ["count", "mean", "std", "min", "q1", "median", "q3", "max"])
    add("correlation", item("column_a", "column_b"), ["r"])
    add("top_correlations", item("column_a", "column_b"), ["r"])
    add("welch_t", item("value_col", "group_col"), [c for c in out["welch_t"].columns[3:]])
    add("chi2", item("col_a", "col_b"), [c for c in out["chi2"].columns[3:]])
    add("contingency", item(spec.chi2_column, spec.target), ["n"])
    if run.evaluation is not None:
        e = run.evaluation
        add("split", F.lit("rows"), ["n_train", "n_test"], e.sizes)
        add("scores", F.lit("test"), e.scores.columns, e.scores)
        add("classification_report", item("label"), ["precision", "recall", "f1", "support"], e.report)
        add("confusion", item("actual", "predicted"), ["n"], e.confusion)
        add("importance", item("feature"), ["importance"], e.importance)
        checked = e.sizes.select(F.lit(run.reload_ok).alias("reload_ok"), F.lit(run.model_path).alias("path"))
        add("model", F.lit("saved"), ["reload_ok", "path"], checked)
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def run(
    spark: SparkSession,
    spec: TableSpec,
    source: str | DataFrame,
    out: str,
    test_size: float = 0.2,
    size: ForestSize | None = ForestSize(),
) -> Run:
    """Run all stages over a delimited file, or over a table already loaded.

    Writes ``cleaned``, ``model`` and ``report`` below ``out``. The cleaned table is read
    back from there, so later stages scan single columns. Values are filled over all
    rows before the split, as one table serves every stage; ``train_and_evaluate`` on
    unfilled rows fits its fills on the training rows. ``size=None`` leaves the model out.
    """
    results: dict[str, DataFrame] = {}
    if isinstance(source, str):
        raw = stage(read_delimited(spark, source, spec.schema, spec.null_tokens), "raw")
        tolerant = read_tolerant(spark, source, spec.schema, spec.null_tokens)
        results["reconcile"] = reconcile(raw, tolerant)
    else:
        raw = source
    tidy = clean(raw, spec.target)
    results["history"] = tidy.history
    path = write_table(tidy.table, f"{out}/cleaned")
    cleaned = spark.read.schema(tidy.table.schema).parquet(path)
    done = Run(raw=raw, cleaned=cleaned, results=results)
    analyse(done, spec)
    if size is not None:
        done.evaluation = train_and_evaluate(cleaned, spec, test_size, size)
        done.model_path = save_model(done.evaluation.model, f"{out}/model")
        sample = first_rows(cleaned, cleaned.columns, 5).select(*[col(c) for c in spec.features])
        done.reload_ok = verify_reload(
            done.model_path, done.evaluation.model, sample, spec.positive_label
        )
    done.report_path = write_table(report_table(done, spec), f"{out}/report")
    return done
