"""Profiling, cleaning, testing and modelling of tables of any size, as Spark jobs."""

from tallyloom.functions.text import (
    clean_label,
    drop_empty_rows,
    strip_space,
    strip_strings,
    tokens_to_null,
)
from tallyloom.learning.metrics import (
    classification_report,
    confusion,
    per_class,
    roc_auc,
    scores,
)
from tallyloom.learning.model import (
    Evaluation,
    ForestSize,
    build_model,
    feature_importance,
    fit_model,
    predict,
    save_model,
    train_and_evaluate,
    verify_reload,
)
from tallyloom.learning.split import stratified_split
from tallyloom.operators.charts import box_plot, density_curve, histogram, outliers
from tallyloom.operators.clean import (
    Cleaned,
    clean,
    dedupe,
    imputation_impact,
    worst_impact,
)
from tallyloom.operators.profile import (
    by_count,
    categorical_profile,
    describe_numeric,
    dtypes,
    duplicate_count,
    eda_summary,
    group_summary,
    majority_share,
    null_profile,
    shape,
    target_share,
    total_nulls,
    value_counts,
)
from tallyloom.operators.rank import first_rows, medians, quantiles, top_per_group, top_rows
from tallyloom.operators.reconcile import reconcile
from tallyloom.operators.reshape import crosstab, crosstab_long, crosstab_pct, melt
from tallyloom.operators.stats import (
    chi2_independence,
    correlation_matrix,
    correlations,
    group_moments,
    top_correlations,
    welch_t,
)
from tallyloom.plans.run import Run, run
from tallyloom.sources.delimited import column_names, read_delimited, read_tolerant, write_delimited
from tallyloom.sources.tables import clear_staged, stage, staged_tables, write_table
from tallyloom.spec import (
    CENSUS_INCOME,
    TableSpec,
    feature_view,
    nan_to_null,
    rounded,
    select_class,
)

__all__ = [name for name in dir() if not name.startswith("_")]
