"""The stored tables and the views over them, as temporary views for ad-hoc SQL."""

from __future__ import annotations

from namelens.functions.sql import register_functions
from namelens.plans.baseline import low_confidence, person_clean, unmatched_report
from namelens.sources.tables import KEYED, PER_BATCH, Tables


def register_views(tables: Tables) -> list[str]:
    """Register everything that is stored, the derived views and the SQL functions.

    A view shows a keyed table as it is now; register again to see later versions.
    """
    register_functions(tables.spark)
    views = {name: tables.read(name) for name in KEYED if tables.has(name) or KEYED[name]}
    views |= {name: tables.read_people(name) for name in PER_BATCH}
    views["person_clean"] = person_clean(views["person_input"])
    views["vw_model_improvement_low_confidence"] = low_confidence(views["improvement_store"])
    views["vw_model_improvement_agg_unmatched_low_quality"] = unmatched_report(
        views["improvement_store"]
    )
    for name, rows in views.items():
        rows.createOrReplaceTempView(name)
    return sorted(views)
