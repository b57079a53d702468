"""Point-event hotspot analytics on Spark DataFrames."""

from kerbscope.operators.cleaning import clean_events
from kerbscope.operators.profiles import hour_profile, month_hour_profile
from kerbscope.operators.windows import walk_forward_windows
from kerbscope.plans import views
from kerbscope.plans.backtest import backtest, metric_means
from kerbscope.plans.model import (
    best_blend,
    candidate_backtest,
    final_ranking,
    hybrid_backtest,
    prepare,
    weight_search,
)
from kerbscope.plans.ranking import (
    hotspots,
    rank_hotspots,
    run_summary,
    shift_plan,
    station_summary,
    top_hotspots,
)
from kerbscope.settings import CleanSettings
from kerbscope.sources.violations import read_violations

__all__ = [
    "CleanSettings",
    "backtest",
    "best_blend",
    "candidate_backtest",
    "clean_events",
    "final_ranking",
    "hotspots",
    "hour_profile",
    "hybrid_backtest",
    "metric_means",
    "month_hour_profile",
    "prepare",
    "rank_hotspots",
    "read_violations",
    "run_summary",
    "shift_plan",
    "station_summary",
    "top_hotspots",
    "views",
    "walk_forward_windows",
    "weight_search",
]
