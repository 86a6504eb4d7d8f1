from lagscope.plans.marts import correlation_matrix, fact_from_series, key_kpi, kpi_from_fact, quarterly_fact
from lagscope.plans.models import MODEL_LAYERS, build_models, publish

__all__ = [
    "MODEL_LAYERS",
    "build_models",
    "correlation_matrix",
    "fact_from_series",
    "key_kpi",
    "kpi_from_fact",
    "publish",
    "quarterly_fact",
]
