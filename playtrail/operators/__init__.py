from playtrail.operators.counted import (
    games_by_city_from_counts,
    games_by_month_from_counts,
    hours_from_counts,
    phone_models_from_counts,
)
from playtrail.operators.geo import CityRanges, measure_ranges, most_specific_ranges, with_city
from playtrail.operators.keyed import from_cells, latest_per_key, to_cells, upsert, with_row_key
from playtrail.operators.reports import (
    phone_model_times,
    top_games_by_city,
    top_games_by_month,
    visits_by_hour,
)
from playtrail.operators.topn import top_n, top_n_per_group

__all__ = [
    "CityRanges",
    "from_cells",
    "games_by_city_from_counts",
    "games_by_month_from_counts",
    "hours_from_counts",
    "latest_per_key",
    "measure_ranges",
    "most_specific_ranges",
    "phone_model_times",
    "phone_models_from_counts",
    "to_cells",
    "top_games_by_city",
    "top_games_by_month",
    "top_n",
    "top_n_per_group",
    "upsert",
    "visits_by_hour",
    "with_city",
    "with_row_key",
]
