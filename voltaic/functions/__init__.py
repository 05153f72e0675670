"""Column expressions (JVM-side, codegen-friendly); no Python UDFs."""

from voltaic.functions.calendar import (  # noqa: F401
    calendar_columns, day_name, forecast_horizon_hours, hour_of_day, is_peak_hour, is_weekend, local_time,
)
from voltaic.functions.measures import (  # noqa: F401
    curtailment, forecast_error, forecast_error_pct, pct_of,
)
from voltaic.functions.classify import POINT_RULES, classify_point  # noqa: F401
