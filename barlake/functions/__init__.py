"""Column-level building blocks (built-in Spark expressions only)."""

from barlake.functions.numeric import (  # noqa: F401
    PRICE_TYPE, RETURN_TYPE, half_up_ratio, micro_units,
)
from barlake.functions.text import strip_whitespace  # noqa: F401
from barlake.functions.windows import series_window, calculate_sma, rolling_mean  # noqa: F401
