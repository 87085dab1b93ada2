from hourwise.functions.columns import (  # noqa: F401
    trunc_hour, epoch_seconds, ratio, stable_id,
    seconds_between, ceil_hour, truthy, round_doubles, null_safe_differs, within_tolerance,
)
