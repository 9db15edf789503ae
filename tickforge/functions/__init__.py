from .columns import (as_of_max, bind_once, epoch_ms_to_ts, epoch_s_to_ts,  # noqa: F401
                      lookback_start, order_key, pct, resolve_as_of, safe_div, to_ntz)
