from .tables import load, TABLES  # noqa: F401
from .adapters import trades, ticks, trades_bulk  # noqa: F401
