"""jobtide — labour-demand analytics and forecasting as Spark DataFrame operators.

Canonical interfaces: a *spans* table ``(id, grp, start_ts, end_ts, weight)``
and a long *series* table ``(series, period, value)``.
"""

__version__ = "0.1.0"
