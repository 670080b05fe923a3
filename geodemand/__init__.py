"""geodemand: place-and-day demand analytics as lazy Spark DataFrame operators.

Sub-packages:

* ``functions`` - column expressions (text, dates, geo, money, flags)
* ``sources``   - scans, sinks, typing, and the driver-table input roles
* ``operators`` - keyed picks, measures, nearest place, order lines,
                  features, quality checks, report views, model training
* ``plans``     - composite jobs: resolve customers, place-day sales and
                  weather, training table, weekday forecast, report, end-to-end
* ``queries``   - registered queries and their DuckDB oracle SQL
"""

__version__ = "0.1.0"
