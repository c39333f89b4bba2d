"""appmart: a Spark-native batch analytics mart for mobile-app data.

Raw engagement, rating, install, subscription-trial and campaign-spend tables
are stamped with one run timestamp, conformed to two hashed natural-key
dimensions, merged into user/app and per-country marts, and measured with
per-table load statistics. Every operator takes and returns DataFrames or
Columns, so Catalyst plans the work and executors do it.
"""

__all__ = ["session", "schemas", "functions", "sources", "operators", "plans"]
