"""trackside — train-movement analytics on Spark.

Feed frames are decoded into movements, landed in a London-date partitioned
lake, loaded one day at a time into a typed movements table, exposed through
staging and operating-company views, and summarised by the punctuality,
operator, station, route, hourly, daily and scorecard queries in
``trackside.operators.analytics``.  Everything is a DataFrame -> DataFrame
function built from native Spark expressions.
"""

__version__ = "0.1.0"
