"""tillroll: retail basket analytics as Spark DataFrame jobs.

Every public operator takes and returns ``pyspark.sql.DataFrame`` (or
``Column``) objects.  The work runs as Catalyst expressions, joins,
aggregates and Spark ML's FPGrowth; there are no Python UDFs and no
driver-side collection of data.
"""

__version__ = "0.1.0"
