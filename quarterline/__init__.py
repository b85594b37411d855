"""quarterline: periodic financial facts across many entities, on Spark.

Every public function takes DataFrames (or a SparkSession plus a data
directory) and returns a DataFrame.  Nothing is collected to the driver and
no Python UDF is used; the work is expressed with DataFrame / SQL operators so
Catalyst can prune, push down and plan the shuffles.
"""

__version__ = "0.1.0"
