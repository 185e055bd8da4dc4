"""stopcast: Spark-native feature engineering, leak-free history, resampling,
temporal validation, model training and evaluation for transit-style app
events.  Every operator is a DataFrame -> DataFrame function built from
Spark SQL expressions, joins, aggregates and windows."""

__version__ = "0.1.0"
