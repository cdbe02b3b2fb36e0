"""riskforge: Spark-native feature engineering and evaluation for credit risk.

Every operator takes and returns DataFrames. Heavy work (scans, unpivots,
aggregations, joins, model fitting) runs on Spark; the driver only sees
small, bounded results such as bin edges, split cut keys and per-feature
metrics.
"""

__version__ = "0.1.0"
