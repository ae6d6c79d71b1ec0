"""tessera: inspection-report feature engineering and imbalanced binary
classification, expressed as Spark DataFrame / pyspark.ml jobs.

Sub-packages
------------
sources    table scans, columnar-JSON ingest, catalog, lookup files, stage/sink
functions  column expressions (category buckets, rule classifiers, hashing)
operators  bridge joins, pivots, shares, feature attachment, profiles, stats
plans      declarative feature specs, master-table assembly, driver binding
ml         preparation, kNN / ADASYN, training, evaluation, imputation
streaming  applying the stateless scorers to Structured Streaming inputs
"""

__version__ = "0.1.0"
