"""Trip lakehouse jobs on Spark DataFrames.

Typical use::

    from tripmart.plans import Lakehouse, run_pipeline
    from tripmart.sources import read_zones_csv

    run_pipeline(spark, "s3://bucket/raw/taxi", "s3://bucket/lake", read_zones_csv(spark, zones_path))
"""
