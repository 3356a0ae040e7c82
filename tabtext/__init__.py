"""tabtext: Spark-native tabular + text classification operators.

Every operator is a DataFrame / Spark SQL / pyspark.ml job. Sub-packages:

* ``sources``   - case-JSON, CSV and vector readers, sinks, and the stand-in
                  tables built from the driver's parquet fixtures.
* ``functions`` - column expressions (report statistics, keyword flags,
                  n-gram generators, array helpers, F-distribution).
* ``operators`` - relational operators (joins, schema alignment, missing
                  data, medians, TF-IDF, encoding, selection, sampling,
                  metrics, probability calibration, models, tuning).
* ``plans``     - end-to-end pipelines composed from the operators.
* ``streaming`` - the stateless feature projections applied to a stream.
"""

__version__ = "0.1.0"
