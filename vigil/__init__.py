"""vigil — labelled-tabular classification analytics on Spark DataFrames.

Every operator takes and returns DataFrames and is built from Spark SQL expressions,
windows, joins and Spark ML stages.  Sub-packages:

* ``sources``   — typed CSV / Parquet readers, sinks, model persistence, run ids
* ``functions`` — column expressions (relabelling, thresholds, arg-max, keyed hashes)
* ``operators`` — encoding, scaling, ranks and splits, neighbours, SMOTE, metrics,
                  history analytics, selectors, models
* ``plans``     — the registered queries on the driver tables and their SQL oracles
* ``streaming`` — applying fitted models and confusion counts to streaming frames
"""

__version__ = "0.1.0"
