"""tabrix: DataFrame operators for the data side of supervised tabular ML on Spark.

Every operator takes and returns Spark DataFrames and is built from native
Spark expressions (no row-at-a-time Python UDFs). Sub-packages:

* ``sources``   – readers / writers for tables, reports and models
* ``functions`` – column-expression builders (nulls, text, dates)
* ``operators`` – quality checks, cleaning, splits, features, evaluation,
                  drift, promotion ledger, MLlib training and scoring
* ``plans``     – the registered queries over the driver tables
* ``streaming`` – Structured Streaming scoring
"""

from tabrix.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
