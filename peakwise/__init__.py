"""Tandem mass spectrum identification as Spark DataFrame operators.

Spectra live in one of two shapes:

* *records*: one row per spectrum with ``peaks ARRAY<STRUCT<mz, intensity>>``.  What an MSP
  file holds.  Every per-spectrum step is a column expression, so cleaning and
  featurising records never shuffles.
* *peak rows*: one row per peak.  What pooling replicates produces, because one structure
  may own a third of all spectra and must never be gathered into a single row.
"""

import sys

from pyspark import cloudpickle

# The few Python tasks (embedding, tile ranking) are shipped by value, so executors need
# pyspark, numpy and pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
