"""Curation of labelled image (or any embedded-item) datasets on Spark.

Layout: ``functions`` are column expressions, ``sources`` readers and writers,
``operators`` DataFrame -> DataFrame building blocks, ``plans`` the composed
steps of a curation run, ``streaming`` their incremental forms, and ``catalog``
the registered queries over the test tables.
"""

import sys

from pyspark import cloudpickle

# Arrow functions travel to the executors by value, so a cluster needs no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
