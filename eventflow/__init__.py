"""eventflow - event-flow analytics on Spark DataFrames.

An event is one row: ``headers: map<string,string>`` plus ``body: binary``.
Every operator is ``DataFrame -> DataFrame`` (or ``Column -> Column``) and works
on batch and streaming inputs alike.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Python tasks (packing, tail reader) carry their own code, so a job needs no
# separate --py-files step to find this package on the executors.
register_pickle_by_value(sys.modules[__name__])
