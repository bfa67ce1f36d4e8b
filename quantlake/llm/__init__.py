"""Training-data operators on Spark: packing, fingerprints, sharding, toxicity, mixing, URL rules,
near-duplicate joins, exact search and repeated-text removal.

Nothing else in the library imports this subpackage; ``__spark_entry__.py`` adds its queries only
when it is present.
"""

import sys

from pyspark import cloudpickle

# functions of this subpackage travel to the executors whole, so those need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
