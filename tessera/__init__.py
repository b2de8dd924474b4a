"""tessera: a PySpark-native analytics library.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function so that Catalyst sees one declarative plan per job.
"""

import sys as _sys

__version__ = "0.1.0"

# Python that runs on executors (the admission fold, the similarity UDF,
# streaming state functions) is shipped by value, so executors need not have
# this package installed or on their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: fall back to by-reference
    pass
