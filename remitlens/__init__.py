"""remitlens — money-transfer analytics on Spark.

Transfers are turned into sender (OUT) and receiver (IN) fact rows placed by
province, district and quarter; reports (regional density and flows, district
risk, peak hours, growth, VIP customers, statements, ledger balances, quality
checks) are plain ``DataFrame -> DataFrame`` functions built from Spark SQL
expressions, so Catalyst plans every one of them.
"""

import sys

from remitlens.session import get_spark, scratch_path

# Python functions run by executors (the settlement fold, the streaming state
# function) are shipped by value, so Python workers need no installed copy of
# this package; on a cluster it works without --py-files as well.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError):  # older pyspark: ship the package with --py-files
    pass

__all__ = ["get_spark", "scratch_path"]
