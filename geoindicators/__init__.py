"""Geographic indicators on Spark.

Turns yearly statistics tables into published indicators for a three-level
geography (sub-district, district, city).  Every operator is a function from
``DataFrame`` to ``DataFrame`` built from Spark SQL expressions, so Catalyst
plans the whole chain and nothing but the final action leaves the executors.
"""

from geoindicators.keys import Keys, OSLO_KEYS

__all__ = ["Keys", "OSLO_KEYS"]
