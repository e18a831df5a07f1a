"""tripkit: PySpark-native building blocks for trip-duration data.

Everything is DataFrame in, DataFrame out. The sub-packages are

* ``sources``   readers, version store, manifests, run metrics
* ``functions`` row-wise column expressions (time, geography, weather)
* ``operators`` relational operators (quality, enrichment, statistics, splits)
* ``plans``     compositions (features, preparation, profiling, training, scoring)
* ``streaming`` the same row-wise operators on unbounded input
"""

__version__ = "0.1.0"
