"""barlake: a Spark-native analytics engine for daily price-and-volume bars.

Every operator is a plain function ``DataFrame -> DataFrame`` built from the
DataFrame / SQL API, so Catalyst plans it and the work runs distributed.
"""

__version__ = "0.1.0"
