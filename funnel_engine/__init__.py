"""Spark-native marketing-funnel and retention analytics.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from
built-in Spark expressions; see ``operators``, ``sources``, ``plans`` and
``sinks``.
"""

__version__ = "0.1.0"
