"""marketlake: a Spark-native labour-market analytics engine.

Bronze source dumps -> silver contract -> gold star schema -> indicators,
expressed as DataFrame plans (see README.md).
"""

__version__ = "0.1.0"
