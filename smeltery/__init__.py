"""Spark-native refinement of messy tables into typed, ranked and model-ready ones.

The package is a set of DataFrame operators (``operators``, ``functions``),
readers and writers (``sources``) and flows that chain them (``plans``).
Nothing here creates a Spark session: the caller's session is always used.
"""

from smeltery.vocabulary import Vocabulary

__all__ = ["Vocabulary"]
