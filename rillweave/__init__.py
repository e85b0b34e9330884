"""Spark-native multi-source record integration.

Layers, from the bottom up:

* ``functions``  column expressions (text, ids, dates, money, taxonomy, similarity)
* ``sources``    readers, schema alignment, quarantine and sinks
* ``operators``  DataFrame operators (survivorship, email merge, fuzzy match, quality, profile)
* ``plans``      the staged pipeline built from the operators
"""

from rillweave.config import IntegrationConfig

__all__ = ["IntegrationConfig"]
