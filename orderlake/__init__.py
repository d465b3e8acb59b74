"""orderlake: a Spark-native medallion pipeline for invoice-line order events.

Bronze keeps every arrival, Silver keeps the latest row per key (last writer
wins), a declarative quality gate records failures and rejected rows, and Gold
holds the business aggregates the reports read. Every step is a DataFrame
transformation; only ``sources.tables`` and ``plans`` touch storage.
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
