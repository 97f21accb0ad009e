"""shelfcast: retail demand analytics as lazy Spark DataFrame plans.

Layers: ``sources`` (store tables, calendar, category documents, sinks),
``functions`` (column expressions, conditions), ``operators`` (views,
features, hierarchy, quality, exploration, insights, relational shapes),
``plans`` (mediated relations and the query catalog).
"""

from .sources.tables import SourceSet  # noqa: F401

__all__ = ["SourceSet"]
