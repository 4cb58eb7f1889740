"""reelframe: film-catalogue analytics as lazy Spark DataFrame operators.

Layers: ``sources`` (raw schema, CSV reader, typed view, film view over the
driver tables), ``functions`` (column helpers), ``operators`` (analyses and
chart shapes), ``sinks`` (encodings and writers), ``plans`` (intermediate
storage, plan checks), ``catalog`` (registered queries with oracle SQL).
"""

__version__ = "0.1.0"
