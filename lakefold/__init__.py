"""lakefold: a layered document-to-insight pipeline expressed as Spark DataFrame plans.

Layers: ``sources`` land raw files and documents, ``plans.silver`` shreds them
into typed relational tables, ``plans.gold`` publishes detail and summary
datasets, ``plans.quality`` measures them, ``plans.sinks``/``plans.serving``
write and read them back.  Every function takes DataFrames and returns a
DataFrame so Catalyst sees one plan end to end.
"""

__all__ = ["session"]
