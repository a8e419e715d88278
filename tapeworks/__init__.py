"""tapeworks: media-catalogue and localization data operators on Spark.

Operators live in ``tapeworks.operators`` (discovery, rules, timeline, jobs,
manifest, calendar, ordering), column helpers in ``tapeworks.functions``,
contracts, scans and sinks in ``tapeworks.sources``, streams in
``tapeworks.streaming`` and the registered queries in ``tapeworks.plans``.
"""

__version__ = "0.1.0"
