"""cirrus: Spark-native analytics for time-stamped station readings.

Layout
------
sources/    raw line files, JSON readings, literal tables, driver tables, sinks
functions/  Column-expression builders (field parsing, time helpers, baselines, labels)
operators/  generic DataFrame operators (windows, sequences, ranking, joins, alerts)
plans/      the ten analytics bound to readings, the normalisation job, serving views
streaming/  Structured Streaming versions: jobs, keyed state as a stored table
"""

__version__ = "0.1.0"
