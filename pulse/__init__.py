"""pulse: Spark-native analytics for streams of short text posts.

Every operator is a function from DataFrame(s) to DataFrame built on Spark SQL
and Structured Streaming.  Nothing in the library collects data to the driver;
callers decide what (small, finished) result to look at.

Layout
------
- ``pulse.sources``    reading tables and lines, JSON parsing, envelopes
- ``pulse.functions``  scalar column functions (labels, scores, text formats, time parsing)
- ``pulse.operators``  DataFrame -> DataFrame operators (ingest, windows, views)
- ``pulse.plans``      the registered queries over the test tables and their SQL oracles
- ``pulse.streaming``  Structured Streaming sources, sinks, triggers and query lifecycle
"""

__version__ = "0.1.0"
