"""learnstream: online-learning activity analytics as Spark DataFrame plans.

Feeds (registrations, practice answers, page views, video plays) are parsed
into typed DataFrames; every metric is a pure ``DataFrame -> DataFrame``
transform that serves batch queries, Structured Streaming aggregations and
``foreachBatch`` state merges alike.
"""

__version__ = "0.1.0"
