"""Restart-safe ingestion of partitioned, offset-addressed record logs on Spark.

Everything is a DataFrame transformation over the columns in ``schemas``:
restore contiguous offset order per topic-partition, find and declare gaps,
split and conform payloads, account for every offset and derive the commit
frontier from which a new run resumes.
"""
