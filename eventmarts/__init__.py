"""Event marts: a social-event firehose turned into trustworthy daily tables on Spark.

Functions take and return DataFrames.  Keys, versions, tie-breaks and clocks are
arguments, so the same function serves a batch job, a micro-batch and a test.
"""
