"""Structured Streaming jobs.

Jobs with batch output keep their state in the tables they write, one folder per
micro-batch, so output and state cannot drift apart on a restart.
"""
