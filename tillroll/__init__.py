"""Retail star-schema analytics on Spark.

Transaction files and a holiday calendar go in; a checked, keyed star schema
and its reports come out. Everything is DataFrame work planned by Catalyst.
"""
