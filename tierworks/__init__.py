"""Governed bronze / silver / gold tables as ordinary Spark jobs.

The sub-packages follow the life of a row:

``sources``    readers, sinks, synthetic tables and table mirroring
``functions``  column expressions (tiers, masks, text, calendar)
``operators``  DataFrame -> DataFrame steps (quality, personal data, joins, ...)
``streaming``  incremental bronze tables, change application, feed consumers
``plans``      whole tables: refresh, governed publishing, audits, products
"""
