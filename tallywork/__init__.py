"""Reconciliation and metric-definition operators for Spark.

Every operator takes DataFrames and returns a lazy DataFrame.  The sub-packages:

``functions``  column expressions (money, time, classification, aggregates, geography)
``operators``  DataFrame operators (dedup, rollup, definitions, bridges, quality, as-of FX)
``sources``    declared schemas, readers, versioned mart writer
``plans``      the four worked domains and the gated run that publishes them
``streaming``  replay dedup and daily usage over event streams
"""
