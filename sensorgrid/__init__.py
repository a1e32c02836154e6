"""Spark-native processing of particulate-sensor networks.

Every operator is a plain ``DataFrame -> DataFrame`` or ``Column -> Column``
function; the same function serves batch and Structured Streaming wherever
Spark allows it.
"""
