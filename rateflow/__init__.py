"""rateflow: Spark jobs over aggregated rate observations.

A row is one bucket (period + coded dimensions) holding a volume, the part of
it that was affected, minutes lost, and a breakdown by cause.
"""
