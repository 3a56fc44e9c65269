"""Operators over tables on a time axis. Each takes a DataFrame and column names and returns a DataFrame.

Windows are partitioned by the keys given, usually one recording or one entity, and ordered by the columns
given; a unique last order column makes results repeatable.
"""
