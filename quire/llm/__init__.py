"""Training-data operators: sanitising, deduplication, scoring, packing, sharding.

Nothing outside this folder imports it.  Every operator takes DataFrames and
returns DataFrames; each module's docstring states how nulls, empty texts,
repeated rows and empty tables come out.
"""
