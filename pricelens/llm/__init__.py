"""Training-data pipeline operators.

Nothing else in the library imports this subpackage.  Every operator takes a
DataFrame plus column names, reads only those columns (so other columns may
carry any name) and returns its own columns.  Null texts count as empty,
repeated rows are scored one by one, and an empty table gives an empty result
with the same schema.
"""
