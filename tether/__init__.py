"""Entity linking over web records and document tables, written as Spark jobs.

Every operator is a function from DataFrames (or Columns) to DataFrames (or Columns); nothing here starts a session, collects rows
to the driver or runs row-at-a-time Python.
"""
