"""Schedule and result analytics as Spark plans.

Every operator takes DataFrames and returns a DataFrame; nothing runs until
the caller acts on the result (sinks and streams excepted).
"""
