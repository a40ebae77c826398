"""millrace: analytics operators written on the Spark DataFrame and Structured Streaming APIs.

Every operator takes DataFrames and returns a DataFrame.  Nothing runs until the
caller acts on the result, except where a docstring says that an intermediate
table is written to the shared checkpoint folder.
"""
