"""Millrace: layered e-commerce warehouse jobs as PySpark DataFrame functions.

Raw change records and behaviour logs become keyed dimension tables, cleaned
fact tables and windowed summaries.  Every job is a function from DataFrames to
a DataFrame; jobs that need state have a batch form and a Structured Streaming
form behind one name.
"""
