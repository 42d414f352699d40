"""tessera — conformed reference and fact tables as Spark DataFrame operators.

Every public operator takes DataFrames (plus plain parameters) and returns a lazy
DataFrame. Nothing is collected to the driver except bounded, one-row results.
"""

__version__ = "0.1.0"
