"""revrecon: clinic revenue, billing reconciliation and ledger analytics on Spark DataFrames.

Every operator is a function from DataFrames to a DataFrame. Nothing here collects facts to the
driver; plans stay declarative so that Catalyst and AQE choose the physical strategy.
"""

__version__ = "0.1.0"
