"""Named analytic queries as functions of DataFrames."""
