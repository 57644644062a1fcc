"""PySpark analytics jobs: cross-tabs, word counts, engagement scores, windowed
stream counts and model flows, each a function from DataFrames to a DataFrame."""
