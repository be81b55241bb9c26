"""tidegrid: PySpark-native operators for causal time-series and market-data analytics."""
