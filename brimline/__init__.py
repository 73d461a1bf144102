"""Panel forecasting and backtesting for daily series, as PySpark DataFrame jobs."""
