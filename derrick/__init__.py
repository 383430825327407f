"""derrick: Spark-native batch analytics for well production, forecasting,
equipment health and delivery logistics.

Every operator takes DataFrames and column names and returns a DataFrame.
Nothing here collects data-sized input to the driver.
"""

__version__ = "0.1.0"
