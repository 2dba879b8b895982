"""wellspan: Spark-native analytics for plate-based, multi-channel measurement data."""
