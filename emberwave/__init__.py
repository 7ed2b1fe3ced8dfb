"""emberwave: a Spark-native analytics engine for transient searches in beam data."""
