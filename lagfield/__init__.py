"""Monthly sales panels on Spark: panels, features, forecasters, back-tests."""
