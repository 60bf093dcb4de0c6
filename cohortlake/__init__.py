"""Credit-behaviour analytics as composable Spark DataFrame functions."""
