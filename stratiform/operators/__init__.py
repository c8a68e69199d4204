"""stratiform: survey analytics on Spark."""
