"""tessera: review snapshot analytics on Spark."""
