"""Payment-transaction analytics on Spark: reconciliation, user features, fraud rules."""
