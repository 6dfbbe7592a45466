"""Event normalisation, verified loading and reconciliation on PySpark."""
