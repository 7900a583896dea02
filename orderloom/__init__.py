"""Event reconciliation on Spark: orders, payments and inventory joined per order."""
