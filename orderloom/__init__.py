"""Order delivery, failing-order ledger, code remapping and reconciliation on Spark."""
