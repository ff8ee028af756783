"""Spark-native ledger / processor reconciliation and journal posting."""
