"""Payments-ledger extracts expressed as Spark DataFrame plans."""
