"""Screening and counting of card-transaction streams on Spark."""
