"""Repair, model, check and score observation tables on Spark."""
