"""Operators a training-data pipeline needs, on Spark DataFrames; nothing else imports them."""
