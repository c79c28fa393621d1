"""Layered (bronze, silver, gold) batch analytics for hourly and daily demand data on Spark."""
