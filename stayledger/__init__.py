"""Booking analytics as Spark jobs: clean, split, profile, encode, score, monitor."""
