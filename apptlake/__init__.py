"""Booking-attribution analytics as Spark jobs and DataFrame operators."""
