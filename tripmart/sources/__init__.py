"""Readers for trips, zones and monthly deliveries, and the writers of every layer."""
