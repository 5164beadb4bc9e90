"""Announcement analytics on Spark: text, place, time and label queries as DataFrame programs."""
