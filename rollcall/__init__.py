"""Attendance and absence analytics as plain PySpark DataFrame functions."""
