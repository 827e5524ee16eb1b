"""Reusable DataFrame operators shared by the load jobs and the reports."""
