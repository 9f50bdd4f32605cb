"""Every operator and report as a runnable query with, where SQL can say it, its SQL twin."""
