"""Where bars, reports and audit rows go."""
