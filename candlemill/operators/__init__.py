"""Building blocks of the reports, each a DataFrame to DataFrame function."""
