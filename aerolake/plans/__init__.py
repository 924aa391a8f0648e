"""Jobs that move data from landed files to gold tables."""
