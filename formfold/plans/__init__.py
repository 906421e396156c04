"""Reports: compositions of operators, from input frames to report rows."""
