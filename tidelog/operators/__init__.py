"""DataFrame in, DataFrame out: windows, ordered scans, change feeds."""
