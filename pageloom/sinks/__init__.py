"""Writers and the rows they write."""
