"""Aggregates over streams. The programs that the operators replace read no streams; what is here is the
same sums kept up to date while reads arrive, an extension of the batch operators."""
