"""DataFrame in, DataFrame out: the batch operators."""
