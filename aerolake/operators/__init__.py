"""DataFrame in, DataFrame out; nothing here starts a job by itself."""
