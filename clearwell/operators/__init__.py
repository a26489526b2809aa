"""DataFrame in, DataFrame out; nothing here runs a job."""
