"""Link-gap analytics on web link graphs, as Spark DataFrame functions."""
