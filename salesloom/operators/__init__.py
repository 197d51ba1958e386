"""DataFrame-to-DataFrame building blocks shared by the marts."""
