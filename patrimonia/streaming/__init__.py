"""Empty on purpose: the disclosure jobs are weekly batch runs and have no stream, state or late data."""
