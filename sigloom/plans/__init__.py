"""Pass chains, the pipeline text form and job reports."""
