"""Source specifications, the standardisation plan, pipelines and marts."""
