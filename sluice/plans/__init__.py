"""Plans: the six table specs (tables), runs (run), the CLI job (job), registered queries and oracles."""
