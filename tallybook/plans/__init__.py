"""Plans: whole runs put together from the operators."""
