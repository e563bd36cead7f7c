"""The warehouse: silver tables, dimensions, facts and the jobs that load them."""
