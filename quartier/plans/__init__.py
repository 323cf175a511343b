"""Reports over the star schema, summary tables and the jobs that build them."""
