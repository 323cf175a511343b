"""Loading the warehouse into a relational database."""
