"""Plans for the landed and the silver tables, and the jobs that write them."""
