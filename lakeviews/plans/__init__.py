"""Plans: star binding, views, named queries, text jobs, catalogue, the full job."""
